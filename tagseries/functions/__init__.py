from .aggregates import aggregate_function, supported_aggregates
from .ids import name_uuid, node_id
from .paths import (
    build_stored_path,
    extract_category,
    extract_component,
    folder_prefix,
    stored_path,
    strip_category,
)
from .time import bucket_start, format_period, parse_period, period_ms, relative_range, to_millis
from .values import (
    datatype_of,
    nan_to_null,
    quality_to_status,
    status_to_quality,
    tag_value,
    typed_value,
    value_type,
)

__all__ = [
    "aggregate_function",
    "bucket_start",
    "build_stored_path",
    "datatype_of",
    "extract_category",
    "extract_component",
    "folder_prefix",
    "format_period",
    "name_uuid",
    "nan_to_null",
    "node_id",
    "parse_period",
    "period_ms",
    "quality_to_status",
    "relative_range",
    "status_to_quality",
    "stored_path",
    "strip_category",
    "supported_aggregates",
    "tag_value",
    "to_millis",
    "typed_value",
    "value_type",
]
