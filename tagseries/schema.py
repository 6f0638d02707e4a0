"""Canonical table layouts of the tag-history model."""

from pyspark.sql import types as T

SERIES = "series_name"
TS = "ts_ms"

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())

POINTS = T.StructType(
    [
        T.StructField("series_name", T.StringType()),
        T.StructField("measurement_uuid", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("value_num", T.DoubleType()),
        T.StructField("value_bool", T.BooleanType()),
        T.StructField("value_str", T.StringType()),
        T.StructField("quality_code", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("tags", _TEXT_MAP),
        T.StructField("seq", T.LongType()),
    ]
)

SPECS = T.StructType(
    [
        T.StructField("uom", T.StringType()),
        T.StructField("value_min", T.DoubleType()),
        T.StructField("value_max", T.DoubleType()),
        T.StructField("limit_lo", T.DoubleType()),
        T.StructField("limit_hi", T.DoubleType()),
    ]
)

MEASUREMENTS = T.StructType(
    [
        T.StructField("uuid", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("datatype", T.StringType()),
        T.StructField("database", T.StringType()),
        T.StructField("collector_uuid", T.StringType()),
        T.StructField("labels", T.ArrayType(T.StringType())),
        T.StructField("quality", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("description", T.StringType()),
        T.StructField("attributes", _TEXT_MAP),
        T.StructField("settings", _TEXT_MAP),
        T.StructField("is_calculation", T.BooleanType()),
        T.StructField("depends_on", T.ArrayType(T.StringType())),
        T.StructField("specs", SPECS),
    ]
)

ASSETS = T.StructType(
    [
        T.StructField("uuid", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("parent_uuid", T.StringType()),
        T.StructField("asset_path", T.StringType()),
        T.StructField("attributes", _TEXT_MAP),
        T.StructField("metadata", _TEXT_MAP),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

ASSET_PROPERTIES = T.StructType(
    [
        T.StructField("uuid", T.StringType()),
        T.StructField("asset_uuid", T.StringType()),
        T.StructField("measurement_uuid", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("datatype", T.StringType()),
    ]
)

REQUESTS = T.StructType(
    [
        T.StructField("qpath", T.StringType()),
        T.StructField("aggregate", T.StringType()),
    ]
)

PENDING_METADATA = T.StructType(
    [
        T.StructField("tag_path", T.StringType()),
        T.StructField("properties", _TEXT_MAP),
        T.StructField("seq", T.LongType()),
    ]
)

OP_LOG = T.StructType(
    [
        T.StructField("ts_ms", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("elapsed_ms", T.LongType()),
        T.StructField("is_error", T.BooleanType()),
    ]
)

STATISTICS = T.StructType(
    [
        T.StructField("collector_uuid", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("points_sent", T.LongType()),
        T.StructField("good_points", T.LongType()),
        T.StructField("bad_points", T.LongType()),
        T.StructField("buffer_size", T.LongType()),
        T.StructField("buffer_disk_flushes", T.LongType()),
        T.StructField("buffer_error_files", T.LongType()),
    ]
)

LOGS = T.StructType(
    [
        T.StructField("collector_uuid", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("level", T.StringType()),
        T.StructField("measurement_uuid", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)

HEALTH = T.StructType(
    [
        T.StructField("collector_uuid", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("health", T.StringType()),
    ]
)

# Log levels of the telemetry contract.
LOG_LEVELS = ["PANIC", "FATAL", "ERROR", "WARNING", "INFO", "DEBUG", "TRACE"]
