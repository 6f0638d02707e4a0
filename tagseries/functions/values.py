"""Quality, datatype and value conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._columns import ColumnLike, col

# Quality thresholds with their status names, one representative code per
# status, and the value type that stands for each datatype.
GOOD_CODE = 192
UNCERTAIN_CODE = 64
BAD_CODE = 0
GOOD, UNCERTAIN, BAD = "Good", "Uncertain", "Bad"
BOOLEAN, NUMBER, STRING = "boolean", "number", "string"
VALUE_TYPES = {"boolean": "Boolean", "number": "Float8", "string": "String"}
DEFAULT_VALUE_TYPE = "Float8"
#: Point column of the datatypes that are no numbers.
VALUE_COLUMN = {BOOLEAN: "value_bool", STRING: "value_str"}
NOT_FOUND = "Bad_NotFound"
ACTIVE = "active"


def quality_to_status(code: ColumnLike) -> Column:
    return (
        F.when(col(code) >= GOOD_CODE, GOOD).when(col(code) >= UNCERTAIN_CODE, UNCERTAIN).otherwise(BAD)
    )


def status_to_quality(status: ColumnLike) -> Column:
    """Representative quality code; unknown and missing statuses read as good."""
    return (
        F.when(col(status) == UNCERTAIN, UNCERTAIN_CODE).when(col(status) == BAD, BAD_CODE).otherwise(GOOD_CODE)
    )


def datatype_of(
    num: ColumnLike = "value_num", boolean: ColumnLike = "value_bool", text: ColumnLike = "value_str"
) -> Column:
    """Datatype of a point's value; NULL when the point holds none."""
    return (
        F.when(col(boolean).isNotNull(), BOOLEAN)
        .when(col(num).isNotNull(), NUMBER)
        .when(col(text).isNotNull(), STRING)
    )


def value_type(datatype: ColumnLike) -> Column:
    """Value type shown for a node; unknown datatypes count as a float."""
    out = F.lit(DEFAULT_VALUE_TYPE)
    for name, shown in VALUE_TYPES.items():
        out = F.when(col(datatype) == name, shown).otherwise(out)
    return out


def has_value(
    num: ColumnLike = "value_num", boolean: ColumnLike = "value_bool", text: ColumnLike = "value_str"
) -> Column:
    return col(num).isNotNull() | col(boolean).isNotNull() | col(text).isNotNull()


def typed_value(
    datatype: ColumnLike,
    num: ColumnLike = "value_num",
    boolean: ColumnLike = "value_bool",
    text: ColumnLike = "value_str",
) -> Column:
    """The value as text, read from the column its datatype points to."""
    return (
        F.when(col(datatype) == BOOLEAN, col(boolean).cast("string"))
        .when(col(datatype) == STRING, col(text))
        .otherwise(col(num).cast("string"))
    )


def nan_to_null(value: ColumnLike) -> Column:
    return F.when(~F.isnan(col(value)), col(value))


def drop_empty(properties: ColumnLike) -> Column:
    """Property map without its NULL values."""
    return F.map_filter(col(properties), lambda _, v: v.isNotNull())


def map_text(properties: ColumnLike) -> Column:
    """Map rendered as ``k=v;k=v`` in key order."""
    entries = F.array_sort(F.map_entries(col(properties)))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")


def tag_value(tags: ColumnLike, key: str) -> Column:
    """One entry of a point's tag map, NULL when absent."""
    return F.try_element_at(col(tags), F.lit(key))
