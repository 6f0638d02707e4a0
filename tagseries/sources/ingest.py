"""Request shapes of the store interface, turned into point rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import GOOD_CODE

_REQUEST = ("paths", "values", "timestamps", "qualities")


def from_tag_matrix(df: DataFrame) -> DataFrame:
    """Points of tag-major requests: ``values[tag][t]`` against ``paths`` and ``timestamps``.

    ``qualities`` has one code per instant; without it every point is good. ``place`` numbers the points of
    a request: of two for one instant the later one counts.
    """
    rest = [c for c in df.columns if c not in _REQUEST]
    tags = df.select(*rest, "values", "timestamps", "qualities", F.posexplode("paths").alias("__tag", "qpath"))
    per_tag = tags.withColumn("values", F.get("values", F.col("__tag")))
    cells = per_tag.select(
        *rest, "__tag", "qpath", "values", "qualities", F.size("timestamps").alias("__n"),
        F.posexplode("timestamps").alias("__at", "ts_ms"),
    )
    place = F.col("__tag").cast("bigint") * F.col("__n") + F.col("__at")
    return _points(cells, rest, F.get("values", F.col("__at")), F.get("qualities", F.col("__at")), place)


def from_parallel_arrays(df: DataFrame) -> DataFrame:
    """Points of requests with one entry per point in ``paths``, ``values``, ``timestamps`` and
    optionally ``qualities``; ``place`` is the entry's number."""
    rest = [c for c in df.columns if c not in _REQUEST]
    cells = df.select(
        *rest, "values", "timestamps", "qualities", F.posexplode("paths").alias("__at", "qpath")
    ).withColumn("ts_ms", F.get("timestamps", F.col("__at")))
    place = F.col("__at").cast("bigint")
    return _points(cells, rest, F.get("values", F.col("__at")), F.get("qualities", F.col("__at")), place)


def typed_columns(value: Column, kind: T.DataType) -> dict[str, Column]:
    """The value columns of a request's value of a type: number, boolean, text, or a variant that may be any
    of them from value to value. What is none of these (a list, an object) becomes no value."""
    none = {"value_num": F.lit(None), "value_bool": F.lit(None), "value_str": F.lit(None)}
    if isinstance(kind, T.VariantType):
        found = F.schema_of_variant(value)
        number = found.isin("BIGINT", "DOUBLE", "FLOAT") | found.startswith("DECIMAL")
        columns = {
            "value_num": F.when(number, F.try_variant_get(value, "$", "double")),
            "value_bool": F.when(found == "BOOLEAN", F.try_variant_get(value, "$", "boolean")),
            "value_str": F.when(found == "STRING", F.try_variant_get(value, "$", "string")),
        }
    elif isinstance(kind, T.BooleanType):
        columns = none | {"value_bool": value}
    elif isinstance(kind, T.StringType):
        columns = none | {"value_str": value}
    else:
        columns = none | {"value_num": value}
    types = {"value_num": "double", "value_bool": "boolean", "value_str": "string"}
    return {name: c.cast(types[name]).alias(name) for name, c in columns.items()}


def _points(cells: DataFrame, rest: list[str], value: Column, code: Column, place: Column) -> DataFrame:
    kind = cells.schema["values"].dataType.elementType
    return cells.select(
        *[c for c in rest if c != "place"],
        "qpath",
        F.col("ts_ms").cast("bigint").alias("ts_ms"),
        *typed_columns(value, kind).values(),
        F.coalesce(code, F.lit(GOOD_CODE)).cast("int").alias("quality_code"),
        place.alias("place"),
    )
