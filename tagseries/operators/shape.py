"""Result layouts: tall, wide, aligned, nested and JSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import nan_to_null
from .ordered import with_position

RETURN_FORMATS = ("WIDE", "TALL")
PAGE_SIZE = 10_000
#: Arrival of a point without one: before all others.
NO_SEQ = -(2**63)


def check_format(name: str) -> str:
    """WIDE and TALL have a described layout; anything else is refused."""
    if name.upper() not in RETURN_FORMATS:
        raise ValueError(f"return format {name!r} is not supported; use one of {RETURN_FORMATS}")
    return name.upper()


def tall(df: DataFrame, value: str = "value_num") -> DataFrame:
    """(series_name, ts_ms, value) rows."""
    return df.select("series_name", "ts_ms", F.col(value).alias("value"))


def _columns(names: Sequence[str], aliases: Sequence[str] | None) -> list[str]:
    if aliases is None:
        return list(names)
    if len(aliases) != len(names):
        raise ValueError("one column name per path is needed")
    return list(aliases)


def wide(
    df: DataFrame,
    names: Sequence[str],
    aliases: Sequence[str] | None = None,
    value: str | Mapping[str, str] = "value_num",
    time_column: str = "t_stamp",
    key: str = "series_name",
) -> DataFrame:
    """One row per instant and one column per requested series.

    The column list comes from the request, so no job has to look for it. An instant holds the
    last write of each series. ``value`` names the value column of all series, or of each one
    (those left out are numbers), so every column of the answer keeps its series' type.
    """
    last = F.coalesce(F.col("seq"), F.lit(NO_SEQ)) if "seq" in df.columns else F.col("ts_ms")
    shown = _columns(names, aliases)
    if not isinstance(value, Mapping):
        value = dict.fromkeys(names, value)
    known = {n: value.get(n, "value_num") for n in dict.fromkeys(names)}
    values = {c: f"__v{i}" for i, c in enumerate(dict.fromkeys(known.values()))}
    picked = df.select(
        F.col("ts_ms").alias(time_column),
        F.col(key).alias("__key"),
        *[F.col(c).alias(v) for c, v in values.items()],
        last.alias("__o"),
    )
    if len(values) == 1:
        out = picked.groupBy(time_column).pivot("__key", list(known)).agg(F.max_by("__v0", "__o"))
        return out.select(time_column, *[F.col(f"`{n}`").alias(a) for n, a in zip(names, shown)])
    place = {n: f"__c{i}" for i, n in enumerate(known)}
    own = {n: F.col("__key") == F.lit(n) for n in known}
    out = picked.groupBy(time_column).agg(
        *[F.max_by(values[c], F.when(own[n], F.col("__o"))).alias(place[n]) for n, c in known.items()]
    )
    return out.select(time_column, *[F.col(place[n]).alias(a) for n, a in zip(names, shown)])


def align(
    df: DataFrame,
    names: Sequence[str],
    how: str = "outer",
    aliases: Sequence[str] | None = None,
    value: str | Mapping[str, str] = "value_num",
) -> DataFrame:
    """Series joined on equal instants: all instants, or those where every series has a value."""
    if how not in ("outer", "inner"):
        raise ValueError(f"unknown alignment: {how}")
    out = wide(df, names, aliases, value, time_column="ts_ms")
    return out if how == "outer" else out.dropna("any", subset=_columns(names, aliases))


def to_series(
    df: DataFrame,
    header: Sequence[str] = ("series_name",),
    value: str = "value_num",
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """Nested result: header, field names and the ordered points of a series.

    A series comes in pages of ``page_size`` points (``page`` counts from 0), so one array
    never holds more than a page; a series that fits in one page is one row. Copies of an
    instant are points too, in order of arrival.
    """
    rows = df.select(*dict.fromkeys([*header, "series_name", "ts_ms", "seq", value]))
    ranked = with_position(rows, name="__rank")
    paged = ranked.withColumn("page", F.floor((F.col("__rank") - 1) / page_size).cast("bigint"))
    point = F.struct("__rank", "ts_ms", F.col(value).alias("value"))
    ordered = F.sort_array(F.collect_list(point))
    return (
        paged.groupBy(*dict.fromkeys([*header, "series_name", "page"]))
        .agg(F.transform(ordered, lambda p: F.struct(p["ts_ms"].alias("ts_ms"), p["value"].alias("value"))).alias("points"))
        .withColumn("fields", F.array(F.lit("time"), F.lit("value")))
    )


def to_json_rows(df: DataFrame) -> DataFrame:
    """One JSON text per row: timestamps as epoch milliseconds, NaN as null."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_millis(c.cast("timestamp"))
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = nan_to_null(c)
        out.append(c.alias(field.name))
    return df.select(F.to_json(F.struct(*out), {"ignoreNullFields": "false"}).alias("json"))
