"""Raw point reads: series, time, tag and value filters, bounds and limits."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import arrival_order, check_range, part_bounds
from ..functions.values import GOOD, GOOD_CODE, tag_value
from .ordered import last_writes, limit_per_series

VALUE_COLUMNS = ("value_num", "value_bool", "value_str")


def time_range(df: DataFrame, start: int | None = None, end: int | None = None, column: str = "ts_ms") -> DataFrame:
    """Points in ``[start, end)``; an absent end is open, an inverted range an error.

    A table of stored points (with its ``part`` column) also prunes its partitions.
    """
    check_range(start, end)
    if column == "ts_ms" and ("part", "date") in df.dtypes and (start is not None or end is not None):
        df = df.filter(part_bounds(start, end))
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(column) < F.lit(end))
    return df


def by_uuid(df: DataFrame, ids: Iterable[str] | DataFrame) -> DataFrame:
    """Points of the given measurement uuids: a pushed IN filter for a list, a semi join for a
    DataFrame with a ``measurement_uuid`` column."""
    if isinstance(ids, DataFrame):
        return df.join(ids.select("measurement_uuid"), "measurement_uuid", "left_semi")
    return df.filter(F.col("measurement_uuid").isin(list(ids)))


def by_name(df: DataFrame, pairs: DataFrame, meas: DataFrame) -> DataFrame:
    """Points of measurements given as (database, measurement) rows."""
    wanted = meas.join(
        pairs.select("database", F.col("measurement").alias("name")), ["database", "name"], "left_semi"
    )
    return df.join(wanted.select(F.col("name").alias("series_name")), "series_name", "left_semi")


def by_asset_property(
    df: DataFrame, props: DataFrame, ids: Iterable[str] | DataFrame, key: str = "measurement_uuid"
) -> DataFrame:
    """Points of the measurements behind the given asset property uuids."""
    if isinstance(ids, DataFrame):
        bound = props.join(ids.select("uuid"), "uuid", "left_semi")
    else:
        bound = props.filter(F.col("uuid").isin(list(ids)))
    return df.join(bound.select(F.col("measurement_uuid").alias(key)), key, "left_semi")


def by_tags(df: DataFrame, tags: dict[str, str]) -> DataFrame:
    """Points whose tag map holds all given entries."""
    for key, wanted in tags.items():
        df = df.filter(tag_value("tags", key) == wanted)
    return df


def _compare(column: Column, operator: str, value) -> Column:
    comparisons = {
        "=": lambda c: c == value,
        "!=": lambda c: c != value,
        ">": lambda c: c > value,
        ">=": lambda c: c >= value,
        "<": lambda c: c < value,
        "<=": lambda c: c <= value,
        "contains": lambda c: c.contains(value),
        "regex": lambda c: c.rlike(value),
    }
    if operator not in comparisons:
        raise ValueError(f"unknown value filter operator: {operator}")
    return comparisons[operator](column)


def value_predicate(filters: Sequence[tuple]) -> Column:
    """Predicate of ``(operator, value[, condition])`` filters, folded left to right.

    The value's Python type selects the column; ``condition`` (``AND`` / ``OR``) links a filter
    to the ones before it.
    """
    predicate = None
    for operator, value, *rest in filters:
        if isinstance(value, bool):
            column = "value_bool"
        elif isinstance(value, str):
            column = "value_str"
        else:
            column, value = "value_num", float(value)
        term = F.coalesce(_compare(F.col(column), operator, value), F.lit(False))
        condition = (rest[0] if rest and rest[0] else "AND").upper()
        if condition not in ("AND", "OR"):
            raise ValueError(f"unknown value filter condition: {condition}")
        if predicate is None:
            predicate = term
        else:
            predicate = predicate & term if condition == "AND" else predicate | term
    return F.lit(True) if predicate is None else predicate


def value_filter(df: DataFrame, filters: Sequence[tuple]) -> DataFrame:
    return df.filter(value_predicate(filters))


def assume_good(df: DataFrame) -> DataFrame:
    """Quality reset of the compatible read: every returned point is good."""
    return df.withColumn("quality_code", F.lit(GOOD_CODE)).withColumn("status", F.lit(GOOD))


def restrict(pts: DataFrame, keys: DataFrame) -> DataFrame:
    """Points of the requested series with the request's path and uuid.

    ``keys`` are resolved keys. Two paths of one series both get its points.
    """
    found = keys.filter(F.col("measurement_uuid").isNotNull()).select("qpath", "series_name", "measurement_uuid")
    return pts.drop("qpath", "measurement_uuid").join(found, "series_name")


def raw_points(
    pts: DataFrame,
    keys: DataFrame,
    start: int | None = None,
    end: int | None = None,
    return_size: int | None = None,
    keep_quality: bool = False,
) -> DataFrame:
    """Points of all requested series in one job; time filter first, then the key join.

    ``return_size`` returns the earliest rows of the answer. Unknown keys add no rows; list
    them with ``missing_keys``.
    """
    found = restrict(time_range(pts, start, end), keys)
    if not keep_quality:
        found = assume_good(found)
    if return_size is None:
        return found
    return found.orderBy("ts_ms", "series_name", "qpath", "seq").limit(return_size)


def ordered(df: DataFrame, desc: bool = False, keys: Sequence[str] = ("series_name",)) -> DataFrame:
    """Rows by series (or other keys), then time ascending or descending, then arrival."""
    direction = F.desc if desc else F.asc
    arrival = [direction("seq")] if "seq" in df.columns else []
    return df.orderBy(*keys, direction("ts_ms"), *arrival)


def limited(
    df: DataFrame, limit: int | None, offset: int = 0, desc: bool = False, scope: str = "series"
) -> DataFrame:
    """Limit and offset per series, or over the whole answer with ``scope="global"``."""
    if scope == "series":
        return limit_per_series(df, limit, offset, desc)
    if scope != "global":
        raise ValueError(f"unknown scope: {scope}")
    direction = F.desc if desc else F.asc
    out = df.orderBy(direction("ts_ms"), direction("seq"), "series_name")
    if offset:
        out = out.offset(offset)
    return out if limit is None else out.limit(limit)


def _edge(df: DataFrame, last: bool, keys: Sequence[str]) -> DataFrame:
    """One row per key: the last or first in arrival order.

    A fixed-width aggregate finds the edge's instant and arrival of each key, an equi join brings its
    row back. Only rows that share both are ordered, by their values.
    """
    at = arrival_order()
    edge = df.groupBy(*keys).agg((F.max(at) if last else F.min(at)).alias("__edge"))
    found = df.withColumn("__edge", at).join(edge, [*keys, "__edge"]).drop("__edge")
    return last_writes(found, keys, [])


def latest(df: DataFrame, before: int | None = None, keys: Sequence[str] = ("series_name",)) -> DataFrame:
    """Last point of each series, optionally before an instant."""
    return _edge(time_range(df, None, before), True, keys).select(df.columns)


def first_from(df: DataFrame, start: int, keys: Sequence[str] = ("series_name",)) -> DataFrame:
    """First point of each series at or after ``start``."""
    return _edge(time_range(df, start, None), False, keys).select(df.columns)


def with_bounds(pts: DataFrame, start: int, end: int, keys: Sequence[str] = ("series_name",)) -> DataFrame:
    """Points in the range plus, per series, the last one before and the first one from its end.

    Column ``bound`` tells ``lower``, ``inside`` and ``upper`` apart.
    """
    check_range(start, end)
    inside = time_range(pts, start, end).withColumn("bound", F.lit("inside"))
    lower = latest(pts, start, keys).withColumn("bound", F.lit("lower"))
    upper = first_from(pts, end, keys).withColumn("bound", F.lit("upper"))
    return inside.unionByName(lower).unionByName(upper)


def concat_series(*frames: DataFrame) -> DataFrame:
    """Results of several reads as one."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
