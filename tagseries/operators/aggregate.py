"""Bucketed aggregation of many series in one scan."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aggregates import FUNCTIONS, MINMAX, aggregate_function, function_expr, functions_of
from ..functions.time import arrival_order, bucket_start, check_range, period_ms
from ..functions.values import tag_value
from ..session import written
from .fill import fill as fill_gaps
from .raw import VALUE_COLUMNS, time_range


def bucket_origin(start: int | None, origin: str) -> int:
    """Buckets count from the query start, or from the epoch when asked or unbounded."""
    if origin not in ("start", "epoch"):
        raise ValueError(f"unknown bucket origin: {origin}")
    return start if origin == "start" and start is not None else 0


def any_value(pts: DataFrame) -> Column:
    """Whether a point holds a value of any type."""
    present = F.lit(False)
    for name in VALUE_COLUMNS:
        if name in pts.columns:
            present = present | F.col(name).isNotNull()
    return present


def bucketed(
    pts: DataFrame,
    functions: Sequence[str],
    period: int | str | None,
    start: int | None = None,
    end: int | None = None,
    origin: str = "start",
    keys: Sequence[str] = ("series_name",),
) -> DataFrame:
    """One row per (keys, bucket) with a column per function; ``ts_ms`` is the bucket start.

    ``period=None`` makes one bucket of the whole range. All functions share one partial
    aggregation, so what is shuffled is one fixed-width row per group and map task.
    """
    check_range(start, end)
    if period is None:
        at = F.lit(start if start is not None else 0).cast("bigint")
    else:
        at = bucket_start("ts_ms", period_ms(period), bucket_origin(start, origin))
    exprs = [
        (F.count_if(any_value(pts)).cast("double") if name == "count" else function_expr(name)).alias(name)
        for name in functions
    ]
    return time_range(pts, start, end).groupBy(*keys, at.alias("bucket_ms")).agg(*exprs).withColumnRenamed(
        "bucket_ms", "ts_ms"
    )


def aggregate_series(
    pts: DataFrame,
    function: str,
    period: int | str | None,
    start: int | None = None,
    end: int | None = None,
    origin: str = "start",
    keys: Sequence[str] = ("series_name",),
    fill: str = "none",
    fill_value: float | None = None,
) -> DataFrame:
    """(keys, ts_ms, value) of one function; groups without a result are left out."""
    out = bucketed(pts, [function], period, start, end, origin, keys)
    out = out.withColumnRenamed(function, "value").filter(F.col("value").isNotNull())
    if fill == "none":
        return out
    if start is None or end is None or period is None:
        raise ValueError("filling needs a bounded range and a period")
    return fill_gaps(
        out, fill, period_ms(period), start, end, bucket_origin(start, origin), keys=keys, fill_value=fill_value
    )


def min_max(buckets: DataFrame, keys: Sequence[str] = ("series_name",)) -> DataFrame:
    """Two rows per bucket with one time stamp: minimum (0), then maximum (1)."""
    return buckets.select(*keys, "ts_ms", F.posexplode(F.array("min", "max")).alias("ordinal", "value")).filter(
        F.col("value").isNotNull()
    )


def answer_requests(buckets: DataFrame, requests: DataFrame, functions: Sequence[str] = FUNCTIONS) -> DataFrame:
    """Rows of (qpath, series_name, aggregate) requests from buckets that hold ``functions``.

    MinMax gives two rows per bucket, minimum first; a result that is NULL gives none.
    """
    wanted = requests.select("qpath", "series_name", "aggregate")
    rows = buckets.join(wanted, "series_name").withColumn("function", aggregate_function("aggregate"))
    single = F.lit(None).cast("double")
    for name in functions:
        single = F.when(F.col("function") == name, F.col(name)).otherwise(single)
    values = F.array(single)
    if {"min", "max"} <= set(functions):
        values = F.when(F.col("aggregate") == MINMAX, F.array("min", "max")).otherwise(values)
    return rows.select(
        "qpath", "series_name", "aggregate", "ts_ms", F.posexplode(values).alias("ordinal", "value")
    ).filter(F.col("value").isNotNull())


def aggregate(
    pts: DataFrame,
    requests: DataFrame,
    period: int | str | None,
    start: int | None = None,
    end: int | None = None,
    fill: str = "none",
    origin: str = "start",
    aggregates: Iterable[str] | None = None,
    fill_value: float | None = None,
) -> DataFrame:
    """Answer of (qpath, series_name, aggregate) requests, each key with its own aggregate.

    One scan computes the union of the functions the requests need (``aggregates`` names them
    if known, else all); the small per-bucket result is then matched with the requests.
    """
    functions = list(FUNCTIONS) if aggregates is None else functions_of(aggregates)
    wanted = requests.select("series_name")
    scope = pts.join(wanted, "series_name", "left_semi")
    out = answer_requests(bucketed(scope, functions, period, start, end, origin), requests, functions)
    if fill == "none":
        return out
    if start is None or end is None or period is None:
        raise ValueError("filling needs a bounded range and a period")
    return fill_gaps(
        out,
        fill,
        period_ms(period),
        start,
        end,
        bucket_origin(start, origin),
        keys=("qpath", "series_name", "aggregate", "ordinal"),
        fill_value=fill_value,
    )


def last_values(
    pts: DataFrame,
    requests: DataFrame,
    period: int | str | None,
    start: int | None = None,
    end: int | None = None,
    origin: str = "start",
) -> DataFrame:
    """Last value of any type per request and bucket, in ``value``, ``value_bool`` or ``value_str``.

    ``aggregate`` answers numbers only; this is its LastValue for boolean and text series.
    """
    check_range(start, end)
    if period is None:
        at = F.lit(start if start is not None else 0).cast("bigint")
    else:
        at = bucket_start("ts_ms", period_ms(period), bucket_origin(start, origin))
    scope = time_range(pts, start, end).join(requests.select("series_name"), "series_name", "left_semi")
    last = [F.max_by(c, arrival_order()).alias(c) for c in VALUE_COLUMNS]
    buckets = scope.filter(any_value(pts)).groupBy("series_name", at.alias("bucket_ms")).agg(*last)
    return buckets.join(requests.select("qpath", "series_name", "aggregate"), "series_name").select(
        "qpath",
        "series_name",
        "aggregate",
        F.col("bucket_ms").alias("ts_ms"),
        F.lit(0).alias("ordinal"),
        F.col("value_num").alias("value"),
        "value_bool",
        "value_str",
    )


def aggregate_by_tags(
    pts: DataFrame,
    tags: Sequence[str],
    function: str,
    period: int | str | None,
    start: int | None = None,
    end: int | None = None,
    origin: str = "start",
) -> DataFrame:
    """Aggregate over all points that share the values of the given tag keys."""
    for tag in tags:
        pts = pts.withColumn(tag, tag_value("tags", tag))
    return aggregate_series(pts, function, period, start, end, origin, keys=list(tags))


# Share of a group's rows to either side of the wanted rank that is sorted; the sketch's own
# error is a fifth of it.
PERCENTILE_MARGIN = 0.0005


#: A group is large if it holds more than this part of all points; there are fewer large groups than this.
HOT_SHARE = 10_000


def _beside(rows: DataFrame, per_group: DataFrame, group: list[str], large: Column) -> DataFrame:
    """Rows joined with the one row of their group, no group meeting in one task.

    Large groups, of which there are fewer than ``HOT_SHARE``, become a local table, small enough for Spark to send
    to all tasks; the others are joined by a shuffle, where each is a small part of all.
    """
    few = per_group.filter(large).collect()
    if not few:
        return rows.join(per_group, group)
    local = per_group.sparkSession.createDataFrame(few, per_group.schema)
    rest = rows.join(local.select(group), group, "left_anti").join(per_group.filter(~large), group)
    return rows.join(local, group).unionByName(rest)


def percentile(
    pts: DataFrame,
    p: float,
    period: int | str | None,
    start: int | None = None,
    end: int | None = None,
    origin: str = "start",
    keys: Sequence[str] = ("series_name",),
    margin: float = PERCENTILE_MARGIN,
) -> DataFrame:
    """Exact interpolated percentile per (keys, bucket).

    No group is ever gathered. Equal values collapse to counts before the shuffle; a bounded
    sketch brackets the wanted rank, exact counts below, inside and above the bracket tell where
    the two neighbouring ranks lie, and only that part, a thousandth of the group, is sorted. The sketch
    steers the work only: the counts make the result exact whatever its error.
    """
    if not 0 <= p <= 1:
        raise ValueError("a percentile argument lies between 0 and 1")
    check_range(start, end)
    at = (
        F.lit(start if start is not None else 0).cast("bigint")
        if period is None
        else bucket_start("ts_ms", period_ms(period), bucket_origin(start, origin))
    )
    group = [*keys, "bucket_ms"]
    rows = (
        time_range(pts, start, end)
        .filter(F.col("value_num").isNotNull())
        .select(*keys, at.alias("bucket_ms"), F.col("value_num").alias("v"))
    )
    counts = rows.groupBy(*group, "v").agg(F.count(F.lit(1)).alias("n"))
    edges = F.percentile_approx("v", [max(p - margin, 0.0), min(p + margin, 1.0)])
    brackets = written(rows.groupBy(*group).agg(edges.alias("edges"), F.count(F.lit(1)).alias("points")))
    hot = brackets.agg((F.sum("points") / HOT_SHARE).cast("bigint")).first()[0] or 0
    large = F.col("points") > hot
    placed = _beside(counts, brackets, group, large).withColumn(
        "part", F.when(F.col("v") < F.col("edges")[0], 0).when(F.col("v") <= F.col("edges")[1], 1).otherwise(2)
    )

    def size(part: int):
        return F.sum(F.when(F.col("part") == part, F.col("n")).otherwise(0))

    ranks = (
        placed.groupBy(*group)
        .agg(F.sum("n").alias("points"), size(0).alias("below"), size(1).alias("inside"))
        .withColumn("at", F.lit(float(p)) * (F.col("points") - 1))
        .withColumn("lo", F.floor("at"))
        .withColumn("hi", F.ceil("at"))
    )
    part, below, upper = F.col("part"), F.col("below"), F.col("below") + F.col("inside")
    holds_any = (
        ((part == 0) & (F.col("lo") < below))
        | ((part == 1) & (F.col("hi") >= below) & (F.col("lo") < upper))
        | ((part == 2) & (F.col("hi") >= upper))
    )
    sorted_part = Window.partitionBy(*group, "part").orderBy("v")
    ranked = (
        _beside(placed.drop("edges", "points"), written(ranks), group, large)
        .filter(holds_any)
        .withColumn("skip", F.when(part == 0, F.lit(0)).when(part == 1, below).otherwise(upper))
        .withColumn("upto", F.col("skip") + F.sum("n").over(sorted_part))
    )

    def holds(rank: str):
        return (F.col(rank) >= F.col("upto") - F.col("n")) & (F.col(rank) < F.col("upto"))

    return (
        ranked.groupBy(*group)
        .agg(
            F.max(F.when(holds("lo"), F.col("v"))).alias("v_lo"),
            F.max(F.when(holds("hi"), F.col("v"))).alias("v_hi"),
            F.max("at").alias("at"),
            F.max("lo").alias("lo"),
        )
        .select(
            *keys,
            F.col("bucket_ms").alias("ts_ms"),
            (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (F.col("at") - F.col("lo"))).alias("value"),
        )
    )


def aggregate_with_arguments(pts: DataFrame, name: str, arguments: Sequence[float], *args, **kwargs) -> DataFrame:
    """Aggregates that take arguments: ``percentile`` with one number."""
    if name != "percentile" or len(arguments) != 1:
        raise ValueError(f"aggregate {name!r} does not take the arguments {list(arguments)!r}")
    return percentile(pts, float(arguments[0]), *args, **kwargs)
