"""Registered queries: bucketed aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.time import period_for_buckets
from ..operators import aggregate as agg
from ..operators.resolve import resolved_once
from ..operators.shape import wide
from ..sources import testbed as tb
from .registered import MEASUREMENTS, POINTS, SHIP, r6, register

DAY = "24h"
BUCKET = f"ts_ms - (ts_ms - {tb.T0}) % {tb.DAY_MS}"

# function, SQL of the same aggregate
SIMPLE = {
    "mean": "avg(value_num)",
    "min": "min(value_num)",
    "max": "max(value_num)",
    "sum": "sum(value_num)",
    "count": "CAST(count(value_num) AS DOUBLE)",
    "last": "arg_max(value_num, ts_ms * 1000000 + seq)",
    "spread": "max(value_num) - min(value_num)",
    "variance": "var_samp(value_num)",
    "stddev": "stddev_samp(value_num)",
}


def _simple(function: str):
    def query(spark, sf):
        out = agg.aggregate_series(tb.points(spark, sf, tb.T0), function, DAY, tb.T0)
        return out.select("series_name", "ts_ms", r6("value").alias("value"))

    return query


for _name, _sql in SIMPLE.items():
    register(
        f"agg_{_name}",
        f"""WITH {POINTS}, b AS (SELECT series_name, {BUCKET} AS bucket, {_sql} AS value FROM points
        WHERE ts_ms >= {tb.T0} GROUP BY series_name, bucket)
        SELECT series_name, bucket AS ts_ms, round(value, 6) AS value FROM b WHERE value IS NOT NULL""",
    )(_simple(_name))


@register(
    "agg_all_functions",
    f"""WITH {POINTS} SELECT type_series AS series_name, ts_ms - (ts_ms - {tb.T0}) % 3600000 AS ts_ms,
    {", ".join(f"round({sql}, 6) AS {name}_value" for name, sql in SIMPLE.items())}
    FROM points WHERE ts_ms >= {tb.T0} GROUP BY type_series, ts_ms - (ts_ms - {tb.T0}) % 3600000""",
)
def agg_all_functions(spark, sf):
    out = agg.bucketed(tb.points_by_type(spark, sf, tb.T0), list(SIMPLE), "1h", tb.T0)
    return out.select("series_name", "ts_ms", *[r6(f).alias(f"{f}_value") for f in SIMPLE])


@register(
    "agg_epoch_origin",
    f"""WITH {POINTS} SELECT type_series AS series_name, ts_ms - ts_ms % 604800000 AS ts_ms,
    round(sum(value_num), 4) AS value FROM points WHERE ts_ms >= {tb.T0} + 1
    GROUP BY type_series, ts_ms - ts_ms % 604800000""",
)
def agg_epoch_origin(spark, sf):
    out = agg.aggregate_series(tb.points_by_type(spark, sf, tb.T0), "sum", "168h", tb.T0 + 1, origin="epoch")
    return out.select("series_name", "ts_ms", F.round("value", 4).alias("value"))


@register(
    "agg_minmax",
    f"""WITH {POINTS}, b AS (SELECT series_name, {BUCKET} AS bucket, min(value_num) AS lo, max(value_num) AS hi
      FROM points WHERE ts_ms >= {tb.T0} GROUP BY series_name, bucket)
    SELECT series_name, bucket AS ts_ms, 0 AS ordinal, lo AS value FROM b WHERE lo IS NOT NULL
    UNION ALL SELECT series_name, bucket, 1, hi FROM b WHERE hi IS NOT NULL""",
)
def agg_minmax(spark, sf):
    return agg.min_max(agg.bucketed(tb.points(spark, sf, tb.T0), ["min", "max"], DAY, tb.T0))


def mixed_requests(spark, sf):
    """Two requests per active series: one by event type (a name nobody knows for errors) and
    a count."""
    keys = tb.measurement_keys(spark, sf)
    known = resolved_once(keys, tb.measurements_view(spark, sf), tb.assets_view(spark, sf), tb.COLLECTOR).filter(
        F.col("measurement_uuid").isNotNull()
    )
    kind = F.split("series_name", "/")[2]
    own = (
        F.when(kind == "click", "Average")
        .when(kind == "view", "MinMax")
        .when(kind == "purchase", "Range")
        .when(kind == "signup", "LastValue")
        .otherwise("Mystery")
    )
    return known.select("qpath", "series_name", F.explode(F.array(own, F.lit("Count"))).alias("aggregate"))


@register(
    "agg_mixed_requests",
    f"""WITH {POINTS}, {MEASUREMENTS}, b AS (
      SELECT qpath, series_name, points.event_type, {BUCKET} AS bucket, avg(value_num) AS mean, min(value_num) AS lo,
             max(value_num) AS hi, arg_max(value_num, ts_ms * 1000000 + seq) AS last, count(value_num) AS n
      FROM points JOIN active ON name = series_name WHERE ts_ms >= {tb.T0} GROUP BY ALL),
    r AS (
      SELECT qpath, series_name, bucket, 'Count' AS aggregate, 0 AS ordinal, CAST(n AS DOUBLE) AS value FROM b
      UNION ALL SELECT qpath, series_name, bucket, 'Average', 0, mean FROM b WHERE event_type = 'click'
      UNION ALL SELECT qpath, series_name, bucket, 'MinMax', 0, lo FROM b WHERE event_type = 'view'
      UNION ALL SELECT qpath, series_name, bucket, 'MinMax', 1, hi FROM b WHERE event_type = 'view'
      UNION ALL SELECT qpath, series_name, bucket, 'Range', 0, hi - lo FROM b WHERE event_type = 'purchase'
      UNION ALL SELECT qpath, series_name, bucket, 'LastValue', 0, last FROM b WHERE event_type = 'signup'
      UNION ALL SELECT qpath, series_name, bucket, 'Mystery', 0, mean FROM b WHERE event_type = 'error')
    SELECT qpath, series_name, aggregate, bucket AS ts_ms, ordinal, round(value, 6) AS value FROM r
    WHERE value IS NOT NULL""",
)
def agg_mixed_requests(spark, sf):
    names = ["Average", "MinMax", "Range", "LastValue", "Mystery", "Count"]
    out = agg.aggregate(tb.points(spark, sf, tb.T0), mixed_requests(spark, sf), DAY, tb.T0, aggregates=names)
    return out.withColumn("value", r6("value"))


@register(
    "agg_n_buckets",
    f"""WITH {POINTS} SELECT series_name, ts_ms - (ts_ms - {tb.T0}) % {3 * tb.DAY_MS} AS ts_ms,
    round(sum(value_num), 6) AS value FROM points WHERE ts_ms >= {tb.T0} AND ts_ms < {tb.T1}
    GROUP BY series_name, ts_ms - (ts_ms - {tb.T0}) % {3 * tb.DAY_MS}""",
)
def agg_n_buckets(spark, sf):
    period = period_for_buckets(tb.T0, tb.T1, 10)
    out = agg.aggregate_series(tb.points(spark, sf, tb.T0, tb.T1), "sum", period, tb.T0, tb.T1)
    return out.withColumn("value", r6("value"))


@register(
    "agg_whole_range",
    f"""WITH {POINTS} SELECT type_series AS series_name, CAST({tb.T0} AS BIGINT) AS ts_ms, round(avg(value_num), 6) AS mean_value,
    CAST(count(*) AS DOUBLE) AS count_value, round(max(value_num) - min(value_num), 6) AS spread_value
    FROM points WHERE ts_ms >= {tb.T0} GROUP BY type_series""",
)
def agg_whole_range(spark, sf):
    out = agg.bucketed(tb.points_by_type(spark, sf, tb.T0), ["mean", "count", "spread"], None, tb.T0)
    return out.select(
        "series_name",
        "ts_ms",
        r6("mean").alias("mean_value"),
        F.col("count").alias("count_value"),
        r6("spread").alias("spread_value"),
    )


@register(
    "agg_group_by_tag",
    f"""WITH {POINTS} SELECT event_type AS type, CAST(k // 10 AS VARCHAR) AS k10, {BUCKET} AS ts_ms,
    round(sum(value_num), 4) AS value FROM points WHERE ts_ms >= {tb.T0} GROUP BY ALL""",
)
def agg_group_by_tag(spark, sf):
    out = agg.aggregate_by_tags(tb.points(spark, sf, tb.T0), ["type", "k10"], "sum", DAY, tb.T0)
    return out.withColumn("value", F.round("value", 4))


@register(
    "agg_percentile",
    f"""WITH {POINTS} SELECT type_series AS series_name, {BUCKET} AS ts_ms,
    round(quantile_cont(value_num, 0.9), 6) AS value FROM points WHERE ts_ms >= {tb.T0} GROUP BY ALL""",
)
def agg_percentile(spark, sf):
    out = agg.aggregate_with_arguments(tb.points_by_type(spark, sf, tb.T0), "percentile", [0.9], DAY, tb.T0)
    return out.withColumn("value", r6("value"))


@register(
    "agg_percentile_copies",
    f"""WITH {SHIP} SELECT line_series AS series_name, CAST(0 AS BIGINT) AS ts_ms,
    round(quantile_cont(value_num, 0.25), 6) AS value FROM ship GROUP BY line_series""",
)
def agg_percentile_copies(spark, sf):
    out = agg.percentile(tb.points_lines(spark, sf), 0.25, None)
    return out.withColumn("value", r6("value"))


_GRID = f"""WITH {POINTS}, b AS (
  SELECT series_name, {BUCKET} AS ts_ms, avg(value_num) AS v FROM points
  WHERE ts_ms >= {tb.T0} AND ts_ms < {tb.T1} GROUP BY ALL),
grid AS (SELECT DISTINCT series_name, g.at AS ts_ms FROM b, (SELECT unnest(range({tb.T0}, {tb.T1}, {tb.DAY_MS})) AS at) g),
f AS (SELECT grid.series_name, grid.ts_ms, v FROM grid LEFT JOIN b USING (series_name, ts_ms)),
n AS (SELECT *, last_value(v IGNORE NULLS) OVER up AS pv, max(CASE WHEN v IS NOT NULL THEN ts_ms END) OVER up AS pt,
        first_value(v IGNORE NULLS) OVER down AS nv, min(CASE WHEN v IS NOT NULL THEN ts_ms END) OVER down AS nt
      FROM f WINDOW up AS (PARTITION BY series_name ORDER BY ts_ms ROWS UNBOUNDED PRECEDING),
        down AS (PARTITION BY series_name ORDER BY ts_ms ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def _filled(kind: str, value=None):
    def query(spark, sf):
        out = agg.aggregate_series(
            tb.points(spark, sf, tb.T0, tb.T1), "mean", DAY, tb.T0, tb.T1, fill=kind, fill_value=value
        )
        return out.withColumn("value", r6("value"))

    return query


for _kind, _expr in {
    "null": "v",
    "previous": "pv",
    "linear": "CASE WHEN v IS NOT NULL THEN v ELSE pv + (nv - pv) * ((ts_ms - pt) / (nt - pt)) END",
    "value": "coalesce(v, -1.0)",
}.items():
    register(f"agg_fill_{_kind}", f"{_GRID} SELECT series_name, ts_ms, round({_expr}, 6) AS value FROM n")(
        _filled(_kind, -1.0 if _kind == "value" else None)
    )


@register(
    "agg_wide",
    f"""WITH {POINTS} SELECT ts_ms - (ts_ms - {tb.T0}) % 3600000 AS t_stamp,
    {", ".join(f"round(avg(value_num) FILTER (event_type = '{t}'), 6) AS {t}_mean" for t in tb.EVENT_TYPES)}
    FROM points WHERE ts_ms >= {tb.T0} GROUP BY ts_ms - (ts_ms - {tb.T0}) % 3600000""",
)
def agg_wide(spark, sf):
    out = agg.aggregate_series(tb.points_by_type(spark, sf, tb.T0), "mean", "1h", tb.T0).withColumn("value", r6("value"))
    names = [f"{tb.COLLECTOR}/type/{t}" for t in tb.EVENT_TYPES]
    return wide(out, names, [f"{t}_mean" for t in tb.EVENT_TYPES], value="value")
