"""Registered queries: raw reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.time import relative_range, to_millis
from ..functions.values import datatype_of, quality_to_status, typed_value
from ..operators import raw, resolve, shape
from ..operators.ordered import dedupe_last_write, limit_per_series, only_changes
from ..operators.registry import measurements
from ..sources import testbed as tb
from .registered import ASSETS, MEASUREMENTS, POINTS, PROPERTIES, SHIP, register
from .timeseries import Aggregation, TimeseriesRequest, query_timeseries

FROM = tb.T0 + 4 * tb.DAY_MS
TO = tb.T0 + 19 * tb.DAY_MS
RELATIVE = relative_range(tb.T1, hours=360)


def resolved(spark, sf):
    keys = tb.measurement_keys(spark, sf).unionByName(tb.asset_keys(spark, sf))
    return resolve.resolved_once(keys, tb.measurements_view(spark, sf), tb.assets_view(spark, sf), tb.COLLECTOR)


def _read(spark, sf, start, end, **options):
    return raw.raw_points(tb.points(spark, sf, start, end), resolved(spark, sf), start, end, **options)


@register(
    "raw_range",
    f"""WITH {POINTS}, {MEASUREMENTS}
    SELECT qpath, series_name, uuid AS measurement_uuid, ts_ms, value_num, 192 AS quality_code, 'Good' AS status
    FROM points JOIN active ON name = series_name WHERE ts_ms >= {FROM} AND ts_ms < {TO}""",
)
def raw_range(spark, sf):
    return _read(spark, sf, FROM, TO).select(
        "qpath", "series_name", "measurement_uuid", "ts_ms", "value_num", "quality_code", "status"
    )


@register(
    "raw_unbounded",
    f"""WITH {POINTS}, {MEASUREMENTS}
    SELECT qpath, series_name, uuid AS measurement_uuid, ts_ms, value_num, quality_code, points.status
    FROM points JOIN active ON name = series_name""",
)
def raw_unbounded(spark, sf):
    return _read(spark, sf, None, None, keep_quality=True).select(
        "qpath", "series_name", "measurement_uuid", "ts_ms", "value_num", "quality_code", "status"
    )


@register(
    "raw_missing_keys",
    f"""WITH {MEASUREMENTS}, {ASSETS}, keys AS (
      SELECT DISTINCT concat('histprov:h:/sys:gw:/prov:default:/tag:', event_type, '/u', user_id) AS qpath,
             concat('Plant/default/', event_type, '/u', user_id) AS series_name FROM events
      UNION ALL SELECT concat('histprov:h:/tag:Assets/', s_name), s_name FROM supplier)
    SELECT qpath, series_name, 'Bad_NotFound' AS status FROM keys
    WHERE series_name NOT IN (SELECT name FROM active) AND series_name NOT IN (SELECT name FROM assets)""",
)
def raw_missing_keys(spark, sf):
    # supplier names without their place in the tree name no asset
    bare = tb.table(spark, sf, "supplier").select(F.concat(F.lit("histprov:h:/tag:Assets/"), "s_name").alias("qpath"))
    keys = tb.measurement_keys(spark, sf).unionByName(bare)
    return resolve.missing_keys(keys, tb.measurements_view(spark, sf), tb.assets_view(spark, sf), tb.COLLECTOR)


@register(
    "raw_relative",
    f"""WITH {POINTS} SELECT series_name, ts_ms, value_num FROM points
    WHERE ts_ms >= {RELATIVE[0]} AND ts_ms < {RELATIVE[1]}""",
)
def raw_relative(spark, sf):
    start, end = RELATIVE
    return raw.time_range(tb.points(spark, sf, start, end), start, end).select("series_name", "ts_ms", "value_num")


@register(
    "raw_return_size",
    f"""WITH {POINTS}, {MEASUREMENTS} SELECT qpath, series_name, ts_ms, value_num
    FROM points JOIN active ON name = series_name ORDER BY ts_ms, series_name, qpath, seq LIMIT 500""",
)
def raw_return_size(spark, sf):
    return _read(spark, sf, None, None, return_size=500).select("qpath", "series_name", "ts_ms", "value_num")


@register("raw_tall", f"WITH {POINTS} SELECT type_series AS series_name, ts_ms, value_num AS value FROM points")
def raw_tall(spark, sf):
    return shape.tall(tb.points_by_type(spark, sf))


@register(
    "raw_by_uuid",
    f"""WITH {POINTS}, {MEASUREMENTS} SELECT uuid AS measurement_uuid, ts_ms, value_num
    FROM points JOIN active ON name = series_name WHERE quality = 'Good'""",
)
def raw_by_uuid(spark, sf):
    stored = raw.restrict(tb.points(spark, sf), resolved(spark, sf))
    good = measurements(tb.measurements_view(spark, sf)).filter("quality = 'Good'")
    return raw.by_uuid(stored, good.select(F.col("uuid").alias("measurement_uuid"))).select(
        "measurement_uuid", "ts_ms", "value_num"
    )


@register(
    "raw_by_name",
    f"""WITH {POINTS}, {MEASUREMENTS} SELECT series_name, ts_ms, value_num
    FROM points JOIN active ON name = series_name WHERE database IN ('db_building', 'db_machinery')""",
)
def raw_by_name(spark, sf):
    meas = measurements(tb.measurements_view(spark, sf))
    pairs = meas.filter(F.col("database").isin("db_building", "db_machinery")).select(
        "database", F.col("name").alias("measurement")
    )
    return raw.by_name(tb.points(spark, sf), pairs, meas).select("series_name", "ts_ms", "value_num")


@register(
    "raw_by_asset_property",
    f"""WITH {POINTS}, {PROPERTIES} SELECT series_name, ts_ms, value_num FROM points
    WHERE series_name IN (SELECT series_name FROM props)""",
)
def raw_by_asset_property(spark, sf):
    props = tb.properties_view(spark, sf)
    by_series = props.drop("measurement_uuid").withColumnRenamed("series_name", "measurement_uuid")
    return raw.by_asset_property(tb.points(spark, sf), by_series, props.select("uuid"), key="series_name").select(
        "series_name", "ts_ms", "value_num"
    )


@register(
    "raw_by_tags",
    f"""WITH {POINTS} SELECT series_name, ts_ms, value_num FROM points
    WHERE event_type = 'click' AND k // 10 = 3""",
)
def raw_by_tags(spark, sf):
    return raw.by_tags(tb.points(spark, sf), {"type": "click", "k10": "3"}).select(
        "series_name", "ts_ms", "value_num"
    )


@register(
    "raw_value_filter",
    f"""WITH {POINTS} SELECT series_name, ts_ms, value_num FROM points
    WHERE (value_num >= 5.0 AND value_num < 20.0) OR value_num > 60.0""",
)
def raw_value_filter(spark, sf):
    filters = [(">=", 5), ("<", 20, "AND"), (">", 60, "OR")]
    return raw.value_filter(tb.points(spark, sf), filters).select("series_name", "ts_ms", "value_num")


@register(
    "raw_text_filter",
    f"""WITH {POINTS} SELECT series_name, ts_ms, status AS value_str FROM points
    WHERE contains(status, 'certain') OR regexp_matches(status, '^B')""",
)
def raw_text_filter(spark, sf):
    text = tb.points(spark, sf).withColumn("value_str", F.col("status")).withColumn(
        "value_num", F.lit(None).cast("double")
    )
    filters = [("contains", "certain"), ("regex", "^B", "OR")]
    return raw.value_filter(text, filters).select("series_name", "ts_ms", "value_str")


@register(
    "raw_only_changes",
    f"""WITH {POINTS}, linked AS (
      SELECT type_series AS series_name, ts_ms, CAST(quality_code AS DOUBLE) AS value_num,
             lag(quality_code) OVER (PARTITION BY type_series ORDER BY ts_ms, seq) AS before FROM points)
    SELECT series_name, ts_ms, value_num FROM linked WHERE before IS DISTINCT FROM value_num""",
)
def raw_only_changes(spark, sf):
    coded = tb.points_by_type(spark, sf).withColumn("value_num", F.col("quality_code").cast("double"))
    return only_changes(coded.select("series_name", "ts_ms", "value_num", "seq")).select(
        "series_name", "ts_ms", "value_num"
    )


@register(
    "raw_limit_offset_desc",
    f"""WITH {POINTS} SELECT series_name, ts_ms, value_num FROM points
    QUALIFY row_number() OVER (PARTITION BY series_name ORDER BY ts_ms DESC, seq DESC) BETWEEN 3 AND 7""",
)
def raw_limit_offset_desc(spark, sf):
    return limit_per_series(tb.points(spark, sf), 5, offset=2, desc=True).select("series_name", "ts_ms", "value_num")


@register(
    "raw_limit_long",
    f"""WITH {POINTS} SELECT type_series AS series_name, ts_ms, value_num FROM points
    QUALIFY row_number() OVER (PARTITION BY type_series ORDER BY ts_ms, seq) BETWEEN 301 AND 1800""",
)
def raw_limit_long(spark, sf):
    return limit_per_series(tb.points_by_type(spark, sf), 1500, offset=300).select(
        "series_name", "ts_ms", "value_num"
    )


@register(
    "raw_limit_global",
    f"""WITH {POINTS} SELECT series_name, ts_ms, value_num FROM points
    ORDER BY ts_ms DESC, seq DESC, series_name LIMIT 100 OFFSET 20""",
)
def raw_limit_global(spark, sf):
    return raw.limited(tb.points(spark, sf), 100, offset=20, desc=True, scope="global").select(
        "series_name", "ts_ms", "value_num"
    )


@register(
    "raw_latest",
    f"""WITH {POINTS} SELECT series_name, max(ts_ms) AS ts_ms, arg_max(value_num, seq) AS value_num,
    arg_max(status, seq) AS status FROM points GROUP BY series_name""",
)
def raw_latest(spark, sf):
    return raw.latest(tb.points(spark, sf).select("series_name", "ts_ms", "value_num", "status", "seq")).select(
        "series_name", "ts_ms", "value_num", "status"
    )


@register(
    "raw_bounds",
    f"""WITH {POINTS}, inside AS (
      SELECT series_name, ts_ms, value_num, 'inside' AS bound FROM points WHERE ts_ms >= {FROM} AND ts_ms < {TO}),
    lower_b AS (SELECT series_name, max(ts_ms) AS ts_ms, arg_max(value_num, ts_ms) AS value_num, 'lower' AS bound
      FROM points WHERE ts_ms < {FROM} GROUP BY series_name),
    upper_b AS (SELECT series_name, min(ts_ms) AS ts_ms, arg_min(value_num, ts_ms) AS value_num, 'upper' AS bound
      FROM points WHERE ts_ms >= {TO} GROUP BY series_name)
    SELECT * FROM inside UNION ALL SELECT * FROM lower_b UNION ALL SELECT * FROM upper_b""",
)
def raw_bounds(spark, sf):
    pts = tb.points(spark, sf).select("series_name", "ts_ms", "value_num", "seq")
    return raw.with_bounds(pts, FROM, TO).select("series_name", "ts_ms", "value_num", "bound")


@register(
    "raw_wide",
    f"""WITH {POINTS} SELECT ts_ms AS t_stamp,
    {", ".join(f"arg_max(value_num, seq) FILTER (event_type = '{t}') AS {t}_value" for t in tb.EVENT_TYPES)}
    FROM points GROUP BY ts_ms""",
)
def raw_wide(spark, sf):
    names = [f"{tb.COLLECTOR}/type/{t}" for t in tb.EVENT_TYPES]
    return shape.wide(tb.points_by_type(spark, sf), names, aliases=[f"{t}_value" for t in tb.EVENT_TYPES])


LINES = ["AF", "AO", "NF", "NO", "RF", "RO"]
_LINE_COLUMNS = ", ".join(
    f"arg_max(value_num, seq) FILTER (line_series = 'Plant/line/{x}') AS line_{x.lower()}" for x in LINES
)


@register("raw_align", f"WITH {SHIP} SELECT ts_ms, {_LINE_COLUMNS} FROM ship GROUP BY ts_ms")
def raw_align(spark, sf):
    names = [f"{tb.COLLECTOR}/line/{x}" for x in LINES]
    return shape.align(tb.points_lines(spark, sf), names, aliases=[f"line_{x.lower()}" for x in LINES])


@register(
    "raw_align_inner",
    f"""WITH {SHIP}, w AS (SELECT ts_ms, {_LINE_COLUMNS} FROM ship GROUP BY ts_ms)
    SELECT * FROM w WHERE {" AND ".join(f"line_{x.lower()} IS NOT NULL" for x in LINES)}""",
)
def raw_align_inner(spark, sf):
    names = [f"{tb.COLLECTOR}/line/{x}" for x in LINES]
    return shape.align(tb.points_lines(spark, sf), names, how="inner", aliases=[f"line_{x.lower()}" for x in LINES])


@register(
    "raw_series_nested",
    f"""WITH {POINTS}, ranked AS (
      SELECT type_series AS series_name, ts_ms, quality_code,
             (row_number() OVER (PARTITION BY type_series ORDER BY ts_ms) - 1) // 500 AS page FROM points)
    SELECT series_name, page, string_agg(concat(ts_ms, '=', quality_code), ',' ORDER BY ts_ms) AS points
    FROM ranked GROUP BY series_name, page""",
)
def raw_series_nested(spark, sf):
    coded = tb.points_by_type(spark, sf).select("series_name", "ts_ms", "quality_code", "seq")
    nested = shape.to_series(coded, value="quality_code", page_size=500)
    text = F.transform("points", lambda p: F.concat(p["ts_ms"], F.lit("="), p["value"]))
    return nested.select("series_name", "page", F.array_join(text, ",").alias("points"))


@register(
    "raw_json_rows",
    f"""WITH {POINTS} SELECT concat('{{"series_name":"', series_name, '","t_stamp":', ts_ms, ',"code":', quality_code,
    ',"value":', CASE WHEN status = 'Bad' THEN 'null' ELSE CAST(round(value_num * 100) AS BIGINT) || '.0' END, '}}') AS json
    FROM points""",
)
def raw_json_rows(spark, sf):
    cents = F.round(F.col("value_num") * 100)
    shown = tb.points(spark, sf).select(
        "series_name",
        F.timestamp_millis("ts_ms").alias("t_stamp"),
        F.col("quality_code").alias("code"),
        F.when(F.col("status") == "Bad", F.lit(float("nan"))).otherwise(cents).alias("value"),
    )
    return shape.to_json_rows(shown)


@register(
    "dedupe_last_write",
    f"""WITH {SHIP} SELECT series_name, ts_ms, arg_max(value_num, seq) AS value_num, max(seq) AS seq
    FROM ship GROUP BY series_name, ts_ms""",
)
def dedupe(spark, sf):
    return dedupe_last_write(tb.points_ship(spark, sf)).select("series_name", "ts_ms", "value_num", "seq")


@register(
    "dedupe_hot_instants",
    f"""WITH {SHIP} SELECT line_series AS series_name, ts_ms, arg_max(value_num, seq) AS value_num, max(seq) AS seq
    FROM ship GROUP BY line_series, ts_ms""",
)
def dedupe_hot(spark, sf):
    return dedupe_last_write(tb.points_lines(spark, sf)).select("series_name", "ts_ms", "value_num", "seq")


@register(
    "concat_series",
    f"""WITH {POINTS}, {SHIP} SELECT series_name, ts_ms, value_num, seq FROM points
    UNION ALL SELECT series_name, ts_ms, value_num, seq FROM ship""",
)
def concat(spark, sf):
    cols = ["series_name", "ts_ms", "value_num", "seq"]
    return raw.concat_series(tb.points(spark, sf).select(cols), tb.points_ship(spark, sf).select(cols))


@register(
    "typed_values",
    f"""WITH {POINTS} SELECT series_name, ts_ms,
    CASE event_type WHEN 'signup' THEN CASE WHEN k >= 50 THEN 'true' ELSE 'false' END WHEN 'view' THEN status
    ELSE concat(k, '.0') END AS value FROM points""",
)
def typed_values(spark, sf):
    kind, k = F.col("event_type"), tb.event_k()
    typed = tb.table(spark, sf, "events").select(
        tb.user_series().alias("series_name"),
        to_millis("ts").alias("ts_ms"),
        F.when(kind == "signup", k >= 50).alias("value_bool"),
        F.when(kind == "view", quality_to_status(tb.quality_from_k())).alias("value_str"),
        F.when(~kind.isin("signup", "view"), k.cast("double")).alias("value_num"),
    )
    return typed.select("series_name", "ts_ms", typed_value(datatype_of()).alias("value"))


@register(
    "timeseries_request",
    f"""WITH {POINTS}, {MEASUREMENTS}, chosen AS (
      SELECT points.* FROM points JOIN active ON name = series_name
      WHERE database = 'db_building' AND ts_ms >= {FROM} AND ts_ms < {TO} AND value_num > 1.0),
    b AS (SELECT event_type AS type, ts_ms - (ts_ms - {FROM}) % 86400000 AS ts_ms, max(value_num) AS value
      FROM chosen GROUP BY ALL)
    SELECT type, ts_ms, value FROM b
    QUALIFY row_number() OVER (PARTITION BY type ORDER BY ts_ms DESC) BETWEEN 2 AND 11""",
)
def timeseries_request(spark, sf):
    meas = tb.measurements_view(spark, sf)
    pts = tb.points(spark, sf, FROM, TO)
    building = measurements(meas).filter("database = 'db_building'")
    pts = raw.by_name(pts, building.select("database", F.col("name").alias("measurement")), meas)
    request = TimeseriesRequest(
        start=FROM,
        end=TO,
        value_filters=[(">", 1)],
        aggregation=Aggregation("max", "24h"),
        group_by=["type"],
        limit=10,
        offset=1,
        desc=True,
    )
    return query_timeseries(request, pts, meas)



@register(
    "raw_limit_copies",
    f"""WITH {SHIP} SELECT series_name, ts_ms, value_num, seq FROM ship
    QUALIFY row_number() OVER (PARTITION BY series_name ORDER BY ts_ms, seq) BETWEEN 11 AND 510""",
)
def raw_limit_copies(spark, sf):
    return limit_per_series(tb.points_ship(spark, sf), 500, offset=10).select("series_name", "ts_ms", "value_num", "seq")


@register(
    "series_nested_copies",
    f"""WITH {SHIP}, r AS (SELECT *, (row_number() OVER (PARTITION BY line_series ORDER BY ts_ms, seq) - 1) // 200 AS page FROM ship)
    SELECT line_series AS series_name, page, count(*) AS n, min(ts_ms) AS first, round(sum(value_num), 2) AS total
    FROM r GROUP BY ALL""",
)
def series_nested_copies(spark, sf):
    pages = shape.to_series(tb.points_lines(spark, sf), page_size=200)
    total = F.aggregate("points", F.lit(0.0), lambda s, p: s + p["value"])
    return pages.select(
        "series_name",
        "page",
        F.size("points").cast("bigint").alias("n"),
        F.element_at("points", 1)["ts_ms"].alias("first"),
        F.round(total, 2).alias("total"),
    )


@register(
    "latest_without_seq",
    f"""WITH {POINTS} SELECT series_name, max(ts_ms) AS ts_ms, arg_max(value_num, ts_ms) AS value_num FROM points GROUP BY ALL""",
)
def latest_without_seq(spark, sf):
    pts = tb.points(spark, sf).withColumn("seq", F.lit(None).cast("bigint"))
    return raw.latest(pts).select("series_name", "ts_ms", "value_num")
