"""Registered queries: values of all types and asset paths through the reading interface."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import raw, resolve
from ..operators.registry import extend_registry, onboard
from ..schema import ASSETS as ASSET_SCHEMA
from ..schema import MEASUREMENTS as MEASUREMENT_SCHEMA
from ..session import shared_dir
from ..sources import testbed as tb
from ..streaming import aggregate as stream_agg
from ..streaming import changes
from .history import TagHistory
from .registered import ASSETS, MEASUREMENTS, POINTS, PROPERTIES, register
from .timeseries import TimeseriesRequest, query_timeseries

_TYPED = f"""{POINTS}, typed AS (
  SELECT concat('histprov:h:/sys:gw:/prov:type:/tag:', event_type) AS qpath, type_series AS series_name, event_type, ts_ms, seq,
    CASE WHEN event_type NOT IN ('signup', 'view') THEN CAST(k AS DOUBLE) END AS value,
    CASE WHEN event_type = 'signup' THEN k >= 50 END AS value_bool, CASE WHEN event_type = 'view' THEN status END AS value_str
  FROM points)"""
_COLUMN = {"signup": "value_bool", "view": "value_str"}


def typed_history(spark, sf) -> TagHistory:
    """Reading interface over series of three types, each with the datatype its first value showed."""
    pts = tb.typed_points(spark, sf)
    none = spark.createDataFrame([], MEASUREMENT_SCHEMA)
    meas = extend_registry(none, onboard(pts, none))
    return TagHistory(pts, meas, spark.createDataFrame([], ASSET_SCHEMA), tb.COLLECTOR)


@register(
    "raw_wide_types",
    f"""WITH {_TYPED} SELECT ts_ms AS t_stamp,
    {", ".join(f"arg_max({_COLUMN.get(t, 'value')}, seq) FILTER (event_type = '{t}') AS {t}_value" for t in tb.EVENT_TYPES)}
    FROM typed GROUP BY ts_ms""",
)
def raw_wide_types(spark, sf):
    return typed_history(spark, sf).query_raw_points(
        tb.type_paths(), column_names=[f"{t}_value" for t in tb.EVENT_TYPES]
    )


@register(
    "raw_join_types",
    f"""WITH {_TYPED} SELECT ts_ms,
    {", ".join(f"arg_max({_COLUMN.get(t, 'value')}, seq) FILTER (event_type = '{t}') AS {t}_value" for t in tb.EVENT_TYPES)}
    FROM typed GROUP BY ts_ms""",
)
def raw_join_types(spark, sf):
    """A request that joins series of three types on their instants."""
    history = typed_history(spark, sf)
    names = [f"{tb.COLLECTOR}/type/{t}" for t in tb.EVENT_TYPES]
    out = query_timeseries(TimeseriesRequest(join=names), history.points, history.meas)
    return out.select("ts_ms", *[F.col(f"`{n}`").alias(f"{t}_value") for n, t in zip(names, tb.EVENT_TYPES)])


@register(
    "raw_ordered",
    f"""WITH {_TYPED} SELECT series_name, ts_ms, seq, value AS value_num, value_bool, value_str FROM typed
    WHERE ts_ms >= {tb.T0}""",
)
def raw_ordered(spark, sf):
    """A request for all points, newest first, without a limit."""
    history = typed_history(spark, sf)
    out = query_timeseries(TimeseriesRequest(start=tb.T0, desc=True), history.points, history.meas)
    return out.select("series_name", "ts_ms", "seq", "value_num", "value_bool", "value_str")


@register("raw_tall_types", f"WITH {_TYPED} SELECT qpath, series_name, ts_ms, value, value_bool, value_str, seq FROM typed")
def raw_tall_types(spark, sf):
    return typed_history(spark, sf).query_raw_points(tb.type_paths(), return_format="TALL")


@register(
    "agg_last_types",
    f"""WITH {_TYPED} SELECT qpath, series_name, 'LastValue' AS aggregate, ts_ms - (ts_ms - {tb.T0}) % 86400000 AS ts_ms,
      0 AS ordinal, arg_max(value, ts_ms * 1000000 + seq) AS value, arg_max(value_bool, ts_ms * 1000000 + seq) AS value_bool,
      arg_max(value_str, ts_ms * 1000000 + seq) AS value_str
    FROM typed WHERE ts_ms >= {tb.T0} AND ts_ms < {tb.T1} GROUP BY qpath, series_name, ts_ms - (ts_ms - {tb.T0}) % 86400000""",
)
def agg_last_types(spark, sf):
    return typed_history(spark, sf).query_aggregated_points(
        tb.type_paths(), tb.T0, tb.T1, ["LastValue"], return_format="TALL", period="24h"
    )


@register(
    "asset_path_points",
    f"""WITH {POINTS}, {MEASUREMENTS}, {ASSETS}, {PROPERTIES}
    SELECT concat('histprov:h:/tag:Assets/', assets.name) AS qpath, points.series_name, props.name AS property, ts_ms, value_num
    FROM assets JOIN props ON asset_uuid = assets.uuid JOIN active ON active.uuid = measurement_uuid
    JOIN points ON points.series_name = active.name""",
)
def asset_path_points(spark, sf):
    """Every supplier asset asked for by its path: the points of its properties."""
    meas, assets = tb.measurements_view(spark, sf), tb.assets_view(spark, sf)
    found = resolve.resolve_keys(tb.asset_keys(spark, sf), meas, assets, tb.COLLECTOR)
    keys = resolve.with_asset_series(found, tb.properties_view(spark, sf), meas)
    rows = raw.raw_points(tb.points(spark, sf), keys)
    named = keys.select("qpath", "series_name", "property")
    return rows.join(named, ["qpath", "series_name"]).select("qpath", "series_name", "property", "ts_ms", "value_num")


@register(
    "stream_count_types",
    f"""WITH {_TYPED} SELECT series_name, ts_ms - ts_ms % 86400000 AS ts_ms, CAST(count(*) AS DOUBLE) AS count
    FROM typed GROUP BY ALL""",
)
def stream_count_types(spark, sf):
    """Points of any type counted per day by a stream."""
    base = shared_dir(spark)
    typed = tb.typed(tb.event_stream(spark, sf), tb.type_series())
    windows = stream_agg.stream_aggregate(typed, ["count"], "24h")
    stream_agg.write_snapshots(windows, f"{base}/out", f"{base}/checkpoint", "counts", once=True).awaitTermination()
    return stream_agg.latest_snapshot(spark, f"{base}/out")


@register(
    "stream_changes_types",
    f"""WITH {_TYPED}, linked AS (SELECT *, lag(value) OVER w AS n, lag(value_bool) OVER w AS b, lag(value_str) OVER w AS s
      FROM typed WINDOW w AS (PARTITION BY series_name ORDER BY ts_ms, seq))
    SELECT series_name, ts_ms, value AS value_num, value_bool, value_str, false AS late FROM linked
    WHERE n IS DISTINCT FROM value OR b IS DISTINCT FROM value_bool OR s IS DISTINCT FROM value_str""",
)
def stream_changes_types(spark, sf):
    """Changes of boolean, text and number series of a stream."""
    base = shared_dir(spark)
    typed = tb.typed(tb.event_stream(spark, sf), tb.type_series())
    changes.stream_only_changes(typed, f"{base}/out", f"{base}/checkpoint", "typed", once=True).awaitTermination()
    return changes.read_changes(spark, f"{base}/out").drop("seq")


@register(
    "stream_window_closed",
    f"""WITH {POINTS}, w AS (SELECT series_name, ts_ms - ts_ms % 86400000 AS ts_ms, min(value_num) AS min, max(value_num) AS max,
      CAST(count(*) AS DOUBLE) AS count FROM points GROUP BY series_name, ts_ms - ts_ms % 86400000)
    SELECT * FROM w WHERE ts_ms + 86400000 <= (SELECT max(ts_ms) FROM points) - 600000""",
)
def stream_window_closed(spark, sf):
    """Windows that the watermark has closed, each written once; state is held for open windows only."""
    base = shared_dir(spark)
    windows = stream_agg.stream_aggregate(tb.stream_user_points(spark, sf), ["min", "max", "count"], "24h")
    stream_agg.write_closed(windows, f"{base}/out", f"{base}/checkpoint", "closed", once=True).awaitTermination()
    return spark.read.schema(windows.schema).parquet(f"{base}/out")
