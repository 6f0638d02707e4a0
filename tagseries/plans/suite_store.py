"""Registered queries: ingest, storage, telemetry and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.values import map_text
from ..operators import raw
from ..operators import registry as reg
from ..operators import storage, telemetry
from ..operators.aggregate import answer_requests
from ..session import shared_dir, written
from ..sources import ingest
from ..sources import tables
from ..sources import testbed as tb
from ..streaming import aggregate as stream_agg
from ..streaming import changes, partials
from ..streaming import ingest as stream_ingest
from ..schema import POINTS as POINTS_SCHEMA
from .history import store_points as store_named_points
from .history import store_requests
from .registered import K, MEASUREMENTS, ORACLE, POINTS, r6, register
from .suite_registry import _PENDING, pending
from .suite_aggregate import mixed_requests

LINE_SEQ = "((l_orderkey * 16 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey"


def line_requests(spark, sf):
    """One store request per line item, with the columns the two request forms are built from."""
    return tb.table(spark, sf, "lineitem").select(
        F.expr(LINE_SEQ).alias("seq"),
        F.concat(F.lit("sys:gw:/prov:ship:/tag:s"), "l_suppkey").alias("base"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("at"),
        F.col("l_returnflag").alias("flag"),
    )


def matrix_requests(spark, sf):
    """Two tags at two instants each; only line items with flag R carry qualities."""
    base = F.col("base")
    return line_requests(spark, sf).select(
        "seq",
        F.array(F.concat(base, F.lit("/quantity")), F.concat(base, F.lit("/price"))).alias("paths"),
        F.array(
            F.array(F.col("quantity"), F.col("quantity") + 1), F.array(F.col("price"), F.lit(None).cast("double"))
        ).alias("values"),
        F.array(F.col("at"), F.col("at") + 1000).alias("timestamps"),
        F.when(F.col("flag") == "R", F.array(F.lit(64), F.lit(0))).alias("qualities"),
    )


def array_requests(spark, sf):
    """Three points per request in parallel arrays, with qualities for flag R only."""
    base = F.col("base")
    return line_requests(spark, sf).select(
        "seq",
        F.array(
            F.concat(base, F.lit("/quantity")), F.concat(base, F.lit("/quantity")), F.concat(base, F.lit("/price"))
        ).alias("paths"),
        F.array("quantity", F.lit(None).cast("double"), "price").alias("values"),
        F.array(F.col("at"), F.col("at") + 1, F.col("at")).alias("timestamps"),
        F.when(F.col("flag") == "R", F.array(F.lit(192), F.lit(64), F.lit(0))).alias("qualities"),
    )


_SHAPE = ["seq", "qpath", "ts_ms", "value_num", "quality_code"]


@register(
    "ingest_matrix",
    f"""WITH l AS (SELECT {LINE_SEQ} AS seq, concat('sys:gw:/prov:ship:/tag:s', l_suppkey) AS base, l_quantity AS q,
      l_extendedprice AS p, epoch_us(l_shipdate) // 1000 AS t0, l_returnflag = 'R' AS r FROM lineitem)
    SELECT seq, concat(base, '/quantity') AS qpath, t0 AS ts_ms, q AS value_num, CASE WHEN r THEN 64 ELSE 192 END AS quality_code FROM l
    UNION ALL SELECT seq, concat(base, '/quantity'), t0 + 1000, q + 1, CASE WHEN r THEN 0 ELSE 192 END FROM l
    UNION ALL SELECT seq, concat(base, '/price'), t0, p, CASE WHEN r THEN 64 ELSE 192 END FROM l
    UNION ALL SELECT seq, concat(base, '/price'), t0 + 1000, NULL, CASE WHEN r THEN 0 ELSE 192 END FROM l""",
)
def ingest_matrix(spark, sf):
    return ingest.from_tag_matrix(matrix_requests(spark, sf)).select(_SHAPE)


@register(
    "ingest_arrays",
    f"""WITH l AS (SELECT {LINE_SEQ} AS seq, concat('sys:gw:/prov:ship:/tag:s', l_suppkey) AS base, l_quantity AS q,
      l_extendedprice AS p, epoch_us(l_shipdate) // 1000 AS t0, l_returnflag = 'R' AS r FROM lineitem)
    SELECT seq, concat(base, '/quantity') AS qpath, t0 AS ts_ms, q AS value_num, 192 AS quality_code FROM l
    UNION ALL SELECT seq, concat(base, '/quantity'), t0 + 1, NULL, CASE WHEN r THEN 64 ELSE 192 END FROM l
    UNION ALL SELECT seq, concat(base, '/price'), t0, p, CASE WHEN r THEN 0 ELSE 192 END FROM l""",
)
def ingest_arrays(spark, sf):
    return ingest.from_parallel_arrays(array_requests(spark, sf)).select(_SHAPE)


@register(
    "ingest_storable",
    f"""WITH {MEASUREMENTS}, {POINTS}, o AS (
      SELECT CASE WHEN status = 'Bad' THEN 'null value' WHEN series_name NOT IN (SELECT name FROM active) THEN 'no series'
        WHEN event_type = 'signup' THEN 'datatype mismatch' ELSE 'stored' END AS outcome FROM points)
    SELECT outcome, count(*) AS points FROM o GROUP BY outcome""",
)
def ingest_storable(spark, sf):
    # bad points lose their value, sign-ups arrive as text into numeric series
    is_text = F.element_at("tags", "type") == "signup"
    lost = F.col("status") == "Bad"
    pts = (
        tb.points(spark, sf)
        .withColumn("value_str", F.when(~lost & is_text, "yes"))
        .withColumn("value_num", F.when(~lost & ~is_text, F.col("value_num")))
    )
    return storage.skipped_counts(pts, tb.measurements_view(spark, sf))


def stored_events(spark, sf):
    """The events written through the batch store; returns the table's folder."""
    path = shared_dir(spark)
    storage.write_points(tb.points(spark, sf), tb.measurements_view(spark, sf), path, "batch-1")
    return path


@register(
    "store_points",
    f"""WITH {POINTS}, {MEASUREMENTS} SELECT series_name, uuid AS measurement_uuid, ts_ms, value_num, quality_code,
    points.status, concat('k10=', k // 10, ';type=', points.event_type) AS tags
    FROM points JOIN active ON name = series_name""",
)
def store_points(spark, sf):
    table = storage.read_points(spark, stored_events(spark, sf))
    return table.select(
        "series_name",
        "measurement_uuid",
        "ts_ms",
        "value_num",
        "quality_code",
        "status",
        map_text("tags").alias("tags"),
    )


@register(
    "store_requests",
    f"""WITH l AS (SELECT {LINE_SEQ} AS seq, concat('Plant/ship/s', l_suppkey) AS base, l_quantity AS q,
      l_extendedprice AS p, epoch_us(l_shipdate) // 1000 AS t0, l_returnflag = 'R' AS r FROM lineitem)
    SELECT concat(base, '/quantity') AS series_name, t0 AS ts_ms, q AS value_num, 'Good' AS status, seq FROM l
    UNION ALL SELECT concat(base, '/price'), t0, p, CASE WHEN r THEN 'Bad' ELSE 'Good' END, seq FROM l""",
)
def store_line_requests(spark, sf):
    base = shared_dir(spark)
    registry, path = f"{base}/registry", f"{base}/points"
    tables.write_registry(tb.measurements_view(spark, sf), registry, "base")
    store_requests(
        array_requests(spark, sf), "arrays", registry, path, "batch-1", tb.COLLECTOR, grain="year", every_write=True
    )
    table = storage.read_points(spark, path, every_write=True)
    return table.select("series_name", "ts_ms", "value_num", "status", "seq")


_OPS = f"""o AS (SELECT epoch_us(ts) // 1000 AS ts_ms, CASE event_type WHEN 'view' THEN 'raw' WHEN 'purchase' THEN 'agg' ELSE 'store' END AS op,
  CAST({K} AS BIGINT) AS n, CAST(round(value * 100) AS BIGINT) AS ms, event_type = 'error' AS bad FROM events),
i AS (SELECT ts_ms - ts_ms % 30000 AS ts_ms,
  count(*) FILTER (op = 'store' AND NOT bad) AS store_ops, coalesce(sum(n) FILTER (op = 'store' AND NOT bad), 0) AS store_points,
  coalesce(sum(ms) FILTER (op = 'store' AND NOT bad), 0) AS store_ms, count(*) FILTER (op = 'store' AND bad) AS errors,
  count(*) FILTER (op = 'raw') AS raw_ops, coalesce(sum(n) FILTER (op = 'raw'), 0) AS raw_rows,
  coalesce(sum(ms) FILTER (op = 'raw'), 0) AS raw_ms, count(*) FILTER (op = 'agg') AS agg_ops,
  coalesce(sum(n) FILTER (op = 'agg'), 0) AS agg_rows, coalesce(sum(ms) FILTER (op = 'agg'), 0) AS agg_ms
  FROM o GROUP BY ts_ms - ts_ms % 30000)"""
_CUMULATIVE = ["store_ms", "errors", "raw_ops", "raw_rows", "raw_ms", "agg_ops", "agg_rows", "agg_ms"]
_REPORT = f"""SELECT ts_ms, CAST(store_ops AS BIGINT) AS store_ops, CAST(store_points AS BIGINT) AS store_points,
  round(store_points * 1000.0 / coalesce(ts_ms - lag(ts_ms) OVER w, 30000), 6) AS points_per_second,
  {", ".join(f"CAST(sum({c}) OVER w AS BIGINT) AS {c}" for c in _CUMULATIVE)}
  FROM i WINDOW w AS (ORDER BY ts_ms)"""


def _report(df):
    return df.withColumn("points_per_second", F.round("points_per_second", 6))


@register("op_metrics", f"WITH {_OPS} {_REPORT}")
def op_metrics(spark, sf):
    return _report(telemetry.op_metrics(tb.op_log(spark, sf)))


_LEVELS = ["panic", "fatal", "error", "warning", "info", "debug", "trace"]


@register(
    "collector_stats",
    f"""WITH s AS (SELECT concat('c-', event_type) AS collector_uuid, epoch_us(ts) // 1000 AS ts_ms, event_id * 3 AS sent,
      event_id * 3 - event_id // 10 AS good, event_id // 10 AS bad, {K} AS size, event_id // 50 AS flushes, event_id // 500 AS files,
      {K} % 7 AS level FROM events),
    d AS (SELECT *, sent - coalesce(lag(sent) OVER w, 0) AS d_sent, good - coalesce(lag(good) OVER w, 0) AS d_good,
      bad - coalesce(lag(bad) OVER w, 0) AS d_bad, flushes - coalesce(lag(flushes) OVER w, 0) AS d_flushes
      FROM s WINDOW w AS (PARTITION BY collector_uuid ORDER BY ts_ms))
    SELECT collector_uuid, ts_ms - ts_ms % 3600000 AS ts_ms, CAST(sum(d_sent) AS BIGINT) AS points_sent,
      CAST(sum(d_good) AS BIGINT) AS good_points, CAST(sum(d_bad) AS BIGINT) AS bad_points,
      CAST(sum(d_flushes) AS BIGINT) AS buffer_disk_flushes, CAST(arg_max(size, ts_ms) AS BIGINT) AS buffer_size,
      CAST(arg_max(files, ts_ms) AS BIGINT) AS buffer_error_files,
      {", ".join(f"count(*) FILTER (level = {i}) AS log_{x}" for i, x in enumerate(_LEVELS))}
    FROM d GROUP BY collector_uuid, ts_ms - ts_ms % 3600000""",
)
def collector_stats(spark, sf):
    return telemetry.collector_stats(tb.statistics_view(spark, sf), tb.logs_view(spark, sf))


@register(
    "telemetry_store",
    f"""WITH l AS (SELECT concat('c-', event_type) AS collector_uuid, epoch_us(ts) // 1000 AS ts_ms, {K} % 7 AS level, {K} AS k, event_id FROM events)
    SELECT 'logs' AS kind, collector_uuid, ts_ms, CASE level WHEN 0 THEN 'PANIC' WHEN 1 THEN 'FATAL' WHEN 2 THEN 'ERROR'
      WHEN 3 THEN 'WARNING' WHEN 4 THEN 'INFO' WHEN 5 THEN 'DEBUG' ELSE 'TRACE' END AS what FROM l
    UNION ALL SELECT 'statistics', collector_uuid, ts_ms, CAST(event_id * 3 AS VARCHAR) FROM l
    UNION ALL SELECT 'health', collector_uuid, ts_ms, CASE WHEN k < 10 THEN 'Bad' WHEN k < 25 THEN 'Uncertain' ELSE 'Good' END FROM l""",
)
def telemetry_store(spark, sf):
    base = shared_dir(spark)
    health = tb.points(spark, sf).select(
        F.concat(F.lit("c-"), F.element_at("tags", "type")).alias("collector_uuid"), "ts_ms", F.col("status").alias("health")
    )
    sources = {"logs": tb.logs_view(spark, sf), "statistics": tb.statistics_view(spark, sf), "health": health}
    shown = {"logs": "level", "statistics": "points_sent", "health": "health"}
    out = None
    for kind, df in sources.items():
        telemetry.append_telemetry(df, kind, f"{base}/{kind}", "batch-1")
        part = spark.read.parquet(f"{base}/{kind}").select(
            F.lit(kind).alias("kind"), "collector_uuid", "ts_ms", F.col(shown[kind]).cast("string").alias("what")
        )
        out = part if out is None else out.unionByName(part)
    return out


@register(
    "stream_ingest",
    f"""WITH {POINTS} SELECT series_name, {", ".join(["ts_ms", "value_num", "status", "seq"])} FROM points""",
)
def stream_points(spark, sf):
    base = shared_dir(spark)
    registry, path = f"{base}/registry", f"{base}/points"
    tables.write_registry(tb.measurements_view(spark, sf), registry, "base")
    stream_ingest.stream_points(
        tb.stream_user_points(spark, sf), registry, path, f"{base}/checkpoint", once=True
    ).awaitTermination()
    return storage.read_points(spark, path).select("series_name", "ts_ms", "value_num", "status", "seq")


@register(
    "stream_quarantine_replay",
    f"""WITH {POINTS}, {MEASUREMENTS} SELECT CASE WHEN series_name IN (SELECT name FROM active) THEN 'first' ELSE 'replayed' END AS pass,
    series_name, ts_ms, value_num FROM points""",
)
def stream_quarantine_replay(spark, sf):
    """Points of unknown series are set aside, their series are created, the replay stores them."""
    base = shared_dir(spark)
    registry, path, quarantine = f"{base}/registry", f"{base}/points", f"{base}/quarantine"
    meas = tb.measurements_view(spark, sf)
    tables.write_registry(meas, registry, "base")
    stream_ingest.stream_points(
        tb.stream_user_points(spark, sf),
        registry,
        path,
        f"{base}/checkpoint",
        name="first",
        quarantine=quarantine,
        auto_onboard=False,
        once=True,
    ).awaitTermination()
    held = spark.read.parquet(quarantine)
    tables.write_registry(reg.onboard(held, tables.registry_reader(spark, registry)), registry, "repair")
    stream_ingest.replay_quarantine(
        spark, quarantine, registry, path, f"{base}/replay", name="replayed", once=True
    ).awaitTermination()
    done = storage.read_points(spark, path)
    return done.select(F.substring_index("batch", "-", 1).alias("pass"), "series_name", "ts_ms", "value_num")


@register(
    "stream_window_agg",
    f"""WITH {POINTS} SELECT series_name, ts_ms - ts_ms % 86400000 AS ts_ms, round(avg(value_num), 6) AS mean,
    min(value_num) AS min, max(value_num) AS max, CAST(count(*) AS DOUBLE) AS count,
    arg_max(value_num, ts_ms * 1000000 + seq) AS last FROM points GROUP BY series_name, ts_ms - ts_ms % 86400000""",
)
def stream_window_agg(spark, sf):
    base = shared_dir(spark)
    windows = stream_agg.stream_aggregate(
        tb.stream_user_points(spark, sf), ["mean", "min", "max", "count", "last"], "24h"
    )
    stream_agg.write_snapshots(windows, f"{base}/out", f"{base}/checkpoint", "windows", once=True).awaitTermination()
    return stream_agg.latest_snapshot(spark, f"{base}/out").withColumn("mean", F.round("mean", 6))


@register("stream_mixed_requests", ORACLE["agg_mixed_requests"])
def stream_mixed_requests(spark, sf):
    """The mixed requests answered from windows kept by a stream."""
    base = shared_dir(spark)
    requests = mixed_requests(spark, sf)
    functions = ["mean", "min", "max", "spread", "last", "count"]
    windows = stream_agg.stream_aggregate(tb.stream_user_points(spark, sf), functions, "24h", requests=requests)
    stream_agg.write_snapshots(windows, f"{base}/out", f"{base}/checkpoint", "requests", once=True).awaitTermination()
    out = answer_requests(stream_agg.latest_snapshot(spark, f"{base}/out"), requests, functions)
    return out.withColumn("value", r6("value"))


@register(
    "stream_only_changes",
    f"""WITH {POINTS}, linked AS (
      SELECT series_name, ts_ms, CAST(quality_code AS DOUBLE) AS value_num,
             lag(quality_code) OVER (PARTITION BY series_name ORDER BY ts_ms, seq) AS before FROM points)
    SELECT series_name, ts_ms, value_num, false AS late FROM linked WHERE before IS DISTINCT FROM value_num""",
)
def stream_only_changes(spark, sf):
    base = shared_dir(spark)
    coded = tb.stream_user_points(spark, sf).withColumn("value_num", F.col("quality_code").cast("double"))
    changes.stream_only_changes(coded, f"{base}/out", f"{base}/checkpoint", "changes", once=True).awaitTermination()
    return changes.read_changes(spark, f"{base}/out").select("series_name", "ts_ms", "value_num", "late")


@register(
    "stream_telemetry",
    f"""SELECT concat('c-', event_type) AS collector_uuid, epoch_us(ts) // 1000 AS ts_ms,
    CASE {K} % 7 WHEN 0 THEN 'PANIC' WHEN 1 THEN 'FATAL' WHEN 2 THEN 'ERROR' WHEN 3 THEN 'WARNING' WHEN 4 THEN 'INFO'
      WHEN 5 THEN 'DEBUG' ELSE 'TRACE' END AS level, props AS message FROM events""",
)
def stream_telemetry(spark, sf):
    base = shared_dir(spark)
    logs = tb.event_logs(tb.event_stream(spark, sf))
    stream_ingest.stream_telemetry(logs, "logs", f"{base}/logs", f"{base}/checkpoint", once=True).awaitTermination()
    return spark.read.parquet(f"{base}/logs").select("collector_uuid", "ts_ms", "level", "message")


@register("stream_metrics", f"WITH {_OPS} {_REPORT}")
def stream_metrics(spark, sf):
    base = shared_dir(spark)
    ops = tb.event_operations(tb.event_stream(spark, sf))
    partials.stream_metrics(ops, f"{base}/out", f"{base}/checkpoint", "metrics", once=True).awaitTermination()
    return _report(telemetry.metric_report(written(partials.read_metrics(spark, f"{base}/out"))))


@register(
    "stream_two_writers",
    f"""WITH {POINTS} SELECT series_name, ts_ms, seq, count(*) * 2 AS writes FROM points GROUP BY ALL""",
)
def stream_two_writers(spark, sf):
    """Two streams of one name and two checkpoints write into one table; neither replaces the other's rows."""
    base = shared_dir(spark)
    registry, path = f"{base}/registry", f"{base}/points"
    tables.write_registry(tb.measurements_view(spark, sf), registry, "base")
    for i in range(2):
        stream_ingest.stream_points(
            tb.stream_user_points(spark, sf), registry, path, f"{base}/checkpoint-{i}", once=True
        ).awaitTermination()
    written = storage.read_points(spark, path, every_write=True)
    return written.groupBy("series_name", "ts_ms", "seq").agg(F.count("*").alias("writes"))


@register(
    "store_refused",
    f"""WITH {POINTS}, {MEASUREMENTS} SELECT reason, count(*) AS points FROM (
      SELECT CASE WHEN series_name NOT IN (SELECT name FROM active) THEN 'no series' WHEN event_type = 'signup'
        THEN 'datatype mismatch' ELSE 'stored' END AS reason FROM points) GROUP BY reason""",
)
def store_refused(spark, sf):
    """What a batch store takes and what it sets aside add up to the input."""
    path = shared_dir(spark)
    is_text = F.element_at("tags", "type") == "signup"
    pts = tb.points(spark, sf).withColumn("value_str", F.when(is_text, "yes"))
    pts = pts.withColumn("value_num", F.when(~is_text, F.col("value_num")))
    storage.write_points(pts, tb.measurements_view(spark, sf), path, "batch-1")
    refused = spark.read.parquet(storage.refused_path(path)).select("reason")
    both = refused.unionAll(storage.read_points(spark, path).select(F.lit("stored").alias("reason")))
    return both.groupBy("reason").agg(F.count("*").alias("points"))


@register(
    "stored_range",
    f"""WITH {POINTS}, {MEASUREMENTS}, b AS (SELECT min(ts_ms) + 86400000 AS lo, max(ts_ms) - 86400000 AS hi FROM points)
    SELECT series_name, ts_ms, value_num FROM points, b WHERE series_name IN (SELECT name FROM active)
    AND ts_ms >= lo AND ts_ms < hi""",
)
def stored_range(spark, sf):
    """A range read of a table written by month; the range prunes its partitions."""
    path = shared_dir(spark)
    pts = tb.points(spark, sf)
    storage.write_points(pts, tb.measurements_view(spark, sf), path, "batch-1", grain="month")
    low, high = pts.agg(F.min("ts_ms"), F.max("ts_ms")).first()
    day = 86_400_000
    return raw.time_range(storage.read_points(spark, path), low + day, high - day).select("series_name", "ts_ms", "value_num")


@register(
    "ingest_same_instant",
    f"""WITH l AS (SELECT {LINE_SEQ} AS seq, concat('Plant/ship/s', l_suppkey) AS base, l_quantity AS q,
      l_extendedprice AS p, epoch_us(l_shipdate) // 1000 AS t0, l_returnflag = 'R' AS r FROM lineitem),
    a AS (SELECT concat(base, '/quantity') AS series_name, t0 AS ts_ms, q AS value_num, 'Good' AS status, seq FROM l
      UNION ALL SELECT concat(base, '/price'), t0, p, CASE WHEN r THEN 'Bad' ELSE 'Good' END, seq FROM l)
    SELECT series_name, ts_ms, arg_max(value_num, seq) AS value_num, arg_max(status, seq) AS status, max(seq) AS seq
    FROM a GROUP BY series_name, ts_ms""",
)
def ingest_same_instant(spark, sf):
    """Requests with many values for one instant: the table keeps the last one."""
    base = shared_dir(spark)
    registry, path = f"{base}/registry", f"{base}/points"
    tables.write_registry(tb.measurements_view(spark, sf), registry, "base")
    store_requests(array_requests(spark, sf), "arrays", registry, path, "batch-1", tb.COLLECTOR, grain="year")
    return storage.read_points(spark, path).select("series_name", "ts_ms", "value_num", "status", "seq")


def rewritten_events(spark, sf):
    """The events stored in two batches, the second of which gives every instant of an even k another value, and
    in a third with lower arrival numbers, which drops that of the clicks again; returns the table's folder."""
    path, meas, pts = shared_dir(spark), tb.measurements_view(spark, sf), tb.points(spark, sf)
    storage.write_points(pts, meas, path, "batch-1", grain="month")
    changed = pts.filter(F.element_at("tags", "k10").cast("int") % 2 == 0)
    storage.write_points(changed.withColumn("value_num", F.col("value_num") + 1000), meas, path, "batch-2", grain="month")
    clicks = changed.filter(F.element_at("tags", "type") == "click").withColumn("seq", F.lit(0))
    storage.write_points(clicks.withColumn("value_num", -F.col("value_num")), meas, path, "batch-3", grain="month")
    return path


_REWRITTEN = f"""{POINTS}, {MEASUREMENTS}, stored AS (
  SELECT series_name, ts_ms, CASE WHEN k // 10 % 2 = 1 THEN value_num WHEN event_type = 'click' THEN -value_num
    ELSE value_num + 1000 END AS value_num FROM points WHERE series_name IN (SELECT name FROM active))"""


@register("store_rewritten_instant", f"WITH {_REWRITTEN} SELECT * FROM stored")
def store_rewritten_instant(spark, sf):
    """An instant written three times has the value of the last write, whatever its arrival number."""
    return storage.read_points(spark, rewritten_events(spark, sf)).select("series_name", "ts_ms", "value_num")


@register(
    "agg_rewritten_instant",
    f"""WITH {_REWRITTEN} SELECT series_name, CAST(count(*) AS DOUBLE) AS count, round(sum(value_num), 6) AS sum,
    arg_max(value_num, ts_ms) AS last FROM stored GROUP BY series_name""",
)
def agg_rewritten_instant(spark, sf):
    """Aggregates over rewritten instants count each once."""
    pts = storage.read_points(spark, rewritten_events(spark, sf))
    return pts.groupBy("series_name").agg(
        F.count("*").cast("double").alias("count"),
        r6(F.sum("value_num")).alias("sum"),
        F.max_by("value_num", "ts_ms").alias("last"),
    )


@register("compacted_day", f"WITH {_REWRITTEN} SELECT series_name, ts_ms, value_num, 1 AS folders FROM stored")
def compacted_day(spark, sf):
    """Parts merged into one folder each and read back, with the number of folders behind each part."""
    path = rewritten_events(spark, sf)
    storage.compact_points(spark, path)
    folders = storage.live_folders(spark, path)
    rows = storage.read_points(spark, path).join(folders, "part")
    return rows.select("series_name", "ts_ms", "value_num", "folders")


def typed_requests(spark, sf):
    """Matrix requests whose two tags hold a number and a text, a boolean or a null."""
    flag = F.col("flag")
    text = F.when(flag == "R", F.lit("true")).when(flag == "A", F.lit('"a"')).otherwise(F.lit("null"))
    cell = lambda c: F.parse_json(c)
    number = F.col("quantity").cast("decimal(12,2)").cast("string")
    return line_requests(spark, sf).select(
        "seq",
        F.array(F.concat("base", F.lit("/quantity")), F.concat("base", F.lit("/flag"))).alias("paths"),
        F.array(F.array(cell(number)), F.array(cell(text))).alias("values"),
        F.array("at").alias("timestamps"),
        F.lit(None).cast("array<int>").alias("qualities"),
    )


@register(
    "ingest_typed_matrix",
    f"""WITH l AS (SELECT {LINE_SEQ} AS seq, concat('sys:gw:/prov:ship:/tag:s', l_suppkey) AS base, l_quantity AS q,
      epoch_us(l_shipdate) // 1000 AS ts_ms, l_returnflag AS f FROM lineitem)
    SELECT seq, concat(base, '/quantity') AS qpath, ts_ms, CAST(q AS DOUBLE) AS value_num, CAST(NULL AS BOOLEAN) AS value_bool,
      CAST(NULL AS VARCHAR) AS value_str, 0 AS place FROM l
    UNION ALL SELECT seq, concat(base, '/flag'), ts_ms, NULL, CASE WHEN f = 'R' THEN true END, CASE WHEN f = 'A' THEN 'a' END, 1 FROM l""",
)
def ingest_typed_matrix(spark, sf):
    """Values of any type in one request, each in the column of its type."""
    out = ingest.from_tag_matrix(typed_requests(spark, sf))
    return out.select("seq", "qpath", "ts_ms", "value_num", "value_bool", "value_str", F.col("place").cast("int").alias("place"))


@register(
    "ingest_array_order",
    """SELECT concat('Plant/ship/s', l_suppkey, '/o', l_orderkey) AS series_name, epoch_us(l_shipdate) // 1000 AS ts_ms,
      CAST(l_quantity AS DOUBLE) + 2 AS value_num FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_orderkey, l_shipdate ORDER BY l_linenumber DESC) = 1""",
)
def ingest_array_order(spark, sf):
    """Three entries of a request for one instant: the last of the arrays is stored."""
    base = shared_dir(spark)
    registry, path = f"{base}/registry", f"{base}/points"
    tables.write_registry(tb.measurements_view(spark, sf), registry, "base")
    lines = tb.table(spark, sf, "lineitem")
    tag = F.concat(F.lit("sys:gw:/prov:ship:/tag:s"), "l_suppkey", F.lit("/o"), "l_orderkey")
    at = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    asked = lines.select(
        F.col("l_linenumber").cast("bigint").alias("seq"),
        F.array(tag, tag, tag).alias("paths"),
        F.array(*[F.col("l_quantity").cast("double") + i for i in range(3)]).alias("values"),
        F.array(at, at, at).alias("timestamps"),
        F.lit(None).cast("array<int>").alias("qualities"),
    )
    store_requests(asked, "arrays", registry, path, "batch-1", tb.COLLECTOR, grain="year")
    return storage.read_points(spark, path).select("series_name", "ts_ms", "value_num")


@register(
    "evict_stored",
    f"""WITH {MEASUREMENTS}, {POINTS}, names AS (SELECT DISTINCT series_name AS name FROM points)
    SELECT names.name, CASE WHEN m.name IS NULL THEN 1 WHEN lower(m.status) = 'deleted' THEN 2 WHEN m.quality = 'Bad' THEN 3
      ELSE 1 END AS versions, 1 AS kept, m.name IS NULL OR lower(m.status) = 'deleted' OR m.quality = 'Bad' AS created
    FROM names LEFT JOIN measurements m ON m.name = names.name""",
)
def evict_stored(spark, sf):
    """Series that the store rejects are forgotten until their next points create them anew; merging the
    registry keeps the newest version of each."""
    base = shared_dir(spark)
    registry, path = f"{base}/registry", f"{base}/points"
    tables.write_registry(tb.measurements_view(spark, sf), registry, "base")
    rejected = tables.registry_reader(spark, registry).filter("quality = 'Bad'")
    tables.retire_stored(spark, registry, rejected, "reject-1")
    store_named_points(tb.points(spark, sf), registry, path, "batch-1", grain="month")
    versions = tables.registry_reader(spark, registry).groupBy("name").agg(F.count("*").cast("int").alias("versions"))
    tables.compact_registry(spark, registry)
    rows = tables.registry_reader(spark, registry).groupBy("name").agg(F.count("*").cast("int").alias("kept"))
    active = reg.measurements(tables.registry_reader(spark, registry))
    made = active.select("name", F.col("database").isNull().alias("created"))
    return versions.join(rows, "name").join(made, "name")


@register(
    "stream_metadata",
    f"""WITH {MEASUREMENTS}, {_PENDING} SELECT tag_path AS name, CASE WHEN low > 0 THEN concat('series of ', event_type) END AS description,
      concat(CASE WHEN high > 0 THEN 'grade=high;' ELSE '' END, 'last_k=', last_k) AS attributes,
      tag_path IN (SELECT name FROM active) AS waits FROM pending""",
)
def stream_metadata(spark, sf):
    """Properties written for all series before their stream: new series take theirs, those of known series wait on."""
    base = shared_dir(spark)
    registry, path, metadata = f"{base}/registry", f"{base}/points", f"{base}/metadata"
    tables.write_registry(tb.measurements_view(spark, sf), registry, "base")
    tables.write_metadata(pending(spark, sf), metadata, "metadata-1")
    stream_ingest.stream_points(
        tb.stream_user_points(spark, sf), registry, path, f"{base}/checkpoint", once=True, metadata=metadata, grain="month"
    ).awaitTermination()
    made = reg.measurements(tables.registry_reader(spark, registry)).filter(F.col("database").isNull())
    waiting = tables.metadata_reader(spark, metadata)
    rest = F.map_filter("properties", lambda k, v: k != "description")
    columns = ["name", "description", map_text("attributes").alias("attributes"), "waits"]
    left = waiting.select(
        F.col("tag_path").alias("name"),
        F.try_element_at("properties", F.lit("description")).alias("description"),
        rest.alias("attributes"),
        F.lit(True).alias("waits"),
    )
    return made.withColumn("waits", F.lit(False)).select(columns).unionByName(left.select(columns))


_LAST = f"""{_REWRITTEN}, b AS (SELECT min(ts_ms) + 8 * 86400000 AS lo, max(ts_ms) - 8 * 86400000 AS hi FROM points)"""


@register(
    "latest_stored",
    f"""WITH {_REWRITTEN} SELECT series_name, max(ts_ms) AS ts_ms, arg_max(value_num, ts_ms) AS value_num
    FROM stored GROUP BY series_name""",
)
def latest_stored(spark, sf):
    """The newest stored point of every series, found through the spans of the batches."""
    return storage.latest_stored(spark, rewritten_events(spark, sf)).select("series_name", "ts_ms", "value_num")


@register(
    "bounds_stored",
    f"""WITH {_LAST} SELECT series_name, ts_ms, value_num, 'inside' AS bound FROM stored, b WHERE ts_ms >= lo AND ts_ms < hi
    UNION ALL SELECT series_name, max(ts_ms), arg_max(value_num, ts_ms), 'lower' FROM stored, b WHERE ts_ms < lo GROUP BY series_name
    UNION ALL SELECT series_name, min(ts_ms), arg_min(value_num, ts_ms), 'upper' FROM stored, b WHERE ts_ms >= hi GROUP BY series_name""",
)
def bounds_stored(spark, sf):
    """A stored range with the points around it."""
    path = rewritten_events(spark, sf)
    low, high = tb.points(spark, sf).agg(F.min("ts_ms"), F.max("ts_ms")).first()
    span = 8 * 86_400_000
    return storage.bounds_stored(spark, path, low + span, high - span).select("series_name", "ts_ms", "value_num", "bound")


@register(
    "stream_window_corrected",
    f"""WITH {POINTS}, b AS (SELECT max(ts_ms) - 600000 AS behind FROM points WHERE k >= 30)
    SELECT series_name, ts_ms - ts_ms % 86400000 AS ts_ms, round(avg(value_num), 6) AS mean, min(value_num) AS min,
      max(value_num) AS max, round(sum(value_num), 6) AS sum, CAST(count(*) AS DOUBLE) AS count,
      arg_max(value_num, ts_ms * 1000000 + seq) AS last, count(*) FILTER (k < 30 AND ts_ms < behind) AS late
    FROM points, b GROUP BY series_name, ts_ms - ts_ms % 86400000""",
)
def stream_window_corrected(spark, sf):
    """Windows of a stream whose second batch holds points of all days: those behind a watermark are counted as late,
    and the windows are those of all points."""
    base = shared_dir(spark)
    pts = tb.points(spark, sf)
    low = F.expr("CAST(element_at(tags, 'k10') AS INT)") < 3
    for part in (pts.filter(~low), pts.filter(low)):  # one batch each, of as many files as there are tasks
        storage.conform(part).write.mode("append").parquet(f"{base}/in")
        src = tables.point_stream(spark, f"{base}/in", POINTS_SCHEMA)
        partials.stream_windows(src, f"{base}/out", f"{base}/checkpoint", "corrected", "24h", once=True).awaitTermination()
    out = partials.read_windows(spark, f"{base}/out", ["mean", "min", "max", "sum", "count", "last"])
    return out.withColumns({"mean": r6("mean"), "sum": r6("sum")})
