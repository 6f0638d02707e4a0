"""Ingest shapes, storage, telemetry and streams on small fixtures."""

import pytest
from fixtures import BASE, measurement, measurements, point, points, values
from pyspark.sql import functions as F

from tagseries.operators import storage, telemetry
from tagseries.operators.ordered import dedupe_last_write, only_changes
from tagseries.operators.raw import time_range
from tagseries.plans import history
from tagseries.plans.history import pending_metadata, store_requests
from tagseries.schema import OP_LOG, POINTS
from tagseries.sources import ingest, tables
from tagseries.streaming import aggregate as stream_agg
from tagseries.streaming import changes
from tagseries.streaming import ingest as streams


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def test_matrix(spark):
    df = spark.createDataFrame(
        [(["a", "b"], [[1.0, 2.0], [3.0, None]], [10, 20], None), (["c"], [[5.0]], [30], [64])],
        "paths array<string>, values array<array<double>>, timestamps array<bigint>, qualities array<int>",
    )
    assert values(ingest.from_tag_matrix(df), "qpath", "ts_ms", "value_num", "quality_code") == [
        ("a", 10, 1.0, 192),
        ("a", 20, 2.0, 192),
        ("b", 10, 3.0, 192),
        ("b", 20, None, 192),
        ("c", 30, 5.0, 64),
    ]


def test_parallel_arrays(spark):
    df = spark.createDataFrame(
        [(["a", "b"], [1.0, 2.0], [10, 20], None), (["c", "c"], [5.0, 6.0], [30, 31], [64, None])],
        "paths array<string>, values array<double>, timestamps array<bigint>, qualities array<int>",
    )
    assert values(ingest.from_parallel_arrays(df), "qpath", "ts_ms", "value_num", "quality_code") == [
        ("a", 10, 1.0, 192),
        ("b", 20, 2.0, 192),
        ("c", 30, 5.0, 64),
        ("c", 31, 6.0, 192),
    ]


def test_skipped_points_have_reasons(spark):
    meas = measurements(spark, [measurement("num"), measurement("flag", datatype="boolean")])
    pts = points(
        spark,
        [point("num", 1, 1), point("num", 2, None), point("num", 3, "x"), point("flag", 4, True), point("no", 5, 1),
         point("num", None, 1, seq=6)],
    )
    good, skipped = storage.storable(pts, meas)
    assert values(good, "series_name", "ts_ms", "measurement_uuid") == [("flag", 4, "id-flag"), ("num", 1, "id-num")]
    assert sorted(r for (r,) in values(skipped, "reason")) == ["datatype mismatch", "no series", "no timestamp", "null value"]
    assert dict(values(storage.skipped_counts(pts, meas), "outcome", "points"))["stored"] == 2


def test_repeated_batch_is_idempotent(spark, folder):
    meas = measurements(spark, [measurement("a")])
    df = points(spark, [point("a", BASE + i * 3_600_000, i) for i in range(40)])
    storage.write_points(df, meas, folder, "one")
    storage.write_points(df, meas, folder, "one")
    storage.write_points(df.withColumn("value_num", F.col("value_num") + 1), meas, folder, "two")
    assert storage.read_points(spark, folder, every_write=True).count() == 80
    assert sorted(v for (v,) in values(storage.read_points(spark, folder), "value_num")) == list(range(1, 41))
    ranged = storage.read_points(spark, folder, BASE + 3_600_000, BASE + 5 * 3_600_000)
    assert ranged.count() == 4
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "GreaterThanOrEqual(ts_ms" in plan


@pytest.mark.parametrize("grain,parts", [("day", 2), ("month", 1), ("year", 1)])
def test_partition_grains(spark, folder, grain, parts):
    meas = measurements(spark, [measurement("a")])
    storage.write_points(points(spark, [point("a", BASE, 1), point("a", BASE + 86_400_000, 2)]), meas, folder, "b", grain)
    back = storage.read_points(spark, folder, BASE + 1, BASE + 90_000_000)
    assert values(back, "value_num") == [(2.0,)]
    assert storage.read_points(spark, folder).select("part").distinct().count() == parts


def test_store_round_trip(spark, folder):
    registry, path = f"{folder}/registry", f"{folder}/points"
    tables.write_registry(measurements(spark, [measurement("Plant/default/old")]), registry, "base")
    q = "sys:gw:/prov:default:/tag:"
    asked = spark.createDataFrame(
        [([q + "rt"] * 5, [42.0 + i for i in range(5)], [BASE + i * 1000 for i in range(5)], [192] * 5, 1)],
        "paths array<string>, values array<double>, timestamps array<bigint>, qualities array<int>, seq bigint",
    )
    meta = spark.createDataFrame(
        [(q + "rt", {"description": "round trip", "unit": "C"}, 1)], "qpath string, properties map<string,string>, seq bigint"
    )
    for _ in range(2):
        store_requests(asked, "arrays", registry, path, "b1", "Plant", pending_metadata(meta, "Plant"))
    assert sorted(v for (v,) in values(storage.read_points(spark, path), "value_num")) == [42, 43, 44, 45, 46]
    created = tables.registry_reader(spark, registry).filter("name = 'Plant/default/rt'")
    assert values(created, "datatype", "description", "attributes") == [("number", "round trip", {"unit": "C"})]
    with pytest.raises(ValueError):
        store_requests(asked, "table", registry, path, "b2", "Plant")


def op_log(spark, rows):
    return spark.createDataFrame(rows, OP_LOG)


def test_metrics(spark):
    df = op_log(
        spark,
        [
            (1_000, "store", 3, 50, False),
            (2_000, "store", 7, 150, False),
            (3_000, "raw", 10, 100, False),
            (4_000, "store", 9, 9, True),
            (31_000, "raw", 20, 300, False),
            (95_000, "store", 6, 1, False),
            (96_000, "agg", 25, 500, False),
        ],
    )
    got = telemetry.op_metrics(df).orderBy("ts_ms").collect()
    assert [(r.ts_ms, r.store_ops, r.store_points, r.points_per_second) for r in got] == [
        (0, 2, 10, 10 / 30),
        (30_000, 0, 0, 0.0),
        (90_000, 1, 6, 0.1),
    ]
    assert [(r.store_ms, r.errors, r.raw_ops, r.raw_rows, r.raw_ms) for r in got] == [
        (200, 1, 1, 10, 100),
        (200, 1, 2, 30, 400),
        (201, 1, 2, 30, 400),
    ]
    assert [(r.agg_ops, r.agg_rows, r.agg_ms) for r in got] == [(0, 0, 0), (0, 0, 0), (1, 25, 500)]


def test_collector_counters_survive_a_restart(spark):
    rows = [("c", t, sent, sent, 0, size, 0, 0) for t, sent, size in [(0, 10, 5), (10, 25, 6), (3_600_000, 4, 7), (3_600_001, 9, 8)]]
    stats = spark.createDataFrame(rows, telemetry.STATISTICS)
    logs = spark.createDataFrame([("c", 5, "ERROR", None, "m"), ("d", 6, "INFO", None, "m")], telemetry.LOGS)
    got = telemetry.collector_stats(stats, logs)
    assert values(got, "collector_uuid", "ts_ms", "points_sent", "buffer_size", "log_error", "log_info") == [
        ("c", 0, 25, 6, 1, 0),
        ("c", 3_600_000, 9, 8, 0, 0),
        ("d", 0, None, None, 0, 1),
    ]


def test_telemetry_table(spark, folder):
    logs = spark.createDataFrame([("c", BASE, "ERROR", None, "m")], telemetry.LOGS)
    for _ in range(2):
        telemetry.append_telemetry(logs, "logs", folder, "b")
    assert spark.read.parquet(folder).count() == 1
    with pytest.raises(ValueError):
        telemetry.append_telemetry(logs, "notes", folder, "b")
    mixed = logs.unionAll(logs.withColumn("level", F.lit("LOUD"))).unionAll(logs.withColumn("level", F.lit(None)))
    for _ in range(2):
        telemetry.append_telemetry(mixed, "logs", folder, "c")
    assert spark.read.parquet(folder).count() == 2  # the good entry is stored
    refused = spark.read.parquet(telemetry.refused_telemetry_path(folder))
    assert values(refused, "level", "message") == [("LOUD", "m"), (None, "m")]


def drop(df, folder):
    """Add one file to a stream's folder."""
    df.coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder, per_trigger=1):
    return tables.point_stream(spark, folder, POINTS, files_per_trigger=per_trigger)


def test_stream_onboards_and_stores_late_points(spark, folder):
    src, registry, path, check = (f"{folder}/{x}" for x in ("in", "registry", "points", "check"))
    tables.write_registry(measurements(spark, [measurement("old")]), registry, "base")
    drop(points(spark, [point("new", BASE, 1), point("new", BASE + 5, "oops"), point("new", BASE + 6, None)]), src)
    drop(points(spark, [point("new", BASE - 10**9, 2), point("old", BASE, 3)]), src)

    def run():
        streams.stream_points(source(spark, src), registry, path, check, quarantine=f"{folder}/q", once=True).awaitTermination()

    run()
    assert values(storage.read_points(spark, path), "series_name", "value_num") == [("new", 1.0), ("new", 2.0), ("old", 3.0)]
    assert values(spark.read.parquet(f"{folder}/q"), "series_name", "reason", "attempt") == [("new", "datatype mismatch", 1)]
    assert tables.registry_reader(spark, registry).filter("name = 'new'").count() == 1
    drop(points(spark, [point("new", BASE + 9, 4)]), src)
    run()
    assert storage.read_points(spark, path).count() == 4


def test_stream_applies_pending_metadata(spark, folder):
    from tagseries.schema import PENDING_METADATA

    src, registry, meta = (f"{folder}/{x}" for x in ("in", "registry", "meta"))
    tables.write_registry(measurements(spark, [measurement("old")]), registry, "base")
    drop(points(spark, [point("new", BASE, 1)]), src)
    rows = [("new", {"unit": "C", "description": "d1"}, 1), ("new", {"description": "d2"}, 2)]
    tables.write_metadata(spark.createDataFrame(rows, PENDING_METADATA), meta, "m-1")
    streams.stream_points(
        source(spark, src), registry, f"{folder}/points", f"{folder}/check", once=True, metadata=meta
    ).awaitTermination()
    made = tables.registry_reader(spark, registry).filter("name = 'new'")
    assert values(made, "description", "attributes") == [("d2", {"unit": "C"})]


def test_repeated_micro_batch_changes_nothing(spark, folder):
    registry, path = f"{folder}/registry", f"{folder}/points"
    tables.write_registry(measurements(spark, [measurement("old")]), registry, "base")
    df = points(spark, [point("new", BASE, 1), point("old", BASE, 2), point("old", None, 3, seq=1)])
    for _ in range(2):
        streams.store_batch(df, "s-1", registry, path, f"{folder}/q")
    assert storage.read_points(spark, path).count() == 2
    assert tables.registry_reader(spark, registry).count() == 2
    assert values(spark.read.parquet(f"{folder}/q"), "reason") == [("no timestamp",)]


def test_quarantine_and_replay(spark, folder):
    src, registry, path, q = (f"{folder}/{x}" for x in ("in", "registry", "points", "q"))
    tables.write_registry(measurements(spark, [measurement("a")]), registry, "base")
    drop(points(spark, [point("a", BASE, 1), point("b", BASE, 2), point("c", BASE, 3)]), src)
    streams.stream_points(
        source(spark, src), registry, path, f"{folder}/check", quarantine=q, auto_onboard=False, once=True
    ).awaitTermination()
    assert storage.read_points(spark, path).count() == 1

    def replay():
        streams.replay_quarantine(spark, q, registry, path, f"{folder}/replay", once=True).awaitTermination()

    replay()
    assert storage.read_points(spark, path).count() == 1
    assert sorted(values(spark.read.parquet(q), "series_name", "attempt")) == [("b", 1), ("b", 2), ("c", 1), ("c", 2)]
    tables.write_registry(measurements(spark, [measurement("b")]), registry, "repair")
    replay()
    assert values(storage.read_points(spark, path), "series_name") == [("a",), ("b",)]
    replay()
    assert dedupe_last_write(storage.read_points(spark, path)).count() == 2


def test_stream_changes_equal_the_batch(spark, folder):
    levels = [1, 1, 2, 2, None, None, 3, 3, 1, 1]
    rows = [point(s, BASE + i * 1000, v, seq=i) for s in "ab" for i, v in enumerate(levels)]
    first, second = [r for r in rows if r[9] < 4], [r for r in rows if r[9] >= 4]
    drop(points(spark, first), f"{folder}/in")
    run = lambda: changes.stream_only_changes(
        source(spark, f"{folder}/in"), f"{folder}/out", f"{folder}/check", "changes", once=True
    ).awaitTermination()
    run()
    drop(points(spark, second), f"{folder}/in")
    run()
    late = points(spark, [point("a", BASE + 500, 9, seq=99)])
    drop(late, f"{folder}/in")
    run()
    got = changes.read_changes(spark, f"{folder}/out")
    want = only_changes(points(spark, rows))
    assert values(got.filter("NOT late"), "series_name", "ts_ms", "value_num") == values(want, "series_name", "ts_ms", "value_num")
    assert values(got.filter("late"), "series_name", "value_num") == [("a", 9.0)]


def test_closed_windows(spark, folder):
    rows = [point("a", BASE + i * 10_000, i) for i in range(30)]
    drop(points(spark, rows), f"{folder}/in")
    df = stream_agg.stream_aggregate(source(spark, f"{folder}/in"), ["mean", "count", "last"], "1m", lateness="10 seconds")
    stream_agg.write_closed(df, f"{folder}/out", f"{folder}/check", "closed", once=True).awaitTermination()
    got = sorted(values(spark.read.parquet(f"{folder}/out"), "ts_ms", "count", "last"))
    assert got[0] == (BASE - BASE % 60_000, 1.0 * sum(1 for r in rows if r[2] < BASE - BASE % 60_000 + 60_000), got[0][2])
    assert all(t + 60_000 <= BASE + 290_000 - 10_000 for t, _, _ in got)


def test_range_reads_prune_partitions(spark, folder):
    df = points(spark, [point("a", BASE + i * 86_400_000, i, seq=i) for i in range(40)])
    for grain in ("day", "month", "year"):
        path = f"{folder}/{grain}"
        storage.write_points(df, measurements(spark, [measurement("a")]), path, "b", grain)
        got = time_range(storage.read_points(spark, path), BASE + 3 * 86_400_000, BASE + 5 * 86_400_000)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert got.count() == 2 and "part#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_refused_points_are_kept(spark, folder):
    df = points(spark, [point("a", BASE, "OFF"), point("x", BASE, 1), point("a", BASE, 2), point("a", BASE, None)])
    storage.write_points(df, measurements(spark, [measurement("a")]), f"{folder}/p", "b")
    kept = spark.read.parquet(storage.refused_path(f"{folder}/p"))
    assert values(kept, "series_name", "reason") == [("a", "datatype mismatch"), ("x", "no series")]


def test_replays_do_not_pile_up(spark, folder):
    registry, q = f"{folder}/registry", f"{folder}/q"
    tables.write_registry(measurements(spark, [measurement("a")]), registry, "base")
    drop(points(spark, [point("b", BASE, i, seq=i) for i in range(3)]), f"{folder}/in")
    streams.stream_points(
        source(spark, f"{folder}/in"), registry, f"{folder}/p", f"{folder}/check", quarantine=q, auto_onboard=False, once=True
    ).awaitTermination()
    for _ in range(4):
        streams.replay_quarantine(spark, q, registry, f"{folder}/p", f"{folder}/replay", once=True).awaitTermination()
    assert 3 <= spark.read.parquet(q).count() <= 9


@pytest.mark.parametrize("every_write", [False, True])
def test_requests_meet_only_the_known_series_among_them(spark, folder, monkeypatch, every_write):
    """Few paths and many lead to the same rows, and the registry is not shuffled beside the points of either."""
    q, meas = "sys:gw:/prov:default:/tag:", [measurement("Plant/default/old"), measurement("Plant/default/text", datatype="string")]
    rows = []
    for i, (name, at) in enumerate([("old", 0), ("new", 0), ("text", 0), ("new", 1), ("new", None), ("late", None)]):
        base = None if at is None else BASE + at
        rows += [([q + name, q + name, None], [float(i), i + 0.5, 1.0], [base, base, base], None, i // 2 if i else None)]
    rows += [([q + "empty"], [None], [BASE], [192], 9), ([q + "new"] * 2, [7.0, None], [BASE, BASE], [64, 0], 1)]
    asked = spark.createDataFrame(
        rows, "paths array<string>, values array<double>, timestamps array<bigint>, qualities array<int>, seq bigint"
    )
    plans, write = [], storage.live.write

    def kept(df, path, *args):
        if path.endswith("points"):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, path, *args)

    monkeypatch.setattr(storage.live, "write", kept)
    found = []
    for few, one in ((10**6, 10**6), (10**6, 0), (0, 0)):
        monkeypatch.setattr(history, "FEW_PATHS", few, raising=False)
        monkeypatch.setattr(storage, "ONE_TASK", one, raising=False)
        base = f"{folder}/{few}-{one}"
        tables.write_registry(measurements(spark, meas), f"{base}/registry", "base")
        store_requests(asked, "arrays", f"{base}/registry", f"{base}/points", "b", "Plant", grain="year", every_write=every_write)
        stored = storage.read_points(spark, f"{base}/points", every_write=every_write)
        names = ["series_name", "measurement_uuid", "ts_ms", "value_num", "quality_code", "status", "seq"]
        refused = spark.read.parquet(storage.refused_path(f"{base}/points"))
        series = tables.registry_reader(spark, f"{base}/registry")
        found.append([values(stored, *names), values(refused, *names, "reason"), values(series, "name", "uuid", "datatype")])
    assert found[0] == found[1] == found[2]
    points, refused, series = found[0]
    if not every_write:
        assert {(r[0][14:], r[2] - BASE, r[3]) for r in points} == {("old", 0, 0.5), ("new", 0, 7.0), ("new", 1, 3.5)}
    assert len(points) == (7 if every_write else 3)
    assert sorted(r[-1] for r in refused) == ["datatype mismatch"] * 2 + ["no series"] * 4 + ["no timestamp"] * 6
    assert {r[0][14:]: r[2] for r in series} == {"old": "number", "text": "string", "new": "number", "late": None}
    assert all(p.count("Exchange ") + p.count("Exchange(") <= (2 if not every_write else 1) + p.count("BroadcastExchange") for p in plans)


def test_each_batch_of_the_corrected_windows_has_many_files(spark, folder, monkeypatch):
    """No task writes or reads a whole batch, and there are two batches all the same."""
    from tagseries.plans import suite_store

    rows = spark.range(0, 400, 1, 4).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.col("id") * 37, F.lit(400)) * 3600).cast("timestamp_ntz").alias("ts"),
        F.pmod("id", F.lit(3)).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.col("id").cast("double").alias("value"),
        F.format_string('{"k": %d}', F.pmod("id", F.lit(100))).alias("props"),
    )
    rows.write.parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(suite_store, "shared_dir", lambda _: f"{folder}/base")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a task per file, as with large ones
    try:
        got = suite_store.stream_window_corrected(spark, folder).collect()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    points = [(i * 37 % 400, i % 100) for i in range(400)]
    newest = max(h for h, k in points if k >= 30)
    assert sum(r["late"] for r in got) == sum(k < 30 and h < newest for h, k in points)
    assert sum(r["sum"] for r in got) == sum(range(400)) and sum(r["count"] for r in got) == 400
    assert len(spark.read.schema(POINTS).parquet(f"{folder}/base/in").inputFiles()) == 8
    assert sorted(n for n, _ in storage.live.children(spark, f"{folder}/base/out")) == ["added=0", "added=1"]
