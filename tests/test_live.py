"""Tables of batches: one value per instant, merging behind a manifest, the registry as a log, changes of streams."""

import random

import pytest
from fixtures import BASE, measurement, measurements, point, points, values
from pyspark.sql import functions as F

from tagseries.operators import storage
from tagseries.operators.ordered import only_changes
from tagseries.plans.history import TagStore
from tagseries.schema import POINTS
from tagseries.sources import ingest, live, tables
from tagseries.streaming import changes

DAY = 86_400_000
PATHS = [f"histprov:h:/sys:gw:/prov:default:/tag:{x}" for x in "ab"]


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def store(spark, path, rows, batch, **options):
    storage.write_points(points(spark, rows), measurements(spark, [measurement("a"), measurement("b")]), path, batch, **options)


def stored(spark, path, *bounds, **options):
    return values(storage.read_points(spark, path, *bounds, **options), "series_name", "ts_ms", "value_num")


def folders(spark, path):
    return {(e.part, e.batch) for e in live.entries(spark, path)}


def test_all_answers_count_an_instant_once(spark, folder):
    s = TagStore(spark, folder, "Plant")
    s.store_data_points([PATHS[0]] * 3, [1.0, 5.0, 2.0], [BASE, BASE, BASE + 1000])
    s.store_data_points([PATHS[0], PATHS[1]], [9.0, 3.0], [BASE, BASE])
    for _ in range(2):
        h = s.history()
        raw = h.query_raw_points(PATHS, BASE, BASE + 5000, column_names=["a", "b"]).orderBy("t_stamp")
        assert [tuple(r) for r in raw.collect()] == [(BASE, 9.0, 3.0), (BASE + 1000, 2.0, None)]
        tall = h.query_raw_points(PATHS[:1], return_format="TALL")
        assert values(tall, "ts_ms", "value") == [(BASE, 9.0), (BASE + 1000, 2.0)]
        got = h.query_aggregated_points(PATHS[:1] * 2, BASE, BASE + 5000, ["Count", "Sum"], return_size=1)
        assert [float(x) for x in got.drop("t_stamp").collect()[0]] == [2.0, 11.0]
        assert len(s.compact()) in (0, 1)
    assert len(folders(spark, s.points)) == 1


def test_last_write_wins_whatever_its_arrival(spark, folder):
    store(spark, folder, [point("a", BASE, 1, seq=50), point("a", BASE, 2, seq=None), point("a", BASE + 1, 3)], "one")
    store(spark, folder, [point("a", BASE, 4, seq=1), point("b", BASE, 5)], "two")
    store(spark, folder, [point("a", BASE, 1, seq=50), point("a", BASE + 1, 3)], "one")  # repeated, still the first
    assert stored(spark, folder) == [("a", BASE, 4.0), ("a", BASE + 1, 3.0), ("b", BASE, 5.0)]
    assert len(stored(spark, folder, every_write=True)) == 4
    store(spark, f"{folder}/log", [point("a", BASE, v, seq=v) for v in range(5)], "one", every_write=True)
    assert len(stored(spark, f"{folder}/log", every_write=True)) == 5


def test_against_a_plain_table(spark, folder):
    rng, plain = random.Random(4), {}
    for n in range(5):
        rows = [point(rng.choice("ab"), BASE + rng.randint(0, 3) * DAY + rng.randint(0, 9), rng.random(), seq=i) for i in range(60)]
        plain |= {(r[0], r[2]): r[3] for r in rows}
        store(spark, folder, rows, f"batch {n}/é=:")
        want = sorted((*k, v) for k, v in plain.items())
        assert sorted(stored(spark, folder)) == want
        if n % 2:
            storage.compact_points(spark, folder, storage.read_points(spark, folder).agg(F.max("part")).first()[0].isoformat())
            assert sorted(stored(spark, folder)) == want
    low, high = BASE + DAY, BASE + 2 * DAY + 5
    assert sorted(stored(spark, folder, low, high)) == [w for w in want if low <= w[1] < high]


def test_only_parts_with_several_batches_are_merged_on_reading(spark, folder):
    store(spark, folder, [point("a", BASE, 1), point("a", BASE + DAY, 1)], "one")
    alone = storage.read_points(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in alone and "Exchange" not in alone
    store(spark, folder, [point("a", BASE + DAY, 2)], "two")
    both = storage.read_points(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert both.count("WindowGroupLimit") == 2 and both.count("FileScan") == 2
    ranged = storage.read_points(spark, folder).filter((F.col("ts_ms") < BASE + 5) & (F.col("measurement_uuid") == "id-a"))
    plan = ranged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LessThan(ts_ms") == 2 and plan.count("= id-a") >= 2


def test_reader_and_merge_overlap(spark, folder):
    store(spark, folder, [point("a", BASE + i, i) for i in range(20)], "one")
    store(spark, folder, [point("a", BASE + i, -i) for i in range(10)], "two")
    before = storage.read_points(spark, folder)  # planned, not run
    want = stored(spark, folder)
    assert storage.compact_points(spark, folder) and storage.compact_points(spark, folder) == []
    assert values(before, "series_name", "ts_ms", "value_num") == want == stored(spark, folder)
    assert len(folders(spark, folder)) == 1
    gone = live.remove_replaced(spark, folder, keep_ms=live.HOUR_MS)
    assert gone == []  # too young
    assert len(live.remove_replaced(spark, folder, keep_ms=-1000)) >= 2
    assert stored(spark, folder) == want
    store(spark, folder, [point("a", BASE, 77)], "three")
    store(spark, folder, [point("a", BASE + i, i) for i in range(20)], "one")  # its note was taken in: a new write
    assert stored(spark, folder)[0] == ("a", BASE, 0.0) and len(stored(spark, folder)) == 20


def test_merge_that_dies_half_way_changes_nothing(spark, folder, monkeypatch):
    store(spark, folder, [point("a", BASE + i, i) for i in range(5)], "one")
    store(spark, folder, [point("a", BASE, 9)], "two")
    want, listed = stored(spark, folder), folders(spark, folder)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(live, "_rename", fail)
        with pytest.raises(RuntimeError):
            storage.compact_points(spark, folder)
    assert stored(spark, folder) == want and folders(spark, folder) == listed
    live.remove_replaced(spark, folder, keep_ms=-1000)
    assert stored(spark, folder) == want and folders(spark, folder) == listed
    storage.compact_points(spark, folder)
    assert stored(spark, folder) == want and len(folders(spark, folder)) == 1


def test_two_merges_at_a_time(spark, folder, monkeypatch):
    store(spark, folder, [point("a", BASE, 1)], "one")
    store(spark, folder, [point("a", BASE, 2)], "two")
    put, inside = live._put, []

    def slow(df, path, batch):
        put(df, path, batch)
        if not inside:
            inside.append(1)
            storage.compact_points(spark, folder)  # another one gets there first

    monkeypatch.setattr(live, "_put", slow)
    with pytest.raises(Exception, match="(?i)exist"):
        storage.compact_points(spark, folder)
    assert stored(spark, folder) == [("a", BASE, 2.0)] and len(folders(spark, folder)) == 1


def test_a_write_during_a_merge_is_not_lost(spark, folder, monkeypatch):
    store(spark, folder, [point("a", BASE, 1)], "one")
    store(spark, folder, [point("a", BASE, 2)], "two")
    put, inside = live._put, []

    def slow(df, path, batch):
        put(df, path, batch)
        if not inside:
            inside.append(1)
            store(spark, folder, [point("a", BASE, 3), point("b", BASE, 4)], "three")

    monkeypatch.setattr(live, "_put", slow)
    storage.compact_points(spark, folder)
    assert stored(spark, folder) == [("a", BASE, 3.0), ("b", BASE, 4.0)]


def test_one_grain_per_table(spark, folder):
    store(spark, folder, [point("a", BASE, 1)], "one")
    with pytest.raises(ValueError, match="kept by day"):
        store(spark, folder, [point("a", BASE, 1)], "two", grain="month")
    assert stored(spark, f"{folder}/none") == []


def test_batch_without_a_note_is_not_seen(spark, folder):
    store(spark, folder, [point("a", BASE, 1)], "one")
    store(spark, folder, [point("a", BASE, 2)], "two")
    live.remove_folder(spark, f"{live.notes_path(folder)}/batch=two")
    assert stored(spark, folder) == [("a", BASE, 1.0)]
    store(spark, folder, [], "two")
    assert stored(spark, folder) == [("a", BASE, 1.0)]


def test_copies_of_a_hot_instant_shrink_before_the_shuffle(spark, folder):
    hot = points(spark, []).sparkSession.range(0, 30_000, 1, 6).select(
        F.lit("a").alias("series_name"), F.lit(BASE).cast("long").alias("ts_ms"), F.col("id").cast("double").alias("value_num"),
        F.lit(192).alias("quality_code"), F.lit("Good").alias("status"), F.col("id").alias("seq"),
    )
    meas = measurements(spark, [measurement("a")])
    storage.write_points(storage.conform(hot), meas, folder, "one")
    assert stored(spark, folder) == [("a", BASE, 29_999.0)]


def test_evicted_series_come_back_with_their_next_point(spark, folder):
    s = TagStore(spark, folder, "Plant")
    s.store_metadata(PATHS, {"description": "first", "unit": "C"}, "m-1")
    s.store_data_points(PATHS, [1.0, 2.0], [BASE, BASE], batch="b-1")
    assert values(s.pending(), "tag_path") == []
    known = tables.registry_reader(spark, s.registry)
    a = known.filter("name = 'Plant/default/a'").first()
    assert (a["description"], a["attributes"]) == ("first", {"unit": "C"})
    for _ in range(2):
        s.evict([a["uuid"]], "e-1")
    assert values(s.history().missing(PATHS), "qpath") == [(PATHS[0],)]
    s.store_metadata(PATHS[:1], {"unit": "K"}, "m-2")
    for _ in range(2):
        s.store_data_points([PATHS[0]], [True], [BASE + 1], batch="b-2")
    assert values(s.history().missing(PATHS), "qpath") == []
    for _ in range(2):
        made = s.history().query_metadata(PATHS[:1]).first()["properties"]
        assert made["datatype"] == "boolean"
        now = tables.registry_reader(spark, s.registry).filter("name = 'Plant/default/a'").orderBy(F.desc("updated_at")).first()
        assert now["attributes"] == {"unit": "K"} and now["description"] is None  # what was taken is not taken twice
        tables.compact_registry(spark, s.registry)
    assert tables.registry_reader(spark, s.registry).count() == 2
    s.delete([now["uuid"]])
    assert values(s.history().missing(PATHS), "qpath") == [(PATHS[0],)]


def test_retry_sees_the_metadata_of_its_first_try(spark, folder):
    from tagseries.plans.history import store_points

    registry, path, metadata = f"{folder}/r", f"{folder}/p", f"{folder}/m"
    rows = spark.createDataFrame([("x", {"unit": "C"}, 1)], "tag_path string, properties map<string,string>, seq bigint")
    tables.write_metadata(rows, metadata, "m-1")
    for _ in range(3):
        store_points(points(spark, [point("x", BASE, 1)]), registry, path, "b-1", metadata=metadata)
        assert values(tables.registry_reader(spark, registry), "name", "attributes") == [("x", {"unit": "C"})]
    later = spark.createDataFrame([("x", {"unit": "F"}, 2)], rows.schema)
    tables.write_metadata(later, metadata, "m-2")
    assert values(tables.metadata_reader(spark, metadata), "tag_path", "properties") == [("x", {"unit": "F"})]


def test_typed_requests(spark):
    df = spark.createDataFrame(
        [(["p", "q"], [['1', '"t"'], ['true', 'null']], [1, 2]), (["p"], [['[1]', '2.5']], [3, 4])],
        "paths array<string>, v array<array<string>>, timestamps array<bigint>",
    )
    typed = df.withColumn("values", F.transform("v", lambda r: F.transform(r, F.parse_json))).drop("v")
    typed = typed.withColumn("qualities", F.lit(None).cast("array<int>"))
    got = ingest.from_tag_matrix(typed)
    assert values(got, "qpath", "ts_ms", "value_num", "value_bool", "value_str", "place") == [
        ("p", 1, 1.0, None, None, 0), ("p", 2, None, None, "t", 1), ("p", 3, None, None, None, 0), ("p", 4, 2.5, None, None, 1),
        ("q", 1, None, True, None, 2), ("q", 2, None, None, None, 3),
    ]
    for kind, value, want in (("string", "x", (None, None, "x")), ("boolean", True, (None, True, None)), ("int", 3, (3.0, None, None))):
        one = spark.createDataFrame([(["p"], [value], [1], None)], f"paths array<string>, values array<{kind}>, timestamps array<bigint>, qualities array<int>")
        assert values(ingest.from_parallel_arrays(one), "value_num", "value_bool", "value_str") == [want]


def run_changes(spark, folder, name="changes", chunk_ms=None):
    src = tables.point_stream(spark, f"{folder}/in", POINTS, files_per_trigger=1)
    more = {} if chunk_ms is None else {"chunk_ms": chunk_ms}
    changes.stream_only_changes(src, f"{folder}/out", f"{folder}/check", name, once=True, **more).awaitTermination()


def test_changes_over_many_batches_with_folding(spark, folder, monkeypatch):
    monkeypatch.setattr(changes, "FOLD", 3)
    rng = random.Random(1)
    rows = []
    for i in range(11):
        batch = [point(s, BASE + i * 100 + j, rng.choice([1, 1, 2, True, "t", None]), seq=i * 100 + j) for s in "ab" for j in range(rng.randint(0, 6))]
        rows += batch
        points(spark, batch or [point("c", BASE, 1, seq=i)]).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        run_changes(spark, folder, chunk_ms=2)
    got = changes.read_changes(spark, f"{folder}/out").filter("series_name <> 'c'")
    want = only_changes(points(spark, rows))
    columns = ("series_name", "ts_ms", "value_num", "value_bool", "value_str")
    assert values(got.filter("NOT late"), *columns) == values(want, *columns) and got.filter("late").count() == 0


def test_repeated_batch_of_changes_writes_the_same(spark):
    last = spark.createDataFrame([("a", 5, 1.0, None, None, 0)], changes.STATE)
    rows = points(spark, [point("a", 4, 7, seq=1), point("a", 5, 1, seq=2), point("a", 6, 1, seq=3), point("a", 7, 2, seq=4),
                          point("a", 7, 3, seq=5), point("b", 1, None, seq=6)])
    for _ in range(2):
        out, newest = changes.changes_of_batch(rows, last)
        assert values(out, "series_name", "ts_ms", "value_num", "late") == [
            ("a", 4, 7.0, True), ("a", 7, 3.0, False), ("b", 1, None, False),
        ]
        assert values(newest, "series_name", "ts_ms", "value_num") == [("a", 7, 3.0), ("b", 1, None)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_edges_read_only_the_parts_that_hold_them(spark, folder):
    rows = [point("a", BASE + i * DAY, i) for i in range(40)] + [point("b", BASE + 3 * DAY, 7)]
    store(spark, folder, rows, "one")
    store(spark, folder, [point("a", BASE + 39 * DAY, 100), point("a", BASE + 30 * DAY + 5, 8)], "two")
    columns = ("series_name", "ts_ms", "value_num")
    last = storage.latest_stored(spark, folder)
    assert values(last, *columns) == [("a", BASE + 39 * DAY, 100.0), ("b", BASE + 3 * DAY, 7.0)]
    points_read = [f for f in last.inputFiles() if f"{folder}/batch=" in f]
    assert len({f.split("/part=")[1].split("/")[0] for f in points_read}) == 2  # of 40 days
    earlier = storage.latest_stored(spark, folder, BASE + 30 * DAY + 6)
    assert values(earlier, *columns) == [("a", BASE + 30 * DAY + 5, 8.0), ("b", BASE + 3 * DAY, 7.0)]
    ids = spark.createDataFrame([("id-a",)], "measurement_uuid string")
    assert values(storage.latest_stored(spark, folder, BASE + 2 * DAY, ids), *columns) == [("a", BASE + DAY, 1.0)]
    for _ in range(2):
        both = storage.bounds_stored(spark, folder, BASE + 10 * DAY, BASE + 12 * DAY)
        assert values(both, "series_name", "value_num", "bound") == [
            ("a", 10.0, "inside"), ("a", 11.0, "inside"), ("a", 12.0, "upper"), ("a", 9.0, "lower"), ("b", 7.0, "lower"),
        ]
        assert len({f.split("/part=")[1].split("/")[0] for f in both.inputFiles() if f"{folder}/batch=" in f}) <= 5
        storage.compact_points(spark, folder)
    assert storage.latest_stored(spark, f"{folder}/none").count() == 0
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
