"""One series, gap or group that holds everything, without adaptive execution."""

import pytest
from fixtures import BASE, point, points, values
from pyspark.sql import functions as F

from tagseries.operators import aggregate as agg
from tagseries.operators import fill, raw


@pytest.fixture
def plain_plans(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_long_gap_is_dealt_over_tasks(plain_plans):
    spark, n = plain_plans, 300_000
    ends = spark.createDataFrame([("a", 0, 1.0), ("a", n * 1000, 2.0)], "series_name string, ts_ms bigint, value double")
    out = fill.fill(ends, "linear", 1000, 0, (n + 1) * 1000)
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == n + 1 and max(per_task) <= 5 * fill.BLOCK
    assert values(out.filter("ts_ms = 150000000"), "value") == [(1.5,)]


@pytest.mark.parametrize("p", [0.0, 0.37, 0.5, 1.0])
def test_a_percentile_of_one_group(plain_plans, p):
    spark, n = plain_plans, 40_000
    few = points(spark, [point("b", BASE + i, i) for i in range(5)]).select("series_name", "ts_ms", "value_num")
    hot = spark.range(0, n, 1, 8).select(
        F.lit("a").alias("series_name"), (F.col("id") + BASE).alias("ts_ms"), F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("double").alias("value_num")
    )
    want = hot.agg(F.percentile("value_num", p)).first()[0]
    out = agg.percentile(hot.unionByName(few), p, None)
    assert dict(values(out, "series_name", "value")) == {"a": pytest.approx(want), "b": pytest.approx(4 * p)}
    joins = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Join " in x]
    assert any("BroadcastHashJoin" in x for x in joins)


def test_only_large_groups_are_sent_to_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(agg, "HOT_SHARE", 4)
    rows = [point(s, BASE + i, i * i) for s, n in (("a", 50), ("b", 9), ("c", 1)) for i in range(n)]
    got = dict(values(agg.percentile(points(spark, rows), 0.5, None), "series_name", "value"))
    assert got == {"a": (24**2 + 25**2) / 2, "b": 16.0, "c": 0.0}


def test_latest_is_a_hash_aggregate(spark):
    rows = [point("a", BASE, 1, seq=1), point("a", BASE, "x", seq=2), point("a", BASE, 3, seq=2), point("b", BASE, None)]
    out = raw.latest(points(spark, rows))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
    assert values(out, "series_name", "value_num", "value_str") == [("a", 3.0, None), ("b", None, None)]
    assert values(raw.first_from(points(spark, rows), BASE), "series_name", "value_num") == [("a", 1.0), ("b", None)]


def test_late_points_correct_their_windows(spark, tmp_path, monkeypatch):
    from tagseries.schema import OP_LOG, POINTS
    from tagseries.sources import tables
    from tagseries.streaming import partials
    from tagseries.operators import telemetry

    monkeypatch.setattr(partials, "FOLD", 2)
    batches = [
        [point("a", BASE + i * 60_000, i, seq=i) for i in range(30)],
        [point("a", BASE + 5, 100, seq=99), point("b", BASE + 29 * 60_000, "x")],
        [point("a", BASE + 5, -7, seq=100), point("b", BASE, None)],
        [point("c", BASE, 1)],
        [point("a", BASE - 3_600_000, 3)],
    ]
    rows = []
    for batch in batches:
        rows += batch
        points(spark, batch).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        src = tables.point_stream(spark, f"{tmp_path}/in", POINTS, files_per_trigger=1)
        partials.stream_windows(src, f"{tmp_path}/out", f"{tmp_path}/check", "w", "10m", once=True).awaitTermination()
        got = partials.read_windows(spark, f"{tmp_path}/out", ["mean", "min", "max", "sum", "count", "last", "spread"])
        want = agg.bucketed(points(spark, rows), ["mean", "min", "max", "sum", "count", "last", "spread"], "10m")
        assert values(got.drop("late"), *want.columns) == values(want, *want.columns)
    assert got.agg(F.sum("late")).first()[0] == 5
    with pytest.raises(ValueError):
        partials.read_windows(spark, f"{tmp_path}/out", ["stddev"])

    ops = [[(t * 30_000 + b, "store", 2, 5, False) for t in range(b, b + 3)] for b in range(5)]
    for batch in ops:
        spark.createDataFrame(batch, OP_LOG).coalesce(1).write.mode("append").parquet(f"{tmp_path}/ops")
        src = tables.point_stream(spark, f"{tmp_path}/ops", OP_LOG, files_per_trigger=1)
        partials.stream_metrics(src, f"{tmp_path}/m", f"{tmp_path}/check-m", "m", once=True).awaitTermination()
    whole = telemetry.metric_intervals(spark.createDataFrame([r for b in ops for r in b], OP_LOG))
    assert values(partials.read_metrics(spark, f"{tmp_path}/m"), *whole.columns) == values(whole, *whole.columns)
    sizes = {p.name: spark.read.parquet(str(p)).count() for p in (tmp_path / "m").iterdir()}
    assert all(n == 3 for name, n in sizes.items() if name.startswith("added"))  # only what the batch touched


def test_a_request_in_order_and_one_of_all_types(spark):
    from fixtures import measurement, measurements
    from tagseries.plans.timeseries import TimeseriesRequest, query_timeseries

    meas = measurements(spark, [measurement("n"), measurement("f", datatype="boolean"), measurement("t", datatype="string")])
    pts = points(spark, [point("n", 1, 5), point("f", 1, True), point("t", 2, "x"), point("n", 2, 6, seq=9), point("n", 2, 7, seq=8)])
    joined = query_timeseries(TimeseriesRequest(join=["n", "f", "t"]), pts, meas)
    assert values(joined, "ts_ms", "n", "f", "t") == [(1, 5.0, True, None), (2, 6.0, None, "x")]
    newest = query_timeseries(TimeseriesRequest(desc=True), pts.filter("series_name = 'n'"), meas)
    assert values(newest, "value_num", sort=False) == [(6.0,), (7.0,), (5.0,)]
    assert values(raw.ordered(pts.filter("series_name = 'n'")), "value_num", sort=False) == [(5.0,), (7.0,), (6.0,)]
