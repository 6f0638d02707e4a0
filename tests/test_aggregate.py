"""Aggregation and gap filling on small fixtures."""

import math
import random
import statistics

import pytest
from fixtures import BASE, point, points, ramp, values
from pyspark.sql import functions as F

from tagseries.operators import aggregate as agg
from tagseries.operators.fill import fill

GOLDEN = {
    "mean": 49.5,
    "min": 0.0,
    "max": 99.0,
    "sum": 4950.0,
    "count": 100.0,
    "last": 99.0,
    "spread": 99.0,
    "variance": statistics.variance(range(100)),
    "stddev": statistics.stdev(range(100)),
}


@pytest.mark.parametrize("function", GOLDEN)
def test_ramp_in_one_bucket(spark, function):
    start, end = BASE - 1000, BASE + 100_000
    got = agg.aggregate_series(ramp(spark), function, end - start, start, end).collect()
    assert [(r.ts_ms, round(r.value, 6)) for r in got] == [(start, round(GOLDEN[function], 6))]


def test_epoch_origin_splits_the_ramp(spark):
    start, end = BASE - 1000, BASE + 100_000
    got = agg.aggregate_series(ramp(spark), "count", 101_000, start, end, origin="epoch")
    assert sorted(v for (v,) in values(got, "value")) == [19, 81]


def test_minmax_pairs(spark):
    start, end = BASE - 1000, BASE + 100_000
    requests = spark.createDataFrame([("q", "Plant/default/ramp", "MinMax")], "qpath string, series_name string, aggregate string")
    got = agg.aggregate(ramp(spark), requests, 101_000, start, end)
    assert values(got.orderBy("ordinal"), "ts_ms", "ordinal", "value", sort=False) == [(start, 0, 0.0), (start, 1, 99.0)]


def test_every_key_has_its_own_aggregate(spark):
    df = points(spark, [point("a", 0, 1), point("a", 500, 5), point("b", 10, 7), point("c", 10, 9)])
    asked = [("qa", "a", "Maximum"), ("qa", "a", "Count"), ("qb", "b", "StdDev"), ("qb", "b", "nonsense"), ("qx", "x", "Sum")]
    requests = spark.createDataFrame(asked, "qpath string, series_name string, aggregate string")
    want = [("qa", "Count", 2.0), ("qa", "Maximum", 5.0), ("qb", "nonsense", 7.0)]
    for names in (None, [a for _, _, a in asked]):
        got = agg.aggregate(df, requests, "1s", 0, 1000, aggregates=names)
        assert values(got, "qpath", "aggregate", "value") == want


def test_empty_buckets_are_left_out(spark):
    df = points(spark, [point("a", 0, 1), point("a", 5000, 2)])
    assert values(agg.aggregate_series(df, "mean", "1s", 0, 10_000), "ts_ms") == [(0,), (5000,)]


def test_last_is_the_last_write(spark):
    df = points(spark, [point("a", 5, 1, seq=9), point("a", 7, 2, seq=3), point("a", 7, 3, seq=4), point("a", 8, None, seq=5)])
    assert values(agg.aggregate_series(df, "last", "1s", 0), "value") == [(3.0,)]


def test_count_takes_any_type(spark):
    df = points(spark, [point("a", 0, "x"), point("a", 1, True), point("a", 2, 1), point("a", 3, None)])
    assert values(agg.aggregate_series(df, "count", "1s", 0), "value") == [(3.0,)]
    assert values(agg.aggregate_series(df, "mean", "1s", 0), "value") == [(1.0,)]


def test_non_positive_period_is_a_minute(spark):
    df = points(spark, [point("a", 0, 1), point("a", 59_999, 2), point("a", 60_000, 3)])
    assert values(agg.aggregate_series(df, "count", -5, 0), "ts_ms", "value") == [(0, 2.0), (60_000, 1.0)]


def test_group_by_tags(spark):
    df = points(spark, [point("a", 0, 1, tags={"line": "1"}), point("b", 1, 2, tags={"line": "1"}), point("c", 2, 4)])
    got = agg.aggregate_by_tags(df, ["line"], "sum", "1s", 0)
    assert values(got, "line", "value") == [("1", 3.0), (None, 4.0)]


def quantile(sample, p):
    s = sorted(sample)
    at = p * (len(s) - 1)
    lo, hi = math.floor(at), math.ceil(at)
    return s[lo] + (s[hi] - s[lo]) * (at - lo)


@pytest.mark.parametrize("p", [0, 0.1, 0.5, 0.973, 1])
@pytest.mark.parametrize("margin", [0.0, 0.01, 0.5])
def test_percentile_is_exact(spark, p, margin):
    rng = random.Random(11)
    rows, sample = [], {}
    for i in range(400):
        name = rng.choice(["hot", "hot", "hot", "cold"])
        v = rng.choice([1.0, 1.0, 1.0, rng.random() * 10, -rng.random()])
        rows.append(point(name, i, v))
        sample.setdefault(name, []).append(v)
    got = agg.percentile(points(spark, rows), p, None, margin=margin)
    assert {n: round(v, 9) for n, v in values(got, "series_name", "value")} == {
        n: round(quantile(s, p), 9) for n, s in sample.items()
    }


def test_arguments_are_checked(spark):
    with pytest.raises(ValueError):
        agg.aggregate_with_arguments(ramp(spark), "mean", [1], "1s")
    with pytest.raises(ValueError):
        agg.aggregate_with_arguments(ramp(spark), "percentile", [], "1s")
    with pytest.raises(ValueError):
        agg.percentile(ramp(spark), 1.5, "1s")


def gaps(spark):
    return spark.createDataFrame([("a", 2000, 2.0), ("a", 5000, 8.0), ("b", 0, 1.0)], "series_name string, ts_ms bigint, value double")


@pytest.mark.parametrize(
    "kind,a,b",
    [
        ("null", [None, None, 2, None, None, 8, None], [1] + [None] * 6),
        ("previous", [None, None, 2, 2, 2, 8, 8], [1] * 7),
        ("linear", [None, None, 2, 4, 6, 8, None], [1] + [None] * 6),
        ("value", [0, 0, 2, 0, 0, 8, 0], [1] + [0] * 6),
    ],
)
def test_fill(spark, kind, a, b):
    got = fill(gaps(spark), kind, 1000, 0, 7000, fill_value=0.0)
    rows = sorted(values(got, "series_name", "ts_ms", "value"), key=lambda r: r[:2])
    assert [r[2] for r in rows if r[0] == "a"] == a
    assert [r[2] for r in rows if r[0] == "b"] == b
    assert [r[1] for r in rows if r[0] == "a"] == [i * 1000 for i in range(7)]


def test_fill_over_many_blocks(spark, monkeypatch):
    from tagseries.operators import fill as module

    monkeypatch.setattr(module, "BLOCK", 3)
    df = spark.createDataFrame([("a", 4000, 1.0), ("a", 23_000, 2.0)], "series_name string, ts_ms bigint, value double")
    got = module.fill(df, "previous", 1000, 0, 30_000)
    rows = sorted(values(got, "ts_ms", "value"))
    assert [t for t, _ in rows] == [i * 1000 for i in range(30)]
    assert [v for _, v in rows] == [None] * 4 + [1.0] * 19 + [2.0] * 7


def test_fill_with_epoch_origin(spark):
    df = points(spark, [point("a", 2500, 1), point("a", 4100, 3)])
    got = agg.aggregate_series(df, "mean", "1s", 1500, 5200, origin="epoch", fill="linear")
    assert sorted(values(got, "ts_ms", "value")) == [(1000, None), (2000, 1.0), (3000, 2.0), (4000, 3.0), (5000, None)]


def test_fill_arguments(spark):
    with pytest.raises(ValueError):
        fill(gaps(spark), "cubic", 1000, 0, 7000)
    with pytest.raises(ValueError):
        fill(gaps(spark), "value", 1000, 0, 7000)
    with pytest.raises(ValueError):
        agg.aggregate_series(ramp(spark), "mean", "1s", fill="previous")


def test_plan_has_one_scan_and_one_shuffle(spark, sf_dir):
    """All functions of all series come from one scan and one exchange, by hash aggregation."""
    from tagseries.sources import testbed as tb

    df = agg.bucketed(tb.points(spark, sf_dir), list(GOLDEN), "24h", tb.T0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "SortAggregate" not in plan


def test_time_filter_reaches_the_files(spark, sf_dir):
    from tagseries.sources import testbed as tb

    df = tb.points(spark, sf_dir, tb.T0, tb.T1).groupBy("series_name").agg(F.sum("value_num"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
