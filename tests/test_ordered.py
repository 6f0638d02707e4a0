"""Chunked order-dependent operators against plain Python on the same rows."""

import random

import pytest
from fixtures import point, points, values

from tagseries.operators import ordered


def random_rows(seed, series=3, span=400, n=300, levels=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        value = rng.choice([None, *range(levels)])
        rows.append(point(f"s{rng.randrange(series)}", rng.randrange(-span, span), value, seq=i))
    return rows


def last_writes(rows):
    best = {}
    for r in rows:
        key = (r[0], r[2])
        if key not in best or best[key][9] < r[9]:
            best[key] = r
    by_series = {}
    for r in sorted(best.values(), key=lambda r: (r[0], r[2])):
        by_series.setdefault(r[0], []).append(r)
    return by_series


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("chunk", [1, 7, 100_000])
def test_only_changes(spark, seed, chunk):
    rows = random_rows(seed)
    want = []
    for name, pts in last_writes(rows).items():
        for i, r in enumerate(pts):
            if i == 0 or pts[i - 1][3] != r[3]:
                want.append((name, r[2], r[3]))
    got = ordered.only_changes(points(spark, rows), chunk_ms=chunk)
    assert values(got, "series_name", "ts_ms", "value_num") == sorted(want, key=repr)


def test_only_changes_example(spark):
    rows = [point("a", i, v) for i, v in enumerate([1, 2, 2, 3])]
    got = ordered.only_changes(points(spark, rows), chunk_ms=2)
    assert [v for _, v in sorted(values(got, "ts_ms", "value_num"))] == [1, 2, 3]


def test_only_changes_mixed_types(spark):
    rows = [point("a", i, v) for i, v in enumerate([True, True, "x", "x", 1, False, None, None])]
    got = ordered.only_changes(points(spark, rows), chunk_ms=3)
    assert sorted(t for (t,) in values(got, "ts_ms")) == [0, 2, 4, 5, 6]


@pytest.mark.parametrize("chunk", [1, 13, 100_000])
def test_neighbours(spark, chunk):
    rows = random_rows(5)
    want = []
    for name, pts in last_writes(rows).items():
        for i, r in enumerate(pts):
            before = pts[i - 1][2:4] if i else None
            after = pts[i + 1][2:4] if i + 1 < len(pts) else None
            want.append((name, r[2], before, after))
    df = ordered.with_neighbours(
        points(spark, rows), ["ts_ms", "value_num"], chunk_ms=chunk, previous="p", following="f", seq="seq"
    )
    got = [(r.series_name, r.ts_ms, r.p and tuple(r.p), r.f and tuple(r.f)) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("desc", [False, True])
@pytest.mark.parametrize("chunk", [1, 17, 100_000])
def test_rank(spark, desc, chunk):
    rows = random_rows(8)
    want = []
    for name, pts in last_writes(rows).items():
        for i, r in enumerate(reversed(pts) if desc else pts):
            want.append((name, r[2], i + 1))
    unique = ordered.dedupe_last_write(points(spark, rows))
    got = ordered.with_rank(unique, desc=desc, chunk_ms=chunk)
    assert values(got, "series_name", "ts_ms", "rank") == sorted(want, key=repr)


@pytest.mark.parametrize("n,offset,desc", [(3, 0, False), (4, 2, True), (None, 5, False), (2000, 1, True), (0, 0, False)])
def test_limit_per_series(spark, n, offset, desc):
    rows = random_rows(3)
    rows += [point("s0", 7, 1, seq=1000 + i) for i in range(40)]  # copies of an instant are rows too
    want, series = [], {}
    for r in sorted(rows, key=lambda r: (r[2], r[9])):
        series.setdefault(r[0], []).append(r)
    for name, pts in series.items():
        ordered_pts = list(reversed(pts)) if desc else pts
        stop = None if n is None else offset + n
        want += [(name, r[2], r[9]) for r in ordered_pts[offset:stop]]
    got = ordered.limit_per_series(points(spark, rows), n, offset, desc, chunk_ms=11)
    assert values(got, "series_name", "ts_ms", "seq") == sorted(want, key=repr)


def test_running_totals(spark):
    rng = random.Random(4)
    rows = [(t, rng.randrange(10)) for t in rng.sample(range(1000), 200)]
    total, want = 0, []
    for t, v in sorted(rows):
        total += v
        want.append((t, total))
    df = spark.createDataFrame(rows, "ts_ms bigint, v bigint")
    got = ordered.running_totals(df, {"total": "v"}, chunk_ms=37)
    assert sorted(values(got, "ts_ms", "total")) == want


def test_dedupe_keeps_null_of_last_write(spark):
    rows = [point("a", 1, 5, seq=1), point("a", 1, None, seq=2), point("a", 2, 7, seq=3)]
    assert values(ordered.dedupe_last_write(points(spark, rows)), "ts_ms", "value_num") == [(1, None), (2, 7.0)]


def _tasks_of_hot_series(df):
    """Rows per task after the plan's shuffles."""
    from pyspark.sql import functions as F

    return [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_hot_series_is_spread(spark):
    """One series holds every row, yet the changes are found in several tasks."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [point("hot", i * 60_000, i) for i in range(2000)]
        counts = _tasks_of_hot_series(ordered.only_changes(points(spark, rows)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(counts) == 2000 and len(counts) > 1 and max(counts) < 1500
