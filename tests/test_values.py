"""Scalar conversions, by example."""

import uuid

import pytest
from pyspark.sql import functions as F

from tagseries import functions as fn
from tagseries.functions import time
from tagseries.functions.aggregates import functions_of


def rows(spark, data, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]


def test_quality(spark):
    got = rows(
        spark,
        [(0,), (63,), (64,), (191,), (192,), (200,)],
        "c int",
        fn.quality_to_status("c"),
        fn.status_to_quality(fn.quality_to_status("c")),
    )
    assert got == [("Bad", 0), ("Bad", 0), ("Uncertain", 64), ("Uncertain", 64), ("Good", 192), ("Good", 192)]


def test_unknown_status_reads_good(spark):
    assert rows(spark, [(None,), ("odd",)], "s string", fn.status_to_quality("s")) == [(192,), (192,)]


def test_datatypes(spark):
    data = [(None, True, None), (42.0, None, None), (3.14, None, None), (None, None, "hello"), (None, None, None)]
    schema = "value_num double, value_bool boolean, value_str string"
    got = rows(
        spark, data, schema, fn.datatype_of(), fn.value_type(fn.datatype_of()), fn.typed_value(fn.datatype_of())
    )
    assert got == [
        ("boolean", "Boolean", "true"),
        ("number", "Float8", "42.0"),
        ("number", "Float8", "3.14"),
        ("string", "String", "hello"),
        (None, "Float8", None),
    ]


def test_value_type_of_unknown(spark):
    assert rows(spark, [("odd",), (None,)], "d string", fn.value_type("d")) == [("Float8",), ("Float8",)]


NAMES = [
    ("Average", "mean"),
    ("SimpleAverage", "mean"),
    ("Minimum", "min"),
    ("Maximum", "max"),
    ("Sum", "sum"),
    ("Count", "count"),
    ("LastValue", "last"),
    ("Range", "spread"),
    ("Variance", "variance"),
    ("StdDev", "stddev"),
    ("Whatever", "mean"),
    (None, "mean"),
]


def test_aggregate_names(spark):
    got = rows(spark, NAMES, "n string, want string", fn.aggregate_function("n"), "want")
    assert all(a == b for a, b in got)


def test_catalogue(spark):
    assert fn.supported_aggregates(spark).count() == 11
    assert functions_of(["MinMax", "Average"]) == ["mean", "min", "max"]


PERIODS = [(9000, "2h30m"), (45, "45s"), (60, "1m"), (3600, "1h"), (3661, "1h1m1s"), (0, "1m"), (-5, "1m")]


def test_period_text(spark):
    got = rows(spark, PERIODS, "s bigint, want string", fn.format_period("s"), "want", fn.parse_period("want"), "s")
    assert all(a == b for a, b, _, _ in got)
    assert all(back == s for _, _, back, s in got if s > 0)


def test_parse_period_refuses(spark):
    data = [("",), ("2x",), ("m",), ("1m2h",), (None,)]
    assert rows(spark, data, "t string", fn.parse_period("t")) == [(None,)] * 5


@pytest.mark.parametrize(
    "given,want",
    [("2h30m", 9_000_000), (45_000, 45_000), (1_500, 1_000), (999, 60_000), (0, 60_000), (-1, 60_000), (None, 60_000)],
)
def test_period_ms(given, want):
    assert time.period_ms(given) == want


def test_bad_period():
    with pytest.raises(ValueError):
        time.period_ms("soon")


def test_period_for_buckets():
    assert time.period_for_buckets(0, 101_000, 1) == 101_000
    assert time.period_for_buckets(0, 100_500, 4) == 26_000


def test_name_uuid(spark):
    for name in ["Plant/default/a", "", "ümläut", "x" * 300]:
        raw = bytearray(__import__("hashlib").md5(name.encode()).digest())
        raw[6] = raw[6] & 0x0F | 0x30
        raw[8] = raw[8] & 0x3F | 0x80
        assert spark.range(1).select(fn.name_uuid(F.lit(name))).first()[0] == str(uuid.UUID(bytes=bytes(raw)))


def test_millis_round_down(spark):
    got = rows(
        spark,
        [("2024-01-01 00:00:00.1239",), ("1969-12-31 23:59:59.9991",)],
        "t string",
        fn.to_millis(F.col("t").cast("timestamp_ntz")),
    )
    assert got == [(1704067200123,), (-1,)]


def test_bucket_before_origin(spark):
    got = rows(spark, [(-1,), (0,), (99,), (100,), (149,)], "t bigint", fn.bucket_start("t", 100, 50))
    assert got == [(-50,), (-50,), (50,), (50,), (50,)]


def test_relative_range():
    assert fn.relative_range(10_000_000, minutes=10) == (9_400_000, 10_000_000)
    assert fn.relative_range(10_000_000, hours=1) == (6_400_000, 10_000_000)


def test_nan_to_null(spark):
    got = rows(spark, [(1.0,), (float("nan"),), (None,)], "v double", fn.nan_to_null("v"))
    assert got == [(1.0,), (None,), (None,)]
