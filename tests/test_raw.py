"""Raw reads on small fixtures."""

import pytest
from fixtures import BASE, asset, assets, measurement, measurements, point, points, ramp, values

from tagseries.operators import raw, resolve, shape
from tagseries.operators.storage import named_points, path_names


def test_range_is_half_open(spark):
    df = raw.time_range(ramp(spark), BASE, BASE + 5000)
    assert sorted(t - BASE for (t,) in values(df, "ts_ms")) == [0, 1000, 2000, 3000, 4000]


def test_range_open_ends(spark):
    assert raw.time_range(ramp(spark)).count() == 100
    assert raw.time_range(ramp(spark), start=BASE + 99_000).count() == 1
    assert raw.time_range(ramp(spark), end=BASE).count() == 0


def test_inverted_range_is_an_error(spark):
    with pytest.raises(ValueError, match="inverted"):
        raw.time_range(ramp(spark), BASE + 5000, BASE - 5000)


def test_empty_range(spark):
    assert raw.time_range(ramp(spark), 1_600_000_000_000, 1_600_000_010_000).count() == 0


@pytest.fixture(scope="module")
def plant(spark):
    meas = measurements(
        spark,
        [
            measurement("Plant/default/a"),
            measurement("Plant/default/gone", status="deleted"),
            measurement("shared", uuid="from-measurement"),
        ],
    )
    things = assets(spark, [asset("as-1", "shared"), asset("as-2", "Line/pump")])
    return meas, things


def keys(spark, *paths):
    return spark.createDataFrame([(p,) for p in paths], "qpath string")


PREFIX = "histprov:h:/sys:gw:/prov:default:/tag:"


def test_resolution_prefers_measurements(spark, plant):
    found = resolve.resolve_keys(
        keys(spark, PREFIX + "a", "histprov:h:/tag:shared", "histprov:h:/tag:Line/pump", PREFIX + "gone"),
        *plant,
        "Plant",
    )
    assert dict(values(found, "series_name", "measurement_uuid")) == {
        "Plant/default/a": "id-Plant/default/a",
        "shared": "from-measurement",
        "Line/pump": "as-2",
        "Plant/default/gone": None,
    }


def test_missing_keys_do_not_stop_the_others(spark, plant):
    pts = points(spark, [point("Plant/default/a", BASE, 42), point("Plant/default/a", BASE + 1, 43)])
    asked = keys(spark, PREFIX + "a", PREFIX + "none")
    resolved = resolve.resolve_keys(asked, *plant, "Plant")
    assert raw.raw_points(pts, resolved).count() == 2
    missing = resolve.missing_keys(asked, *plant, "Plant")
    assert values(missing, "qpath", "status") == [(PREFIX + "none", "Bad_NotFound")]


def test_only_missing_keys_give_no_rows(spark, plant):
    resolved = resolve.resolve_keys(keys(spark, PREFIX + "none"), *plant, "Plant")
    assert raw.raw_points(points(spark, [point("Plant/default/a", 1, 1)]), resolved).count() == 0


def test_two_paths_of_one_series_both_answer(spark, plant):
    pts = points(spark, [point("Plant/default/a", BASE, 42)])
    both = keys(spark, PREFIX + "a", "histprov:h:/tag:Plant/default/a")
    assert raw.raw_points(pts, resolve.resolve_keys(both, *plant, "Plant")).count() == 2


def test_read_resets_quality(spark, plant):
    pts = points(spark, [point("Plant/default/a", BASE, 1, code=0)])
    resolved = resolve.resolve_keys(keys(spark, PREFIX + "a"), *plant, "Plant")
    assert values(raw.raw_points(pts, resolved), "quality_code", "status") == [(192, "Good")]
    assert values(raw.raw_points(pts, resolved, keep_quality=True), "quality_code", "status") == [(0, "Bad")]


def test_return_size(spark, plant):
    pts = points(spark, [point("Plant/default/a", BASE + i, i) for i in range(50)])
    resolved = resolve.resolve_keys(keys(spark, PREFIX + "a"), *plant, "Plant")
    got = raw.raw_points(pts, resolved, return_size=7)
    assert [v for (v,) in values(got, "value_num", sort=False)] == list(range(7))


def test_nodes(spark, plant):
    got = resolve.lookup_nodes(keys(spark, "histprov:h:/tag:Line/pump", PREFIX + "none"), *plant, "Plant")
    assert values(got, "uuid", "data_type", "created_ms", "retired_ms") == [("as-2", "Float8", 0, None)]


def test_metadata_leaves_out_unset(spark):
    specs = (None, 0.0, None, None, 9.5)
    meas = measurements(spark, [measurement("m", specs=specs), measurement("n", datatype="", specs=None)])
    got = dict(values(resolve.query_metadata(keys(spark, "m", "n", "o"), meas, "Plant"), "qpath", "properties"))
    assert got == {
        "m": {"datatype": "number", "status": "Active", "name": "m", "engLow": "0.0", "limitHigh": "9.5"},
        "n": {"status": "Active", "name": "n"},
    }
    gone = resolve.missing_metadata(keys(spark, "m", "o"), meas, "Plant")
    assert values(gone, "qpath") == [("o",)]


@pytest.mark.parametrize(
    "filters,want",
    [
        ([("=", 3)], [3]),
        ([("!=", 3), ("<", 5)], [0, 1, 2, 4]),
        ([(">=", 97), ("<=", 1, "OR")], [0, 1, 97, 98, 99]),
        ([("<", 2), (">", 97, "OR"), ("!=", 0, "AND")], [1, 98, 99]),
        ([], list(range(100))),
    ],
)
def test_value_filters(spark, filters, want):
    assert sorted(v for (v,) in values(raw.value_filter(ramp(spark), filters), "value_num")) == want


def test_value_filters_by_type(spark):
    df = points(spark, [point("s", 1, "hello"), point("s", 2, "world"), point("s", 3, True), point("s", 4, 1)])
    assert values(raw.value_filter(df, [("contains", "orl")]), "ts_ms") == [(2,)]
    assert values(raw.value_filter(df, [("regex", "^h.*o$")]), "ts_ms") == [(1,)]
    assert values(raw.value_filter(df, [("=", True)]), "ts_ms") == [(3,)]
    assert values(raw.value_filter(df, [("!=", "hello")]), "ts_ms") == [(2,)]


@pytest.mark.parametrize("bad", [[("~", 1)], [("=", 1), ("=", 2, "XOR")]])
def test_bad_value_filters(bad):
    with pytest.raises(ValueError):
        raw.value_predicate(bad)


def test_tags(spark):
    df = points(spark, [point("s", 1, 1, tags={"a": "x"}), point("s", 2, 1, tags={"a": "y", "b": "z"}), point("s", 3, 1)])
    assert values(raw.by_tags(df, {"a": "y", "b": "z"}), "ts_ms") == [(2,)]


def test_bounds(spark):
    got = raw.with_bounds(ramp(spark), BASE + 10_000, BASE + 12_000)
    assert values(got, "bound", "value_num") == [
        ("inside", 10.0),
        ("inside", 11.0),
        ("lower", 9.0),
        ("upper", 12.0),
    ]


def test_bounds_at_the_edges(spark):
    got = raw.with_bounds(ramp(spark), BASE, BASE + 200_000)
    assert {b for (b,) in values(got, "bound")} == {"inside"}


def test_latest_prefers_the_last_write_and_keeps_nulls(spark):
    df = points(spark, [point("a", 5, 1, seq=1), point("a", 5, None, seq=2), point("b", 9, "x", seq=3)])
    assert values(raw.latest(df), "series_name", "value_num", "value_str", "seq") == [
        ("a", None, None, 2),
        ("b", None, "x", 3),
    ]
    assert values(raw.latest(df, before=9), "series_name") == [("a",)]


def test_global_limit(spark):
    got = raw.limited(ramp(spark), 3, offset=2, desc=True, scope="global")
    assert sorted(v for (v,) in values(got, "value_num")) == [95, 96, 97]


def three_tags(spark):
    return points(spark, [point(f"t{i}", BASE + j * 1000, i * 100 + j) for i in range(3) for j in range(5)])


def test_wide(spark):
    got = shape.wide(three_tags(spark), ["t0", "t1", "t2", "t9"], ["a", "b", "c", "none"])
    assert got.columns == ["t_stamp", "a", "b", "c", "none"]
    assert sorted(values(got, *got.columns))[2] == (BASE + 2000, 2.0, 102.0, 202.0, None)
    assert got.count() == 5


def test_wide_takes_one_name_twice(spark):
    got = shape.wide(three_tags(spark), ["t0", "t0"], ["a", "b"])
    assert all(r.a == r.b for r in got.collect())


def test_align(spark):
    df = points(spark, [point("a", 1, 1), point("a", 2, 2), point("b", 2, 3), point("b", 3, 4)])
    assert sorted(values(shape.align(df, ["a", "b"]), "ts_ms", "a", "b")) == [(1, 1.0, None), (2, 2.0, 3.0), (3, None, 4.0)]
    assert values(shape.align(df, ["a", "b"], how="inner"), "ts_ms", "a", "b") == [(2, 2.0, 3.0)]


def test_series_pages(spark):
    got = shape.to_series(ramp(spark), page_size=30).collect()
    pages = {r.page: [p.value for p in r.points] for r in got}
    assert pages == {i: [float(v) for v in range(i * 30, min(i * 30 + 30, 100))] for i in range(4)}
    assert got[0].fields == ["time", "value"]


def test_small_series_is_one_row(spark):
    got = shape.to_series(three_tags(spark)).collect()
    assert len(got) == 3 and all(r.page == 0 and len(r.points) == 5 for r in got)


def test_json_rows(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS t_stamp, double('NaN') AS a, 1.5D AS b, 'x' AS c")
    assert shape.to_json_rows(df).first().json == '{"t_stamp":1704067200000,"a":null,"b":1.5,"c":"x"}'


def test_unknown_format_is_refused():
    with pytest.raises(ValueError):
        shape.check_format("CALCULATION")


def test_strings_and_booleans_come_back(spark, plant):
    rows = [point("Plant/default/a", BASE + i, v) for i, v in enumerate(["hello", "world", "test", True, False])]
    resolved = resolve.resolve_keys(keys(spark, PREFIX + "a"), *plant, "Plant")
    got = raw.raw_points(points(spark, rows), resolved)
    assert values(got, "value_str", "value_bool") == sorted(
        [("hello", None), ("world", None), ("test", None), (None, True), (None, False)], key=repr
    )


def test_named_points_default_quality(spark):
    df = spark.createDataFrame([(PREFIX + "a", 1, None), (PREFIX + "b", 2, 64)], "qpath string, ts_ms bigint, quality_code int")
    for names in (None, path_names(df, "Plant")):
        assert values(named_points(df, "Plant", names), "series_name", "quality_code", "status") == [
            ("Plant/default/a", 192, "Good"),
            ("Plant/default/b", 64, "Uncertain"),
        ]


def test_missing_path_has_the_empty_name(spark):
    df = spark.createDataFrame([(None, 1), (PREFIX + "a", 2)], "qpath string, ts_ms bigint")
    for names in (None, path_names(df, "Plant")):
        assert values(named_points(df, "Plant", names), "series_name") == [("",), ("Plant/default/a",)]
