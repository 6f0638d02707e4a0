"""Scripting interface, composed requests and the registered queries."""

import os
import pathlib

import pytest
from compare import compare, duck
from fixtures import BASE, asset, assets, measurement, measurements, point, points, values

from tagseries.plans.history import TagHistory, TagStore
from tagseries.plans.suite import ORACLE, QUERIES
from tagseries.plans.timeseries import Aggregation, TimeseriesRequest, query_timeseries

A, B, GONE = (f"histprov:h:/sys:gw:/prov:default:/tag:{x}" for x in ("a", "b", "gone"))


@pytest.fixture(scope="module")
def history(spark):
    rows = [point("Plant/default/a", BASE + i * 1000, i, tags={"line": "1"}) for i in range(100)]
    rows += [point("Plant/default/b", BASE + i * 2000, 100 + i, tags={"line": "2"}) for i in range(50)]
    meas = measurements(
        spark, [measurement("Plant/default/a", "ua", database="d1"), measurement("Plant/default/b", "ub", database="d2")]
    )
    return TagHistory(points(spark, rows), meas, assets(spark, [asset("as", "Line/pump")]), "Plant")


def test_raw_wide(history):
    got = history.query_raw_points([A, B, GONE], BASE, BASE + 4000, ["a", "b", "gone"], return_size=3)
    assert values(got, "t_stamp", "a", "b", "gone") == [
        (BASE, 0.0, 100.0, None),
        (BASE + 1000, 1.0, None, None),
        (BASE + 2000, 2.0, 101.0, None),
    ]


def test_raw_tall(history):
    got = history.query_raw_points([A, GONE], BASE, BASE + 2000, return_format="tall")
    assert values(got, "qpath", "ts_ms", "value") == [(A, BASE, 0.0), (A, BASE + 1000, 1.0)]
    assert history.query_raw_points([A, B], BASE, BASE + 9000, return_format="TALL", return_size=4).count() == 4


def test_raw_bounds(history):
    got = history.query_raw_points([A], BASE + 5000, BASE + 7000, ["a"], include_bounds=True)
    assert values(got, "t_stamp", "a") == [(BASE + i * 1000, float(i)) for i in range(4, 8)]


def test_refused_options(history):
    with pytest.raises(ValueError):
        history.query_raw_points([A], return_format="CALCULATION")
    with pytest.raises(ValueError):
        history.query_raw_points([A], exclude_observations=True)
    with pytest.raises(ValueError):
        history.query_raw_points([A, B], column_names=["one"])
    with pytest.raises(ValueError):
        history.query_raw_points([A], BASE + 1, BASE)


def test_aggregates_wide(history):
    got = history.query_aggregated_points(
        [A, B, A], BASE, BASE + 100_000, ["Average", "Count", "Maximum"], return_size=1, column_names=["mean", "n", "top"]
    )
    assert values(got, "t_stamp", "mean", "n", "top") == [(BASE, 49.5, 50.0, 99.0)]


def test_aggregates_tall_default(history):
    got = history.query_aggregated_points([A, GONE], BASE, BASE + 100_000, return_format="TALL", return_size=4)
    assert values(got, "qpath", "aggregate", "ts_ms", "value") == [
        (A, "Average", BASE + i * 25_000, 12.0 + i * 25) for i in range(4)
    ]


def test_aggregates_fill(history):
    got = history.query_aggregated_points(
        [B], BASE, BASE + 4000, ["Sum"], ["NULL"], ["b"], period="1s"
    )
    assert values(got, "t_stamp", "b") == [(BASE, 100.0), (BASE + 1000, None), (BASE + 2000, 101.0), (BASE + 3000, None)]


def test_rest_of_the_interface(history):
    assert history.query_last([A], BASE + 100_000, minutes=1, return_format="TALL").count() == 60
    assert values(history.missing([A, GONE]), "qpath") == [(GONE,)]
    assert values(history.nodes([A, "histprov:h:/tag:Assets/Line/pump"]), "uuid") == [("as",), ("ua",)]
    assert values(history.query_metadata([A]), "qpath") == [(A,)]
    assert history.aggregates().count() == 11
    assert values(history.browse("histprov:h"), "name") == [("Assets",), ("Measurements",)]
    inner = history.browse("histprov:h:/folder:Measurements:/folder:Plant:/folder:default")
    assert values(inner, "name", "path") == [("a", "Plant/default/a"), ("b", "Plant/default/b")]
    assert values(history.browse("histprov:h:/folder:Assets", ["L*"]), "name") == [("Line",)]


def test_stored_points_are_read_by_uuid(spark, history, tmp_path):
    from tagseries.operators.storage import read_points, write_points

    write_points(history.points, history.meas, str(tmp_path), "b")
    stored = TagHistory(read_points(spark, str(tmp_path)), history.meas, history.assets, "Plant", stored=True)
    got = stored.query_raw_points([A, GONE], BASE, BASE + 2000, ["a", "gone"])
    assert values(got, "t_stamp", "a", "gone") == [(BASE, 0.0, None), (BASE + 1000, 1.0, None)]
    assert "EqualTo(measurement_uuid,ua)" in got._jdf.queryExecution().executedPlan().toString()
    agg = stored.query_aggregated_points([A, B], BASE, BASE + 100_000, ["Count"], return_format="TALL", return_size=1)
    assert values(agg, "qpath", "value") == [(A, 100.0), (B, 50.0)]
    assert stored.query_raw_points([GONE], return_format="TALL").count() == 0


def test_fill_mode_per_path(history):
    got = history.query_aggregated_points(
        [A, B], BASE, BASE + 3000, ["Sum"], ["DERIVED", "PREVIOUS"], ["a", "b"], period="1s"
    )
    assert values(got, "t_stamp", "a", "b") == [
        (BASE, 0.0, 100.0),
        (BASE + 1000, 1.0, 100.0),
        (BASE + 2000, 2.0, 101.0),
    ]
    with pytest.raises(ValueError):
        history.query_aggregated_points([A], BASE, BASE + 1, fill_modes=["WAVY"])
    with pytest.raises(ValueError):
        history.query_aggregated_points([A], BASE, BASE + 1, include_bounds=True)


def test_script_store_round_trip(spark, tmp_path):
    store = TagStore(spark, str(tmp_path), "Plant")
    store.store_metadata([A], [{"description": "first", "unit": "C"}, {"unit": "F", "none": None}])
    for _ in range(2):
        store.store_data_points([A, A, A, B], [1, 2.5, None, True], [BASE, BASE + 1, BASE + 2, BASE], batch="one")
    store.store_tag_history(["t1", "t2"], [["hello", "world"], ["x", "y"]], [BASE, BASE + 1], [64, 0])
    back = store.history()
    rows = values(back.points, "series_name", "ts_ms", "value_num", "value_bool", "value_str", "status")
    assert rows == [
        ("Plant/default/a", BASE, 1.0, None, None, "Good"),
        ("Plant/default/a", BASE + 1, 2.5, None, None, "Good"),
        ("Plant/default/b", BASE, None, True, None, "Good"),
        ("Plant/default/t1", BASE, None, None, "hello", "Uncertain"),
        ("Plant/default/t1", BASE + 1, None, None, "world", "Bad"),
        ("Plant/default/t2", BASE, None, None, "x", "Uncertain"),
        ("Plant/default/t2", BASE + 1, None, None, "y", "Bad"),
    ]
    created = {r.name: r for r in back.meas.collect()}
    assert created["Plant/default/a"].description == "first"
    assert created["Plant/default/a"].attributes == {"unit": "F"}
    assert [created[f"Plant/default/{x}"].datatype for x in ("a", "b", "t1")] == ["number", "boolean", "string"]
    assert back.query_raw_points([A], BASE, BASE + 9, return_format="TALL").count() == 2
    with pytest.raises(ValueError):
        store.store_data_points([A], [1, 2], [BASE])


def test_values_keep_their_type(spark):
    names = [f"Plant/default/{x}" for x in ("n", "b", "s")]
    rows = [point(n, BASE + i * 1000, v) for n, vs in zip(names, ([1, 2], [True, False], ["x", "y"])) for i, v in enumerate(vs)]
    meas = measurements(spark, [measurement(n, datatype=t) for n, t in zip(names, ("number", "boolean", "string"))])
    props = spark.createDataFrame(
        [("p1", "pump", f"id-{names[1]}", "on", "boolean"), ("p2", "pump", f"id-{names[2]}", "state", "string")],
        "uuid string, asset_uuid string, measurement_uuid string, name string, datatype string",
    )
    tree = assets(spark, [asset("pump", "Line/pump"), asset("bare", "Line/bare")])
    history = TagHistory(points(spark, rows), meas, tree, "Plant", props=props)
    paths = [f"histprov:h:/sys:gw:/prov:default:/tag:{x}" for x in ("n", "b", "s")]
    pump, bare = (f"histprov:h:/tag:Assets/Line/{x}" for x in ("pump", "bare"))

    wide = history.query_raw_points([*paths, pump, bare], column_names=["n", "b", "s", "pump", "bare"])
    assert wide.columns == ["t_stamp", "n", "b", "s", "pump/on", "pump/state", "bare"]
    assert [tuple(r) for r in wide.orderBy("t_stamp").collect()] == [
        (BASE, 1.0, True, "x", True, "x", None),
        (BASE + 1000, 2.0, False, "y", False, "y", None),
    ]
    for size in (None, 9):
        tall = history.query_raw_points([paths[1], pump], return_format="TALL", return_size=size)
        assert tall.columns == ["qpath", "series_name", "ts_ms", "value", "value_bool", "value_str", "seq"]
        assert tall.count() == 6
    last = history.query_aggregated_points(
        [*paths, pump], BASE, BASE + 10_000, ["LastValue"], column_names=["n", "b", "s", "pump"], return_size=1
    )
    assert values(last, "n", "b", "s", "`pump/on`", "`pump/state`") == [(2.0, False, "y", False, "y")]
    mixed = history.query_aggregated_points(
        paths, BASE, BASE + 10_000, ["Sum", "Count", "LastValue"], return_format="TALL", return_size=1
    )
    assert values(mixed, "aggregate", "value", "value_str") == [("Count", 2.0, None), ("LastValue", None, "y"), ("Sum", 3.0, None)]


def ask(history, **options):
    return query_timeseries(TimeseriesRequest(**options), history.points, history.meas, options.pop("props", None))


def test_requests(spark, history):
    assert ask(history).count() == 150
    assert ask(history, measurement_uuids=["ua"]).count() == 100
    assert ask(history, measurements=[("d2", "Plant/default/b"), ("d1", "Plant/default/b")]).count() == 50
    assert ask(history, measurement_uuids=["ua"], measurements=[("d2", "Plant/default/b")]).count() == 150
    assert ask(history, tags={"line": "2"}, start=BASE + 1, limit=2).count() == 2
    assert values(ask(history, limit=1, desc=True), "value_num") == [(149.0,), (99.0,)]
    assert ask(history, value_filters=[(">", 98)], only_changes=True).count() == 51
    props = spark.createDataFrame(
        [("p", "as", "ub", "speed", "number")], "uuid string, asset_uuid string, measurement_uuid string, name string, datatype string"
    )
    request = TimeseriesRequest(asset_property_uuids=["p"])
    assert query_timeseries(request, history.points, history.meas, props).count() == 50
    joined = ask(history, join=["Plant/default/a", "Plant/default/b"], end=BASE + 3000)
    assert values(joined, "ts_ms", "Plant/default/a", "Plant/default/b") == [
        (BASE, 0.0, 100.0),
        (BASE + 1000, 1.0, None),
        (BASE + 2000, 2.0, 101.0),
    ]


def test_requested_aggregations(history):
    window = {"start": BASE, "end": BASE + 100_000}
    got = ask(history, **window, aggregation=Aggregation("sum", "100s"), group_by=["line"])
    assert values(got, "line", "value") == [("1", 4950.0), ("2", 6225.0)]
    got = ask(history, **window, aggregation=Aggregation("percentile", "100s", arguments=[0.5]))
    assert values(got, "series_name", "value") == [("Plant/default/a", 49.5), ("Plant/default/b", 124.5)]
    got = ask(history, **window, aggregation=Aggregation("max", "10s"), limit=1, offset=1, desc=True)
    assert values(got, "series_name", "value") == [("Plant/default/a", 89.0), ("Plant/default/b", 144.0)]
    with pytest.raises(ValueError):
        ask(history, group_by=["line"])


@pytest.fixture(scope="module")
def database(spark, sf_dir):
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    return duck(sf_dir)


def test_every_query_has_a_counterpart():
    assert sorted(QUERIES) == sorted(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_duckdb(spark, sf_dir, database, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert node not in plan
    _, message = compare(df, database, ORACLE[name])
    assert message == ""


def test_no_join_is_forced_to_broadcast():
    root = pathlib.Path(__file__).parent.parent / "tagseries"
    for file in root.rglob("*.py"):
        if "llm" in file.parts:  # has a test of its own
            continue
        text = file.read_text()
        assert "broadcast(" not in text and "localCheckpoint" not in text and "udf(" not in text, file


def test_entry(spark, sf_dir):
    import __spark_entry__ as entry

    assert os.path.isdir(sf_dir)
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
