"""Registry, metadata, browse tree and assets on small fixtures."""

from datetime import datetime, timedelta

import pytest
from fixtures import asset, assets, measurement, measurements, point, points, values

from tagseries.functions.ids import name_uuid
from tagseries.operators import assets as asset_ops
from tagseries.operators import browse as tree
from tagseries.operators import registry as reg
from tagseries.operators.metadata import merge_metadata
from tagseries.schema import PENDING_METADATA


def at(day):
    return datetime(2024, 1, day)


def test_active_only_and_one_per_name(spark):
    meas = measurements(
        spark,
        [
            measurement("a", "1", "Active", updated_at=at(1)),
            measurement("a", "2", "ACTIVE", updated_at=at(3)),
            measurement("a", "3", "deleted", updated_at=at(9)),
            measurement("b", "4", "inactive"),
            measurement("c", "5", "active", updated_at=at(2)),
            measurement("c", "6", "active", updated_at=at(2)),
        ],
    )
    assert values(reg.measurements(meas), "name", "uuid") == [("a", "2"), ("c", "6")]
    assert values(reg.measurements(meas, since=at(3)), "uuid") == [("2",)]
    assert values(reg.registry_summary(meas), "total", "active", "cached") == [(6, 4, 2)]


def test_diff(spark):
    before = measurements(spark, [measurement("a"), measurement("b")])
    after = measurements(spark, [measurement("b"), measurement("c")])
    assert values(reg.registry_diff(before, after), "name", "change") == [
        ("a", "removed"),
        ("b", "unchanged"),
        ("c", "added"),
    ]


def meta(spark, rows):
    return spark.createDataFrame(rows, PENDING_METADATA)


def test_metadata_merges_by_key(spark):
    df = meta(
        spark,
        [
            ("p", {"unit": "C", "description": "old", "gone": None}, 1),
            ("p", {"description": "new"}, 2),
            ("q", {"only": None}, 3),
            ("r", None, 4),
        ],
    )
    assert values(merge_metadata(df), "tag_path", "properties") == [("p", {"unit": "C", "description": "new"})]
    later = meta(spark, [("p", {"unit": "F"}, 5)])
    assert values(merge_metadata(merge_metadata(df), later), "properties") == [({"unit": "F", "description": "new"},)]


def test_onboard(spark):
    meas = measurements(spark, [measurement("known"), measurement("dead", status="deleted")])
    pts = points(
        spark,
        [
            point("known", 1, 1),
            point("dead", 1, 1),
            point("fresh", 5, None, seq=1),
            point("fresh", 6, "text", seq=2),
            point("fresh", 7, 3, seq=3),
            point("flag", 9, True),
            point("empty", 9, None),
        ],
    )
    pending = meta(spark, [("fresh", {"description": "a new one", "unit": "C"}, 1), ("known", {"x": "y"}, 2)])
    created = reg.onboard(pts, meas, pending)
    assert values(created, "name", "datatype", "description", "attributes") == [
        ("dead", "number", None, None),
        ("flag", "boolean", None, None),
        ("fresh", "string", "a new one", {"unit": "C"}),
    ]
    again = reg.onboard(pts, reg.extend_registry(meas, created), pending)
    assert again.count() == 0
    assert values(created.select("uuid"), "uuid") == values(created.select(name_uuid("name").alias("u")), "u")


def test_evicted_series_is_created_again(spark):
    meas = measurements(spark, [measurement("a", "1"), measurement("b", "2")])
    left = reg.evict(meas, spark.createDataFrame([("1",), ("1",)], "uuid string"))
    assert values(left, "name") == [("b",)]
    assert values(reg.onboard(points(spark, [point("a", 1, 1), point("b", 1, 1)]), left), "name") == [("a",)]


def test_namespace_prefers_measurements(spark):
    meas = measurements(spark, [measurement("x", "m"), measurement("y", "n", status="deleted")])
    things = assets(spark, [asset("as-x", "x"), asset("as-y", "y")])
    assert values(reg.namespace(meas, things), "name", "uuid", "kind") == [("x", "m", "measurement"), ("y", "as-y", "asset")]


def catalogue(spark):
    return measurements(
        spark,
        [
            measurement("temp/in", "1", "Active", database="d1", collector_uuid="c1", labels=["hot"], quality="Good"),
            measurement("temp/out", "2", "deleted", database="d1", collector_uuid="c2", labels=["hot", "x"], quality="Bad"),
            measurement("calc/diff", "3", "Active", "number", database="d2", labels=[], is_calculation=True,
                        depends_on=["temp/in", "temp/out"]),
            measurement("label", "4", "Active", "string", database="d2", collector_uuid="c1"),
        ],
    )


@pytest.mark.parametrize(
    "filters,want",
    [
        ({}, "1234"),
        ({"keyword": "TEMP"}, "12"),
        ({"statuses": ["Active"]}, "134"),
        ({"labels": ["x", "nope"]}, "2"),
        ({"databases": ["d2"]}, "34"),
        ({"collectors": ["c1"]}, "14"),
        ({"datatypes": ["string"]}, "4"),
        ({"quality": "Bad"}, "2"),
        ({"exclude_calculations": True}, "124"),
        ({"keyword": "calc", "include_dependencies": True}, "123"),
        ({"keyword": "calc", "include_dependencies": True, "exclude_calculations": True}, "12"),
    ],
)
def test_find_measurements(spark, filters, want):
    assert "".join(u for (u,) in values(reg.find_measurements(catalogue(spark), **filters), "uuid")) == want


def plant(spark):
    return assets(
        spark,
        [
            asset("r", "Site"),
            asset("l1", "Site/Line1", "r"),
            asset("l2", "Site/Line2", "r"),
            asset("m", "Site/Line1/Motor", "l1"),
            asset("o", "Other"),
        ],
    )


def test_closure(spark):
    assert values(asset_ops.asset_closure(plant(spark), ["r"]), "uuid", "depth") == [("l1", 1), ("l2", 1), ("m", 2), ("r", 0)]
    assert values(asset_ops.asset_closure(plant(spark), ["nobody"]), "uuid") == []
    assert values(asset_ops.asset_closure(plant(spark), ["r", "m"]), "uuid", "depth") == [
        ("l1", 1),
        ("l2", 1),
        ("m", 0),
        ("r", 0),
    ]


def test_closure_ends_on_a_cycle(spark):
    loop = assets(spark, [asset("a", "a", "c"), asset("b", "b", "a"), asset("c", "c", "b")])
    assert values(asset_ops.asset_closure(loop, ["a"]), "uuid", "depth") == [("a", 0), ("b", 1), ("c", 2)]


def test_properties_and_points(spark):
    props = spark.createDataFrame(
        [("p1", "m", "u1", "speed", "number"), ("p2", "l2", "u2", "count", "number"), ("p3", "o", "u3", "speed", "string")],
        "uuid string, asset_uuid string, measurement_uuid string, name string, datatype string",
    )
    found = reg.find_properties(props, plant(spark), asset_uuids=["r"], recursive=True)
    assert values(found, "uuid") == [("p1",), ("p2",)]
    assert values(reg.find_properties(props, asset_uuids=["l2"]), "uuid") == [("p2",)]
    assert values(reg.find_properties(props, keyword="SPEED", datatypes=["number"]), "uuid") == [("p1",)]
    pts = points(spark, [point("x", 1, 5)]).drop("measurement_uuid").selectExpr("*", "'u1' AS measurement_uuid")
    assert values(asset_ops.asset_points(plant(spark), props, pts), "asset", "property", "value_num") == [
        ("Site/Line1/Motor", "speed", 5.0)
    ]


def test_find_assets(spark):
    assert values(reg.find_assets(plant(spark), keyword="line"), "uuid") == [("l1",), ("l2",), ("m",)]
    assert values(reg.find_assets(plant(spark), path="Site/Line1", parents=["r"]), "uuid") == [("l1",)]
    assert values(reg.find_assets(plant(spark), uuids=["o"]), "name") == [("Other",)]


def browse_rows(df):
    return values(df, "node_type", "name", "path", "has_children")


def test_browse(spark):
    meas = measurements(spark, [measurement("P/default/a"), measurement("P/default/b/c"), measurement("P/x"),
                                measurement("P/default/old", status="deleted"), measurement("P/default/a/deep")])
    things = plant(spark)
    assert browse_rows(tree.browse(meas, things)) == [
        ("folder", "Assets", "Assets", True),
        ("folder", "Measurements", "Measurements", True),
    ]
    inner = [
        ("folder", "a", "P/default/a", True),
        ("folder", "b", "P/default/b", True),
        ("tag", "a", "P/default/a", False),
    ]
    assert browse_rows(tree.browse(meas, things, "Measurements/P/default/")) == inner
    assert browse_rows(tree.browse(meas, things, "Measurements/P/default")) == inner
    assert browse_rows(tree.browse(meas, things, "P/default/")) == inner
    assert browse_rows(tree.browse(meas, things, "Measurements")) == [("folder", "P", "P", True)]
    assert browse_rows(tree.browse(meas, things, "Assets/Site/")) == [
        ("folder", "Line1", "Site/Line1", True),
        ("tag", "Line1", "Site/Line1", False),
        ("tag", "Line2", "Site/Line2", False),
    ]
    assert browse_rows(tree.browse(meas, things, "P/default/", ["?"]))[-1][1] == "a"
    assert browse_rows(tree.browse(meas, things, "P/default/", ["z*"])) == []


def test_folder_counts(spark):
    names = spark.createDataFrame([("a/b/c",), ("a/b/d",), ("a/e",), ("f",)], "name string")
    assert values(tree.folder_counts(names), "folder", "names", "depth") == [("a", 3, 1), ("a/b", 2, 2)]


def test_collectors_and_databases(spark):
    collectors = spark.createDataFrame([("1", "North gate", "active"), ("2", "South", "inactive")], "uuid string, description string, status string")
    assert values(reg.find_collectors(collectors, "GATE", ["active"]), "uuid") == [("1",)]
    databases = spark.createDataFrame([("1", "main"), ("2", "archive")], "uuid string, name string")
    assert values(reg.find_databases(databases, "ARCH"), "uuid") == [("2",)]
    assert reg.find_databases(databases).count() == 2


def test_later_deletion_counts(spark):
    at = datetime(2024, 1, 1)
    rows = [("u1", "m", "Active", at), ("u1", "m", "deleted", at + timedelta(1)), ("u2", "n", "Active", at)]
    meas = spark.createDataFrame(rows, "uuid string, name string, status string, updated_at timestamp")
    assert [r.name for r in reg.measurements(meas).collect()] == ["n"]


def test_deep_asset_chain(spark):
    chain = spark.range(200).selectExpr("string(id) AS uuid", "IF(id = 0, NULL, string(id - 1)) AS parent_uuid")
    assert asset_ops.asset_closure(chain, ["190"]).count() == 10 and asset_ops.asset_closure(chain, ["130"]).agg({"depth": "max"}).first()[0] == 69
