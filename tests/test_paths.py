"""Path grammar, by example."""

import pytest
from pyspark.sql import functions as F

from tagseries.functions import paths

NODES = [["Boiler"], ["Kiln 3", "Zone", "Burner#2"], ["Tank.A", "Level"], ["ä", "b c", "d", "e"]]


def written(nodes):
    """Ways to write a path below a provider ``hot`` of collector ``Plant``, from its parts; each gives the same name."""
    tag = "/".join(nodes)
    folders = "".join(f":/folder:{n}" for n in ["Plant", "hot", *nodes[:-1]])
    for store in ("histprov:arc one:/", "histprov:x:/sys:rack-9f:/", "sys:rack-9f:/"):
        yield f"{store}prov:hot:/tag:{tag}"
    yield f"histprov:x:/tag:Plant/hot/{tag}"
    yield f"histprov:x:/tag:Measurements/Plant/hot/{tag}"
    yield f"histprov:x{folders}:/tag:{nodes[-1]}"
    yield f"histprov:x:/folder:Measurements{folders}:/tag:{nodes[-1]}"


STORED = [(path, "Plant/hot/" + "/".join(nodes)) for nodes in NODES for path in written(nodes) if "prov:hot" not in path or "sys:" in path]
# one case per trap of the grammar
STORED += [
    ("histprov:x:/folder:Assets:/folder:Mill:/tag:Drum", "Mill/Drum"),
    ("histprov:x:/tag:Assets/Mill/Drum", "Mill/Drum"),
    ("folder:K/folder:L:/tag:m", "K/folder:L/L/m"),
    ("histprov:x:/folder:Measurements2:/tag:m", "Measurements2/m"),
    ("histprov:x:/folder:Assets:/tag:m", "m"),
    ("histprov:x:/folder::/folder:K:/tag:m", "K/m"),
    ("histprov:x:/folder:K:/folder::/tag:m", "K//m"),
    ("histprov:x:/tag:Assets", ""),
    ("bare", "bare"),
    ("sys:r:/prov:q", "sys:r:/prov:q"),
    ("sys:r:/prov::/tag:m", "Plant//m"),
    ("sys:r:/prov:q:/tag:", "Plant/q/"),
]

PARTS = {"histprov:": "arc one", "sys:": "rack-9f", "prov:": "hot", "tag:": "Kiln 3/Zone"}
COMPONENTS = [(":/".join(f"{k}{v}" for k, v in PARTS.items()), key, PARTS[key]) for key in ("sys:", "prov:", "tag:")]
COMPONENTS += [
    ("sys:rack-9f:/tag:m", "prov:", None),
    ("sys:rack-9f:/prov:hot", "sys:", "rack-9f"),
    ("histprov:alone", "prov:", None),
    ("k/tag:1:/tag:2", "tag:", "1"),
    ("tag:two\nlines:/k", "tag:", "two\nlines"),
]

FOLDERS = [("histprov:arc" + "".join(f":/folder:{n}" for n in nodes), "".join(f"{n}/" for n in nodes)) for nodes in [[], *NODES]]
FOLDERS += [(None, ""), ("", ""), ("xfolder:no:/folder:yes", "yes/")]

CATEGORIES = [
    ("Measurements/Plant/hot/Kiln", "Measurements", "Plant/hot/Kiln"),
    ("Assets/Mill/Drum/Gear", "Assets", "Mill/Drum/Gear"),
    ("Plant/hot/Kiln", None, "Plant/hot/Kiln"),
    ("Measurements", "Measurements", ""),
    ("Assets", "Assets", ""),
    ("Measurements2/a", None, "Measurements2/a"),
    (None, None, None),
]


def test_stored_path(spark):
    df = spark.createDataFrame(STORED, "path string, want string")
    got = df.select("path", "want", paths.stored_path("path", "Plant").alias("got")).collect()
    assert [(r.path, r.got) for r in got] == [(r.path, r.want) for r in got]


@pytest.mark.parametrize("path,key,want", COMPONENTS)
def test_component(spark, path, key, want):
    assert spark.range(1).select(paths.extract_component(F.lit(path), key)).first()[0] == want


def test_folder_prefix(spark):
    df = spark.createDataFrame(FOLDERS, "path string, want string")
    assert all(r.got == r.want for r in df.select("want", paths.folder_prefix("path").alias("got")).collect())


def test_category(spark):
    df = spark.createDataFrame(CATEGORIES, "path string, category string, rest string")
    got = df.select("category", "rest", paths.extract_category("path"), paths.strip_category("path")).collect()
    assert all((r[0], r[1]) == (r[2], r[3]) for r in got)


def test_build_stored_path(spark):
    one = spark.range(1)
    built = one.select(
        paths.build_stored_path(F.lit("Plant"), F.lit("p"), F.lit("t")),
        paths.build_stored_path(F.lit("Plant"), F.lit(None).cast("string"), F.lit("t")),
    ).first()
    assert tuple(built) == ("Plant/p/t", "Plant/default/t")


def test_round_trip(spark):
    stored = spark.createDataFrame([("sys:rack-9f:/prov:hot:/tag:Kiln 3/Zone",)], "p string").select(
        paths.stored_path("p", "Plant").alias("s")
    )
    back = stored.select(
        "s",
        paths.stored_path(F.concat(F.lit("histprov:t:/tag:"), "s"), "Plant").alias("by_tag"),
        paths.stored_path(F.concat(F.lit("histprov:t:/folder:Measurements:/tag:"), "s"), "Plant").alias("by_folder"),
    ).first()
    assert back.s == back.by_tag == back.by_folder == "Plant/hot/Kiln 3/Zone"


@pytest.mark.parametrize(
    "glob,name,match", [("u1*", "u12", True), ("u?", "u12", False), ("a.b", "axb", False), ("*", "", True)]
)
def test_glob(spark, glob, name, match):
    assert spark.range(1).select(F.lit(name).rlike(paths.glob_to_regex(glob))).first()[0] is match
