"""Browse tree over slash-separated names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import ASSETS, MEASUREMENTS, glob_to_regex
from .registry import measurements

NODE = "node_type string, name string, path string, has_children boolean"


def children(names: DataFrame, prefix: str = "") -> DataFrame:
    """Direct children of a prefix: each next segment once as a folder, each complete name as a
    tag. A tag keeps its full stored path so that a query can resolve it."""
    rest = F.expr(f"substring(name, {len(prefix) + 1})")
    below = names.select("name").filter(F.col("name").startswith(prefix)).withColumn("rest", rest)
    below = below.filter(F.col("rest") != "")
    is_folder = F.col("rest").contains("/")
    child = F.substring_index("rest", "/", 1)
    return (
        below.select(
            F.when(is_folder, "folder").otherwise("tag").alias("node_type"),
            F.when(is_folder, child).otherwise(F.col("rest")).alias("name"),
            F.when(is_folder, F.concat(F.lit(prefix), child)).otherwise(F.col("name")).alias("path"),
            is_folder.alias("has_children"),
        )
        .distinct()
    )


def browse_root(spark: SparkSession) -> DataFrame:
    """The two category folders."""
    return spark.createDataFrame([("folder", c, c, True) for c in (MEASUREMENTS, ASSETS)], NODE)


def _category_of(prefix: str) -> tuple[str | None, str]:
    head, _, tail = prefix.partition("/")
    return (head, tail) if head in (MEASUREMENTS, ASSETS) else (None, prefix)


def browse(
    meas: DataFrame, assets: DataFrame, prefix: str = "", name_filters: Sequence[str] | None = None
) -> DataFrame:
    """Nodes below a slash path such as ``Measurements/Plant/``; the empty path is the root.

    A path outside both categories is looked up among the measurements as it stands.
    """
    if prefix == "":
        nodes = browse_root(meas.sparkSession)
    else:
        category, rest = _category_of(prefix)
        if category is not None and rest and not rest.endswith("/"):
            rest += "/"
        nodes = children(assets if category == ASSETS else measurements(meas), rest)
    if not name_filters:
        return nodes
    accepted = F.lit(False)
    for pattern in name_filters:
        accepted = accepted | F.col("name").rlike(glob_to_regex(pattern))
    return nodes.filter(accepted)


def folder_counts(names: DataFrame) -> DataFrame:
    """Number of names below every folder of the tree."""
    parts = F.split("name", "/")
    depth = F.size(parts) - 1
    folders = F.transform(F.sequence(F.lit(1), depth), lambda i: F.concat_ws("/", F.slice(parts, 1, i)))
    return (
        names.select("name")
        .filter(depth > 0)
        .select(F.explode(folders).alias("folder"))
        .groupBy("folder")
        .agg(F.count(F.lit(1)).alias("names"))
        .withColumn("depth", F.size(F.split("folder", "/")))
    )
