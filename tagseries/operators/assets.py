"""Asset tree and the way from assets to points."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed

# Levels after which what is found becomes one table again, so the plan does not grow with the depth.
LEVELS = 16


def asset_closure(assets: DataFrame, roots: Iterable[str] | DataFrame) -> DataFrame:
    """(uuid, depth) of the root assets and everything below them.

    Walks the parent links level by level; every level is one join of the frontier with the
    asset table and is checkpointed, so the plan does not grow with the depth. An asset counts
    at its smallest depth, which also ends the walk on cyclic links.
    """
    links = assets.select("uuid", "parent_uuid")
    if isinstance(roots, DataFrame):
        start = links.join(roots.select("uuid").distinct(), "uuid", "left_semi")
    else:
        start = links.filter(F.col("uuid").isin(list(roots)))
    frontier = checkpointed(start.select("uuid", F.lit(0).alias("depth")))
    found = frontier
    depth = 0
    while not frontier.isEmpty():
        depth += 1
        children = links.join(
            frontier.select(F.col("uuid").alias("parent_uuid")), "parent_uuid", "left_semi"
        ).select("uuid", F.lit(depth).alias("depth"))
        frontier = checkpointed(children.join(found.select("uuid"), "uuid", "left_anti"))
        found = found.unionByName(frontier)
        if depth % LEVELS == 0:
            found = checkpointed(found)
    return found


def asset_points(
    assets: DataFrame, props: DataFrame, points: DataFrame, key: str = "measurement_uuid"
) -> DataFrame:
    """Points of the assets' properties with asset and property names.

    The two small tables join first; the join with the points is then one equi join on the
    measurement, which Spark broadcasts only if the small side's measured size allows it.
    """
    bound = props.join(assets.select(F.col("uuid").alias("asset_uuid"), F.col("name").alias("asset")), "asset_uuid")
    bound = bound.select("asset_uuid", "asset", F.col("name").alias("property"), "measurement_uuid")
    if key != "measurement_uuid":
        bound = bound.withColumnRenamed("measurement_uuid", key)
    return points.join(bound, key)
