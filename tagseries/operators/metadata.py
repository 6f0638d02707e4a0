"""Pending metadata: property maps waiting for their series to be created."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import drop_empty


def merge_metadata(*frames: DataFrame) -> DataFrame:
    """One property map per tag path; for each key the entry with the highest ``seq`` wins.

    NULL values and empty maps are dropped. Entries are reduced per (path, key) on the map
    side first, so only one row per distinct property reaches the map building.
    """
    incoming = frames[0]
    for frame in frames[1:]:
        incoming = incoming.unionByName(frame)
    entries = incoming.select("tag_path", "seq", F.explode(drop_empty("properties")).alias("k", "v"))
    newest = entries.groupBy("tag_path", "k").agg(F.max_by("v", "seq").alias("v"), F.max("seq").alias("seq"))
    return newest.groupBy("tag_path").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "v")))).alias("properties"),
        F.max("seq").alias("seq"),
    )
