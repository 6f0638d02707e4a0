"""From requested paths to series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import node_id
from ..functions.paths import stored_path
from ..functions.values import NOT_FOUND, value_type
from ..session import written
from .registry import measurements, namespace


def named_keys(keys: DataFrame, collector: str) -> DataFrame:
    """Keys (``qpath``) with the name their series is stored under.

    The name is never NULL (a missing path gets the empty name), so a later join adds no
    null check that would run the path expressions a second time, below the keys' own plan.
    """
    return keys.withColumn("series_name", F.coalesce(stored_path("qpath", collector), F.lit("")))


def resolve_keys(keys: DataFrame, meas: DataFrame, assets: DataFrame, collector: str) -> DataFrame:
    """Each key with uuid, kind and datatype; NULL where the name is unknown.

    A measurement is taken before an asset of the same name. The joins carry no broadcast
    hint: Spark picks the strategy from the measured size of the catalogue.
    """
    names = namespace(meas, assets).select(
        F.col("name").alias("series_name"), F.col("uuid").alias("measurement_uuid"), "kind", "datatype", "created_at"
    )
    return named_keys(keys, collector).join(names, "series_name", "left")


def resolved_once(keys: DataFrame, meas: DataFrame, assets: DataFrame, collector: str) -> DataFrame:
    """``resolve_keys``, worked out once and kept: a request reads its keys several times, and the catalogues,
    their windows and the path grammar need not run each time."""
    return written(resolve_keys(keys, meas, assets, collector))


def with_asset_series(found: DataFrame, props: DataFrame, meas: DataFrame) -> DataFrame:
    """Resolved keys, those of assets replaced by one per property bound to an active measurement.

    Such a key keeps its ``qpath`` and gets the series, uuid and datatype of the property and its name as
    ``property``; a key of an asset without any is left as it is.
    """
    active = measurements(meas).select(
        F.col("uuid").alias("__uuid"), F.col("name").alias("__series"), F.col("datatype").alias("__datatype")
    )
    bound = props.select(
        F.col("asset_uuid").alias("__asset"), F.col("measurement_uuid").alias("__uuid"), F.col("name").alias("property")
    ).join(active, "__uuid")
    is_bound = (F.col("kind") == "asset") & (F.col("measurement_uuid") == F.col("__asset"))
    return found.join(bound, is_bound, "left").select(
        "qpath",
        F.coalesce("__series", "series_name").alias("series_name"),
        F.coalesce("__uuid", "measurement_uuid").alias("measurement_uuid"),
        "kind",
        F.coalesce("__datatype", "datatype").alias("datatype"),
        "property",
    )


def missing_keys(keys: DataFrame, meas: DataFrame, assets: DataFrame, collector: str) -> DataFrame:
    """Keys that name neither a measurement nor an asset, with their failure status."""
    return (
        resolve_keys(keys, meas, assets, collector)
        .filter(F.col("measurement_uuid").isNull())
        .select("qpath", "series_name", F.lit(NOT_FOUND).alias("status"))
    )


def lookup_nodes(paths: DataFrame, meas: DataFrame, assets: DataFrame, collector: str) -> DataFrame:
    """Node of every known path; a missing creation time reads as the epoch."""
    known = resolve_keys(paths, meas, assets, collector).filter(F.col("measurement_uuid").isNotNull())
    return known.select(
        "qpath",
        "series_name",
        F.col("measurement_uuid").alias("uuid"),
        node_id("measurement_uuid").alias("node_id"),
        value_type("datatype").alias("data_type"),
        F.coalesce(F.unix_millis("created_at"), F.lit(0)).cast("bigint").alias("created_ms"),
        F.lit(None).cast("bigint").alias("retired_ms"),
    )


def query_metadata(keys: DataFrame, meas: DataFrame, collector: str) -> DataFrame:
    """Property map of every key that names a measurement; unset properties are left out.

    Assets carry no metadata: their names end up in ``missing_metadata``.
    """
    known = measurements(meas)
    found = named_keys(keys, collector).join(known.withColumnRenamed("name", "series_name"), "series_name")
    shown = [
        ("datatype", F.nullif("datatype", F.lit(""))),
        ("status", F.nullif("status", F.lit(""))),
        ("name", F.nullif("series_name", F.lit(""))),
        ("engUnit", F.col("specs.uom")),
        ("engLow", F.col("specs.value_min").cast("string")),
        ("engHigh", F.col("specs.value_max").cast("string")),
        ("limitLow", F.col("specs.limit_lo").cast("string")),
        ("limitHigh", F.col("specs.limit_hi").cast("string")),
    ]
    pairs = [c for name, value in shown for c in (F.lit(name), value)]
    properties = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    return found.select("qpath", "series_name", properties.alias("properties"))


def missing_metadata(keys: DataFrame, meas: DataFrame, collector: str) -> DataFrame:
    """Keys without a measurement of their name."""
    known = measurements(meas).select(F.col("name").alias("series_name"))
    return (
        named_keys(keys, collector)
        .join(known, "series_name", "left_anti")
        .select("qpath", "series_name", F.lit(NOT_FOUND).alias("status"))
    )


def with_header(points: DataFrame, meas: DataFrame) -> DataFrame:
    """Points with the header fields of their measurement."""
    header = measurements(meas).select(
        F.col("name").alias("series_name"), F.col("uuid").alias("header_uuid"), "datatype", "database"
    )
    return points.join(header, "series_name")
