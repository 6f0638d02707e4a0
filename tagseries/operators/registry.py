"""Measurement, asset, collector and database catalogues."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import name_uuid
from ..functions.time import arrival_order
from ..functions.values import ACTIVE, BOOLEAN, NUMBER, STRING, datatype_of
from .assets import asset_closure


#: Status of a series that the store rejected; its next point creates it anew.
EVICTED = "evicted"
DELETED = "deleted"


def _any_of(column: str, values: Iterable | None) -> Column:
    return F.lit(True) if not values else F.col(column).isin(list(values))


def _keyword(column: str, keyword: str | None) -> Column:
    return F.lit(True) if not keyword else F.lower(F.col(column)).contains(keyword.lower())


def is_active(status: str = "status") -> Column:
    return F.lower(F.col(status)) == ACTIVE


def current(meas: DataFrame) -> DataFrame:
    """The newest row of every uuid: a later row with another status replaces an active one."""
    newest = Window.partitionBy("uuid").orderBy(F.col("updated_at").desc_nulls_last(), is_active().asc())
    return meas.withColumn("__rn", F.row_number().over(newest)).filter("__rn = 1").drop("__rn")


def measurements(meas: DataFrame, since=None, collector: str | None = None) -> DataFrame:
    """Active measurements, one per name: the one updated last, then the highest uuid.

    ``since`` keeps measurements updated at or after that time, ``collector`` those of one
    collector. The result replaces any earlier snapshot, so deleted names disappear.
    """
    kept = current(meas).filter(is_active())
    if since is not None:
        kept = kept.filter(F.col("updated_at") >= F.lit(since))
    if collector is not None:
        kept = kept.filter(F.col("collector_uuid") == collector)
    newest = Window.partitionBy("name").orderBy(F.col("updated_at").desc_nulls_last(), F.col("uuid").desc())
    return kept.withColumn("__rn", F.row_number().over(newest)).filter("__rn = 1").drop("__rn")


def registry_summary(meas: DataFrame) -> DataFrame:
    """Rows, active rows and distinct active names of a registry scan."""
    return meas.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_active()).alias("active"),
        F.count_distinct(F.when(is_active(), F.col("name"))).alias("cached"),
    )


def registry_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(uuid, name, change) with change ``added``, ``removed`` or ``unchanged``."""
    old = before.select("uuid", F.col("name").alias("__old"))
    new = after.select("uuid", F.col("name").alias("__new"))
    return old.join(new, "uuid", "full").select(
        "uuid",
        F.coalesce("__new", "__old").alias("name"),
        F.when(F.col("__old").isNull(), "added")
        .when(F.col("__new").isNull(), "removed")
        .otherwise("unchanged")
        .alias("change"),
    )


def infer_datatype(points: DataFrame, key: str = "series_name") -> DataFrame:
    """Datatype of each series from its first non-null value, with the first instant.

    Series that hold no typed value are absent. The aggregate keeps numbers only, so it
    combines on the map side and shuffles one row per series and task.
    """
    code = (
        F.when(F.col("__type") == BOOLEAN, 0).when(F.col("__type") == NUMBER, 1).when(F.col("__type") == STRING, 2)
    )
    names = F.array(F.lit(BOOLEAN), F.lit(NUMBER), F.lit(STRING))
    return (
        points.withColumn("__type", datatype_of())
        .filter(F.col("__type").isNotNull())
        .groupBy(key)
        .agg(F.min_by(code, arrival_order()).alias("__code"), F.min("ts_ms").alias("first_ms"))
        .select(key, F.get(names, F.col("__code")).alias("datatype"), "first_ms")
    )


def onboard(points: DataFrame, meas: DataFrame, meta: DataFrame | None = None) -> DataFrame:
    """Registry rows for series that the active registry does not know yet.

    The datatype comes from the first non-null value. Pending metadata of the name is applied:
    ``description`` becomes the description, all else the attributes. The id is derived from
    the name, so running twice creates nothing twice. A series that had been deleted gets its id
    back with a later update than the deletion, so the new row is the one that counts.
    """
    return created_series(met_series(infer_datatype(points), meas), meta)


def met_series(inferred: DataFrame, meas: DataFrame) -> DataFrame:
    """The series of ``infer_datatype`` with what the registry knows of each: ``known`` (whether it is active), ``uuid``
    and ``known_type``, ``gone`` (last update of any version). The registry comes to the series' own shuffle."""
    known = measurements(meas).select(
        F.col("name").alias("series_name"), "uuid", F.col("datatype").alias("known_type"), F.lit(True).alias("known")
    )
    gone = meas.groupBy(F.col("name").alias("series_name")).agg(F.max("updated_at").alias("gone"))
    met = inferred.filter(F.col("series_name") != "")
    return met.join(known, "series_name", "left").join(gone, "series_name", "left")


def created_series(met: DataFrame, meta: DataFrame | None = None) -> DataFrame:
    """Registry rows of the series of ``met_series`` that are not active."""
    fresh = met.filter("known IS NULL").select("series_name", "datatype", "first_ms", F.col("gone").alias("__gone"))
    text_map = "map<string,string>"
    if meta is not None:
        pending = meta.select(F.col("tag_path").alias("series_name"), F.col("properties").alias("__meta"))
        fresh = fresh.join(pending, "series_name", "left")
    else:
        fresh = fresh.withColumn("__meta", F.lit(None).cast(text_map))
    rest = F.map_filter("__meta", lambda k, v: k != "description")
    first = F.timestamp_millis("first_ms")
    return fresh.select(
        name_uuid("series_name").alias("uuid"),
        F.col("series_name").alias("name"),
        F.lit("Active").alias("status"),
        "datatype",
        first.alias("created_at"),
        F.greatest(first, F.col("__gone") + F.expr("INTERVAL 1 MICROSECOND")).alias("updated_at"),
        F.try_element_at("__meta", F.lit("description")).alias("description"),
        F.when(F.size(rest) > 0, rest).alias("attributes"),
    )


def evict(meas: DataFrame, rejected: DataFrame) -> DataFrame:
    """Registry without the rejected uuids; their series count as new on the next store."""
    return meas.join(rejected.select("uuid").distinct(), "uuid", "left_anti")


def retired(meas: DataFrame, rejected: DataFrame, status: str = EVICTED) -> DataFrame:
    """New versions, with another status, of the active series of the rejected uuids.

    Each is a moment newer than the version it replaces, so it counts wherever both are read.
    """
    active = current(meas).filter(is_active()).join(rejected.select("uuid").distinct(), "uuid", "left_semi")
    later = F.col("updated_at") + F.expr("INTERVAL 1 MICROSECOND")
    since = F.coalesce(later, F.timestamp_millis(F.lit(0)))
    return active.select(meas.columns).withColumns({"status": F.lit(status), "updated_at": since})


def extend_registry(meas: DataFrame, created: DataFrame) -> DataFrame:
    """Registry with the newly created rows appended."""
    return meas.unionByName(created, allowMissingColumns=True)


def namespace(meas: DataFrame, assets: DataFrame) -> DataFrame:
    """(name, uuid, kind, datatype, created_at) of all names; a measurement hides an asset."""
    shown = ["name", "uuid", "datatype", "created_at", "updated_at"]
    both = (
        current(meas)
        .filter(is_active())
        .select(*shown, F.lit("measurement").alias("kind"))
        .unionByName(assets.withColumn("datatype", F.lit(NUMBER)).select(*shown, F.lit("asset").alias("kind")))
    )
    first = Window.partitionBy("name").orderBy(
        F.col("kind").desc(), F.col("updated_at").desc_nulls_last(), F.col("uuid").desc()
    )
    return both.withColumn("__rn", F.row_number().over(first)).filter("__rn = 1").drop("__rn", "updated_at")


def find_measurements(
    meas: DataFrame,
    keyword: str | None = None,
    quality: str | None = None,
    statuses: Iterable[str] | None = None,
    labels: Iterable[str] | None = None,
    databases: Iterable[str] | None = None,
    collectors: Iterable[str] | None = None,
    datatypes: Iterable[str] | None = None,
    asset: str | None = None,
    props: DataFrame | None = None,
    exclude_calculations: bool = False,
    include_dependencies: bool = False,
) -> DataFrame:
    """Measurements that pass every given filter.

    ``asset`` keeps measurements bound to that asset through ``props``;
    ``include_dependencies`` adds the measurements that a kept calculation reads.
    """
    kept = meas.filter(
        _keyword("name", keyword)
        & _any_of("status", statuses)
        & _any_of("database", databases)
        & _any_of("collector_uuid", collectors)
        & _any_of("datatype", datatypes)
    )
    if quality is not None:
        kept = kept.filter(F.col("quality") == quality)
    if labels:
        kept = kept.filter(F.arrays_overlap("labels", F.array(*[F.lit(x) for x in labels])))
    if asset is not None:
        if props is None:
            raise ValueError("an asset filter needs the asset properties")
        bound = props.filter(F.col("asset_uuid") == asset).select(F.col("measurement_uuid").alias("uuid"))
        kept = kept.join(bound, "uuid", "left_semi")
    inputs = kept.select(F.explode("depends_on").alias("name")) if include_dependencies else None
    if exclude_calculations:
        kept = kept.filter(~F.coalesce("is_calculation", F.lit(False)))
    if inputs is None:
        return kept
    read = meas.join(inputs, "name", "left_semi").select(meas.columns)
    return kept.select(meas.columns).unionByName(read.join(kept.select("uuid"), "uuid", "left_anti"))


def find_assets(
    assets: DataFrame,
    keyword: str | None = None,
    path: str | None = None,
    parents: Iterable[str] | DataFrame | None = None,
    uuids: Iterable[str] | None = None,
) -> DataFrame:
    """Assets by keyword in the name, path prefix, parent (a list or a DataFrame with ``uuid``) and uuid."""
    kept = assets.filter(_keyword("name", keyword) & _any_of("uuid", uuids))
    if isinstance(parents, DataFrame):
        kept = kept.join(parents.select(F.col("uuid").alias("parent_uuid")), "parent_uuid", "left_semi")
        kept = kept.select(assets.columns)
    else:
        kept = kept.filter(_any_of("parent_uuid", parents))
    return kept if not path else kept.filter(F.col("asset_path").startswith(path))


def find_properties(
    props: DataFrame,
    assets: DataFrame | None = None,
    asset_uuids: Iterable[str] | None = None,
    recursive: bool = False,
    keyword: str | None = None,
    datatypes: Iterable[str] | None = None,
    uuids: Iterable[str] | None = None,
) -> DataFrame:
    """Asset properties; ``recursive`` includes those of all assets below the given ones."""
    kept = props.filter(_keyword("name", keyword) & _any_of("datatype", datatypes) & _any_of("uuid", uuids))
    if not asset_uuids:
        return kept
    if not recursive:
        return kept.filter(_any_of("asset_uuid", asset_uuids))
    if assets is None:
        raise ValueError("a recursive search needs the assets")
    below = asset_closure(assets, list(asset_uuids)).select(F.col("uuid").alias("asset_uuid"))
    return kept.join(below, "asset_uuid", "left_semi").select(props.columns)


def find_collectors(
    collectors: DataFrame, keyword: str | None = None, statuses: Iterable[str] | None = None
) -> DataFrame:
    """Collectors by keyword in the description and by status."""
    return collectors.filter(_keyword("description", keyword) & _any_of("status", statuses))


def find_databases(databases: DataFrame, keyword: str | None = None) -> DataFrame:
    """Time-series databases by keyword in the name."""
    return databases.filter(_keyword("name", keyword))
