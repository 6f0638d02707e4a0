"""Point storage: checks, layout and batch append."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import name_uuid
from ..functions.paths import stored_path
from ..functions.time import check_range, part_bounds
from ..functions.values import GOOD_CODE, datatype_of, has_value, quality_to_status
from ..schema import POINTS
from ..session import written, shared_dir
from ..sources import live
from .ordered import last_writes
from .raw import first_from, latest
from .registry import measurements

#: Columns of the files of a point table.
STORED = T.StructType([*POINTS.fields, T.StructField("written", T.LongType())])

# Reasons why a point is not stored.
NULL_VALUE = "null value"
NO_SERIES = "no series"
NO_TIMESTAMP = "no timestamp"
WRONG_TYPE = "datatype mismatch"


def conform(df: DataFrame, *more: Column) -> DataFrame:
    """Canonical point columns and ``more``; missing ones are added as NULL."""
    out = []
    for field in POINTS.fields:
        c = F.col(field.name) if field.name in df.columns else F.lit(None)
        out.append(c.cast(field.dataType).alias(field.name))
    return df.select(*out, *more)


def path_names(df: DataFrame, collector: str) -> DataFrame:
    """(qpath, series_name) of the distinct paths in ``df``, as a table in the shared folder.

    Points are many and paths are few: the path grammar runs once per path instead of once per
    point and pass. As a table its size is known, so Spark broadcasts it only if it is small.
    """
    folder = shared_dir(df.sparkSession)
    names = df.select("qpath").distinct().withColumn("series_name", stored_path("qpath", collector))
    names.write.parquet(folder)
    return df.sparkSession.read.schema("qpath string, series_name string").parquet(folder)


def named_points(df: DataFrame, collector: str, names: DataFrame | None = None) -> DataFrame:
    """Incoming (qpath, ...) points with series name, default quality 192 and status.

    ``names`` (see ``path_names``) saves the path grammar per point. The name is never NULL; a
    missing path gets the empty name, which no series has.
    """
    code = F.coalesce("quality_code", F.lit(GOOD_CODE)) if "quality_code" in df.columns else F.lit(GOOD_CODE)
    if names is None:
        named = df.withColumn("series_name", stored_path("qpath", collector))
    else:
        named = df.drop("series_name").join(names, "qpath", "left")
    return (
        named.withColumn("series_name", F.coalesce("series_name", F.lit("")))
        .withColumn("quality_code", code.cast("int"))
        .withColumn("status", quality_to_status("quality_code"))
    )


def rejection(datatype: Column | None = None) -> Column:
    """Why a point with a resolved ``measurement_uuid`` cannot be stored, NULL if it can."""
    reason = F.when(~has_value(), NULL_VALUE).when(F.col("ts_ms").isNull(), NO_TIMESTAMP)
    reason = reason.when(F.col("measurement_uuid").isNull(), NO_SERIES)
    if datatype is not None:
        reason = reason.when(datatype_of() != datatype, WRONG_TYPE)
    return reason


def assign_series(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Points with ``measurement_uuid`` of their series and the ``reason`` against storing."""
    known = measurements(registry).select(
        F.col("name").alias("series_name"), F.col("uuid").alias("measurement_uuid"), F.col("datatype").alias("__type")
    )
    joined = df.drop("measurement_uuid").join(known, "series_name", "left")
    return joined.withColumn("reason", rejection(F.col("__type"))).drop("__type")


def storable(df: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(points to store, skipped points with ``reason``)."""
    checked = assign_series(df, registry)
    return checked.filter(F.col("reason").isNull()).drop("reason"), checked.filter(F.col("reason").isNotNull())


def skipped_counts(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Points per outcome (``stored`` or the reason for skipping)."""
    outcome = F.coalesce("reason", F.lit("stored")).alias("outcome")
    return assign_series(df, registry).groupBy(outcome).agg(F.count(F.lit(1)).alias("points"))


# Partition grains; a day suits a busy plant, a coarser grain long sparse histories.
GRAINS = ("day", "month", "year")


def _part(ts_ms: Column, grain: str) -> Column:
    if grain not in GRAINS:
        raise ValueError(f"unknown partition grain: {grain}")
    return F.date_trunc(grain, F.timestamp_millis(ts_ms)).cast("date")


def lay_out(df: DataFrame, grain: str = "day") -> DataFrame:
    """Rows range-partitioned and sorted by (part, series, time).

    Each task writes a contiguous piece of few parts, a hot series or day is split by time, and
    row-group statistics on ``measurement_uuid`` and ``ts_ms`` let reads skip; copies of one
    instant are cut by arrival.
    """
    order = ["part", "measurement_uuid", "ts_ms", "seq"]
    dated = df.withColumn("part", _part(F.col("ts_ms"), grain))
    return dated.repartitionByRange(*order).sortWithinPartitions(*order)


def refused_path(path: str) -> str:
    """Where a point table keeps what it refused, unless another folder is given."""
    return f"{path.rstrip('/')}-refused"


def write_refused(checked: DataFrame, path: str, batch: str) -> None:
    """Keep refused points with their reason and the number of tries, as one batch.

    Null values carry nothing to store and are skipped.
    """
    attempt = F.col("attempt") + 1 if "attempt" in checked.columns else F.lit(1)
    refused = checked.filter(F.col("reason").isNotNull() & (F.col("reason") != NULL_VALUE))
    (
        conform(refused, F.col("reason"), attempt.cast("int").alias("attempt"))
        .withColumn("batch", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(path)
    )


def write_points(
    df: DataFrame,
    registry: DataFrame,
    path: str,
    batch: str,
    grain: str = "day",
    refused: str | None = None,
    every_write: bool = False,
) -> None:
    """Append the storable points of ``df`` as one batch, and those refused with their reason to
    ``refused`` (by default a folder beside the table).

    Only this batch is replaced, so a repeated batch leaves both as if it had run once.
    """
    checked = assign_series(df, registry)
    write_resolved(checked.filter(F.col("reason").isNull()), path, batch, grain, every_write)
    write_refused(checked, refused or refused_path(path), batch)


def write_requested(df: DataFrame, known: DataFrame, path: str, batch: str, grain: str, every_write: bool) -> None:
    """``write_points`` for ``named_points`` whose values have one datatype and whose series are all in the registry:
    those in ``known`` (series_name, uuid, known_type) as it says, all others just created from these points.

    The id of a created series follows from its name and its datatype is that of its values, so the points meet only
    the known series among their own, however long the registry is, and an id is worked out behind the shuffles
    instead of travelling through them.
    """
    listed = known.select("series_name", F.col("uuid").alias("__uuid"), "known_type", F.lit(True).alias("__listed"))
    rows = _carried(df).join(listed, "series_name", "left")
    lost = F.when(F.col("__listed"), F.col("__uuid").isNull()).otherwise(F.col("series_name") == "")
    checked = rows.withColumn("reason", _refusal(lost)).drop("known_type")
    if every_write:  # cut by range, which reads its input twice
        checked = written(checked)
    new = F.when(F.col("__listed").isNull() & (F.col("series_name") != ""), name_uuid("series_name"))
    uuid = F.coalesce(F.when(F.col("__listed"), F.col("__uuid")), new)
    full = {"measurement_uuid": uuid, "status": quality_to_status("quality_code")}
    live.check_grain(live.entries(df.sparkSession, path), grain)
    stored = checked.filter(F.col("reason").isNull()).drop("reason", "attempt")
    if not every_write:
        stored = stored.withColumn("__hash", F.xxhash64("series_name"))  # names begin alike, which sorts slowly
        stored = last_writes(stored, ("__hash", "series_name", "ts_ms"), [c for c in ("seq", "place") if c in df.columns])
        stored = stored.drop("__hash")
    part = _part(F.col("ts_ms"), grain)
    laid = stored.drop("place").repartitionByRange(part, uuid, "ts_ms", "seq").withColumns({**full, "part": part})
    laid = conform(laid, F.col("part")).sortWithinPartitions("part", *INSTANT, "seq")
    live.write(laid, path, batch, grain)
    write_refused(checked.filter(F.col("reason").isNotNull()).withColumns(full), refused_path(path), batch)


def write_by_path(
    df: DataFrame, paths: DataFrame, path: str, batch: str, grain: str, every_write: bool, largest: int, some_refused: bool
) -> None:
    """``write_points`` for points with a ``qpath`` whose values have one datatype; ``paths`` (qpath, series_name, uuid,
    known_type) holds all of their paths and fits a broadcast table.

    No series has more points than ``largest``; if those fit one task, the shuffle that lays the points out also brings
    the writes of an instant together. ``some_refused`` is false if no point is refused.
    """
    listed = paths.withColumnRenamed("uuid", "measurement_uuid").withColumnRenamed("qpath", "__path")
    checked = _carried(df, "qpath").join(F.broadcast(listed), F.col("qpath").eqNullSafe(F.col("__path")), "left")
    checked = checked.withColumn("reason", _refusal(F.col("measurement_uuid").isNull())).drop("qpath", "__path", "known_type")
    stored = checked.filter(F.col("reason").isNull()).drop("reason", "attempt")
    by = [c for c in ("seq", "place") if c in df.columns]
    live.check_grain(live.entries(df.sparkSession, path), grain)
    order = ["part", *INSTANT, "seq"]
    if not every_write and largest > ONE_TASK:
        stored = last_writes(stored, INSTANT, by)
    laid = stored.withColumn("part", _part(F.col("ts_ms"), grain))
    if every_write or largest > ONE_TASK:
        laid = laid.drop("place").repartitionByRange(*order)
    else:
        order = order[:-1]  # as the window sorts
        laid = last_writes(laid.repartitionByRange(*order), order, by)
    laid = laid.withColumn("status", quality_to_status("quality_code"))
    live.write(conform(laid, F.col("part")).sortWithinPartitions(*order), path, batch, grain)
    refused = checked.filter(F.col("reason").isNotNull()).withColumn("status", quality_to_status("quality_code"))
    write_refused(refused if some_refused else refused.limit(0), refused_path(path), batch)


def _carried(df: DataFrame, *more: str) -> DataFrame:
    """The points with a value, in the columns from which the stored ones follow."""
    derived = ("measurement_uuid", "status", *(["series_name"] if more else []))
    kept = [c for c in df.columns if c in (*POINTS.names, "place", "attempt") and c not in derived]
    return df.filter(has_value()).select(*kept, *more)


def _refusal(lost: Column) -> Column:
    reason = F.when(F.col("ts_ms").isNull(), NO_TIMESTAMP).when(lost, NO_SERIES)
    return reason.when(datatype_of() != F.col("known_type"), WRONG_TYPE)


# What tells writes of one instant apart: the number of the write, then the arrival and the place in the request.
INSTANT = ("measurement_uuid", "ts_ms")
#: Points of one series that a task may meet at once.
ONE_TASK = 2_000_000


def write_resolved(
    df: DataFrame, path: str, batch: str, grain: str = "day", every_write: bool = False
) -> None:
    """Write points with their uuid as one batch that counts as a whole once it is complete.

    The batch keeps one value per instant, the one of highest ``seq`` and then of the last ``place`` in
    its request, if that column is there; ``every_write`` keeps all, for tables that serve as a log.
    """
    live.check_grain(live.entries(df.sparkSession, path), grain)
    if not every_write:
        df = last_writes(df, INSTANT, [c for c in ("seq", "place") if c in df.columns])
    live.write(lay_out(conform(df), grain), path, batch, grain)


def read_points(
    spark: SparkSession, path: str, start: int | None = None, end: int | None = None, every_write: bool = False
) -> DataFrame:
    """Stored points, one per series and instant: that of the last write, then of the highest ``seq``.

    The range prunes parts of any grain and is pushed into the files. Parts with one batch hold one value
    per instant already and are read as they are; only parts with several are merged, by one shuffle in
    which copies shrink on the map side. ``every_write`` returns all rows that were written.
    """
    check_range(start, end)
    return _read_live(spark, path, _entries(spark, path, start, end), start, end, every_write)


def _read_live(
    spark: SparkSession, path: str, found: list[live.Entry], start: int | None, end: int | None, every_write: bool = False
) -> DataFrame:
    def rows(folders: list) -> DataFrame:
        df = live.read(spark, path, STORED, folders).filter(part_bounds(start, end))
        if start is not None:
            df = df.filter(F.col("ts_ms") >= start)
        return df if end is None else df.filter(F.col("ts_ms") < end)

    if every_write:
        return rows(found).drop("written")
    alone, many = live.several(found)
    if not many:
        return rows(alone).drop("written")
    merged = last_writes(rows(many), ("part", *INSTANT), ("written", "seq"))
    return (rows(alone).unionByName(merged) if alone else merged).drop("written")


def _edge_stored(spark: SparkSession, path: str, at: int | None, last: bool, ids: DataFrame | None) -> DataFrame:
    """The last point of each series before an instant, or the first from it on.

    The spans written with each batch tell, per series, the one part that holds it; only the folders of these
    parts are read, and of them only the series that need them.
    """
    bounds = (None, at) if last else (at, None)
    found = _entries(spark, path, *bounds)
    spans = live.spans(spark, path, found)
    if ids is not None:
        spans = spans.join(ids.select("measurement_uuid").distinct(), "measurement_uuid", "left_semi")
    if at is not None:
        spans = spans.filter(F.col("first_ms") < at if last else F.col("last_ms") >= at)
    pick = F.max("part") if last else F.min("part")
    wanted = written(spans.groupBy("measurement_uuid").agg(pick.alias("part")))
    parts = {str(r["part"]) for r in wanted.select("part").distinct().collect()}
    pts = _read_live(spark, path, [e for e in found if e.part in parts], *bounds)
    pts = pts.join(wanted, ["measurement_uuid", "part"], "left_semi")
    keys = ("measurement_uuid",)
    return latest(pts, at, keys) if last else first_from(pts, at, keys)


def latest_stored(
    spark: SparkSession, path: str, before: int | None = None, ids: DataFrame | None = None
) -> DataFrame:
    """Last stored point of each series (of those with a ``measurement_uuid`` in ``ids``), optionally before an
    instant, without reading the history: see ``_edge_stored``."""
    return _edge_stored(spark, path, before, True, ids)


def bounds_stored(
    spark: SparkSession, path: str, start: int, end: int, ids: DataFrame | None = None
) -> DataFrame:
    """Stored points in a range with, per series, the last one before and the first one from its end.

    Column ``bound`` tells ``lower``, ``inside`` and ``upper`` apart. Only the range itself and one part per series
    and side are read.
    """
    inside = read_points(spark, path, start, end)
    if ids is not None:
        inside = inside.join(ids.select("measurement_uuid").distinct(), "measurement_uuid", "left_semi")
    out = inside.withColumn("bound", F.lit("inside"))
    for name, at, last in (("lower", start, True), ("upper", end, False)):
        edge = _edge_stored(spark, path, at, last, ids).withColumn("bound", F.lit(name))
        out = out.unionByName(edge.select(out.columns))
    return out


def compact_points(spark: SparkSession, path: str, before: str | None = None) -> list[str]:
    """Merge the batches of every part before a date (all parts, if none is given) into one folder per
    part with one value per instant; returns the parts. Readers see the old folders or the new one.

    A write that comes later, also one of an earlier batch repeated, is merged on reading as before.
    """

    def reduce(df: DataFrame) -> DataFrame:
        kept = last_writes(df, ("part", *INSTANT), ("written", "seq")).drop("batch")
        order = ["part", *INSTANT]
        return kept.repartitionByRange(*order).sortWithinPartitions(*order)

    return live.merge(spark, path, STORED, reduce, before)


def live_folders(spark: SparkSession, path: str) -> DataFrame:
    """(part, folders): how many folders hold the points of each part."""
    rows = [(e.part,) for e in live.entries(spark, path)]
    parts = spark.createDataFrame(rows, "part string").groupBy(F.col("part").cast("date").alias("part"))
    return parts.agg(F.count("*").cast("int").alias("folders"))


def _entries(spark: SparkSession, path: str, start: int | None, end: int | None) -> list[live.Entry]:
    """Live folders of the parts that may hold points of a range."""
    if start is None:
        return live.entries(spark, path, None, None if end is None else f"{_utc(end):%Y-%m-%d}")
    first = {g: f"{_utc(start):{form}}" for g, form in (("day", "%Y-%m-%d"), ("month", "%Y-%m-01"), ("year", "%Y-01-01"))}
    found = live.entries(spark, path, first["year"], None if end is None else f"{_utc(end):%Y-%m-%d}")
    return [e for e in found if e.part >= first[e.grain]]


def _utc(ms: int) -> datetime:
    return datetime(1970, 1, 1) + timedelta(milliseconds=ms)
