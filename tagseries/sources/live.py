"""Tables of batches: which folders count, in which order they were written, and their merging.

A batch lies in ``batch=<name>/part=<date>/`` below the table. It counts once a note says so, a small file beside the
table with its parts, the number of its write and the table's grain; a batch without one, still being written or left
by a failed job, is not seen. Merging puts several batches of a part into one and writes a manifest, a list of all that
counts from then on with the notes it took in. A manifest appears by renaming one folder, so a reader sees the old list
or the new one. Readers use the newest manifest and the notes that it has not taken in: they list no data folders but
those they read. Replaced folders stay for readers that planned before, until ``remove_replaced``.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

_NOTE = "part string, written bigint, grain string, batch string"
_MANIFEST = "part string, batch string, written bigint, grain string, taken boolean"
HOUR_MS = 3_600_000


@dataclass(frozen=True)
class Entry:
    """One live folder: a part of a batch and the number of its write."""

    part: str
    batch: str
    written: int
    grain: str


def notes_path(path: str) -> str:
    return f"{path.rstrip('/')}-writes"


def manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}-manifest"


def folder_name(batch: str) -> str:
    """Folder of a batch; characters that paths treat specially are escaped as in partition names."""
    return f"batch={_escaped(batch)}"


def _escaped(batch: str) -> str:
    return "".join(c if c.isalnum() or c in "._-" or ord(c) > 0x7F else f"%{ord(c):02X}" for c in batch)


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the table's own, if it is there."""
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, time of change) of what lies in a folder; nothing if there is none."""
    fs, where = _fs(spark, path)
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(where)] if fs.exists(where) else []


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder its name in one step; fails if the name is taken."""
    jvm = spark._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    _, a = _fs(spark, source)
    _, b = _fs(spark, target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(a, b, spark.sparkContext._gateway.new_array(kind, 0))


def empty(spark: SparkSession, schema: str | StructType) -> DataFrame:
    """No rows of a schema."""
    fields = schema.fields if isinstance(schema, StructType) else StructType.fromDDL(schema).fields
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def _version(spark: SparkSession, path: str) -> int:
    """Number of the newest manifest, 0 if there is none."""
    names = [re.fullmatch(r"version=(\d+)", n) for n, _ in children(spark, manifest_path(path))]
    return max((int(m[1]) for m in names if m), default=0)


def _manifest(spark: SparkSession, path: str, version: int) -> DataFrame:
    if not version:
        return empty(spark, _MANIFEST)
    return spark.read.schema(_MANIFEST).parquet(f"{manifest_path(path)}/version={version}")


def _notes(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, notes_path(path)):
        return empty(spark, _NOTE)
    return spark.read.schema(_NOTE).parquet(notes_path(path))


def _listed(spark: SparkSession, path: str, version: int, first: str | None = None, last: str | None = None) -> DataFrame:
    """Entries of parts in ``[first, last]`` (ISO dates) and the notes taken in, of one manifest and what came after."""
    both = _notes(spark, path).withColumn("taken", F.lit(False))
    if version:
        manifest = _manifest(spark, path, version)
        taken = manifest.filter("taken").select("batch")
        both = manifest.filter("NOT taken").unionByName(both.join(taken, "batch", "left_anti"))
    if first is not None:
        both = both.filter(F.col("part") >= first)
    return both if last is None else both.filter(F.col("part") <= last)


def entries(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> list[Entry]:
    """Live folders of the parts in a range: per closed part one, per open part one per batch."""
    rows = _listed(spark, path, _version(spark, path), first, last).select("part", "batch", "written", "grain").distinct()
    return sorted((Entry(*r) for r in rows.collect()), key=lambda e: (e.part, e.written, e.batch))


def read(spark: SparkSession, path: str, schema: StructType, live: Iterable[Entry]) -> DataFrame:
    """Rows of the given folders with their ``part`` and ``batch``."""
    full = StructType([*schema.fields, StructField("part", DateType()), StructField("batch", StringType())])
    folders = [f"{path}/{folder_name(e.batch)}/part={e.part}" for e in live]
    if not folders:
        return empty(spark, full)
    return spark.read.schema(full).option("basePath", path).parquet(*folders)


def written_number(spark: SparkSession, path: str, batch: str) -> int:
    """Number of a batch's write: that of its first try, else later than all before by the clock."""
    own = f"{notes_path(path)}/{folder_name(batch)}"
    if exists(spark, own):
        row = spark.read.schema("written bigint").parquet(own).agg(F.max("written")).first()
        if row[0] is not None:
            return row[0]
    return time.time_ns() // 1000


def write(df: DataFrame, path: str, batch: str, grain: str) -> None:
    """Write rows with their ``part`` as one batch, in place of an earlier try of it, and note it.

    A batch that is repeated after it was merged is a write of its own.
    """
    spark = df.sparkSession
    if "written" in df.columns:
        raise ValueError("a batch gets its own number")
    version = _version(spark, path)
    if version and not _manifest(spark, path, version).filter(F.col("taken") & (F.col("batch") == batch)).isEmpty():
        batch = f"{batch}.again-{version}"
    number = written_number(spark, path, batch)
    _put(df.withColumn("written", F.lit(number).cast("bigint")), path, batch)
    parts = _parts(spark, path, batch)
    own = f"{notes_path(path)}/{folder_name(batch)}"
    if not parts:
        remove_folder(spark, own)
        remove_folder(spark, f"{path}/{folder_name(batch)}")
        return
    if exists(spark, own):
        noted = spark.read.schema("part string").parquet(own).collect()
        if sorted(r["part"] for r in noted) == parts:
            return
    rows = spark.createDataFrame([(p, number, grain) for p in parts], "part string, written bigint, grain string")
    rows.coalesce(1).write.mode("overwrite").parquet(own)


def _put(df: DataFrame, path: str, batch: str) -> None:
    folder = f"{path}/{folder_name(batch)}"
    df.write.mode("overwrite").partitionBy("part").parquet(folder)
    if {"measurement_uuid", "ts_ms"} <= set(df.columns):
        rows = df.sparkSession.read.schema("measurement_uuid string, ts_ms bigint, part date").parquet(folder)
        spans = rows.groupBy("part", "measurement_uuid").agg(
            F.min("ts_ms").alias("first_ms"), F.max("ts_ms").alias("last_ms"), F.count("*").alias("points")
        )
        spans.write.mode("overwrite").parquet(f"{spans_path(path)}/{folder_name(batch)}")


def spans_path(path: str) -> str:
    return f"{path.rstrip('/')}-spans"


def spans(spark: SparkSession, path: str, live: Iterable[Entry]) -> DataFrame:
    """(part, measurement_uuid, first_ms, last_ms, points, batch) of live folders: a row per series, part and batch,
    written with each batch from its own files."""
    live = list(live)
    schema = "part date, measurement_uuid string, first_ms bigint, last_ms bigint, points bigint, batch string"
    folders = sorted({f"{spans_path(path)}/{folder_name(e.batch)}" for e in live})
    if not folders:
        return empty(spark, schema)
    pairs = spark.createDataFrame([(e.part, e.batch) for e in live], "part string, batch string")
    pairs = pairs.select(F.col("part").cast("date").alias("part"), "batch")
    rows = spark.read.schema(schema).option("basePath", spans_path(path)).parquet(*folders)
    return rows.join(pairs, ["part", "batch"], "left_semi")


def _parts(spark: SparkSession, path: str, batch: str) -> list[str]:
    """Parts that a batch has files in."""
    files = spark.read.schema("ts_ms bigint").parquet(f"{path}/{folder_name(batch)}").inputFiles()
    return sorted({m[1] for m in (re.search(r"/part=([^/]+)/", f) for f in files) if m})


def check_grain(live: Iterable[Entry], grain: str) -> None:
    """A table has one grain: equal instants must lie in equal parts."""
    other = {e.grain for e in live} - {grain}
    if other:
        raise ValueError(f"the table is kept by {sorted(other)[0]}, not by {grain}")


def several(live: Iterable[Entry]) -> tuple[list[Entry], list[Entry]]:
    """(folders that are alone in their part, folders of parts with more than one)."""
    count: dict[str, int] = {}
    live = list(live)
    for e in live:
        count[e.part] = count.get(e.part, 0) + 1
    return [e for e in live if count[e.part] == 1], [e for e in live if count[e.part] > 1]


def merge(spark: SparkSession, path: str, schema: StructType, reduce, before: str | None = None) -> list[str]:
    """Bring every part before a date that has several folders into one; returns the parts.

    ``reduce`` turns the rows of all those folders into the rows to keep, with their ``part`` and ``written``. One job
    writes all parts as a batch of a new name, then one rename switches readers over. A job that fails before leaves
    a folder no one reads. Two merges at a time: the later one fails at the rename and changes nothing.
    """
    version = _version(spark, path)
    found = _listed(spark, path, version).select("part", "batch", "written", "grain").distinct().collect()
    live = [Entry(*r) for r in found]
    _, many = several(live)
    many = [e for e in many if before is None or e.part < before]
    if not many:
        return []
    name = f"merged-{version + 1:09d}-{uuid.uuid4().hex[:8]}"
    _put(reduce(read(spark, path, schema, many)), path, name)
    number: dict[str, int] = {}
    for e in many:
        number[e.part] = max(number.get(e.part, 0), e.written)
    done = _parts(spark, path, name)
    rows = [(e.part, e.batch, e.written, e.grain, False) for e in live if e not in set(many)]
    rows += [(p, name, number[p], many[0].grain, False) for p in done]
    # the notes counted here, and those of older manifests that still lie there
    noted = {n.removeprefix("batch=") for n, _ in children(spark, notes_path(path)) if n.startswith("batch=")}
    old = {_escaped(r["batch"]) for r in _manifest(spark, path, version).filter("taken").select("batch").collect()}
    used = {_escaped(e.batch): e.batch for e in live}
    taken = {used.get(n, n) for n in noted if n in used or n in old}
    rows += [(None, b, 0, None, True) for b in taken]
    fresh = f"{manifest_path(path)}/_new-{uuid.uuid4().hex}"
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(fresh)
    _rename(spark, fresh, f"{manifest_path(path)}/version={version + 1}")
    return done


def remove_replaced(spark: SparkSession, path: str, keep_ms: int = 24 * HOUR_MS) -> list[str]:
    """Delete folders that no list names any more and that have not changed for ``keep_ms``; returns them.

    ``keep_ms`` must be longer than any read or write takes: a batch being written has no note yet.
    """
    limit = time.time() * 1000 - keep_ms
    version = _version(spark, path)
    live = entries(spark, path)
    kept = {(folder_name(e.batch), f"part={e.part}") for e in live}
    gone = []
    for batch, changed in children(spark, path):
        if not batch.startswith("batch="):
            continue
        parts = [(p, t) for p, t in children(spark, f"{path}/{batch}") if p.startswith("part=")]
        if not any(b == batch for b, _ in kept):
            if max([changed, *(t for _, t in parts)]) <= limit:
                gone += [f"{path}/{batch}", f"{spans_path(path)}/{batch}"]
            continue
        gone += [f"{path}/{batch}/{p}" for p, t in parts if (batch, p) not in kept and t <= limit]
    for name, changed in children(spark, manifest_path(path)):
        if name != f"version={version}" and changed <= limit:
            gone.append(f"{manifest_path(path)}/{name}")
    for folder in gone:
        remove_folder(spark, folder)
    return gone
