"""Registry and stream sources on Parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.metadata import merge_metadata
from ..operators.registry import EVICTED, current, retired
from ..schema import MEASUREMENTS, PENDING_METADATA
from . import live


_ROWS = StructType([*MEASUREMENTS.fields, StructField("written", LongType())])
#: A registry is one part of a table of batches.
_PART = "1970-01-01"


def registry_reader(
    spark: SparkSession, path: str, skip_batch: str | None = None, only_batch: str | None = None
) -> DataFrame:
    """Registry as it is now: every version of every series that is still listed. A DataFrame keeps the
    file list it was made with, so a running stream calls this again for every batch. ``skip_batch``
    leaves out the rows an earlier try of that batch created, which makes the retry see the same
    registry as the first try; ``only_batch`` returns just those."""
    df = live.read(spark, path, _ROWS, live.entries(spark, path))
    if skip_batch is not None:
        df = df.filter(F.col("batch") != skip_batch)
    if only_batch is not None:
        df = df.filter(F.col("batch") == only_batch)
    return df.drop("batch", "part", "written")


def write_registry(meas: DataFrame, path: str, batch: str) -> None:
    """Write versions of series as one batch, replacing an earlier try of the same batch."""
    out = []
    for field in MEASUREMENTS.fields:
        c = F.col(field.name) if field.name in meas.columns else F.lit(None)
        out.append(c.cast(field.dataType).alias(field.name))
    live.write(meas.select(*out, F.lit(_PART).cast("date").alias("part")), path, batch, "registry")


def retire_stored(spark: SparkSession, path: str, rejected: DataFrame, batch: str, status: str = EVICTED) -> None:
    """Store that the series of the given uuids are no longer known, for every reader and writer from now on.

    The versions before stay in the log; the next store of a point of such a series creates it anew.
    """
    write_registry(retired(registry_reader(spark, path, skip_batch=batch), rejected, status), path, batch)


def compact_registry(spark: SparkSession, path: str) -> None:
    """Put all batches of a registry into one that keeps the newest version of every uuid."""

    def newest(df: DataFrame) -> DataFrame:
        return current(df).drop("batch")

    live.merge(spark, path, _ROWS, newest)


def consumed_path(path: str) -> str:
    return f"{path.rstrip('/')}-consumed"


def write_metadata(df: DataFrame, path: str, batch: str) -> None:
    """Append pending property maps (tag_path, properties, seq) as one batch, in place of an earlier try."""
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in PENDING_METADATA.fields])
    rows.write.mode("overwrite").parquet(f"{path}/{live.folder_name(batch)}")


def metadata_reader(spark: SparkSession, path: str, skip_batch: str | None = None) -> DataFrame:
    """Property maps that wait for their series, one per path.

    A series takes what waits for it when it is created; only what comes later waits for it again. As with
    the registry, ``skip_batch`` makes a retry see what its first try saw.
    """
    rows = spark.read.schema(PENDING_METADATA).parquet(path)
    if live.exists(spark, consumed_path(path)):
        taken = spark.read.schema("tag_path string, seq bigint, batch string").parquet(consumed_path(path))
        if skip_batch is not None:
            taken = taken.filter(F.col("batch") != skip_batch)
        last = taken.groupBy("tag_path").agg(F.max("seq").alias("__taken"))
        rows = rows.join(last, "tag_path", "left").filter("__taken IS NULL OR seq > __taken").drop("__taken")
    return merge_metadata(rows)


def consume_metadata(spark: SparkSession, path: str, registry: str, batch: str) -> None:
    """Note that the series a batch created have taken what was waiting for them."""
    made = registry_reader(spark, registry, only_batch=batch).select(F.col("name").alias("tag_path"))
    waiting = metadata_reader(spark, path, skip_batch=batch).select("tag_path", "seq")
    taken = waiting.join(made, "tag_path", "left_semi")
    taken.write.mode("overwrite").parquet(f"{consumed_path(path)}/{live.folder_name(batch)}")


def point_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None, glob: str | None = None
) -> DataFrame:
    """Parquet folder as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)
