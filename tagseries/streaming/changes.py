"""Only-changes on a stream, with the last value of every series in a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from ..operators.ordered import CHUNK_MS, changed, last_writes, with_neighbours
from ..sources.live import empty, exists, remove_folder

VALUES = {"value_num": "double", "value_bool": "boolean", "value_str": "string"}
OUTPUT = (
    "series_name string, ts_ms bigint, value_num double, value_bool boolean, value_str string, seq bigint, late boolean"
)
STATE = "series_name string, ts_ms bigint, value_num double, value_bool boolean, value_str string, batch bigint"
#: Batches after which the last values are written anew as a whole.
FOLD = 20


def _folder(state: str, kind: str, batch_id: int) -> str:
    return f"{state.rstrip('/')}/{kind}={batch_id}"


def last_values(spark: SparkSession, state: str, before: int) -> DataFrame:
    """The last value of every series as it was before a batch: the newest whole table and what later batches added."""
    whole = before // FOLD * FOLD - 1
    folders = [_folder(state, "whole", whole)] if whole >= 0 else []
    folders += [_folder(state, "added", i) for i in range(whole + 1, before)]
    folders = [f for f in folders if exists(spark, f)]
    if not folders:
        return empty(spark, STATE)
    return last_writes(spark.read.schema(STATE).parquet(*folders), ["series_name"], ["batch"])


def changes_of_batch(rows: DataFrame, last: DataFrame, chunk_ms: int = CHUNK_MS) -> tuple[DataFrame, DataFrame]:
    """(changes of a batch of points, last value of each of its series), given the last values before it.

    An instant counts with its last write. A point is a change if its value differs from the one before in the batch,
    or for a series' first from the last value before the batch. Points older than that value pass as ``late``. Time
    cells split a series that holds the whole batch.
    """
    held = F.struct(*VALUES).alias("__held")
    known = last.select("series_name", F.col("ts_ms").alias("__last_ms"), held)
    late = F.coalesce(F.col("ts_ms") < F.col("__last_ms"), F.lit(False))
    marked = rows.join(known, "series_name", "left").withColumn("late", late)
    fresh = marked.filter("NOT late").drop("late", "__last_ms", "__held")
    linked = with_neighbours(fresh, list(VALUES), chunk_ms=chunk_ms, previous="__previous", seq="seq")
    linked = linked.join(known.drop("__last_ms"), "series_name", "left")
    before = F.coalesce("__previous", "__held")
    differs = before.isNull()
    for v in VALUES:
        differs = differs | changed(F.col(v), before[v])
    kept = linked.filter(differs).withColumn("late", F.lit(False)).select(*_columns(OUTPUT))
    newest = last_writes(fresh, ["series_name"], ["ts_ms", "seq"])
    return kept.unionByName(marked.filter("late").select(*_columns(OUTPUT))), newest


def _columns(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def stream_only_changes(
    src: DataFrame, path: str, checkpoint: str, name: str, once: bool = False, chunk_ms: int = CHUNK_MS
) -> StreamingQuery:
    """Write the changes of a point stream, for values of any type, as ``batch=<number>`` folders of ``path``.

    The last values lie beside the checkpoint, a folder per batch: a repeated batch reads those before it and replaces
    its own, so it writes the same again. Every ``FOLD`` batches they are written as a whole and older ones go.
    """
    state = f"{checkpoint.rstrip('/')}-last"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        typed = batch.withColumns({c: F.lit(None).cast(t) for c, t in VALUES.items() if c not in batch.columns})
        rows = typed.select("series_name", "ts_ms", *VALUES, "seq").persist(StorageLevel.MEMORY_AND_DISK)
        try:
            last = last_values(spark, state, batch_id)
            out, newest = changes_of_batch(rows, last, chunk_ms)
            out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
            added = newest.withColumn("batch", F.lit(batch_id).cast("bigint")).select(*_columns(STATE))
            added.write.mode("overwrite").parquet(_folder(state, "added", batch_id))
        finally:
            rows.unpersist()
        if (batch_id + 1) % FOLD == 0:
            own = spark.read.schema(STATE).parquet(_folder(state, "added", batch_id))
            whole = last_writes(last.unionByName(own), ["series_name"], ["batch"])
            whole.write.mode("overwrite").parquet(_folder(state, "whole", batch_id))
            # the generation before the last stays unread, also by a repeated batch
            remove_folder(spark, _folder(state, "whole", batch_id - 2 * FOLD))
            for i in range(batch_id - 3 * FOLD + 1, batch_id - 2 * FOLD + 1):
                remove_folder(spark, _folder(state, "added", i))

    trigger = {"availableNow": True} if once else {"processingTime": "30 seconds"}
    return (
        src.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**trigger)
        .start()
    )


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """What ``stream_only_changes`` wrote."""
    return spark.read.schema(f"{OUTPUT}, batch bigint").parquet(path).drop("batch")
