"""Windowed aggregates and metrics on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.aggregates import function_expr
from ..functions.time import period_ms
from ..operators.aggregate import any_value


# Snapshots kept at a time: a reader may go on reading one while this many less one are written.
SLOTS = 8


def stream_aggregate(
    src: DataFrame,
    functions: Sequence[str],
    period: int | str,
    lateness: str = "10 minutes",
    origin_ms: int = 0,
    keys: Sequence[str] = ("series_name",),
    requests: DataFrame | None = None,
) -> DataFrame:
    """Tumbling aggregates per (keys, window) with a watermark on the event time.

    ``requests`` keeps the series it names; ``answer_requests`` then turns the windows into the
    rows each request asked for.
    """
    if requests is not None:
        src = src.join(requests.select("series_name"), "series_name", "left_semi")
    width = period_ms(period)
    timed = src.withColumn("event_time", F.timestamp_millis("ts_ms")).withWatermark("event_time", lateness)
    window = F.window("event_time", f"{width} milliseconds", startTime=f"{origin_ms % width} milliseconds")
    exprs = [
        (F.count_if(any_value(src)).cast("double") if f == "count" else function_expr(f)).alias(f) for f in functions
    ]
    return (
        timed.groupBy(*keys, window)
        .agg(*exprs)
        .select(*keys, F.unix_millis("window.start").alias("ts_ms"), *functions)
    )


def write_snapshots(df: DataFrame, path: str, checkpoint: str, name: str, once: bool = False) -> StreamingQuery:
    """Keep the current state of an aggregating stream as a table (complete mode).

    Each trigger writes a numbered snapshot into one of ``SLOTS`` folders in turn and then, beside the
    table, which number that folder holds. Readers take the newest number noted, so they never see a
    snapshot half written, and the space taken stays bounded.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        slot = batch_id % SLOTS
        batch.write.mode("overwrite").parquet(f"{path}/slot={slot}")
        note = batch.sparkSession.range(1).select(F.lit(batch_id).cast("bigint").alias("snapshot"))
        note.write.mode("overwrite").parquet(f"{_noted(path)}/slot={slot}")

    trigger = {"availableNow": True} if once else {"processingTime": "30 seconds"}
    return (
        df.writeStream.queryName(name)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**trigger)
        .start()
    )


def write_closed(df: DataFrame, path: str, checkpoint: str, name: str, once: bool = False) -> StreamingQuery:
    """Append windows once the watermark has closed them."""
    trigger = {"availableNow": True} if once else {"processingTime": "30 seconds"}
    return (
        df.writeStream.queryName(name)
        .outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**trigger)
        .start()
    )


def latest_snapshot(spark, path: str) -> DataFrame:
    """Newest snapshot that ``write_snapshots`` has written in full."""
    noted = spark.read.schema("snapshot bigint, slot int").parquet(_noted(path))
    return spark.read.parquet(f"{path}/slot={noted.agg(F.max('snapshot')).first()[0] % SLOTS}")


def _noted(path: str) -> str:
    return f"{path.rstrip('/')}-noted"

