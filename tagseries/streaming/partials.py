"""Sums that streams keep as tables: each micro-batch adds its part, readers merge the parts.

A batch summarizes its own rows, one row per group it touches, and writes them as ``added=<batch>``; a repeated batch
replaces its own. Nothing is held between batches, so no watermark has to bound a state and no late row is lost: it
changes just the groups it belongs to. Every ``FOLD`` batches the parts are merged into ``whole=<batch>``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.time import arrival_order, bucket_start, period_ms
from ..operators.aggregate import any_value
from ..operators.telemetry import metric_intervals
from ..sources.live import children, empty, exists, remove_folder

#: Batches after which the parts are merged.
FOLD = 20

WINDOW_FUNCTIONS = ("mean", "min", "max", "sum", "count", "last", "spread")


def _complete(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Batches whose folders of a kind are written in full."""
    found = [re.fullmatch(rf"{kind}=(\d+)", name) for name, _ in children(spark, path)]
    return sorted(int(m[1]) for m in found if m and exists(spark, f"{path}/{m[0]}/_SUCCESS"))


def parts(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """The newest whole and all parts added since, as they were before a batch."""
    inside = lambda i: before is None or i < before
    whole = [i for i in _complete(spark, path, "whole") if inside(i)][-1:]
    added = [i for i in _complete(spark, path, "added") if inside(i) and (not whole or i > whole[0])]
    folders = [f"{path}/whole={i}" for i in whole] + [f"{path}/added={i}" for i in added]
    return spark.read.schema(schema).parquet(*folders) if folders else empty(spark, schema)


def keep_parts(
    src: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    schema: str,
    summarize: Callable[[DataFrame, DataFrame], DataFrame],
    merge: Callable[[DataFrame], DataFrame],
    once: bool = False,
) -> StreamingQuery:
    """Keep ``summarize(batch, parts before)`` of every micro-batch; ``merge`` makes one row of a group's parts."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = summarize(batch, parts(spark, path, schema, batch_id))
        own.write.mode("overwrite").parquet(f"{path}/added={batch_id}")
        if (batch_id + 1) % FOLD == 0:
            merge(parts(spark, path, schema, batch_id + 1)).write.mode("overwrite").parquet(f"{path}/whole={batch_id}")
            # readers and a repeated batch may still use what the last merging took in, not what those before did
            for kind in ("added", "whole"):
                for i in _complete(spark, path, kind):
                    if i <= batch_id - 2 * FOLD:
                        remove_folder(spark, f"{path}/{kind}={i}")

    trigger = {"availableNow": True} if once else {"processingTime": "30 seconds"}
    return (
        src.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**trigger)
        .start()
    )


_WINDOWS = (
    "series_name string, ts_ms bigint, any_n bigint, n bigint, total double, low double, high double, "
    "last double, last_at decimal(38,0), late bigint, newest_ms bigint"
)


def _window_parts(pts: DataFrame, before: DataFrame, period: int, origin_ms: int, lateness_ms: int) -> DataFrame:
    seen = before.agg(F.max("newest_ms")).first()[0]
    behind = F.lit(False) if seen is None else F.col("ts_ms") < seen - lateness_ms
    at = F.when(F.col("value_num").isNotNull(), arrival_order())
    return pts.groupBy("series_name", bucket_start("ts_ms", period, origin_ms).alias("at")).agg(
        F.count_if(any_value(pts)).alias("any_n"),
        F.count("value_num").alias("n"),
        F.sum("value_num").alias("total"),
        F.min("value_num").alias("low"),
        F.max("value_num").alias("high"),
        F.max_by("value_num", at).alias("last"),
        F.max(at).alias("last_at"),
        F.count_if(behind).alias("late"),
        F.max("ts_ms").alias("newest_ms"),
    ).withColumnRenamed("at", "ts_ms").select([c.split()[0] for c in _WINDOWS.split(", ")])


def _merged_windows(rows: DataFrame) -> DataFrame:
    return rows.groupBy("series_name", "ts_ms").agg(
        F.sum("any_n").alias("any_n"),
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.max_by("last", "last_at").alias("last"),
        F.max("last_at").alias("last_at"),
        F.sum("late").alias("late"),
        F.max("newest_ms").alias("newest_ms"),
    )


def stream_windows(
    src: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    period: int | str,
    origin_ms: int = 0,
    lateness: int | str = "10m",
    once: bool = False,
) -> StreamingQuery:
    """Keep the tumbling windows of a point stream; late points correct the windows they belong to.

    A point is late if it lies more than ``lateness`` behind the newest point of earlier batches, where a watermark
    would drop it. Windows count their late points.
    """
    width, allowed = period_ms(period), period_ms(lateness)

    def summarize(batch: DataFrame, before: DataFrame) -> DataFrame:
        return _window_parts(batch, before, width, origin_ms, allowed)

    return keep_parts(src, path, checkpoint, name, _WINDOWS, summarize, _merged_windows, once)


def read_windows(spark: SparkSession, path: str, functions: Sequence[str]) -> DataFrame:
    """(series_name, ts_ms, functions, late) of the windows as they are now."""
    unknown = set(functions) - set(WINDOW_FUNCTIONS)
    if unknown:
        raise ValueError(f"windows keep no {sorted(unknown)[0]}")
    values = {
        "mean": F.col("total") / F.col("n"),
        "min": F.col("low"),
        "max": F.col("high"),
        "sum": F.col("total"),
        "count": F.col("any_n").cast("double"),
        "last": F.col("last"),
        "spread": F.col("high") - F.col("low"),
    }
    merged = _merged_windows(parts(spark, path, _WINDOWS))
    mean = F.when(F.col("n") > 0, values["mean"])
    return merged.select(
        "series_name", "ts_ms", *[(mean if f == "mean" else values[f]).alias(f) for f in functions], "late"
    )


_METRICS = (
    "ts_ms bigint, store_ops bigint, store_points bigint, store_ms bigint, errors bigint, raw_ops bigint, "
    "raw_rows bigint, raw_ms bigint, agg_ops bigint, agg_rows bigint, agg_ms bigint"
)


def _merged_metrics(rows: DataFrame) -> DataFrame:
    sums = [c.split()[0] for c in _METRICS.split(", ")[1:]]
    return rows.groupBy("ts_ms").agg(*[F.sum(c).alias(c) for c in sums])


def stream_metrics(
    op_log: DataFrame, path: str, checkpoint: str, name: str, every: int | str = "30s", once: bool = False
) -> StreamingQuery:
    """Keep the operation sums of every interval; a batch writes just the intervals it touches."""
    return keep_parts(
        op_log, path, checkpoint, name, _METRICS, lambda batch, _: metric_intervals(batch, every), _merged_metrics, once
    )


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The interval sums as they are now; ``metric_report`` turns them into lines."""
    return _merged_metrics(parts(spark, path, _METRICS))
