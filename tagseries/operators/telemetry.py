"""Operation metrics, collector statistics and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import bucket_start, period_ms
from ..schema import HEALTH, LOG_LEVELS, LOGS, STATISTICS
from ..session import checkpointed
from .ordered import running_totals, with_neighbours

TELEMETRY = {"logs": LOGS, "statistics": STATISTICS, "health": HEALTH}


def metric_intervals(op_log: DataFrame, every: int | str = "30s") -> DataFrame:
    """Sums of one interval: operations, rows and milliseconds per kind, and errors.

    A failed store counts as an error only, not as an operation.
    """
    at = bucket_start("ts_ms", period_ms(every))
    store = (F.col("op") == "store") & ~F.col("is_error")
    raw, agg = F.col("op") == "raw", F.col("op") == "agg"

    def total(cond, amount):
        return F.sum(F.when(cond, amount).otherwise(F.lit(0))).cast("bigint")

    one = F.lit(1)
    return op_log.groupBy(at.alias("ts_ms")).agg(
        total(store, one).alias("store_ops"),
        total(store, F.col("row_count")).alias("store_points"),
        total(store, F.col("elapsed_ms")).alias("store_ms"),
        total((F.col("op") == "store") & F.col("is_error"), one).alias("errors"),
        total(raw, one).alias("raw_ops"),
        total(raw, F.col("row_count")).alias("raw_rows"),
        total(raw, F.col("elapsed_ms")).alias("raw_ms"),
        total(agg, one).alias("agg_ops"),
        total(agg, F.col("row_count")).alias("agg_rows"),
        total(agg, F.col("elapsed_ms")).alias("agg_ms"),
    )


def metric_report(intervals: DataFrame, every: int | str = "30s") -> DataFrame:
    """Summary lines from interval sums: store operations and points of the interval with the
    rate per second since the line before, all else counted from the start."""
    cumulative = ["store_ms", "errors", "raw_ops", "raw_rows", "raw_ms", "agg_ops", "agg_rows", "agg_ms"]
    totals = running_totals(intervals, {f"total_{c}": c for c in cumulative})
    linked = with_neighbours(totals, ["ts_ms"], keys=(), chunk_ms=24 * 3_600_000, previous="__line")
    since = F.coalesce(F.col("ts_ms") - F.col("__line.ts_ms"), F.lit(period_ms(every)))
    return linked.select(
        "ts_ms",
        "store_ops",
        "store_points",
        (F.col("store_points") * 1000.0 / since).alias("points_per_second"),
        *[F.col(f"total_{c}").cast("bigint").alias(c) for c in cumulative],
    )


def op_metrics(op_log: DataFrame, every: int | str = "30s") -> DataFrame:
    """Metric summary per interval that saw any operation.

    The interval sums, one row per interval however busy the log, are checkpointed: the report
    reads them several times and the log only once.
    """
    return metric_report(checkpointed(metric_intervals(op_log, every)), every)


def collector_stats(stats: DataFrame, logs: DataFrame, every: int | str = "1h") -> DataFrame:
    """Per collector and interval: points sent / good / bad in the interval (differences of the
    running counters; a counter that falls restarted from zero), last buffer gauges, and log
    entries per level."""
    counters = ["points_sent", "good_points", "bad_points", "buffer_disk_flushes"]
    linked = with_neighbours(stats, counters, keys=["collector_uuid"], previous="__p", seq="points_sent")
    for c in counters:
        before = F.col(f"__p.{c}")
        step = F.when(before.isNull() | (F.col(c) < before), F.col(c)).otherwise(F.col(c) - before)
        linked = linked.withColumn(f"d_{c}", step)
    at = bucket_start("ts_ms", period_ms(every)).alias("bucket_ms")
    per_interval = linked.groupBy("collector_uuid", at).agg(
        *[F.sum(f"d_{c}").cast("bigint").alias(c) for c in counters],
        F.max_by("buffer_size", "ts_ms").alias("buffer_size"),
        F.max_by("buffer_error_files", "ts_ms").alias("buffer_error_files"),
    )
    levels = logs.groupBy("collector_uuid", at).agg(
        *[F.count_if(F.col("level") == level).alias(f"log_{level.lower()}") for level in LOG_LEVELS]
    )
    out = per_interval.join(levels, ["collector_uuid", "bucket_ms"], "full")
    return out.fillna(0, subset=[f"log_{level.lower()}" for level in LOG_LEVELS]).withColumnRenamed(
        "bucket_ms", "ts_ms"
    )


def refused_telemetry_path(path: str) -> str:
    """Where a telemetry table keeps the rows it refused."""
    return f"{path.rstrip('/')}-refused"


def append_telemetry(df: DataFrame, kind: str, path: str, batch: str) -> None:
    """Append logs, statistics or health rows under ``day=.../batch=.../``; a repeated batch
    replaces itself. Log entries of a level outside the contract are set aside, with the rest of the
    batch stored: they lie beside the table. Rows of one instant may be cut over several files."""
    if kind not in TELEMETRY:
        raise ValueError(f"unknown telemetry kind: {kind}")
    names = [f.name for f in TELEMETRY[kind].fields]
    out = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TELEMETRY[kind].fields])
    if kind == "logs":
        known = F.coalesce(F.col("level").isin(LOG_LEVELS), F.lit(False))
        _append(out.filter(~known), refused_telemetry_path(path), batch, names)
        out = out.filter(known)
    _append(out, path, batch, names)


def _append(out: DataFrame, path: str, batch: str, names: list[str]) -> None:
    (
        out.withColumn("day", F.timestamp_millis("ts_ms").cast("date"))
        .withColumn("batch", F.lit(batch))
        .repartitionByRange("day", "ts_ms", "collector_uuid", F.xxhash64(*names))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day", "batch")
        .parquet(path)
    )
