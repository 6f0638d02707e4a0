"""Continuous point ingest with onboarding, quarantine and replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from ..operators.registry import onboard
from ..operators.storage import assign_series, refused_path, write_refused, write_resolved
from ..operators.telemetry import append_telemetry
from ..schema import POINTS
from ..sources.tables import consume_metadata, metadata_reader, registry_reader, write_registry

# Micro-batch interval and quarantine replay interval.
BATCH_INTERVAL = "5 seconds"
REPLAY_INTERVAL = "30 seconds"

QUARANTINE = T.StructType(
    [*POINTS.fields, T.StructField("reason", T.StringType()), T.StructField("attempt", T.IntegerType())]
)


def _trigger(interval: str, once: bool) -> dict:
    return {"availableNow": True} if once else {"processingTime": interval}


def batch_name(df: DataFrame, name: str, batch_id: int) -> str:
    """Name of a micro-batch that no other writer of the table has: a query's id is kept in its
    checkpoint, so a retry has it again, while another stream or a new checkpoint has its own."""
    query = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise ValueError("a micro-batch needs a running query")
    return f"{name}-{query}-{batch_id:012d}"


def store_batch(
    df: DataFrame,
    batch: str,
    registry: str,
    path: str,
    quarantine: str | None = None,
    auto_onboard: bool = True,
    meta: DataFrame | None = None,
    grain: str = "day",
    metadata: str | None = None,
) -> None:
    """Store one micro-batch.

    Reads the registry anew, creates missing series, appends what can be stored and sets the
    rest aside with its reason (beside the table, unless ``quarantine`` says where). Null
    values are skipped, not kept. Every write replaces only this batch's own partitions, so a
    repeated batch changes nothing.
    """
    spark = df.sparkSession
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        known = registry_reader(spark, registry, skip_batch=batch)
        if auto_onboard:
            if metadata is not None:
                meta = metadata_reader(spark, metadata, skip_batch=batch)
            created = onboard(df, known, meta)
            write_registry(created, registry, batch)
            if metadata is not None:
                consume_metadata(spark, metadata, registry, batch)
            known = registry_reader(spark, registry)
        checked = assign_series(df, known)
        write_resolved(checked.filter(F.col("reason").isNull()), path, batch, grain)
        write_refused(checked, quarantine or refused_path(path), batch)
    finally:
        df.unpersist()


def stream_points(
    src: DataFrame,
    registry: str,
    path: str,
    checkpoint: str,
    name: str = "points",
    quarantine: str | None = None,
    auto_onboard: bool = True,
    interval: str = BATCH_INTERVAL,
    once: bool = False,
    metadata: str | None = None,
    grain: str = "day",
) -> StreamingQuery:
    """Append a stream of canonical points to the table at ``path``.

    The checkpoint keeps what is still to forward over an outage; delivery is at least once and
    each batch is idempotent. No watermark is set: late and back-filled points are stored like
    any other. ``once`` works off what is there and stops. ``metadata`` is a folder of pending
    property maps, read anew for every batch; the series a batch creates take theirs.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        store_batch(
            df, batch_name(df, name, batch_id), registry, path, quarantine, auto_onboard, grain=grain, metadata=metadata
        )

    return (
        src.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**_trigger(interval, once))
        .start()
    )


def quarantine_stream(spark: SparkSession, quarantine: str) -> DataFrame:
    """The held rows as a stream. Files whose rows were tried are removed: the folder holds what is
    still refused, not every try."""
    reader = spark.readStream.schema(QUARANTINE).option("cleanSource", "delete")
    return reader.parquet(quarantine).drop("reason")


def replay_quarantine(
    spark: SparkSession,
    quarantine: str,
    registry: str,
    path: str,
    checkpoint: str,
    name: str = "replay",
    auto_onboard: bool = False,
    interval: str = REPLAY_INTERVAL,
    once: bool = False,
) -> StreamingQuery:
    """Bring quarantined points back periodically.

    The quarantine folder is itself a stream source, whose checkpoint tells which rows were
    tried. What is still refused goes back into the folder with its attempt raised and is tried
    again at the next interval.
    """
    return stream_points(
        quarantine_stream(spark, quarantine),
        registry,
        path,
        checkpoint,
        name=name,
        quarantine=quarantine,
        auto_onboard=auto_onboard,
        interval=interval,
        once=once,
    )


def stream_telemetry(
    src: DataFrame,
    kind: str,
    path: str,
    checkpoint: str,
    interval: str = BATCH_INTERVAL,
    once: bool = False,
) -> StreamingQuery:
    """Append a stream of logs, statistics or health rows; each micro-batch is idempotent."""

    def write(df: DataFrame, batch_id: int) -> None:
        append_telemetry(df, kind, path, batch_name(df, kind, batch_id))

    return (
        src.writeStream.queryName(kind)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**_trigger(interval, once))
        .start()
    )
