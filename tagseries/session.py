"""Session settings the engine relies on, and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "tagseries", cpus: str | int = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TAGSERIES_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone: the model keeps UTC epoch milliseconds."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors reach.

    Only a local master may go without the setting; it then gets a temporary folder.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base is None:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="tagseries-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4()}"


def checkpointed(df):
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df):
    """The rows, written once to the shared folder and read back: their size is known, and a lost executor loses
    none of the work."""
    folder = shared_dir(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
