"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator relies on; all others are the cluster's business.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests, the bench and small command-line runs."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tickloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Recording a Python call site for every column expression costs milliseconds each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@functools.cache
def _machine_folder() -> tempfile.TemporaryDirectory:
    """For local runs alone; it goes when the process ends."""
    return tempfile.TemporaryDirectory(prefix="tickloom-", ignore_cleanup_errors=True)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine; on a cluster the
    executors could not see it, so a missing setting is an error there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _machine_folder().name


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a small derived table once and read it back, so later branches rescan it cheaply."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
