"""Message sources and sinks: keyed JSON, from a broker or from files.

The broker adapters only name options; they need the spark-sql-kafka module on the class
path. The file adapters give the same ``key, value`` rows and serve replays and tests.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom import fixed_values as fixed

MESSAGE = "key string, value string"


def subscribe(
    spark: SparkSession,
    servers: str,
    topics: list[str] | None = None,
    starting: str = "earliest",
    max_rows: int | None = None,
    min_rows: int | None = fixed.LANDING_ROWS,
    max_delay: str = fixed.LANDING_INTERVAL,
) -> DataFrame:
    """Stream ``key, value`` texts of several topics; offsets live in the query's checkpoint.

    A micro-batch starts once ``min_rows`` messages wait or ``max_delay`` has passed; run the query without a trigger
    interval then. ``max_rows`` bounds a micro-batch.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics or fixed.TOPICS))
        .option("startingOffsets", starting)
    )
    return texts(reader.options(**batch_bounds(max_rows, min_rows, max_delay)).load())


def batch_bounds(max_rows: int | None, min_rows: int | None, max_delay: str) -> dict[str, str]:
    """Options of the broker source for when a micro-batch starts and how large it may be."""
    least = {"minOffsetsPerTrigger": str(min_rows), "maxTriggerDelay": max_delay.replace(" seconds", "s")} if min_rows else {}
    return {**least, **({"maxOffsetsPerTrigger": str(max_rows)} if max_rows else {})}


def texts(messages: DataFrame) -> DataFrame:
    """Binary or text ``key`` and ``value`` as texts; other columns are kept."""
    return messages.withColumns({name: F.col(name).cast("string") for name in ("key", "value")})


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """A table of messages: JSON lines with ``key`` and ``value`` fields."""
    return spark.read.schema(MESSAGE).json(path)


def stream_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same files as a stream."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def union_topics(*topics: DataFrame) -> DataFrame:
    """Several topics as one; works on tables and on streams."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), topics)


def publish(messages: DataFrame, path: str) -> None:
    """Append ``key, value`` rows as JSON lines."""
    messages.select("key", "value").write.mode("append").json(path)
