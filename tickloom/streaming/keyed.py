"""A keyed table that a stream in update mode feeds: every micro-batch is a partition of its own.

A batch's rows replace what an earlier attempt at the same batch left, so a restart writes nothing twice. The row of a
key that counts is that of its newest batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

BATCH = "batch"


def write_batch(rows: DataFrame, batch_id: int, path: str, by: tuple[str, ...] = (), fmt: str = "parquet") -> None:
    """Write or replace one batch's part of ``path``, partitioned by ``by`` and the batch.

    The rebalance leaves few files in each partition, and splits the large ones.
    """
    numbered = rows.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    (
        (numbered.hint("rebalance", *by) if by else numbered)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by, BATCH)
        .format(fmt)
        .save(path)
    )


def keyed_sink(updates: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Writer of a stream's updated rows; aggregates emit a window whenever it changes, the open ones included."""
    return updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(lambda rows, number: write_batch(rows, number, path))


def newest(spark: SparkSession, path: str, schema, keys: tuple[str, ...]) -> DataFrame:
    """The last written row of each key."""
    stored = spark.read.schema(schema.add(BATCH, "long") if BATCH not in schema.names else schema).parquet(path)
    columns = [name for name in stored.columns if name != BATCH]
    return stored.groupBy(*keys).agg(F.max_by(F.struct(*columns), BATCH).alias("_row")).select("_row.*")


def compact(spark: SparkSession, path: str, schema, keys: tuple[str, ...], out: str) -> None:
    """The newest rows as one batch of another table, which a stopped stream's table can be replaced by."""
    write_batch(newest(spark, path, schema, keys).hint("rebalance"), 0, out)
