"""Land messages: the rows of each event type into its own partitioned table, dead letters into JSON.

``land`` is one query that reads and parses every message once and writes both. ``tick_sink`` and ``dead_letter_sink`` are
two queries, each with its own checkpoint and its own reading of the source, so that either can fail and restart alone.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom import fixed_values as fixed
from tickloom.operators.extract import EXTRACTORS, Extractor, classify, dead_letters_of, decode, ticks_of
from tickloom.sources import avro
from tickloom.streaming.keyed import BATCH, write_batch

# What landed rows of one event repeat when a source delivers it again.
IDENTITY = ("symbol", "exchange", "time", "price", "volume")


def classified(messages: DataFrame, extractors: dict[str, Extractor] = EXTRACTORS) -> DataFrame:
    return classify(decode(messages, payload_fields=fixed.PAYLOAD_DOUBLES + fixed.PAYLOAD_BIGINTS), extractors)


def distinct_ticks(ticks: DataFrame, keys: tuple[str, ...] = IDENTITY, within: str = "10 minutes") -> DataFrame:
    """A stream of ticks without the repeats of at-least-once delivery that come within a time of the first one.

    State holds a key until the watermark, ``within`` behind the newest tick, has passed it; older ticks are dropped as late.
    """
    return ticks.withWatermark("time", within).dropDuplicatesWithinWatermark(list(keys))


def land(
    messages: DataFrame, path: str, letters_path: str, log_path: str, checkpoint: str, interval: str | None = fixed.LANDING_INTERVAL,
    fmt: str = "parquet", keep: tuple[str, ...] = (), extractors: dict[str, Extractor] = EXTRACTORS,
) -> DataStreamWriter:
    """Writer of ``path/<event type>`` (by asset class, UTC day and batch), the dead letters, and a log of each batch's counts.

    Every message is parsed once a micro-batch. All three sinks hold a batch in partitions of its own, which a repeated
    batch replaces, so a restart between the writes leaves each message once; the log's row comes last and says that the
    batch is whole.
    """

    def both(batch: DataFrame, number: int) -> None:
        parsed = classified(batch, extractors).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for event_type in extractors:
                rows = ticks_of(parsed, event_type, keep, extractors)
                if fmt == avro.FORMAT:
                    spread = rows.withColumn(BATCH, F.lit(str(number))).sortWithinPartitions("asset_class", "event_date")
                    avro.write(spread, f"{path}/{event_type}", ("asset_class", "event_date", BATCH), overwrite=True)
                else:
                    write_batch(rows, number, f"{path}/{event_type}", ("asset_class", "event_date"), fmt)
            write_batch(dead_letters_of(parsed, keep), number, letters_path, ("event_type",), "json")
            counts = parsed.groupBy("status", F.coalesce("event_type", F.lit("none")).alias("event_type")).agg(F.count(F.lit(1)).alias("rows"))
            write_batch(counts.coalesce(1), number, log_path, fmt="json")
        finally:
            parsed.unpersist()

    writer = messages.writeStream.queryName("landing").option("checkpointLocation", checkpoint).foreachBatch(both)
    return with_trigger(writer, interval)


def landed(spark: SparkSession, path: str, event_type: str = fixed.PRICE_SNAPSHOT, fmt: str = "parquet") -> DataFrame:
    """What ``land`` wrote of one event type."""
    table = avro.read(spark, f"{path}/{event_type}") if fmt == avro.FORMAT else spark.read.format(fmt).load(f"{path}/{event_type}")
    return table.drop(BATCH)


def landing_log(spark: SparkSession, log_path: str) -> DataFrame:
    """``status, event_type, rows, batch`` of every whole batch."""
    return spark.read.schema(f"status string, event_type string, rows bigint, {BATCH} bigint").json(log_path)


def with_trigger(writer: DataStreamWriter, interval: str | None = fixed.LANDING_INTERVAL) -> DataStreamWriter:
    """Run every ``interval``, or once over what is available when it is None."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def tick_sink(
    messages: DataFrame, path: str, checkpoint: str, interval: str | None = fixed.LANDING_INTERVAL,
    fmt: str = "parquet", keep: tuple[str, ...] = (),
) -> DataStreamWriter:
    """Writer of typed ticks, partitioned by asset class and the UTC day of the tick.

    Symbols stay a column: a directory per symbol would multiply small files.
    """
    ticks = ticks_of(classified(messages), keep=keep)
    writer = (
        ticks.writeStream.queryName("landing-ticks")
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("asset_class", "event_date")
    )
    return with_trigger(writer, interval)


def dead_letter_sink(
    messages: DataFrame, path: str, checkpoint: str, interval: str | None = fixed.LANDING_INTERVAL,
    keep: tuple[str, ...] = (),
) -> DataStreamWriter:
    """Writer of rejected messages with their reason, partitioned by event type."""
    letters = dead_letters_of(classified(messages), keep=keep)
    writer = (
        letters.writeStream.queryName("landing-dead-letters")
        .format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("event_type")
    )
    return with_trigger(writer, interval)
