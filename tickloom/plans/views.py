"""Market tables derived from the test tables: ticks, boards, messages, bars, fundamentals.

Every row of the source table is mapped; SQL twins of these views are in ``oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom import fixed_values as fixed
from tickloom.functions.coerce import asset_class_of_source, iso_text, once
from tickloom.operators.bars import day_filter
from tickloom.session import configure, materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def streamed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream, be it one file or a folder of files.

    A plain path must be a folder; a pattern, here one that matches only this name, need not.
    """
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet")


def streamed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamed(spark, sf_dir, "events")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def instruments(rows: DataFrame) -> DataFrame:
    """Event columns plus the instrument they stand for; works on a stream."""
    user = F.col("user_id")
    crypto = user % 4 == 0
    return once(
        rows.select("event_id", "event_type", "value", "ts", "user_id", "props"),
        time=F.col("ts").cast("timestamp"),
        k=F.get_json_object("props", "$.k").cast("bigint"),
        symbol=F.when(crypto, _pick(fixed.CRYPTO_SYMBOLS, F.floor(user / 4) % 4)).otherwise(
            _pick(fixed.STOCK_SYMBOLS, user % 6)
        ),
        exchange=F.when(crypto, F.upper(F.lit(fixed.CRYPTO_EXCHANGE))).otherwise(F.lit(fixed.STOCK_EXCHANGE)),
        source=F.when(crypto, F.lit(fixed.CRYPTO_SOURCE_PREFIX + fixed.CRYPTO_EXCHANGE)).otherwise(
            F.lit(fixed.DEFAULT_SOURCE)
        ),
    ).drop("ts", "user_id", "props")


def quoted(rows: DataFrame) -> DataFrame:
    """``instruments`` plus the numbers of a tick."""
    k = F.col("k")
    return rows.select(
        "*",
        F.when((F.col("event_type") == "error") & (k < 2), F.lit(0.0)).otherwise(F.col("value")).alias("price"),
        (k * 0.25).alias("change"),
        ((k - 50) / 5).alias("pct_change"),
        k.alias("volume"),
        (F.col("value") - 0.25).alias("bid"),
        (F.col("value") + 0.25).alias("ask"),
    )


TICK_FIELDS = ["event_id", "time", "symbol", "exchange", "price", "change", "pct_change", "volume", "bid", "ask", "source"]


def ticks(spark: SparkSession, sf_dir: str, first=None, last=None) -> DataFrame:
    """All ticks, or those of a range of days (filtered on the stored column, so the scan prunes)."""
    rows = events(spark, sf_dir)
    if first is not None:
        rows = day_filter(rows, first, last, "ts")
    return quoted(instruments(rows)).select(*TICK_FIELDS)


def classed_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks(spark, sf_dir).withColumn("asset_class", asset_class_of_source(F.col("source")))


def mixed_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks of which some come from an unknown feed, and some from one of another class than their symbol's."""
    source = F.when(F.col("event_id") % 10 == 0, F.lit("feed")).when(F.col("event_id") % 7 == 3, F.lit(fixed.CRYPTO_SOURCE_PREFIX + "x"))
    mixed = ticks(spark, sf_dir).withColumn("source", source.otherwise(F.col("source")))
    return mixed.withColumn("asset_class", asset_class_of_source(F.col("source")))


def odd_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks for rules: some symbols are the text ``*``, and prices are texts, some of which are no numbers."""
    symbol = F.when(F.col("event_id") % 97 == 0, F.lit("*")).otherwise(F.col("symbol"))
    price = F.when(F.col("event_id") % 89 == 0, F.lit("n/a")).otherwise(F.col("price").cast("string"))
    return ticks(spark, sf_dir).withColumns({"symbol": symbol, "price": price})


def faulty_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks whose error events report negative volumes, so that some bars break the invariants."""
    error = F.col("event_type") == "error"
    return (
        quoted(instruments(events(spark, sf_dir)))
        .withColumn("volume", F.when(error, -3 * F.col("k")).otherwise(F.col("k")))
        .select(*TICK_FIELDS)
    )


def board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stock board: numbers as texts, some unreadable, symbols in lower case, some fields empty."""
    rows = instruments(events(spark, sf_dir))
    kind, k = F.col("event_type"), F.col("k")
    text = F.col("value").cast("string")
    return rows.select(
        "event_id",
        "time",
        F.when(kind == "signup", F.lit(None)).otherwise(F.lower("symbol")).alias("symbol"),
        F.when(kind == "view", F.lit("")).when(kind == "click", F.lit(None)).otherwise(F.lit("hnx")).alias("exchange"),
        F.when(kind == "error", F.lit("N/A")).otherwise(text).alias("close_price"),
        F.when(k < 10, F.lit(None)).otherwise(k.cast("string")).alias("price_change"),
        F.concat(F.lit("-"), text).alias("percent_change"),
        F.concat(k.cast("string"), F.lit(".9")).alias("volume_accumulated"),
        F.lit("").alias("bid_price_1"),
        F.concat(F.lit("1_"), F.lpad(k.cast("string"), 3, "0")).alias("ask_price_1"),
    )


def tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange tickers: the pair symbol and numeric fields, some null."""
    rows = quoted(instruments(events(spark, sf_dir)))
    return rows.select(
        "event_id",
        "time",
        "symbol",
        F.col("price").alias("last"),
        F.when(F.col("k") < 10, F.lit(None)).otherwise(F.col("change")).alias("change"),
        F.col("pct_change").alias("percentage"),
        (F.col("k") + 0.75).alias("quoteVolume"),
        "bid",
        "ask",
    )


def event_messages(rows: DataFrame) -> DataFrame:
    """Event rows (table or stream) as JSON messages: good, malformed and foreign ones by event type."""
    q = quoted(instruments(rows))
    kind, k = F.col("event_type"), F.col("k")
    error = kind == "error"

    def fault(first: int, last: int) -> Column:
        return error & k.between(first, last)

    shifted = F.date_format(F.col("time") + F.expr("interval 7 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+07:00'")
    payload = F.struct(
        "price",
        "change",
        "pct_change",
        F.when(fault(80, 99), F.lit("inf")).otherwise(k.cast("string")).alias("volume"),
        F.when(k < 5, F.lit("N/A")).otherwise(F.col("bid").cast("string")).alias("bid"),
        "ask",
    )
    envelope = F.struct(
        F.when(kind == "signup", F.lit("market.rumour")).otherwise(F.lit(fixed.PRICE_SNAPSHOT)).alias("event_type"),
        F.when(fault(0, 19), F.lit(None)).otherwise(F.col("symbol")).alias("symbol"),
        F.when(kind == "purchase", F.lit(None)).otherwise(F.col("exchange")).alias("exchange"),
        F.when(fault(40, 59), F.lit("soon"))
        .when(fault(60, 79), F.lit(None))
        .when(kind == "purchase", shifted)
        .otherwise(iso_text(F.col("time")))
        .alias("timestamp"),
        "source",
        F.when(~fault(20, 39), payload).alias("payload"),
    )
    return q.select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("key"), F.to_json(envelope).alias("value")
    )


def chat_messages(turns: DataFrame) -> DataFrame:
    """Whole conversation texts as messages, from a table or a stream: none of them is JSON."""
    key = F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))
    return turns.select(key.alias("key"), F.col("text").alias("value"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both topics in one table."""
    return event_messages(events(spark, sf_dir)).unionByName(chat_messages(table(spark, sf_dir, "conversations")))


def streamed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as one stream of both topics."""
    return event_messages(streamed(spark, sf_dir, "events")).unionByName(chat_messages(streamed(spark, sf_dir, "conversations")))


def long_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Close-only daily bars over several years: one series per order priority.

    Written once to the shared scratch folder, as the indicators scan their bars repeatedly.
    """
    orders = table(spark, sf_dir, "orders")
    bars = orders.groupBy(
        F.col("o_orderpriority").alias("symbol"),
        F.lit("ORD").alias("exchange"),
        F.date_trunc("day", F.col("o_orderdate").cast("timestamp")).alias("time"),
    ).agg(F.max("o_totalprice").alias("close"))
    # Bars that hold no price: a null close on the 13th, NaN on the 27th of a month.
    date = F.dayofmonth("time")
    close = F.when(date == 27, F.lit(float("nan"))).when(date != 13, F.col("close"))
    bars = bars.withColumn("close", close)
    return materialise(bars, "long-bars")


def fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer a made-up company: P/E, D/E and EPS figures."""
    per_customer = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_totalprice").alias("largest"), F.count(F.lit(1)).alias("orders"))
    )
    eps = F.col("largest") / 1000
    return (
        table(spark, sf_dir, "customer")
        .join(per_customer, "c_custkey", "left")
        .select(
            F.col("c_name").alias("symbol"),
            (F.col("c_acctbal") / eps).alias("pe"),
            (F.col("orders") / 10).alias("de"),
            eps.alias("eps"),
        )
    )
