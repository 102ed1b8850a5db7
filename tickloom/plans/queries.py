"""Registered queries: every operator over the whole test tables.

Times leave as texts and doubles rounded, so that results compare across engines.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from tickloom import fixed_values as fixed, schemas
from tickloom.functions import coerce
from tickloom.operators import alerts, bar_states, bars, calendar, envelope, extract, incremental, indicators, quality, reports
from tickloom.operators.asof import asof_join
from tickloom.operators.cooldown import cooldown
from tickloom.operators.series import latest_rows
from tickloom.plans import jobs, views
from tickloom.session import materialise, scratch_path
from tickloom.sources import avro, messages as topics, tables
from tickloom.streaming import alerts as alert_stream, keyed, landing, progress

SCREEN = [
    {"field": "pe", "operator": "<=", "threshold": 12.0},
    {"field": "de", "operator": ">=", "threshold": 0.5},
    {"field": "eps", "operator": ">", "threshold": 350.0},
]
# A rule set with rules that validation has to reject.
MIXED_RULES = [
    *fixed.ALERT_RULES,
    {"symbol": "*", "field": "price", "operator": "~~", "threshold": 1.0, "message": "unknown operator"},
    {"symbol": "VCB", "field": "volume", "operator": None, "threshold": 1.0, "message": "no operator"},
]
# Rules for each symbol and for all, over a ladder of prices.
MANY_RULES = [
    {"symbol": symbol, "field": "price", "operator": operator, "threshold": float(20 * step), "message": f"{operator} {20 * step}"}
    for symbol in ("*", *fixed.STOCK_SYMBOLS, *fixed.CRYPTO_SYMBOLS)
    for operator in ("<=", ">")
    for step in range(1, 17)
]
BACKFILL = ("2024-01-10", "2024-01-16")
COOLDOWN_MINUTES = 360


def day(column: str = "time") -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def instant(column: str = "time") -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def rounded(digits: int, *names: str) -> list[Column]:
    return [F.round(name, digits).alias(name) for name in names]


# ---- bars -------------------------------------------------------------------------------

def _bars(df: DataFrame) -> DataFrame:
    prices = rounded(4, "open", "high", "low", "close")
    return df.select(day().alias("bar_date"), "symbol", "exchange", "asset_class", *prices, "volume")


def ohlcv_daily(spark, sf_dir):
    return _bars(bars.ohlcv(views.ticks(spark, sf_dir)))


def ohlcv_unique_times(spark, sf_dir):
    return _bars(bars.ohlcv(views.ticks(spark, sf_dir), unique_times=True))


def ohlcv_landed_class(spark, sf_dir):
    """Bars whose asset class comes from the landed ticks instead of the symbol."""
    return _bars(bars.ohlcv(views.mixed_ticks(spark, sf_dir)))


def ohlcv_valid(spark, sf_dir):
    return _bars(bars.valid_bars(bars.ohlcv(views.faulty_ticks(spark, sf_dir))))


def ohlcv_backfill(spark, sf_dir):
    return _bars(bars.ohlcv(views.ticks(spark, sf_dir, *BACKFILL)))


def bars_merged(spark, sf_dir):
    """Bars from ticks that arrive in three lots, which share every day; the last lot comes twice."""
    states = scratch_path(spark, "bar-states")
    ticks = views.mixed_ticks(spark, sf_dir)
    for lot in (0, 1, 2, 2):
        jobs.add_bar_lot(ticks.filter(F.col("event_id") % 3 == lot), states, lot)
    stored = spark.read.parquet(states).drop("event_date", keyed.BATCH)
    return _bars(bars.valid_bars(bar_states.bars_of(bar_states.merged(stored))))


def quality_report(spark, sf_dir):
    return quality.quality_report(bars.ohlcv(views.faulty_ticks(spark, sf_dir), fault_counts=True))


def rows_per_symbol(spark, sf_dir):
    return bars.rows_per_symbol(views.ticks(spark, sf_dir))


def asset_classes(spark, sf_dir):
    ticks = views.mixed_ticks(spark, sf_dir)
    return ticks.groupBy(
        coerce.asset_class_of_source(F.col("source")).alias("by_source"),
        coerce.asset_class_of_symbol(F.col("symbol")).alias("by_symbol"),
        coerce.symbol_key(F.col("symbol")).alias("symbol_key"),
    ).agg(F.count(F.lit(1)).alias("rows"))


# ---- indicators -------------------------------------------------------------------------

def _series(df: DataFrame, *columns) -> DataFrame:
    return df.select(day().alias("bar_date"), "symbol", *columns)


def sma(spark, sf_dir):
    rolled = indicators.rolling_indicators(views.long_bars(spark, sf_dir))
    return _series(rolled, *rounded(6, "sma20", "sma50", "sma200"))


def bollinger(spark, sf_dir):
    rolled = indicators.rolling_indicators(views.long_bars(spark, sf_dir))
    return _series(rolled, *rounded(6, "bb_mid"), *rounded(3, "bb_upper", "bb_lower"))


def rsi14(spark, sf_dir):
    rolled = indicators.rolling_indicators(views.long_bars(spark, sf_dir))
    return _series(rolled, *rounded(4, "rsi14"))


def prev_close_gain_loss(spark, sf_dir):
    rolled = indicators.rolling_indicators(views.long_bars(spark, sf_dir))
    return _series(rolled, "bar_number", *rounded(4, "prev_close", "gain", "loss"))


MACD_LINES = ("macd", "macd_signal", "macd_hist")


def macd_series(spark, sf_dir):
    return _series(indicators.macd_series(views.long_bars(spark, sf_dir)), *rounded(3, *MACD_LINES))


def _all_indicators(df: DataFrame) -> DataFrame:
    return _series(
        df,
        *rounded(6, "sma20", "sma50", "sma200", "bb_mid"),
        *rounded(3, "bb_upper", "bb_lower", *MACD_LINES),
        *rounded(4, "rsi14"),
    )


def indicators_full(spark, sf_dir):
    return _all_indicators(indicators.indicators(views.long_bars(spark, sf_dir)))


def indicators_latest(spark, sf_dir):
    return _all_indicators(indicators.latest_indicators(views.long_bars(spark, sf_dir)))


def macd_latest(spark, sf_dir):
    latest = indicators.latest_macd_of(views.long_bars(spark, sf_dir))
    return latest.select("symbol", *rounded(3, *MACD_LINES))


def latest_bar(spark, sf_dir):
    return _bars(latest_rows(bars.ohlcv(views.ticks(spark, sf_dir)), ("symbol",), ties=("exchange",)))


def indicators_incremental(spark, sf_dir):
    """State up to a day in the middle, advanced by the rest, gives the same latest indicators."""
    series = views.long_bars(spark, sf_dir)
    split = F.lit("1996-01-01").cast("timestamp")
    state = materialise(incremental.indicator_state(series.filter(F.col("time") < split)), "state")
    advanced = incremental.advance_state(state, series.filter(F.col("time") >= split))
    return _all_indicators(incremental.snapshot(advanced))


def indicator_lookup(spark, sf_dir):
    """RSI of a symbol on a day: two run-dated snapshots are stored, one is looked up."""
    source = scratch_path(spark, "bars")
    views.long_bars(spark, sf_dir).withColumn("event_date", F.to_date("time")).write.parquet(source)
    out = scratch_path(spark, "indicators")
    for as_of in ("1995-06-30", "1996-06-30"):
        jobs.run_indicators(spark, source, out, as_of)
    found = tables.lookup(tables.read_table(spark, out), "1995-06-30", "1-URGENT")
    return _series(found, *rounded(4, "rsi14"), *rounded(6, "sma20"), F.date_format("as_of", "yyyy-MM-dd").alias("as_of"))


AMENDED = ("1-URGENT", "1993-04-06")


def indicators_amended(spark, sf_dir):
    """Past closes of one symbol are raised: its states are replayed from the ladder, all others kept."""
    series = views.long_bars(spark, sf_dir)
    ladder = None
    for as_of in ("1992-12-31", "1994-12-31", "2001-12-31"):
        state = incremental.indicator_state(calendar.up_to(series, as_of)).withColumn("as_of", F.lit(as_of).cast("date"))
        ladder = state if ladder is None else ladder.unionByName(state)
    symbol, first = AMENDED
    late = (F.col("symbol") == symbol) & (F.col("time") >= F.lit(first).cast("timestamp")) & (F.dayofmonth("time") == 6)
    amended = series.withColumn("close", F.when(late, F.col("close") + 1000).otherwise(F.col("close")))
    changes = series.filter(late).groupBy("symbol").agg(F.min("time").alias("changed_from"))
    state = incremental.replayed_state(materialise(ladder, "ladder"), amended, changes)
    return _all_indicators(incremental.snapshot(state))


ASOF_DAYS = ("1993-06-30", "1994-06-30", "1996-01-31", "1997-05-31")


def indicator_asof(spark, sf_dir):
    """For every (symbol, day) with an order the newest indicator snapshot at or before that day."""
    source, out = scratch_path(spark, "bars"), scratch_path(spark, "indicators")
    views.long_bars(spark, sf_dir).withColumn("event_date", F.to_date("time")).write.parquet(source)
    for as_of in ASOF_DAYS:
        jobs.run_indicators(spark, source, out, as_of)
    snapshots = tables.read_table(spark, out).select("symbol", "as_of", "rsi14", "sma20")
    orders = views.table(spark, sf_dir, "orders")
    asked = orders.select(F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("asked")).distinct()
    found = asof_join(asked, snapshots, ("symbol",), "asked", "as_of")
    return found.select("symbol", *[F.date_format(name, "yyyy-MM-dd").alias(name) for name in ("asked", "as_of")], *rounded(4, "rsi14"), *rounded(6, "sma20"))


# ---- alerts -----------------------------------------------------------------------------

HIT = ["event_id", "symbol", "rule_id", "message", "matched_field"]


def _hits(df: DataFrame) -> DataFrame:
    return df.select(*HIT, *rounded(4, "matched_value", "price", "pct_change"))


def price_alerts(spark, sf_dir):
    return _hits(alerts.evaluate_rules(views.ticks(spark, sf_dir), alerts.rules_table(spark)))


def price_alerts_many(spark, sf_dir):
    """Hits per rule of over 300 rules, on ticks with odd symbols and prices that are texts."""
    hits = alerts.evaluate_rules(views.odd_ticks(spark, sf_dir), alerts.rules_table(spark, MANY_RULES))
    return hits.groupBy("rule_id", "symbol").agg(F.count(F.lit(1)).alias("hits"), F.round(F.max("matched_value"), 4).alias("largest"))


def rules_from_file(spark, sf_dir):
    """Hits of rules that are loaded from a JSON file."""
    path = scratch_path(spark, "rules")
    spark.range(1).select(F.lit(json.dumps(fixed.ALERT_RULES[:4])).alias("value")).write.text(path)
    return _hits(alerts.evaluate_rules(views.ticks(spark, sf_dir), alerts.load_rules(spark, path)))


def alerts_text(spark, sf_dir):
    rows = alert_stream.alert_rows(views.messages(spark, sf_dir), alerts.rules_table(spark))
    return rows.select("key", "rule_id", "alert")


def _cooled(df: DataFrame) -> DataFrame:
    return df.select("event_id", "symbol", "rule_id", instant().alias("fired"), "message", *rounded(4, "matched_value", "price"))


def alert_cooldown(spark, sf_dir):
    hits = materialise(alerts.evaluate_rules(views.ticks(spark, sf_dir), alerts.rules_table(spark)), "hits")
    return _cooled(cooldown(hits, COOLDOWN_MINUTES))


def rule_validation(spark, sf_dir):
    """Hits per rule of a set with invalid rules; the invalid ones are reported with no hits."""
    rules = alerts.rules_table(spark, MIXED_RULES)
    hits = alerts.evaluate_rules(views.ticks(spark, sf_dir), rules)
    valid = hits.groupBy("rule_id").agg(F.count(F.lit(1)).alias("hits")).withColumn("state", F.lit("valid"))
    rejected = alerts.rejected_rules(rules).select("rule_id", F.lit(0).cast("bigint").alias("hits"), F.lit("rejected").alias("state"))
    return valid.unionByName(rejected)


# ---- envelopes and landing --------------------------------------------------------------

PAYLOAD = ["price", "change", "pct_change", "volume", "bid", "ask"]


def _envelopes(df: DataFrame) -> DataFrame:
    payload = [F.col("payload")[name] for name in PAYLOAD]
    cells = [c.alias(n) if n == "volume" else F.round(c, 4).alias(n) for c, n in zip(payload, PAYLOAD)]
    return df.select("event_id", "key", "event_type", "symbol", "exchange", "timestamp", "source", *cells)


def normalise_stock(spark, sf_dir):
    stamp = coerce.iso_text(F.col("time"))
    return _envelopes(envelope.normalise_stock_board(views.board(spark, sf_dir), timestamp=stamp, keep=("event_id",)))


def normalise_crypto(spark, sf_dir):
    stamp = coerce.iso_text(F.col("time"))
    return _envelopes(envelope.normalise_crypto_tickers(views.tickers(spark, sf_dir), timestamp=stamp, keep=("event_id",)))


def envelope_roundtrip(spark, sf_dir):
    """Normalised tickers written as JSON messages, read back, decoded and typed."""
    stamp = coerce.iso_text(F.col("time"))
    sent = envelope.to_messages(envelope.normalise_crypto_tickers(views.tickers(spark, sf_dir), timestamp=stamp))
    path = scratch_path(spark, "messages")
    topics.publish(sent, path)
    ticks = extract.ticks_of(landing.classified(topics.read_messages(spark, path)), keep=("key",))
    return _ticks(ticks)


def _ticks(df: DataFrame) -> DataFrame:
    doubles = rounded(4, *fixed.PAYLOAD_DOUBLES)
    return df.select("key", instant().alias("tick_time"), "symbol", "exchange", *doubles, "volume", "asset_class",
                     F.date_format("event_date", "yyyy-MM-dd").alias("event_date"))


def landing_ticks(spark, sf_dir):
    return _ticks(extract.ticks_of(landing.classified(views.messages(spark, sf_dir)), keep=("key",)))


def dead_letter_split(spark, sf_dir):
    letters = extract.dead_letters_of(landing.classified(views.messages(spark, sf_dir)), keep=("key",))
    return letters.select("key", "reason", "event_type")


def event_routing(spark, sf_dir):
    rows = landing.classified(views.messages(spark, sf_dir))
    return rows.groupBy("status", F.coalesce("event_type", F.lit("none")).alias("event_type")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def multi_topic_union(spark, sf_dir):
    stock = views.event_messages(views.events(spark, sf_dir)).withColumn("topic", F.lit(fixed.TOPICS[0]))
    crypto = views.chat_messages(views.table(spark, sf_dir, "conversations")).withColumn("topic", F.lit(fixed.TOPICS[1]))
    both = topics.union_topics(stock, crypto)
    return both.groupBy("topic").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("key").alias("keys")
    )


def coerced_values(spark, sf_dir):
    board = views.board(spark, sf_dir)
    number = lambda name: F.round(coerce.to_double(F.col(name)), 4).alias(name)
    year, month, date = coerce.date_parts(F.col("time"))
    return board.select(
        "event_id",
        number("close_price"),
        F.round(coerce.to_double(F.col("price_change"), 99.5), 4).alias("price_change"),
        number("percent_change"),
        coerce.to_bigint(F.col("percent_change")).alias("truncated"),
        coerce.to_bigint(F.col("volume_accumulated"), 5).alias("volume_accumulated"),
        coerce.to_bigint(F.col("bid_price_1"), 5).alias("bid_price_1"),
        number("ask_price_1"),
        coerce.to_iso_text(day()).alias("midnight"),
        instant_of(coerce.parse_iso(coerce.to_iso_text(day()))).alias("parsed"),
        year, month, date,
    )


def instant_of(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


# ---- stored tables ----------------------------------------------------------------------

def landed_day_scan(spark, sf_dir):
    """Ticks landed into day partitions, then a pruned read of some days."""
    path = scratch_path(spark, "raw")
    tables.write_days(views.classed_ticks(spark, sf_dir), path)
    picked = tables.read_days(spark, path, *BACKFILL)
    return picked.groupBy("asset_class", "symbol").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("event_date").alias("days")
    )


def avro_scan(spark, sf_dir):
    """All ticks written as Avro files by asset class and day, and read back."""
    path = scratch_path(spark, "raw-avro")
    tables.write_days(views.classed_ticks(spark, sf_dir), path, fmt=avro.FORMAT)
    back = tables.read_table(spark, path, fmt=avro.FORMAT)
    doubles = rounded(4, *fixed.PAYLOAD_DOUBLES)
    return back.select("event_id", instant().alias("tick_time"), "symbol", "exchange", *doubles, "volume", "source", "asset_class",
                       F.date_format("event_date", "yyyy-MM-dd").alias("event_date"))


def ohlcv_rerun(spark, sf_dir):
    """The daily job over all days and again over some of them, in the year/month/day layout."""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "bars")
    tables.write_days(views.classed_ticks(spark, sf_dir), raw)
    jobs.run_ohlcv(spark, raw, out, "2024-01-01", "2024-12-31", layout="ymd")
    jobs.run_ohlcv(spark, raw, out, *BACKFILL, layout="ymd")
    return _bars(tables.read_table(spark, out))


def explicit_schema_write(spark, sf_dir):
    """Bars written with the declared schema and read back."""
    path = scratch_path(spark, "declared")
    tables.write_rows(bars.ohlcv(views.ticks(spark, sf_dir)), path, schemas.BAR)
    return _bars(spark.read.parquet(path))


# ---- calendar ---------------------------------------------------------------------------

CALENDAR = ("2023-12-28", "2024-02-03")


def partition_calendar(spark, sf_dir):
    """Calendar of the days the ticks span, with the day texts of the path layout."""
    days = calendar.calendar_of(views.events(spark, sf_dir), F.to_date("ts"))
    return days.select(F.date_format("event_date", "yyyy-MM-dd").alias("event_date"),
                       *coerce.date_parts(F.col("event_date")))


def gap_report(spark, sf_dir):
    """Calendar days without ticks."""
    days = calendar.partition_calendar(spark, *CALENDAR)
    gaps = calendar.missing_days(days, views.events(spark, sf_dir), F.to_date("ts"))
    return gaps.select(F.date_format("event_date", "yyyy-MM-dd").alias("event_date"))


def freshness(spark, sf_dir):
    days = calendar.partition_calendar(spark, *CALENDAR)
    ticks = views.faulty_ticks(spark, sf_dir)
    state = calendar.freshness(days, ticks, bars.valid_bars(bars.ohlcv(ticks)))
    return state.select(F.date_format("event_date", "yyyy-MM-dd").alias("event_date"), "ticks", "bars", "state")


def retention_filter(spark, sf_dir):
    kept = calendar.retained(views.events(spark, sf_dir), "2024-02-10", time="ts")
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


def look_back(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    window = calendar.look_back(orders, "1996-06-30", time="o_orderdate")
    return window.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("rows"))


# ---- reports ----------------------------------------------------------------------------

def digest_topk(spark, sf_dir):
    daily = materialise(bars.ohlcv(views.ticks(spark, sf_dir)), "bars")
    board = reports.daily_digest(daily)
    return board.select(day().alias("bar_date"), "board", "place", "symbol", "exchange", *rounded(4, "value"))


def screener(spark, sf_dir):
    passed = reports.screen(views.fundamentals(spark, sf_dir), SCREEN)
    return passed.select("symbol", *rounded(4, "pe", "de"), *rounded(6, "eps"))


BURST = {"length": "6 hours", "slide": "1 hour", "threshold_pct": 1000.0}


def _bursts(df: DataFrame) -> DataFrame:
    return df.select(
        instant("window_start").alias("window_start"), instant("window_end").alias("window_end"), "symbol",
        *rounded(4, "low", "high", "range_pct"), "ticks",
    )


def volatility_burst(spark, sf_dir):
    return _bursts(reports.volatility_bursts(views.ticks(spark, sf_dir), **BURST))


# ---- streams ----------------------------------------------------------------------------


def _landed(spark, sf_dir, source=None, **options):
    """Run the landing query over what is available; the folder of its tables, letters and log."""
    folder = scratch_path(spark, "landing")
    source = views.streamed_messages(spark, sf_dir) if source is None else source
    landing.land(source, f"{folder}/raw", f"{folder}/letters", f"{folder}/log", f"{folder}/checkpoint", None, keep=("key",), **options).start().awaitTermination()
    return folder


def stream_landing(spark, sf_dir):
    return _ticks(landing.landed(spark, f"{_landed(spark, sf_dir)}/raw"))


def stream_dead_letters(spark, sf_dir):
    folder = _landed(spark, sf_dir)
    stored = spark.read.schema(f"key string, {schemas.DEAD_LETTER}, {keyed.BATCH} bigint").json(f"{folder}/letters")
    return stored.select("key", "reason", "event_type")


RUMOUR = "market.rumour"
RUMOUR_EXTRACTOR = extract.Extractor(
    dict, lambda: F.when(F.col("time").isNull(), F.lit("bad timestamp")), lambda: [F.col("time"), F.col("symbol"), F.col("source")]
)


def stream_event_types(spark, sf_dir):
    """Two registered event types, each landed in its own table, and the log of what was landed."""
    folder = _landed(spark, sf_dir, extractors={**extract.EXTRACTORS, RUMOUR: RUMOUR_EXTRACTOR})
    tables_ = [landing.landed(spark, f"{folder}/raw", name).select(F.lit(name).alias("event_type"), "symbol") for name in (fixed.PRICE_SNAPSHOT, RUMOUR)]
    rows = tables_[0].unionByName(tables_[1]).groupBy("event_type", "symbol").agg(F.count(F.lit(1)).alias("rows"))
    logged = landing.landing_log(spark, f"{folder}/log").filter("status = 'good'")
    return rows.unionByName(logged.select(F.concat(F.lit("logged "), "event_type").alias("event_type"), F.lit("").alias("symbol"), "rows"))


LOTS = 6


def _in_lots(rows: DataFrame, name: str) -> DataFrame:
    """A table as a stream of ``LOTS`` micro-batches, its rows dealt out by a hash and so in no order of time."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, name)
    for lot in range(LOTS):
        rows.filter(F.pmod(F.xxhash64("event_id"), F.lit(LOTS)) == lot).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def stream_dedup(spark, sf_dir):
    """Every message delivered twice; repeats of a tick are dropped within the watermark."""
    source = views.streamed_messages(spark, sf_dir)
    ticks = extract.ticks_of(landing.classified(source.unionByName(views.streamed_messages(spark, sf_dir))), keep=("key",))
    return _ticks(_stored_stream(landing.distinct_ticks(ticks, ("key", *landing.IDENTITY)), "stream-distinct"))


def stream_accounting(spark, sf_dir):
    """Ticks in shuffled lots, some delivered twice: kept, late and repeated ones add up to what was sent."""
    ticks = views.ticks(spark, sf_dir)
    source = _in_lots(ticks.unionByName(ticks.filter("event_id % 4 = 0")), "lots")
    path = scratch_path(spark, "kept")
    kept = landing.distinct_ticks(source, ("event_id", *landing.IDENTITY), "2 days")
    query = kept.writeStream.format("parquet").option("path", path).option("checkpointLocation", scratch_path(spark, "checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    counted = progress.table_of(spark, query).agg(F.sum("rows").alias("sent"), F.sum(F.col("late") + F.col("duplicates")).alias("left_out"))
    stored = spark.read.schema(kept.schema).parquet(path).agg(F.count(F.lit(1)).alias("kept"), F.count_distinct("event_id").alias("distinct_kept"))
    both = counted.withColumn("one", F.lit(1)).join(stored.withColumn("one", F.lit(1)), "one")
    return both.select("sent", (F.col("left_out") + F.col("kept")).alias("accounted"), (F.col("kept") == F.col("distinct_kept")).alias("no_repeats"))


def _stored_stream(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over the available files into a Parquet table and read that."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(df.schema).parquet(path)


def stream_alerts(spark, sf_dir):
    source = views.streamed_messages(spark, sf_dir)
    rows = _stored_stream(alert_stream.alert_rows(source, alerts.rules_table(spark)), "stream-alerts")
    return rows.select("key", "rule_id", "symbol", *rounded(4, "matched_value"), "alert")


def stream_cooldown(spark, sf_dir):
    ticks = views.quoted(views.instruments(views.streamed_events(spark, sf_dir)))
    hits = alerts.evaluate_rules(ticks.select(*views.TICK_FIELDS), alerts.rules_table(spark))
    kept = _stored_stream(alert_stream.with_cooldown(hits, COOLDOWN_MINUTES), "stream-cooldown")
    return _cooled(kept)


def stream_ordered_cooldown(spark, sf_dir):
    """Alerts in shuffled lots through the cooldown that holds them until the watermark; an end mark lets the last ones out."""
    alert_stream.use_rocksdb(spark)
    try:
        hits = alerts.evaluate_rules(views.ticks(spark, sf_dir).select(*views.TICK_FIELDS), alerts.rules_table(spark))
        end = hits.agg(*[F.max(name).alias(name) if name == "time" else F.lit(None).cast(kind).alias(name) for name, kind in hits.dtypes])
        end = end.withColumns({"time": F.col("time") + F.expr("interval 1000 days"), "event_id": F.lit(-1).cast("bigint"), "symbol": F.lit(""), "rule_id": F.lit(-1)})
        source = _in_lots(hits, "alert-lots")
        path = scratch_path(spark, "end")
        kept = alert_stream.with_ordered_cooldown(_with_end(source, end, path), COOLDOWN_MINUTES, lateness="400 days")
        return _cooled(_stored_stream(kept, "stream-ordered").filter("rule_id > 0"))
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def _with_end(source: DataFrame, end: DataFrame, path: str) -> DataFrame:
    """A stream with one more file behind its own, read in micro-batches of one file from each side."""
    spark = source.sparkSession
    # As many files as the other side has, so that the mark comes in the last micro-batch.
    for lot in range(LOTS + 1):
        end.filter(F.lit(lot == LOTS)).coalesce(1).write.mode("append").parquet(path)
    return source.unionByName(spark.readStream.schema(source.schema).option("maxFilesPerTrigger", 1).parquet(path))


def stream_volatility(spark, sf_dir):
    """Windows kept in a keyed table, so that those still open at the end count too."""
    ticks = views.quoted(views.instruments(views.streamed_events(spark, sf_dir)))
    windows = reports.price_windows(ticks, BURST["length"], BURST["slide"])
    path, checkpoint = scratch_path(spark, "windows"), scratch_path(spark, "checkpoint")
    keyed.keyed_sink(windows, path, checkpoint).trigger(availableNow=True).start().awaitTermination()
    stored = keyed.newest(spark, path, windows.schema, ("window_start", "symbol"))
    return _bursts(reports.bursts_of(stored, BURST["threshold_pct"]))


QUERIES = {
    query.__name__: query
    for query in [
        ohlcv_daily, ohlcv_unique_times, ohlcv_landed_class, ohlcv_valid, ohlcv_backfill, bars_merged, quality_report,
        rows_per_symbol, asset_classes,
        sma, bollinger, rsi14, prev_close_gain_loss, macd_series, indicators_full,
        indicators_latest, macd_latest, latest_bar, indicators_incremental, indicators_amended, indicator_lookup, indicator_asof,
        price_alerts, price_alerts_many, rules_from_file, alerts_text, alert_cooldown, rule_validation,
        normalise_stock, normalise_crypto, envelope_roundtrip, coerced_values, landing_ticks, dead_letter_split,
        event_routing, multi_topic_union,
        landed_day_scan, avro_scan, ohlcv_rerun, explicit_schema_write,
        partition_calendar, gap_report, freshness, retention_filter, look_back,
        digest_topk, screener, volatility_burst,
        stream_landing, stream_dead_letters, stream_event_types, stream_dedup, stream_accounting, stream_alerts,
        stream_cooldown, stream_ordered_cooldown, stream_volatility,
    ]
}
