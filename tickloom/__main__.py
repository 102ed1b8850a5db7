"""Command line: ``python -m tickloom <command>``. Run through spark-submit on a cluster."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession, functions as F

from tickloom import fixed_values as fixed
from tickloom.operators import alerts, calendar, envelope
from tickloom.plans import jobs
from tickloom.session import configure, local_session
from tickloom.sources import config, messages
from tickloom.streaming.alerts import alert_rows, console
from tickloom.streaming.landing import with_trigger


def _source(spark, args):
    if args.servers:
        return messages.subscribe(spark, args.servers, starting=args.starting, max_rows=args.max_rows)
    return messages.stream_messages(spark, args.messages)


def _wait(queries):
    for query in queries:
        query.awaitTermination()


def publish_stock(spark, args):
    board = spark.read.option("primitivesAsString", True).json(args.board)
    messages.publish(envelope.to_messages(envelope.normalise_stock_board(board, args.exchange)), args.out)


def publish_crypto(spark, args):
    tickers = spark.read.option("primitivesAsString", True).json(args.board)
    messages.publish(envelope.to_messages(envelope.normalise_crypto_tickers(tickers, args.exchange)), args.out)


def storage_consumer(spark, args):
    interval = None if args.once else fixed.LANDING_INTERVAL
    _wait(jobs.run_landing(_source(spark, args), args.raw, args.dead_letters, args.checkpoint, interval, args.format))


def price_alerts(spark, args):
    rules = alerts.load_rules(spark, args.rules) if args.rules else alerts.rules_table(spark)
    writer = console(alert_rows(_source(spark, args), rules), args.checkpoint)
    _wait([with_trigger(writer, None if args.once else fixed.LANDING_INTERVAL).start()])


def ohlcv_daily_ingest(spark, args):
    settings = config.load_json(spark, args.config) if args.config else {}
    first = calendar.target_day(args.date, settings.get("lookback_days", fixed.LOOKBACK_DAYS))
    counts = jobs.run_ohlcv(
        spark, args.raw, args.bars, first, args.until, args.layout, args.format, args.gate,
        volume=args.volume, unique_times=args.unique_times,
    )
    print(f"{first}: no ticks" if counts is None else f"{first}: {counts['bars']} bars, {counts['dropped']} dropped")


def technical(spark, args):
    as_of = calendar.target_day(args.date)
    if args.state:
        jobs.run_indicators_incremental(spark, args.bars, args.state, args.out, as_of, args.since)
    else:
        jobs.run_indicators(spark, args.bars, args.out, as_of, args.layout)


def digest(spark, args):
    jobs.run_digest(spark, args.bars, args.out, calendar.target_day(args.date), args.top)


def screener(spark, args):
    thresholds = config.load_json(spark, args.thresholds)
    jobs.run_screener(spark, args.fundamentals, args.out, thresholds, calendar.target_day(args.date))


def gaps(spark, args):
    days = calendar.partition_calendar(spark, args.first, args.last)
    table = spark.read.parquet(args.table)
    # At most one row per calendar day.
    for row in calendar.missing_days(days, table, F.to_date("time")).orderBy("event_date").collect():
        print(row["event_date"])


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tickloom", description="Market-data pipeline on Spark")
    sub = top.add_subparsers(dest="command", required=True)

    def command(name, run, help, *options):
        made = sub.add_parser(name, help=help)
        made.set_defaults(run=run)
        for flags, settings in options:
            made.add_argument(flags, **settings)

    day = ("--date", {"help": "UTC day YYYY-MM-DD (default: today)"})
    layout = ("--layout", {"choices": ["day", "ymd"], "default": "day"})
    fmt = ("--format", {"default": "parquet", "help": "format of the raw ticks"})
    need = {"required": True}
    source = [
        ("--messages", {"help": "folder of JSON messages"}),
        ("--servers", {"help": "broker addresses, instead of --messages"}),
        ("--max-rows", {"type": int, "help": "rows per micro-batch from the broker"}),
        ("--checkpoint", need),
        ("--once", {"action": "store_true", "help": "stop after the available messages"}),
    ]
    command("stock-price-producer", publish_stock, "stock board rows (JSON) to messages",
            ("--board", need), ("--out", need), ("--exchange", {"default": fixed.STOCK_EXCHANGE}))
    command("crypto-price-producer", publish_crypto, "exchange tickers (JSON) to messages",
            ("--board", need), ("--out", need), ("--exchange", {"default": fixed.CRYPTO_EXCHANGE}))
    command("storage-consumer", storage_consumer, "land messages as ticks and dead letters",
            *source, ("--starting", {"default": "earliest"}), ("--raw", need), ("--dead-letters", need), fmt)
    command("price-alerts", price_alerts, "print alerts for messages",
            *source, ("--starting", {"default": "latest"}), ("--rules", {"help": "JSON array of rules"}))
    command("ohlcv-daily-ingest", ohlcv_daily_ingest, "daily bars from landed ticks", day,
            ("--until", {"help": "last day of a backfill"}), ("--config", {"help": "JSON with lookback_days"}),
            ("--raw", need), ("--bars", need), layout, fmt, ("--volume", {"default": "sum"}),
            ("--unique-times", {"action": "store_true"}), ("--gate", {"action": "store_true"}))
    command("technical", technical, "latest indicators per symbol", day, ("--bars", need), ("--out", need), layout,
            ("--state", {"help": "state table, for incremental runs"}), ("--since", {"help": "day of the state to advance"}))
    command("digest", digest, "top gainers, losers and volumes of a day", day, ("--bars", need), ("--out", need),
            ("--top", {"type": int, "default": 3}))
    command("screener", screener, "rows passing all thresholds", day, ("--fundamentals", need), ("--out", need),
            ("--thresholds", need))
    command("gaps", gaps, "calendar days without rows", ("--table", need),
            ("--first", {"default": fixed.CALENDAR_START}), ("--last", {}))
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    submitted = SparkSession.getActiveSession() or "PYSPARK_GATEWAY_PORT" in os.environ
    spark = SparkSession.builder.getOrCreate() if submitted else local_session()
    args.run(configure(spark), args)


if __name__ == "__main__":
    main()
