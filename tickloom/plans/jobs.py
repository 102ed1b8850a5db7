"""The jobs of the pipeline, from stored input to stored output."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tickloom import fixed_values as fixed
from tickloom.functions.coerce import utc_date
from tickloom.operators import calendar, quality
from tickloom.operators.bar_states import bar_states, bars_of, merged
from tickloom.operators.bars import as_date, day_filter, ohlcv, valid_bars
from tickloom.operators.incremental import advance_state, indicator_state, snapshot
from tickloom.operators.indicators import latest_indicators
from tickloom.operators.reports import daily_digest, screen
from tickloom.operators.series import latest_rows
from tickloom.session import materialise
from tickloom.sources import tables
from tickloom.streaming.keyed import BATCH, write_batch
from tickloom.streaming.landing import dead_letter_sink, tick_sink


def run_landing(
    messages: DataFrame, raw_path: str, letters_path: str, checkpoint: str,
    interval: str | None = fixed.LANDING_INTERVAL, fmt: str = "parquet",
) -> list:
    """Start both landing queries; with ``interval=None`` they stop after what is available."""
    return [
        tick_sink(messages, raw_path, f"{checkpoint}/ticks", interval, fmt).start(),
        dead_letter_sink(messages, letters_path, f"{checkpoint}/dead-letters", interval).start(),
    ]


def add_bar_lot(ticks: DataFrame, states_path: str, lot: int) -> None:
    """Store the bar states of a lot of ticks; a repeated lot replaces itself."""
    write_batch(bar_states(ticks).withColumn("event_date", utc_date(F.col("bar_time"))), lot, states_path, ("event_date",))


def run_bar_lot(spark: SparkSession, ticks: DataFrame, states_path: str, bars_path: str, lot: int, layout: str = "day", **options) -> None:
    """Add a lot of ticks to the stored bar states, and store the bars of the days that it touches.

    The ticks of earlier lots are not read again. Bars are stored by day alone, as a late tick may tell a bar's asset class.
    """
    add_bar_lot(ticks, states_path, lot)
    stored = spark.read.parquet(states_path)
    days = [row["event_date"] for row in stored.filter(F.col(BATCH) == lot).select("event_date").distinct().collect()]
    touched = merged(stored.filter(F.col("event_date").isin(days)).drop("event_date", BATCH))
    tables.write_days(valid_bars(bars_of(touched, **options)).drop("ticks"), bars_path, layout, by=())


def run_ohlcv(
    spark: SparkSession, raw_path: str, bars_path: str, first, last=None, layout: str = "day",
    fmt: str = "parquet", gate: bool = False, **options,
) -> dict | None:
    """Derive and store the bars of the days ``first``..``last``; None when there are no ticks.

    One aggregation covers the whole range and the counts come from the write itself.
    ``gate`` stops before writing when a critical quality check fails.
    """
    ticks = tables.read_days(spark, raw_path, first, last, fmt=fmt)
    if ticks.isEmpty():
        return None
    bars = ohlcv(ticks, fault_counts=gate, **options)
    if gate:
        # Kept aside for the gate and the write, so that the ticks are aggregated once.
        bars = materialise(bars, "gated-bars")
        quality.gate(quality.quality_report(bars))
    counts = Observation("bars")
    tables.write_days(valid_bars(bars, counts).drop("ticks", "bad_prices", "bad_volumes"), bars_path, layout)
    return counts.get


def run_indicators(spark: SparkSession, bars_path: str, out_path: str, as_of, layout: str = "day", **options) -> None:
    """Store each symbol's latest indicators as of a day, from the full history up to it."""
    bars = calendar.up_to(tables.read_table(spark, bars_path), as_of)
    tables.write_snapshot(latest_indicators(bars, **options), out_path, as_of, layout)


def run_indicators_incremental(
    spark: SparkSession, bars_path: str, state_path: str, out_path: str, as_of, since=None, **options
) -> None:
    """As ``run_indicators``, reading only the bars after the state of the day ``since``.

    Without ``since`` the state is built from the full history.
    """
    bars = tables.read_table(spark, bars_path)
    if since is None:
        state = indicator_state(calendar.up_to(bars, as_of), **options)
    else:
        old = tables.lookup(tables.read_table(spark, state_path), since).drop("as_of")
        if old.isEmpty():
            raise ValueError(f"no state of {since} in {state_path}")
        new = tables.read_days(spark, bars_path, as_date(since) + timedelta(days=1), as_of)
        state = advance_state(old, new, **options)
    tables.write_snapshot(state, state_path, as_of)
    stored = tables.lookup(tables.read_table(spark, state_path), as_of).drop("as_of")
    tables.write_snapshot(snapshot(stored), out_path, as_of)


def run_digest(
    spark: SparkSession, bars_path: str, out_path: str, day, top: int = 3, state_path: str | None = None, since=None
) -> None:
    """Store the digest of one day, from its bars and each symbol's last bar before it.

    With ``state_path`` the last bars are kept there per day: given the day ``since`` of an earlier run, only the bars after it
    are read, and none before. Without ``since`` the state is built from the history.
    """
    bars = tables.read_table(spark, bars_path)
    first, columns = as_date(day) - timedelta(days=1), ["time", "symbol", "exchange", "close", "volume"]
    if state_path is not None and since is not None:
        old = tables.lookup(tables.read_table(spark, state_path), since).select(*columns)
        if old.isEmpty():
            raise ValueError(f"no last bars of {since} in {state_path}")
        recent = tables.read_days(spark, bars_path, as_date(since) + timedelta(days=1), day)
        known = old.unionByName(recent.select(*columns))
    else:
        known = calendar.up_to(bars, day).select(*columns)
    before = latest_rows(known.filter(utc_date(F.col("time")) <= F.lit(first)), ("symbol",), ties=("exchange",))
    relevant = before.unionByName(day_filter(bars, day).select(*columns))
    board = daily_digest(relevant, top).filter(utc_date(F.col("time")) == F.lit(as_date(day)))
    tables.write_snapshot(board, out_path, day)
    if state_path is not None:
        tables.write_snapshot(latest_rows(relevant, ("symbol",), ties=("exchange",)), state_path, day)


def run_screener(spark: SparkSession, fundamentals_path: str, out_path: str, thresholds: list[dict], as_of) -> None:
    passed = screen(tables.read_table(spark, fundamentals_path), thresholds)
    tables.write_snapshot(passed, out_path, as_of)
