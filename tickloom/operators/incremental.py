"""Indicator state per key, so that a run costs the new bars and not the history.

State row: keys, ``bars`` (count), ``last_time``, ``tail`` (at most the last 200 closes,
oldest first), and the MACD state ``ema_fast, ema_slow, ema_signal``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom.functions.ema import STATE, Macd, state_of
from tickloom.operators.indicators import TAIL, final_state, last_of, series_summary, state_columns


def _state(rows, last, tail, fast, slow, signal, keys) -> list[Column]:
    return [
        *[F.col(key) for key in keys],
        rows.alias("bars"),
        last.alias("last_time"),
        last_of(tail, TAIL).alias("tail"),
        fast.alias("ema_fast"),
        slow.alias("ema_slow"),
        signal.alias("ema_signal"),
    ]


def indicator_state(
    bars: DataFrame, keys=("symbol",), time="time", ties=("exchange",), cell_seconds=None, macd: Macd = Macd()
) -> DataFrame:
    """State after all of ``bars``."""
    done = series_summary(bars, keys, time, ties, cell_seconds, macd)
    return done.select(*_state(F.col("_rows"), F.col("_last"), F.col("_tail"), *final_state(macd), keys))


def advance_state(
    state: DataFrame, new_bars: DataFrame, keys=("symbol",), time="time", ties=("exchange",),
    cell_seconds=None, macd: Macd = Macd(),
) -> DataFrame:
    """State after ``new_bars``; keys may appear or rest. Bars not newer than their key's state end the job with an error.

    Both sides hold one row per key at the join.
    """
    joined = state.join(series_summary(new_bars, keys, time, ties, cell_seconds, macd), list(keys), "full")
    too_old = F.lit("bars are not newer than the state of their series")
    last = F.when(F.col("_oldest") <= F.col("last_time"), F.raise_error(too_old).cast(state.schema["last_time"].dataType))
    last = last.otherwise(F.coalesce("_last", "last_time"))
    added = F.coalesce("_rows", F.lit(0))
    start = state_of(F.coalesce("ema_fast", "_first"), F.coalesce("ema_slow", "_first"), F.coalesce("ema_signal", F.lit(0.0)))
    zero = state_of(F.lit(0.0), F.lit(0.0), F.lit(0.0))
    ema = macd.after(start, added, F.coalesce("_added", zero))
    empty = F.array().cast("array<double>")
    tail = F.concat(F.coalesce("tail", empty), F.coalesce("_tail", empty))
    rows = F.coalesce("bars", F.lit(0)) + added
    return joined.select(*_state(rows, last, tail, *[ema[name] for name in STATE], keys))


def replayed_state(
    ladder: DataFrame, bars: DataFrame, changes: DataFrame, keys=("symbol",), time="time", ties=("exchange",),
    cell_seconds=None, macd: Macd = Macd(),
) -> DataFrame:
    """State after bars that were changed, added or removed in the past.

    ``ladder`` holds states of several days (``as_of``), ``changes`` has per key ``changed_from``, the time of its earliest
    changed bar. A key without changes keeps its newest state; any other starts from the newest one that ends before
    its change (from nothing, if none does) and replays only its bars since. Keys without any bar left have no state.
    """
    by = list(keys)
    columns = [name for name in ladder.columns if name != "as_of"]
    newest = lambda rows: rows.groupBy(*by).agg(F.max_by(F.struct(*columns), "as_of").alias("_state")).select("_state.*")
    changes = changes.groupBy(*by).agg(F.min("changed_from").alias("changed_from"))
    kept = newest(ladder.join(changes, by, "left_anti"))
    base = newest(ladder.join(changes, by).filter(F.col("last_time") < F.col("changed_from")).select(*ladder.columns))
    starts = changes.join(base.select(*by, F.col("last_time").alias("_since")), by, "left").select(*by, "_since")
    again = bars.join(starts, by).filter(F.col("_since").isNull() | (F.col(time) > F.col("_since"))).drop("_since")
    return kept.unionByName(advance_state(base, again.select(*bars.columns), keys, time, ties, cell_seconds, macd))


def snapshot(state: DataFrame, keys=("symbol",)) -> DataFrame:
    """The ten indicators of each key's newest bar, computed from the state alone."""
    columns = state_columns(F.col("bars"), F.col("tail"), F.col("ema_fast"), F.col("ema_slow"), F.col("ema_signal"))
    newest = [F.col("last_time").alias("time"), F.element_at("tail", -1).alias("close")]
    return state.select(*keys, *newest, *[value.alias(name) for name, value in columns.items()])
