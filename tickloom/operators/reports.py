"""Market reports: daily digest, screener and volatility bursts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.functions.coerce import all_of
from tickloom.operators.alerts import COMPARISONS
from tickloom.operators.series import with_previous


def with_returns(
    bars: DataFrame, keys: tuple[str, ...] = ("symbol",), ties: tuple[str, ...] = ("exchange",), cell_seconds: int | None = None
) -> DataFrame:
    """Add ``prev_close`` and ``return_pct``, the change against the previous bar."""
    followed = with_previous(bars, "close", "prev_close", keys, ties=ties, cell_seconds=cell_seconds)
    return followed.withColumn(
        "return_pct",
        F.when(F.col("prev_close") != 0, (F.col("close") - F.col("prev_close")) / F.col("prev_close") * 100),
    )


def daily_digest(bars: DataFrame, top: int = 3, **series) -> DataFrame:
    """Per day the ``top`` gainers, losers and volumes: ``time, board, place, symbol, exchange, value``.

    Ranks break ties by symbol and exchange. Spark keeps no more than ``top`` rows per day
    and task before the shuffle.
    """
    change, volume = F.col("return_pct"), F.col("volume").cast("double")

    def entry(board: str, value, order):
        return F.struct(F.lit(board).alias("board"), value.alias("value"), order.alias("_order"))

    # Each bar enters up to three boards, so that the returns are computed once.
    entries = F.array(
        entry("gainers", F.when(change > 0, change), -change),
        entry("losers", F.when(change < 0, change), change),
        entry("volume", volume, -volume),
    )
    boards = with_returns(bars, **series).select("time", "symbol", "exchange", F.inline(entries))
    best = Window.partitionBy("time", "board").orderBy("_order", "symbol", "exchange")
    return (
        boards.filter("value is not null")
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= top)
        .select("time", "board", "place", "symbol", "exchange", "value")
    )


def screen(fundamentals: DataFrame, thresholds: list[dict]) -> DataFrame:
    """Rows that pass every threshold ``{field, operator, threshold}``; a null field fails.

    The thresholds become a conjunction of comparisons, which a Parquet scan can use.
    """
    unknown = [t["operator"] for t in thresholds if t["operator"] not in COMPARISONS]
    if unknown:
        raise ValueError(f"unknown operators {unknown}")
    if not thresholds:
        return fundamentals
    return fundamentals.filter(
        all_of(COMPARISONS[t["operator"]](F.col(t["field"]), F.lit(float(t["threshold"]))) for t in thresholds)
    )


def price_windows(ticks: DataFrame, length: str = "5 minutes", slide: str = "1 minute", lateness: str = "10 minutes") -> DataFrame:
    """Low, high and count of a symbol's ticks in sliding windows.

    Runs on a table or a stream; on a stream ``lateness`` bounds the state.
    """
    source = ticks.withWatermark("time", lateness) if ticks.isStreaming else ticks
    windows = source.groupBy(F.window("time", length, slide).alias("w"), "symbol").agg(
        F.min("price").alias("low"), F.max("price").alias("high"), F.count(F.lit(1)).alias("ticks")
    )
    return windows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "symbol", "low", "high", "ticks")


def bursts_of(windows: DataFrame, threshold_pct: float = 3.0) -> DataFrame:
    """Windows whose price range reaches ``threshold_pct`` of the low."""
    percent = F.when(F.col("low") > 0, (F.col("high") - F.col("low")) / F.col("low") * 100)
    return windows.withColumn("range_pct", percent).filter(F.col("range_pct") >= threshold_pct)


def volatility_bursts(
    ticks: DataFrame,
    length: str = "5 minutes",
    slide: str = "1 minute",
    threshold_pct: float = 3.0,
    lateness: str = "10 minutes",
) -> DataFrame:
    """Sliding windows in which a symbol's price range reaches ``threshold_pct`` of its low.

    In append mode a stream emits a window when the watermark has passed it. Where the open ones count too, feed
    ``price_windows`` into a keyed table and read ``bursts_of`` it: a window may pass the threshold, and with a lower
    price that is not positive fail it again.
    """
    return bursts_of(price_windows(ticks, length, slide, lateness), threshold_pct)
