"""Ordered-series building blocks that keep no whole series in one task.

A plain ``Window.partitionBy(symbol)`` sends all rows of a symbol to one task. Here a
series is cut twice, each cut an ordinary hash shuffle:

1. ``number_rows`` ranks rows inside time cells ``(key, cell)`` and adds the row counts of
   the earlier cells, which gives the rank in the whole series;
2. ``with_halo`` groups ranks into blocks of fixed length and copies the last rows of each
   block into the next one, so a window over ``(key, block)`` sees every row its frame needs.

Keys must not be null (ticks without a symbol are dead letters).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickloom.session import materialise

DAY = 86_400
#: Rows of a key that a cell should hold.
CELL_ROWS = 4096


def cells_of(df: DataFrame, keys: tuple[str, ...], time: str = "time") -> DataFrame:
    """Per key ``_start`` (its first second) and ``_length``, the seconds that hold about ``CELL_ROWS`` of its rows.

    Each key has cells of its own length, so a dense key does not cut a sparse one into single rows. One partially
    aggregated pass, whose result is written aside: Spark then knows its size and sends it to the tasks where it is small.
    """
    seconds = F.unix_seconds(F.col(time).cast("timestamp"))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(seconds).alias("_start"), F.max(seconds).alias("_end"))
    length = F.ceil(CELL_ROWS * (F.col("_end") - F.col("_start") + 1) / F.col("_n"))
    return materialise(per_key.select(*keys, "_start", F.greatest(F.lit(1), length).cast("bigint").alias("_length")), "cells")


def with_cells(df: DataFrame, keys: tuple[str, ...], time: str = "time", cell_seconds: int | None = None) -> DataFrame:
    """Add ``_cell``, the number of the time cell that a row of its key lies in."""
    seconds = F.unix_seconds(F.col(time).cast("timestamp"))
    if cell_seconds is not None:
        return df.withColumn("_cell", F.floor(seconds / cell_seconds))
    own = df.join(cells_of(df, keys, time), list(keys))
    return own.withColumn("_cell", F.floor((seconds - F.col("_start")) / F.col("_length"))).drop("_start", "_length")


def number_rows(
    df: DataFrame,
    keys: tuple[str, ...],
    time: str = "time",
    ties: tuple[str, ...] = (),
    cell_seconds: int | None = None,
) -> DataFrame:
    """Add ``_n`` (1 = oldest row of the key) and ``_total`` (rows of the key).

    Rows order by ``time`` then ``ties``. ``cell_seconds`` is the time span one task ranks
    at once; without it, it follows from each key's rows (``cells_of``). The per-cell counts are the
    only thing scanned per key.
    """
    celled = with_cells(df, keys, time, cell_seconds)
    in_cell = Window.partitionBy(*keys, "_cell").orderBy(time, *ties)
    of_key = Window.partitionBy(*keys)
    earlier = of_key.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = celled.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = counts.select(
        *keys,
        "_cell",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(of_key).alias("_total"),
    )
    ranked = celled.withColumn("_rank", F.row_number().over(in_cell))
    return (
        ranked.join(offsets, [*keys, "_cell"])
        .withColumn("_n", F.col("_before") + F.col("_rank"))
        .drop("_cell", "_before", "_rank")
    )


def block_of(block_rows: int) -> Column:
    """Zero-based block of the row numbered ``_n``."""
    return F.floor((F.col("_n") - 1) / block_rows)


def with_halo(numbered: DataFrame, block_rows: int, halo: int) -> DataFrame:
    """Add ``_block`` and ``_own``; the last ``halo`` rows of a block reappear, not owned, in the next."""
    if not 0 <= halo <= block_rows:
        raise ValueError("the halo must fit into one block")
    own = block_of(block_rows)
    to_end = (own + 1) * block_rows - F.col("_n")
    has_next = F.col("_total") > (own + 1) * block_rows
    blocks = F.when(has_next & (to_end < halo), F.array(own, own + 1)).otherwise(F.array(own))
    return numbered.withColumn("_block", F.explode(blocks)).withColumn("_own", F.col("_block") == own)


def block_window(keys: tuple[str, ...]):
    return Window.partitionBy(*keys, "_block").orderBy("_n")


def with_previous(
    df: DataFrame,
    column: str,
    name: str,
    keys: tuple[str, ...],
    time: str = "time",
    ties: tuple[str, ...] = (),
    cell_seconds: int | None = None,
    block_rows: int = 1024,
) -> DataFrame:
    """Add the previous row's ``column`` as ``name`` (null on the oldest row)."""
    blocks = with_halo(number_rows(df, keys, time, ties, cell_seconds), block_rows, 1)
    return (
        blocks.withColumn(name, F.lag(column, 1).over(block_window(keys)))
        .filter("_own")
        .drop("_n", "_total", "_block", "_own")
    )


def latest_rows(
    df: DataFrame, keys: tuple[str, ...], time: str = "time", ties: tuple[str, ...] = ()
) -> DataFrame:
    """The newest row per key; ``ties`` (descending) make the order total.

    Spark limits each task's rows to one per key before the shuffle.
    """
    newest = Window.partitionBy(*keys).orderBy(F.col(time).desc(), *[F.col(name).desc() for name in ties])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
