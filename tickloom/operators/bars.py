"""Open/high/low/close/volume bars from ticks, and the bar quality filter."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tickloom import fixed_values as fixed, schemas
from tickloom.functions.coerce import all_of, asset_class_of_symbol, utc_trunc

VOLUME_MODES = ("sum", "last", "max")


def as_date(day) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)


def day_filter(df: DataFrame, first, last=None, time: str = "time") -> DataFrame:
    """Rows of the UTC days ``first``..``last`` (both inclusive), as a half-open time range.

    The bounds carry the column's own type, so the range reaches the Parquet scan; a
    partitioned ``event_date`` column is restricted too, which prunes directories.
    """
    first = as_date(first)
    last = first if last is None else as_date(last)
    zone = None if df.schema[time].dataType.typeName() == "timestamp_ntz" else timezone.utc
    start = datetime(first.year, first.month, first.day, tzinfo=zone)
    end = datetime(last.year, last.month, last.day, tzinfo=zone) + timedelta(days=1)
    column = F.col(time)
    kind = df.schema[time].dataType
    picked = df.filter((column >= F.lit(start).cast(kind)) & (column < F.lit(end).cast(kind)))
    if "event_date" in df.columns:
        picked = picked.filter(F.col("event_date").between(F.lit(first), F.lit(last)))
    return picked


def ohlcv(
    ticks: DataFrame,
    keys: tuple[str, ...] = ("symbol", "exchange"),
    unit: str = "day",
    volume: str = "sum",
    unique_times: bool = False,
    dedupe: bool = False,
    fault_counts: bool = False,
) -> DataFrame:
    """One bar per key and ``unit`` (a ``date_trunc`` unit), cut at UTC whatever the session's zone.

    Open is the price of the earliest tick, close that of the latest; among ticks of one
    instant open takes the lowest and close the highest price. Partial aggregation runs
    before the shuffle, so a symbol holding most of the ticks still ships one row per
    task and bar. ``unique_times`` promises that no two ticks of a key share an instant
    (or that those doing so agree on the price); the aggregate is then hash based and
    about three times faster, as no tick needs sorting.
    ``volume``: ``sum`` of tick volumes, or ``last`` / ``max`` for a feed that reports a
    running total. ``dedupe`` first removes exact repeats of a tick. ``fault_counts`` adds
    the numbers of ticks with a price that is not positive and with a negative volume.
    """
    if volume not in VOLUME_MODES:
        raise ValueError(f"volume must be one of {VOLUME_MODES}, not {volume!r}")
    if dedupe:
        ticks = ticks.dropDuplicates([name for name in ticks.columns if name in schemas.TICK_COLUMNS])
    if unique_times:
        opening, closing = F.min_by("price", "time"), F.max_by("price", "time")
        last_volume = F.max_by("volume", "time")
    else:
        instant = F.struct("time", "price")
        opening, closing = F.min(instant)["price"], F.max(instant)["price"]
        last_volume = F.max(F.struct("time", "volume"))["volume"]
    volumes = {"sum": F.sum("volume"), "max": F.max("volume"), "last": last_volume}
    # The class is no part of the key: ticks of one series may be landed with several.
    landed = "asset_class" in ticks.columns and "asset_class" not in keys
    known = F.when(F.col("asset_class") != fixed.UNKNOWN_ASSET_CLASS, F.col("asset_class")) if landed else None
    classes = [F.coalesce(F.min(known), F.min("asset_class")).alias("asset_class")] if landed else []
    naive = ticks.schema["time"].dataType.typeName() == "timestamp_ntz"
    start = F.date_trunc(unit, "time") if naive else utc_trunc(unit, F.col("time"))
    bars = ticks.groupBy(*keys, start.alias("time")).agg(
        *classes,
        opening.alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        closing.alias("close"),
        volumes[volume].alias("volume"),
        F.count(F.lit(1)).alias("ticks"),
        *([F.count_if(F.col("price") <= 0).alias("bad_prices")] if fault_counts else []),
        *([F.count_if(F.col("volume") < 0).alias("bad_volumes")] if fault_counts else []),
    )
    if "asset_class" not in ticks.columns and "symbol" in keys:
        bars = bars.withColumn("asset_class", asset_class_of_symbol(F.col("symbol")))
    ordered = [name for name in schemas.BAR_COLUMNS if name in bars.columns]
    return bars.select(*ordered, *[name for name in bars.columns if name not in ordered])


def bar_is_valid() -> Column:
    """The bar invariants; a null, NaN or infinite price makes the bar invalid."""
    high, low = F.col("high"), F.col("low")
    finite = [F.abs(F.col(name)) < float("inf") for name in ("open", "high", "low", "close")]
    checks = [
        *finite,
        high >= low,
        high >= F.greatest("open", "close"),
        low <= F.least("open", "close"),
        F.col("volume") >= 0,
    ]
    return F.coalesce(all_of(checks), F.lit(False))


def valid_bars(bars: DataFrame, observation: Observation | None = None) -> DataFrame:
    """Keep bars that satisfy the invariants.

    An ``Observation`` receives ``bars`` and ``dropped`` in the same pass as the write,
    so counting costs no second scan.
    """
    if observation is not None:
        bars = bars.observe(
            observation,
            F.count(F.lit(1)).alias("bars"),
            F.count_if(~bar_is_valid()).alias("dropped"),
        )
    return bars.filter(bar_is_valid())


def rows_per_symbol(df: DataFrame, key: str = "symbol") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
