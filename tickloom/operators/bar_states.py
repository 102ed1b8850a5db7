"""Bars as mergeable states, so that late ticks cost a small merge and not a day's rescan.

A state row holds what a bar needs of its ticks: the first and the last instant with their prices, extremes, volumes and
counts. States of any lots of ticks merge in any order to the state of all of them; ``bars_of`` reads the bars off.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tickloom import fixed_values as fixed, schemas
from tickloom.functions.coerce import asset_class_of_symbol, utc_trunc
from tickloom.operators.bars import VOLUME_MODES

KEYS = ("symbol", "exchange")


def bar_states(ticks: DataFrame, keys: tuple[str, ...] = KEYS, unit: str = "day") -> DataFrame:
    """One state per key and ``unit`` from a lot of ticks, partially aggregated before the shuffle."""
    landed = "asset_class" in ticks.columns
    instant, traded = F.struct("time", "price"), F.struct("time", "volume")
    known = F.when(F.col("asset_class") != fixed.UNKNOWN_ASSET_CLASS, F.col("asset_class")) if landed else F.lit(None).cast("string")
    naive = ticks.schema["time"].dataType.typeName() == "timestamp_ntz"
    start = F.date_trunc(unit, "time") if naive else utc_trunc(unit, F.col("time"))
    return ticks.groupBy(*keys, start.alias("bar_time")).agg(
        F.min(instant).alias("first"),
        F.max(instant).alias("last"),
        F.max(traded).alias("last_traded"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.sum("volume").alias("volume"),
        F.max("volume").alias("largest_volume"),
        F.count(F.lit(1)).alias("ticks"),
        F.min(known).alias("known_class"),
        (F.min("asset_class") if landed else F.lit(None).cast("string")).alias("any_class"),
    )


def merged(*states: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """States of several lots as those of all their ticks."""
    rows = reduce(lambda one, two: one.unionByName(two), states)
    least, greatest, total = ("first", "low", "known_class", "any_class"), ("last", "last_traded", "high", "largest_volume"), ("volume", "ticks")
    cells = {**{n: F.min(n) for n in least}, **{n: F.max(n) for n in greatest}, **{n: F.sum(n) for n in total}}
    names = [name for name in states[0].columns if name in cells]
    return rows.groupBy(*keys, "bar_time").agg(*[cells[name].alias(name) for name in names])


def bars_of(states: DataFrame, keys: tuple[str, ...] = KEYS, volume: str = "sum") -> DataFrame:
    """The bars of merged states, as ``bars.ohlcv`` makes them from the ticks."""
    if volume not in VOLUME_MODES:
        raise ValueError(f"volume must be one of {VOLUME_MODES}, not {volume!r}")
    volumes = {"sum": F.col("volume"), "max": F.col("largest_volume"), "last": F.col("last_traded")["volume"]}
    by_symbol = asset_class_of_symbol(F.col("symbol")) if "symbol" in keys else F.lit(None).cast("string")
    bars = states.select(
        F.col("bar_time").alias("time"),
        *keys,
        F.col("first")["price"].alias("open"),
        "high",
        "low",
        F.col("last")["price"].alias("close"),
        volumes[volume].alias("volume"),
        F.coalesce("known_class", "any_class", by_symbol).alias("asset_class"),
        "ticks",
    )
    ordered = [name for name in schemas.BAR_COLUMNS if name in bars.columns]
    return bars.select(*ordered, *[name for name in bars.columns if name not in ordered])
