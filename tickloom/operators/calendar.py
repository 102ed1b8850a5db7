"""Daily partitions: calendar, gaps, freshness, backfill ranges and retention."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom import fixed_values as fixed
from tickloom.functions.coerce import utc_date
from tickloom.operators.bars import as_date, day_filter


def today(zone: str = fixed.CALENDAR_ZONE) -> date:
    return datetime.now(ZoneInfo(zone)).date()


def target_day(day: str | None = None, lookback_days: int = fixed.LOOKBACK_DAYS) -> date:
    """The day a daily job works on: the given one, else ``lookback_days`` before today (UTC)."""
    return as_date(day) if day else today("UTC") - timedelta(days=lookback_days)


def day_texts(day: date) -> tuple[str, str, str]:
    """Zero-padded year, month and day."""
    return f"{day:%Y}", f"{day:%m}", f"{day:%d}"


def partition_calendar(spark: SparkSession, first=fixed.CALENDAR_START, last=None) -> DataFrame:
    """One row per calendar day ``first``..``last`` (both inclusive; default: today in the calendar's zone)."""
    first, last = as_date(first), today() if last is None else as_date(last)
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("event_date"))


def calendar_of(df: DataFrame, day: Column) -> DataFrame:
    """One row per day from the table's first to its last day."""
    ends = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return ends.filter("first is not null").select(
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("event_date")
    )


def present_days(df: DataFrame, day: Column) -> DataFrame:
    return df.select(day.alias("event_date")).distinct()


def missing_days(calendar: DataFrame, df: DataFrame, day: Column) -> DataFrame:
    """Calendar days on which ``df`` has no row."""
    return calendar.join(present_days(df, day), "event_date", "left_anti")


def has_day(df: DataFrame, day, time: str = "time") -> bool:
    """Whether any row falls on the UTC day; reads no more than one matching row."""
    return not day_filter(df, day, time=time).isEmpty()


def freshness(calendar: DataFrame, ticks: DataFrame, bars: DataFrame) -> DataFrame:
    """Per calendar day: tick and bar counts and whether each is there.

    Each side is reduced to one row per day before the joins.
    """
    def per_day(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(utc_date(F.col("time")).alias("event_date")).agg(F.count(F.lit(1)).alias(name))

    joined = calendar.join(per_day(ticks, "ticks"), "event_date", "left").join(
        per_day(bars, "bars"), "event_date", "left"
    )
    return joined.select(
        "event_date",
        F.coalesce("ticks", F.lit(0)).alias("ticks"),
        F.coalesce("bars", F.lit(0)).alias("bars"),
        F.when(F.col("ticks").isNull(), F.lit("no ticks"))
        .when(F.col("bars").isNull(), F.lit("no bars"))
        .otherwise(F.lit("ok"))
        .alias("state"),
    )


def look_back(df: DataFrame, as_of, days: int = fixed.INDICATOR_LOOKBACK_DAYS, time: str = "time") -> DataFrame:
    """Rows of the ``days`` calendar days before ``as_of`` and of that day."""
    as_of = as_date(as_of)
    return day_filter(df, as_of - timedelta(days=days), as_of, time)


def midnight(df: DataFrame, day: date, time: str) -> Column:
    """The start of a UTC day as a literal of the time column's own type."""
    kind = df.schema[time].dataType
    if kind.typeName() == "timestamp":
        return F.lit(datetime(day.year, day.month, day.day, tzinfo=timezone.utc))
    return F.lit(day).cast(kind)


def retained(df: DataFrame, as_of, days: int = fixed.RAW_RETENTION_DAYS, time: str = "time") -> DataFrame:
    """Rows no older than ``days`` days before ``as_of``."""
    start = as_date(as_of) - timedelta(days=days)
    kept = df.filter(F.col(time) >= midnight(df, start, time))
    return kept.filter(F.col("event_date") >= F.lit(start)) if "event_date" in df.columns else kept


def up_to(df: DataFrame, as_of, time: str = "time") -> DataFrame:
    """Rows before the end of the UTC day ``as_of``; a partitioned ``event_date`` is bounded too, which prunes directories."""
    as_of = as_date(as_of)
    kept = df.filter(F.col(time) < midnight(df, as_of + timedelta(days=1), time))
    return kept.filter(F.col("event_date") <= F.lit(as_of)) if "event_date" in df.columns else kept
