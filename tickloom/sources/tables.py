"""Stored tables: partitioned layouts, idempotent day writes, pruned reads.

``fmt`` is any Spark file format, or ``avro.FORMAT`` for Avro files without a module. Raw ticks default to Parquet; pass
``"avro"`` where the spark-avro module is on the class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickloom.functions.coerce import date_parts, utc_date
from tickloom.operators.bars import as_date, day_filter
from tickloom.session import materialise
from tickloom.sources import avro

DAY_LAYOUT = ("event_date",)
YMD_LAYOUT = ("year", "month", "day")
LAYOUTS = {"day": DAY_LAYOUT, "ymd": YMD_LAYOUT}


def with_layout(df: DataFrame, layout: str = "day", time: str = "time") -> DataFrame:
    """Add the partition columns of the layout, derived from the row's own UTC time."""
    if layout == "ymd":
        return df.select("*", *date_parts(F.col(time)))
    return df.withColumn("event_date", utc_date(F.col(time)))


def write_days(
    df: DataFrame,
    path: str,
    layout: str = "day",
    by: tuple[str, ...] = ("asset_class",),
    sort: tuple[str, ...] = ("symbol", "time"),
    time: str = "time",
    fmt: str = "parquet",
) -> None:
    """Replace the touched partitions of ``path``; a re-run of a day leaves the same files' content.

    The rebalance gathers each partition into few files and splits the ones too large for
    one task; rows are sorted inside files so that a symbol filter skips row groups.
    Partitions without a row in ``df`` stay as they are.
    """
    partitions = [*[name for name in by if name in df.columns], *LAYOUTS[layout]]
    laid = with_layout(df, layout, time)
    order = [*partitions, *[name for name in sort if name in laid.columns]]
    dealt = laid.hint("rebalance", *partitions).sortWithinPartitions(*order)
    if fmt == avro.FORMAT:
        avro.write(dealt, path, tuple(partitions), overwrite=True)
        return
    (
        dealt.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .format(fmt)
        .save(path)
    )


def compact_days(spark: SparkSession, path: str, first, last=None, layout: str = "day", **options) -> None:
    """Rewrite the days ``first``..``last`` as few files each, which a landing stream has left as many small ones.

    The rows are kept aside first, so a rewrite that fails loses nothing. Meant for days that nothing writes to any more.
    """
    days = read_days(spark, path, first, last, layout)
    aside = materialise(days.drop(*[name for name in LAYOUTS[layout] if name in days.columns]), "compacted")
    if not aside.isEmpty():
        write_days(aside, path, layout, **options)


def read_table(spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Read a partitioned table; with a ``schema`` nothing is inferred from files."""
    if fmt == avro.FORMAT:
        return avro.read(spark, path, schema)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def read_days(
    spark: SparkSession, path: str, first, last=None, layout: str = "day", time: str = "time",
    schema: str | None = None, fmt: str = "parquet",
) -> DataFrame:
    """Rows of the UTC days ``first``..``last``; only their directories are listed for reading."""
    table = read_table(spark, path, schema, fmt)
    picked = day_filter(table, first, last, time)
    if layout != "ymd":
        return picked
    first, last = as_date(first), as_date(first if last is None else last)
    # Partition values read back as numbers, which order like dates when combined.
    number = F.col("year").cast("int") * 10000 + F.col("month").cast("int") * 100 + F.col("day").cast("int")
    bounds = [int(f"{day:%Y%m%d}") for day in (first, last)]
    return picked.filter(number.between(*bounds))


def write_snapshot(df: DataFrame, path: str, as_of, layout: str = "day", fmt: str = "parquet") -> None:
    """Write a result as the partition ``as_of`` of ``path``, replacing an earlier one."""
    as_of = as_date(as_of)
    old = [name for name in ("event_date", "year", "month", "day", "as_of") if name in df.columns]
    dated = df.drop(*old).withColumn("as_of", F.lit(as_of))
    if layout == "ymd":
        dated = dated.select("*", *date_parts(F.col("as_of"))).drop("as_of")
    partitions = list(YMD_LAYOUT) if layout == "ymd" else ["as_of"]
    (
        dated.hint("rebalance")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .format(fmt)
        .save(path)
    )


def lookup(snapshots: DataFrame, as_of, symbol: str | None = None) -> DataFrame:
    """Indicators of one run day, optionally of one symbol; prunes to that day's partition."""
    rows = snapshots.filter(F.col("as_of") == F.lit(as_date(as_of)))
    return rows.filter(F.col("symbol") == symbol) if symbol else rows


def write_rows(df: DataFrame, path: str, schema: str | None = None) -> None:
    """Snappy Parquet with an explicit schema: columns are reordered and cast to fit it."""
    from pyspark.sql.types import StructType

    fitted = df.to(StructType.fromDDL(schema)) if schema else df
    fitted.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_text(df: DataFrame, path: str, column: str = "value") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode("append").text(path)


def write_json(df: DataFrame, path: str, by: tuple[str, ...] = ()) -> None:
    df.write.mode("append").partitionBy(*by).json(path)
