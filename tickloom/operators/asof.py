"""As-of join: for each row the newest row of the other side at or before its time, without a range join.

Both sides are put into one series per key and cut into time cells (``series.cells_of``). A running last value inside a
cell answers most rows; for those before the cell's first value, each cell's last value is carried on along the cells
of its key, which are few. No task holds more than a cell, or one value per cell of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tickloom.operators.series import with_cells


def asof_join(
    left: DataFrame, right: DataFrame, keys: tuple[str, ...], time: str = "time", right_time: str | None = None,
    cell_seconds: int | None = None,
) -> DataFrame:
    """``left`` with the columns of ``right`` (all but the keys), null where no row of it is early enough.

    Of rows of ``right`` with one key and time the greatest in its other columns counts. Times may be dates or timestamps.
    """
    right_time = right_time or time
    values = [name for name in right.columns if name not in keys]
    if clash := set(values) & set(left.columns):
        raise ValueError(f"both sides have {sorted(clash)}")
    stamp = lambda name: F.col(name).cast("timestamp").alias("_time")
    value = F.struct(F.col(right_time).cast("timestamp").alias("_at"), *values)
    asked = left.select(*keys, stamp(time), F.struct(*left.columns).alias("_row"), F.lit(None).cast(_type(right, value)).alias("_value"))
    given = right.select(*keys, stamp(right_time), F.lit(None).cast(_type(left, F.struct(*left.columns))).alias("_row"), value.alias("_value"))
    rows = with_cells(asked.unionByName(given), keys, "_time", cell_seconds)
    # Values of an instant come before the rows that ask at that instant, the greatest last.
    in_cell = Window.partitionBy(*keys, "_cell").orderBy("_time", F.col("_row").isNotNull(), "_value")
    here = rows.withColumn("_found", F.last("_value", ignorenulls=True).over(in_cell.rowsBetween(Window.unboundedPreceding, 0)))
    of_cell = rows.groupBy(*keys, "_cell").agg(F.max("_value").alias("_latest"))
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = of_cell.select(*keys, "_cell", F.last("_latest", ignorenulls=True).over(earlier).alias("_carried"))
    answered = here.filter(F.col("_row").isNotNull()).join(carried, [*keys, "_cell"])
    found = F.coalesce("_found", "_carried")
    return answered.select(*[F.col("_row")[name].alias(name) for name in left.columns], *[found[name].alias(name) for name in values])


def _type(df: DataFrame, column):
    return df.select(column.alias("c")).schema["c"].dataType
