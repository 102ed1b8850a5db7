"""Quality gate over bars and the tick faults they count: one aggregate, one row per check."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

CRITICAL, WARNING = "critical", "warning"

# Per check: severity, what is counted, and how many of it fail.
CHECKS = {
    "price not positive": (CRITICAL, "ticks", lambda: F.sum("bad_prices")),
    "negative volume": (CRITICAL, "ticks", lambda: F.sum("bad_volumes")),
    "high below low": (CRITICAL, "bars", lambda: F.count_if(F.col("high") < F.col("low"))),
    "close outside range": (WARNING, "bars", lambda: F.count_if(~F.col("close").between(F.col("low"), F.col("high")))),
    "open outside range": (WARNING, "bars", lambda: F.count_if(~F.col("open").between(F.col("low"), F.col("high")))),
    "negative bar volume": (CRITICAL, "bars", lambda: F.count_if(F.col("volume") < 0)),
    "fewer than two ticks": (WARNING, "bars", lambda: F.count_if(F.col("ticks") < 2)),
}


def quality_report(bars: DataFrame) -> DataFrame:
    """``check, severity, rows, failed`` for every check.

    ``bars`` come from ``ohlcv(..., fault_counts=True)``, so the ticks are read only once.
    """
    totals = bars.agg(
        F.coalesce(F.sum("ticks"), F.lit(0)).alias("ticks"),
        F.count(F.lit(1)).alias("bars"),
        *[F.coalesce(failed(), F.lit(0)).alias(name) for name, (_, _, failed) in CHECKS.items()],
    )
    lines = [
        F.struct(
            F.lit(name).alias("check"),
            F.lit(severity).alias("severity"),
            F.col(counted).alias("rows"),
            F.col(f"`{name}`").alias("failed"),
        )
        for name, (severity, counted, _) in CHECKS.items()
    ]
    return totals.select(F.inline(F.array(*lines)))


def gate(report: DataFrame) -> None:
    """Raise when a critical check failed. The report has a fixed handful of rows."""
    broken = report.filter((F.col("severity") == CRITICAL) & (F.col("failed") > 0)).collect()
    if broken:
        raise ValueError("; ".join(f"{row['check']}: {row['failed']} of {row['rows']}" for row in broken))
