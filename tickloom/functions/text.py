"""Text rendering of alert rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def alert_text(timestamp, symbol, message, price, pct_change, field, value) -> Column:
    """One printable line per hit; a missing price or change prints as 0.00."""
    return F.format_string(
        "[ALERT %s] %-10s | %s | price=%.2f  pct=%+.2f%%  %s=%s",
        F.substring(F.coalesce(timestamp, F.lit("")), 1, 19),
        F.coalesce(symbol, F.lit("")),
        message,
        F.coalesce(price, F.lit(0.0)),
        F.coalesce(pct_change, F.lit(0.0)),
        field,
        value,
    )
