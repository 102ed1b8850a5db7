"""Scalar coercions as Column -> Column helpers; all run inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tickloom import fixed_values as fixed


# What Spark's cast takes but a plain float literal does not: type suffixes and hexadecimal
# floats; and digit groups that are not joined by single underscores.
NOT_A_NUMBER = r"(?i)[0-9.][df]\s*$|x|^_|__|_$|[^0-9]_|_[^0-9]"


def number(value: Column, text: bool = True) -> Column:
    """A double, or null for what is no number; ``text=False`` says the column is numeric already."""
    if not text:
        return value.cast("double")
    value = value.cast("string")
    unusual = F.when(~value.rlike(NOT_A_NUMBER), F.translate(value, "_", "").try_cast("double"))
    # Most texts have none of these letters and take one cheap test and one cast.
    return F.when(value.rlike("[_dDfFxX]"), unusual).otherwise(value.try_cast("double"))


def to_double(value: Column, default: float = 0.0, text: bool = True) -> Column:
    """Null and unparsable values become ``default``; ``nan`` and ``inf`` texts are kept.

    ``text=False`` says that the column is numeric already.
    """
    return F.coalesce(number(value, text), F.lit(float(default)))


def to_bigint(value: Column, default: int = 0, text: bool = True) -> Column:
    """Read as a double, truncate toward zero; null, unparsable, NaN or out of range -> default."""
    return F.coalesce(number(value, text).try_cast("bigint"), F.lit(default).cast("bigint"))


def beyond_bigint(value: Column) -> Column:
    """True for a double (not NaN) that no bigint can hold, such as ``inf`` or ``1e30``."""
    limit = float(2**63)
    return F.coalesce((value < -limit) | ((value >= limit) & (value <= float("inf"))), F.lit(False))


def to_iso_text(value: Column) -> Column:
    """A bare ``yyyy-MM-dd`` text gets midnight UTC appended; other texts pass unchanged."""
    text = value.cast("string")
    return F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00+00:00"))).otherwise(text)


def iso_text(value: Column) -> Column:
    """A timestamp value as ISO-8601 UTC text with microseconds."""
    return F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to a timestamp; offsets honoured, naive text read in the session zone."""
    dated = (F.length(text) >= 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    return F.when(dated, text.try_cast("timestamp"))


def asset_class_of_source(source: Column) -> Column:
    """Asset class from the prefix of the source text."""
    known = [F.when(F.startswith(source, F.lit(prefix)), F.lit(name)) for prefix, name in fixed.SOURCE_PREFIXES.items()]
    return F.coalesce(*known, F.lit(fixed.UNKNOWN_ASSET_CLASS))


def asset_class_of_symbol(symbol: Column) -> Column:
    """Pairs such as ``BTC/USDT`` are crypto, everything else is a stock."""
    return F.when(F.contains(symbol, F.lit("/")), F.lit("crypto")).otherwise(F.lit("stock"))


def symbol_key(symbol: Column) -> Column:
    """A symbol safe for message keys and paths."""
    return F.replace(F.coalesce(symbol, F.lit(fixed.UNKNOWN_SYMBOL)), F.lit("/"), F.lit("-"))


DAY_MICROS = 86_400_000_000


def utc_date(time: Column) -> Column:
    """The UTC day of a timestamp, whatever the session's zone; a date stays as it is."""
    instant = F.floor(F.unix_micros(time.try_cast("timestamp")) / DAY_MICROS).cast("int")
    return F.when(F.typeof(time) == "timestamp", F.date_from_unix_date(instant)).otherwise(time.try_cast("date"))


def utc_trunc(unit: str, time: Column) -> Column:
    """The start of the UTC ``unit`` (a ``date_trunc`` unit) that holds a timestamp, whatever the session's zone."""
    sizes = {"day": DAY_MICROS, "hour": 3_600_000_000, "minute": 60_000_000, "second": 1_000_000}
    micros = F.unix_micros(time.cast("timestamp"))
    if unit.lower() in sizes:
        size = sizes[unit.lower()]
        return F.timestamp_micros(F.floor(micros / size) * size)
    first = F.trunc(F.date_from_unix_date(F.floor(micros / DAY_MICROS).cast("int")), unit)
    return F.timestamp_micros(F.unix_date(first).cast("bigint") * DAY_MICROS)


def date_parts(time: Column) -> list[Column]:
    """Zero-padded ``year``, ``month`` and ``day`` texts of the UTC day, ``unknown`` for a null time."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    day = utc_date(time)
    return [F.coalesce(F.date_format(day, fmt), F.lit("unknown")).alias(name) for name, fmt in parts.items()]


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row, however often later steps refer to them.

    A plain projection is merged into later filters and projections, which repeats its
    expressions there; inline() keeps them as columns of their own.
    """
    derived = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(derived)))


def all_of(conditions) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def any_of(conditions) -> Column:
    return reduce(lambda left, right: left | right, conditions)
