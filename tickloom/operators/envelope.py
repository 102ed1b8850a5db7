"""Build price envelopes from board rows and turn them into keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tickloom import fixed_values as fixed
from tickloom.functions.coerce import iso_text, symbol_key, to_bigint, to_double


def envelope_columns(
    event_type, symbol, exchange, payload, timestamp=None, source=None
) -> list[Column]:
    """The six envelope columns; an empty timestamp means now, an absent source the stock feed."""
    now = iso_text(F.current_timestamp())
    stamped = now if timestamp is None else F.coalesce(F.nullif(timestamp, F.lit("")), now)
    return [
        event_type.alias("event_type"),
        symbol.alias("symbol"),
        exchange.alias("exchange"),
        stamped.alias("timestamp"),
        (F.lit(fixed.DEFAULT_SOURCE) if source is None else source).alias("source"),
        payload.alias("payload"),
    ]


def snapshot_payload(df: DataFrame, columns: dict[str, str]) -> Column:
    """Typed payload struct; a board without one of the columns yields that field's default."""
    kinds = dict(board_types(df))

    def cell(field: str) -> Column:
        name = columns[field]
        coerce = to_bigint if field in fixed.PAYLOAD_BIGINTS else to_double
        value = F.col(name) if name in kinds else F.lit(None).cast("string")
        return coerce(value, text=kinds.get(name, "string") == "string").alias(field)

    return F.struct(*[cell(field) for field in columns])


def board_types(df: DataFrame) -> list[tuple[str, str]]:
    """Column types, with everything that is not a number read as text."""
    numeric = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    return [(name, kind if kind.startswith(numeric) else "string") for name, kind in df.dtypes]


def normalise_stock_board(
    board: DataFrame,
    default_exchange: str = fixed.STOCK_EXCHANGE,
    timestamp: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Stock board rows -> key + envelope. ``keep`` passes extra board columns through."""
    symbol = F.upper(F.coalesce(F.col("symbol"), F.lit(fixed.UNKNOWN_SYMBOL)))
    listed = F.nullif(F.col("exchange"), F.lit("")) if "exchange" in board.columns else F.lit(None).cast("string")
    exchange = F.upper(F.coalesce(listed, F.lit(default_exchange)))
    return board.select(
        *keep,
        symbol.alias("key"),
        *envelope_columns(
            F.lit(fixed.PRICE_SNAPSHOT), symbol, exchange,
            snapshot_payload(board, fixed.STOCK_BOARD_COLUMNS), timestamp,
        ),
    )


def normalise_crypto_tickers(
    tickers: DataFrame,
    exchange_id: str = fixed.CRYPTO_EXCHANGE,
    timestamp: Column | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Exchange ticker rows -> key + envelope; the key has no slash."""
    symbol = F.col("symbol")
    return tickers.select(
        *keep,
        symbol_key(symbol).alias("key"),
        *envelope_columns(
            F.lit(fixed.PRICE_SNAPSHOT), symbol, F.lit(exchange_id.upper()),
            snapshot_payload(tickers, fixed.CRYPTO_TICKER_COLUMNS), timestamp,
            F.lit(fixed.CRYPTO_SOURCE_PREFIX + exchange_id),
        ),
    )


def to_messages(envelopes: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Envelopes -> ``key``, ``value`` (JSON text), ready for a topic or a file sink."""
    fields = ["event_type", "symbol", "exchange", "timestamp", "source", "payload"]
    return envelopes.select(*keep, "key", F.to_json(F.struct(*fields)).alias("value"))
