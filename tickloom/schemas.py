"""Table contracts as DDL strings (Spark accepts them wherever a schema is expected)."""

ENVELOPE = (
    "event_type string, symbol string, exchange string, timestamp string, source string, "
    "payload map<string,string>"
)

TICK = (
    "time timestamp, symbol string, exchange string, price double, change double, "
    "pct_change double, volume bigint, bid double, ask double"
)
TICK_COLUMNS = ["time", "symbol", "exchange", "price", "change", "pct_change", "volume", "bid", "ask"]

BAR = (
    "time timestamp, symbol string, exchange string, open double, high double, low double, "
    "close double, volume bigint, asset_class string"
)
BAR_COLUMNS = ["time", "symbol", "exchange", "open", "high", "low", "close", "volume", "asset_class"]

INDICATOR_COLUMNS = [
    "sma20", "sma50", "sma200", "bb_mid", "bb_upper", "bb_lower", "rsi14",
    "macd", "macd_signal", "macd_hist",
]

RULE = (
    "source string, symbol string, field string, operator string, threshold double, message string"
)

DEAD_LETTER = "reason string, message string, event_type string, ingest_ts timestamp"
