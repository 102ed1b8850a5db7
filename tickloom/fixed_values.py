"""The constants that decide results, kept together as plain text.

Nothing here is derived; changing a value changes what the operators compute.
"""

# Topics, event types and the source prefix of each asset class.
TOPICS = ["stock.price.realtime", "crypto.price.realtime"]
PRICE_SNAPSHOT = "price.snapshot"
SOURCE_PREFIXES = {"vnstock": "stock", "ccxt": "crypto"}
UNKNOWN_ASSET_CLASS = "unknown"
UNKNOWN_SYMBOL = "UNKNOWN"
DEFAULT_SOURCE = "vnstock/KBS"
CRYPTO_SOURCE_PREFIX = "ccxt/"

# Payload fields of a price snapshot and the board columns that fill them.
PAYLOAD_DOUBLES = ["price", "change", "pct_change", "bid", "ask"]
PAYLOAD_BIGINTS = ["volume"]
STOCK_BOARD_COLUMNS = {
    "price": "close_price",
    "change": "price_change",
    "pct_change": "percent_change",
    "volume": "volume_accumulated",
    "bid": "bid_price_1",
    "ask": "ask_price_1",
}
CRYPTO_TICKER_COLUMNS = {
    "price": "last",
    "change": "change",
    "pct_change": "percentage",
    "volume": "quoteVolume",
    "bid": "bid",
    "ask": "ask",
}

# Polled instruments.
STOCK_EXCHANGE = "HOSE"
STOCK_SYMBOLS = ["VCB", "ACB", "TCB", "VNM", "HPG", "VIC"]
CRYPTO_EXCHANGE = "binance"
CRYPTO_SYMBOLS = ["BTC/USDT", "ETH/USDT", "BNB/USDT", "SOL/USDT"]

# Indicator windows, minimum history and EMA spans.
SMA_BARS = [20, 50, 200]
BOLLINGER_BARS = 20
BOLLINGER_WIDTH = 2
RSI_BARS = 14
MACD_FAST = 12
MACD_SLOW = 26
MACD_SIGNAL = 9
MACD_MIN_BARS = 26

# Landing, retention and calendar.
LANDING_INTERVAL = "30 seconds"
LANDING_ROWS = 500
LOOKBACK_DAYS = 0
RAW_RETENTION_DAYS = 30
INDICATOR_LOOKBACK_DAYS = 200
CALENDAR_START = "2026-05-01"
CALENDAR_ZONE = "Asia/Ho_Chi_Minh"

# Alert rules: operators and the shipped rule set.
RULE_OPERATORS = ["<", ">", "<=", ">=", "=="]
ALERT_RULES = [
    {"source": "stock", "symbol": "*", "field": "pct_change", "operator": "<=", "threshold": -3.0, "message": "Sharp drop — down 3% or more"},
    {"source": "stock", "symbol": "*", "field": "pct_change", "operator": ">=", "threshold": 3.0, "message": "Sharp rise — up 3% or more"},
    {"source": "stock", "symbol": "VCB", "field": "pct_change", "operator": "<=", "threshold": -2.0, "message": "VCB dropped 2% or more"},
    {"source": "stock", "symbol": "VCB", "field": "pct_change", "operator": ">=", "threshold": 2.0, "message": "VCB rose 2% or more"},
    {"source": "crypto", "symbol": "*", "field": "pct_change", "operator": "<=", "threshold": -5.0, "message": "Sharp drop — down 5% or more"},
    {"source": "crypto", "symbol": "*", "field": "pct_change", "operator": ">=", "threshold": 5.0, "message": "Sharp rise — up 5% or more"},
    {"source": "crypto", "symbol": "BTC/USDT", "field": "pct_change", "operator": "<=", "threshold": -3.0, "message": "BTC dropped 3% or more"},
    {"source": "crypto", "symbol": "BTC/USDT", "field": "pct_change", "operator": ">=", "threshold": 3.0, "message": "BTC rose 3% or more"},
    {"source": "crypto", "symbol": "ETH/USDT", "field": "pct_change", "operator": "<=", "threshold": -3.0, "message": "ETH dropped 3% or more"},
    {"source": "crypto", "symbol": "ETH/USDT", "field": "pct_change", "operator": ">=", "threshold": 3.0, "message": "ETH rose 3% or more"},
    {"source": "*", "symbol": "*", "field": "price", "operator": "==", "threshold": 0.0, "message": "Price is zero — possible data issue"},
]
