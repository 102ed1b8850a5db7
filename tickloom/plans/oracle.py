"""SQL twins of the registered queries, for DuckDB on the same tables.

Written from the operators' definitions, not from their Spark plans: EMAs are recursive,
alerts are a plain product of ticks and rules, messages are never parsed.
"""

from __future__ import annotations

from tickloom import fixed_values as fixed
from tickloom.plans import queries as q


def _text(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


EVENT = f"""
instruments AS (
  SELECT event_id, ts, ts AS "time", event_type, value,
         CAST(props->>'k' AS BIGINT) AS k,
         CASE WHEN user_id % 4 = 0 THEN ({_list(fixed.CRYPTO_SYMBOLS)})[(user_id // 4) % 4 + 1]
              ELSE ({_list(fixed.STOCK_SYMBOLS)})[user_id % 6 + 1] END AS symbol,
         CASE WHEN user_id % 4 = 0 THEN 'BINANCE' ELSE 'HOSE' END AS exchange,
         CASE WHEN user_id % 4 = 0 THEN 'ccxt/binance' ELSE 'vnstock/KBS' END AS source,
         CASE WHEN user_id % 4 = 0 THEN 'crypto' ELSE 'stock' END AS asset_class
  FROM events),
ticks AS (
  SELECT *, CASE WHEN event_type = 'error' AND k < 2 THEN 0.0::DOUBLE ELSE value END AS price,
         k * 0.25::DOUBLE AS change, CAST(k - 50 AS DOUBLE) / 5 AS pct_change, k AS volume,
         value - 0.25::DOUBLE AS bid, value + 0.25::DOUBLE AS ask
  FROM instruments),
mixed AS (
  SELECT * REPLACE (CASE WHEN event_id % 10 = 0 THEN 'unknown' WHEN event_id % 7 = 3 THEN 'crypto' ELSE asset_class END AS asset_class)
  FROM ticks),
odd AS (
  SELECT * REPLACE (CASE WHEN event_id % 97 = 0 THEN '*' ELSE symbol END AS symbol,
                    CASE WHEN event_id % 89 <> 0 THEN price END AS price) FROM ticks),
faulty AS (
  SELECT * REPLACE (CASE WHEN event_type = 'error' THEN -3 * k ELSE k END AS volume) FROM ticks)"""

DAY = "strftime({}, '%Y-%m-%d')"
INSTANT = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


def _bars(source: str, where: str = "TRUE") -> str:
    """Day bars; among equal times open is the lowest and close the highest price."""
    return f"""
bars AS (
  SELECT date_trunc('day', "time") AS "time", symbol, exchange, asset_class,
         arg_min(price, ("time", price)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, ("time", price)) AS "close", CAST(sum(volume) AS BIGINT) AS volume, count(*) AS ticks
  FROM {source} WHERE {where} GROUP BY ALL)"""


VALID = "high >= low AND high >= greatest(open, \"close\") AND low <= least(open, \"close\") AND volume >= 0"
SHOW_BARS = f"""
SELECT {DAY.format('"time"')} AS bar_date, symbol, exchange, asset_class, round(open, 4) AS open,
       round(high, 4) AS high, round(low, 4) AS low, round("close", 4) AS "close", volume FROM bars"""


def _bars_query(source: str = "ticks", where: str = "TRUE", having: str = "TRUE") -> str:
    return f"WITH {EVENT}, {_bars(source, where)} {SHOW_BARS} WHERE {having}"


IN_BACKFILL = f"\"time\" >= TIMESTAMP '{q.BACKFILL[0]}' AND \"time\" < TIMESTAMP '{q.BACKFILL[1]}' + INTERVAL 1 DAY"

SERIES = """
long_bars AS (
  SELECT date_trunc('day', o_orderdate) AS "time", o_orderpriority AS symbol, max(o_totalprice) AS "close"
  FROM orders WHERE day(o_orderdate) NOT IN (13, 27) GROUP BY ALL),
numbered AS (
  SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY symbol) AS total, lag("close") OVER w AS prev_close
  FROM {source} WINDOW w AS (PARTITION BY symbol ORDER BY "time")),
moves AS (
  SELECT *, CASE WHEN "close" > prev_close THEN "close" - prev_close ELSE 0 END AS gain,
         CASE WHEN "close" < prev_close THEN prev_close - "close" ELSE 0 END AS loss FROM numbered),
averages AS (
  SELECT *, avg("close") OVER (w ROWS 19 PRECEDING) AS a20, avg("close") OVER (w ROWS 49 PRECEDING) AS a50,
         avg("close") OVER (w ROWS 199 PRECEDING) AS a200, stddev_pop("close") OVER (w ROWS 19 PRECEDING) AS sd,
         avg(gain) OVER (w ROWS 13 PRECEDING) AS g, avg(loss) OVER (w ROWS 13 PRECEDING) AS l
  FROM moves WINDOW w AS (PARTITION BY symbol ORDER BY "time")),
rolled AS (
  SELECT "time", symbol, "close", n, total, prev_close, gain, loss,
         CASE WHEN n >= 20 THEN a20 END AS sma20, CASE WHEN n >= 50 THEN a50 END AS sma50,
         CASE WHEN n >= 200 THEN a200 END AS sma200, CASE WHEN n >= 20 THEN a20 END AS bb_mid,
         CASE WHEN n >= 20 THEN a20 + 2 * sd END AS bb_upper, CASE WHEN n >= 20 THEN a20 - 2 * sd END AS bb_lower,
         CASE WHEN n < 14 THEN NULL WHEN l = 0 THEN 100 ELSE 100 - 100 / (1 + g / l) END AS rsi14
  FROM averages),
emas AS (
  SELECT symbol, n, "close" AS fast, "close" AS slow, 0.0::DOUBLE AS signal FROM numbered WHERE n = 1
  UNION ALL
  SELECT symbol, n, fast, slow, 0.2::DOUBLE * (fast - slow) + 0.8::DOUBLE * signal AS signal
  FROM (SELECT b.symbol, b.n, e.signal,
               2.0::DOUBLE / 13 * b."close" + 11.0::DOUBLE / 13 * e.fast AS fast,
               2.0::DOUBLE / 27 * b."close" + 25.0::DOUBLE / 27 * e.slow AS slow
        FROM emas e JOIN numbered b ON b.symbol = e.symbol AND b.n = e.n + 1)),
lines AS (
  SELECT symbol, n, CASE WHEN n >= 26 THEN fast - slow END AS macd, CASE WHEN n >= 26 THEN signal END AS macd_signal,
         CASE WHEN n >= 26 THEN fast - slow - signal END AS macd_hist FROM emas)"""

BAR_DATE = DAY.format('"time"') + " AS bar_date, symbol"
MACD = "round(macd, 3) AS macd, round(macd_signal, 3) AS macd_signal, round(macd_hist, 3) AS macd_hist"
ALL_INDICATORS = f"""
SELECT {BAR_DATE}, round(sma20, 6) AS sma20, round(sma50, 6) AS sma50, round(sma200, 6) AS sma200,
       round(bb_mid, 6) AS bb_mid, round(bb_upper, 3) AS bb_upper, round(bb_lower, 3) AS bb_lower,
       {MACD}, round(rsi14, 4) AS rsi14
FROM rolled JOIN lines USING (symbol, n)"""


def _series(select: str, source: str = "long_bars") -> str:
    return "WITH RECURSIVE " + SERIES.replace("{source}", source) + select


def _rules(rules=fixed.ALERT_RULES) -> str:
    rows = ", ".join(
        f"({i}, {_text(r.get('source', '*'))}, {_text(r['symbol'])}, {_text(r['field'])}, {_text(r['operator'])},"
        f" {r['threshold']}::DOUBLE, {_text(r['message'])})"
        for i, r in enumerate(rules, 1)
    )
    return f'rules(rule_id, scope, instrument, field, "operator", threshold, message) AS (VALUES {rows})'


MET = """CASE "operator" WHEN '<' THEN v < threshold WHEN '>' THEN v > threshold WHEN '<=' THEN v <= threshold
         WHEN '>=' THEN v >= threshold WHEN '==' THEN v = threshold ELSE FALSE END"""
HITS = f"""
fields AS (
  SELECT t.*, r.*, CASE r.field WHEN 'price' THEN price WHEN 'pct_change' THEN pct_change
                                WHEN 'volume' THEN volume END AS v
  FROM {{source}} t JOIN rules r ON (r.scope = '*' OR r.scope = t.asset_class)
                                AND (r.instrument = '*' OR r.instrument = t.symbol)),
hits AS (SELECT * FROM fields WHERE {MET})"""


def _hits(select: str, source: str = "ticks", rules=fixed.ALERT_RULES, extra: str = "") -> str:
    return f"WITH RECURSIVE {EVENT}, {_rules(rules)}{extra}, {HITS.replace('{source}', source)} {select}"


SHOW_HITS = """
SELECT event_id, symbol, rule_id, message, field AS matched_field, round(v, 4) AS matched_value,
       round(price, 4) AS price, round(pct_change, 4) AS pct_change FROM hits"""

# What the messages carry: error events are damaged in ways that depend on k.
SENT = """
sent AS (
  SELECT * REPLACE (CASE WHEN event_type = 'error' AND k < 20 THEN NULL ELSE symbol END AS symbol),
         'e' || event_id AS "key",
         CASE WHEN event_type <> 'error' THEN NULL WHEN k < 20 THEN 'missing symbol' WHEN k < 40 THEN 'missing payload'
              WHEN k < 60 THEN 'bad timestamp' WHEN k < 80 THEN 'missing timestamp' ELSE 'volume out of range' END AS reason
  FROM ticks),
snapshots AS (SELECT * FROM sent WHERE event_type <> 'signup' AND reason IS DISTINCT FROM 'missing payload')"""
LANDED = f"""
SELECT "key", {INSTANT.format('"time"')} AS tick_time, symbol,
       CASE WHEN event_type = 'purchase' THEN '' ELSE exchange END AS exchange,
       round(price, 4) AS price, round(change, 4) AS change, round(pct_change, 4) AS pct_change,
       CASE WHEN k < 5 THEN 0 ELSE round(bid, 4) END AS bid, round(ask, 4) AS ask, volume, asset_class,
       {DAY.format('"time"')} AS event_date
FROM sent WHERE event_type <> 'signup' AND reason IS NULL"""
EVENT_LETTERS = "SELECT \"key\", reason, 'price.snapshot' AS event_type FROM sent WHERE reason IS NOT NULL"
CHAT_KEY = "'c' || conv_id || ':' || turn"
ALERT_LINE = """
printf('[ALERT %s] %-10s | %s | price=%.2f  pct=%+.2f%%  %s=%s',
  CASE WHEN reason = 'bad timestamp' THEN 'soon' WHEN reason = 'missing timestamp' THEN ''
       WHEN event_type = 'purchase' THEN strftime("time" + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S')
       ELSE strftime("time", '%Y-%m-%dT%H:%M:%S') END,
  coalesce(symbol, ''), message, price, pct_change, field, CAST(v AS VARCHAR)) AS alert"""


def _sent(select: str) -> str:
    return f"WITH {EVENT}, {SENT} {select}"


ISO = "strftime(\"time\", '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
NUMBER = "coalesce(try_cast({} AS DOUBLE), 0)"

CALENDAR_DAYS = f"""
days AS (SELECT unnest(generate_series(TIMESTAMP '{q.CALENDAR[0]}', TIMESTAMP '{q.CALENDAR[1]}', INTERVAL 1 DAY)) AS d)"""

DIGEST = f"""
returns AS (
  SELECT *, lag("close") OVER (PARTITION BY symbol ORDER BY "time", exchange) AS before FROM bars),
changes AS (
  SELECT *, CASE WHEN before <> 0 THEN ("close" - before) / before * 100 END AS pct FROM returns),
boards AS (
  SELECT "time", 'gainers' AS board, symbol, exchange, pct AS value, -pct AS o FROM changes WHERE pct > 0
  UNION ALL SELECT "time", 'losers', symbol, exchange, pct, pct FROM changes WHERE pct < 0
  UNION ALL SELECT "time", 'volume', symbol, exchange, volume, -volume FROM changes),
places AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY "time", board ORDER BY o, symbol, exchange) AS INTEGER) AS place
  FROM boards)
SELECT {DAY.format('"time"')} AS bar_date, board, place, symbol, exchange, round(value, 4) AS value
FROM places WHERE place <= 3"""

BURSTS = f"""
slots AS (SELECT unnest(generate_series(0, 5)) AS i),
spread AS (
  SELECT symbol, price, date_trunc('hour', "time") - i * INTERVAL 1 HOUR AS s FROM ticks CROSS JOIN slots),
windows AS (
  SELECT s, symbol, min(price) AS low, max(price) AS high, count(*) AS ticks FROM spread GROUP BY ALL)
SELECT {INSTANT.format('s')} AS window_start, {INSTANT.format('s + INTERVAL 6 HOUR')} AS window_end, symbol,
       round(low, 4) AS low, round(high, 4) AS high, round((high - low) / low * 100, 4) AS range_pct, ticks
FROM windows WHERE low > 0 AND (high - low) / low * 100 >= 1000"""

CHECKS = [
    ("price not positive", "critical", "tick_rows", "SELECT count(*) FROM faulty WHERE price <= 0"),
    ("negative volume", "critical", "tick_rows", "SELECT count(*) FROM faulty WHERE volume < 0"),
    ("high below low", "critical", "bar_rows", "SELECT count(*) FROM bars WHERE high < low"),
    ("close outside range", "warning", "bar_rows", 'SELECT count(*) FROM bars WHERE "close" NOT BETWEEN low AND high'),
    ("open outside range", "warning", "bar_rows", "SELECT count(*) FROM bars WHERE open NOT BETWEEN low AND high"),
    ("negative bar volume", "critical", "bar_rows", "SELECT count(*) FROM bars WHERE volume < 0"),
    ("fewer than two ticks", "warning", "bar_rows", "SELECT count(*) FROM bars WHERE ticks < 2"),
]
QUALITY = f"""
WITH {EVENT}, {_bars('faulty')}, sizes AS (
  SELECT (SELECT count(*) FROM faulty) AS tick_rows, (SELECT count(*) FROM bars) AS bar_rows)
""" + " UNION ALL ".join(
    f"SELECT '{name}' AS \"check\", '{severity}' AS severity, {rows} AS \"rows\", ({count}) AS failed FROM sizes"
    for name, severity, rows, count in CHECKS
)

COOLDOWN = f"""
, fired AS (
  SELECT symbol, rule_id, min("time") AS t FROM hits GROUP BY ALL
  UNION ALL
  SELECT f.symbol, f.rule_id, min(h."time") AS t
  FROM fired f JOIN hits h ON h.symbol = f.symbol AND h.rule_id = f.rule_id
                          AND h."time" >= f.t + INTERVAL {q.COOLDOWN_MINUTES} MINUTE
  GROUP BY f.symbol, f.rule_id)
SELECT h.event_id, h.symbol, h.rule_id, {INSTANT.format('t')} AS fired, message, round(v, 4) AS matched_value, round(price, 4) AS price
FROM fired f JOIN hits h ON h.symbol = f.symbol AND h.rule_id = f.rule_id AND h."time" = f.t"""

LOOKUP = f"""
SELECT {BAR_DATE}, round(rsi14, 4) AS rsi14, round(sma20, 6) AS sma20, '1995-06-30' AS as_of
FROM rolled WHERE symbol = '1-URGENT' AND n = total"""

SQL = {
    "ohlcv_daily": _bars_query(),
    "ohlcv_unique_times": _bars_query(),
    "ohlcv_landed_class": _bars_query("mixed").replace(
        "symbol, exchange, asset_class,\n         arg_min",
        "symbol, exchange, coalesce(min(asset_class) FILTER (asset_class <> 'unknown'), min(asset_class)) AS asset_class,\n         arg_min",
    ),
    "bars_merged": _bars_query("mixed", having=VALID).replace(
        "symbol, exchange, asset_class,\n         arg_min",
        "symbol, exchange, coalesce(min(asset_class) FILTER (asset_class <> 'unknown'), min(asset_class)) AS asset_class,\n         arg_min",
    ),
    "ohlcv_valid": _bars_query("faulty", having=VALID),
    "ohlcv_backfill": _bars_query(where=IN_BACKFILL),
    "quality_report": QUALITY,
    "rows_per_symbol": f'WITH {EVENT} SELECT symbol, count(*) AS "rows" FROM ticks GROUP BY ALL',
    "asset_classes": f"""
        WITH {EVENT} SELECT asset_class AS by_source,
          CASE WHEN contains(symbol, '/') THEN 'crypto' ELSE 'stock' END AS by_symbol,
          replace(symbol, '/', '-') AS symbol_key, count(*) AS "rows" FROM mixed GROUP BY ALL""",
    "sma": _series(f"""
        SELECT {BAR_DATE}, round(sma20, 6) AS sma20, round(sma50, 6) AS sma50, round(sma200, 6) AS sma200 FROM rolled"""),
    "bollinger": _series(f"""
        SELECT {BAR_DATE}, round(bb_mid, 6) AS bb_mid, round(bb_upper, 3) AS bb_upper,
               round(bb_lower, 3) AS bb_lower FROM rolled"""),
    "rsi14": _series(f"SELECT {BAR_DATE}, round(rsi14, 4) AS rsi14 FROM rolled"),
    "prev_close_gain_loss": _series(f"""
        SELECT {BAR_DATE}, n AS bar_number, round(prev_close, 4) AS prev_close, round(gain, 4) AS gain,
               round(loss, 4) AS loss FROM rolled"""),
    "macd_series": _series(f"SELECT {BAR_DATE}, {MACD} FROM rolled JOIN lines USING (symbol, n)"),
    "indicators_full": _series(ALL_INDICATORS),
    "indicators_latest": _series(ALL_INDICATORS + " WHERE n = total"),
    "indicators_incremental": _series(ALL_INDICATORS + " WHERE n = total"),
    "macd_latest": _series(f"SELECT symbol, {MACD} FROM rolled JOIN lines USING (symbol, n) WHERE n = total"),
    "latest_bar": _bars_query(
        having='TRUE QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY "time" DESC, exchange DESC) = 1'
    ),
    "indicator_lookup": _series(
        LOOKUP, "(SELECT * FROM long_bars WHERE \"time\" < TIMESTAMP '1995-07-01') AS early"
    ),
    "indicators_amended": _series(
        ALL_INDICATORS + " WHERE n = total",
        f"""(SELECT * REPLACE (CASE WHEN symbol = '{q.AMENDED[0]}' AND "time" >= TIMESTAMP '{q.AMENDED[1]}' AND day("time") = 6
            THEN "close" + 1000 ELSE "close" END AS "close") FROM long_bars) AS amended""",
    ),
    "indicator_asof": _series(f""",
        days AS (SELECT unnest([{", ".join(f"DATE '{d}'" for d in q.ASOF_DAYS)}]) AS as_of),
        snapshots AS (SELECT symbol, as_of, arg_max(rsi14, (\"time\", 1)) AS rsi14, arg_max(sma20, (\"time\", 1)) AS sma20
            FROM (SELECT r.*, as_of FROM rolled r JOIN days ON \"time\" < as_of + INTERVAL 1 DAY) GROUP BY ALL),
        asked AS (SELECT DISTINCT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS asked FROM orders)
        SELECT a.symbol, strftime(asked, '%Y-%m-%d') AS asked, strftime(as_of, '%Y-%m-%d') AS as_of, round(rsi14, 4) AS rsi14, round(sma20, 6) AS sma20
        FROM asked a ASOF LEFT JOIN snapshots s ON a.symbol = s.symbol AND a.asked >= s.as_of""".replace('\\"', '"')),
    "price_alerts": _hits(SHOW_HITS),
    "price_alerts_many": _hits(
        'SELECT rule_id, symbol, count(*) AS hits, round(max(v), 4) AS largest FROM hits GROUP BY rule_id, symbol', "odd", q.MANY_RULES
    ),
    "rules_from_file": _hits(SHOW_HITS, rules=fixed.ALERT_RULES[:4]),
    "alerts_text": _hits(f'SELECT "key", rule_id, {ALERT_LINE} FROM hits', "snapshots", extra=", " + SENT),
    "rule_validation": _hits(
        """SELECT rule_id, count(*) AS hits, 'valid' AS state FROM hits GROUP BY rule_id
           UNION ALL SELECT rule_id, 0, 'rejected' FROM rules
           WHERE "operator" IS NULL OR "operator" NOT IN ('<', '>', '<=', '>=', '==')""",
        rules=q.MIXED_RULES,
    ),
    "normalise_stock": f"""
        WITH {EVENT}, board AS (
          SELECT *, CASE WHEN event_type = 'signup' THEN 'UNKNOWN' ELSE upper(symbol) END AS name FROM ticks)
        SELECT event_id, name AS "key", 'price.snapshot' AS event_type, name AS symbol,
               CASE WHEN event_type IN ('view', 'click') THEN 'HOSE' ELSE 'HNX' END AS exchange,
               {ISO} AS "timestamp", 'vnstock/KBS' AS source,
               CASE WHEN event_type = 'error' THEN 0 ELSE round(value, 4) END AS price,
               CASE WHEN k < 10 THEN 0.0::DOUBLE ELSE CAST(k AS DOUBLE) END AS change,
               round(-value, 4) AS pct_change, k AS volume, 0.0::DOUBLE AS bid, CAST(1000 + k AS DOUBLE) AS ask
        FROM board""",
    "normalise_crypto": f"""
        WITH {EVENT}
        SELECT event_id, replace(symbol, '/', '-') AS "key", 'price.snapshot' AS event_type, symbol,
               'BINANCE' AS exchange, {ISO} AS "timestamp", 'ccxt/binance' AS source, round(price, 4) AS price,
               CASE WHEN k < 10 THEN 0.0::DOUBLE ELSE round(change, 4) END AS change,
               round(pct_change, 4) AS pct_change, k AS volume, round(bid, 4) AS bid, round(ask, 4) AS ask
        FROM ticks""",
    "envelope_roundtrip": f"""
        WITH {EVENT}
        SELECT replace(symbol, '/', '-') AS "key", {INSTANT.format('"time"')} AS tick_time, symbol,
               'BINANCE' AS exchange, round(price, 4) AS price,
               CASE WHEN k < 10 THEN 0.0::DOUBLE ELSE round(change, 4) END AS change,
               round(pct_change, 4) AS pct_change, round(bid, 4) AS bid, round(ask, 4) AS ask, k AS volume,
               'crypto' AS asset_class, {DAY.format('"time"')} AS event_date
        FROM ticks""",
    "coerced_values": f"""
        WITH {EVENT}
        SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE round(value, 4) END AS close_price,
               CASE WHEN k < 10 THEN 99.5::DOUBLE ELSE CAST(k AS DOUBLE) END AS price_change,
               round(-value, 4) AS percent_change, CAST(trunc(-value) AS BIGINT) AS truncated,
               k AS volume_accumulated, CAST(5 AS BIGINT) AS bid_price_1, CAST(1000 + k AS DOUBLE) AS ask_price_1,
               strftime("time", '%Y-%m-%dT00:00:00+00:00') AS midnight,
               strftime("time", '%Y-%m-%d 00:00:00.000000') AS parsed,
               strftime("time", '%Y') AS "year", strftime("time", '%m') AS "month", strftime("time", '%d') AS "day"
        FROM ticks""",
    "landing_ticks": _sent(LANDED),
    "stream_landing": _sent(LANDED),
    "stream_dedup": _sent(LANDED),
    "stream_event_types": _sent("""
        , landed AS (SELECT 'price.snapshot' AS event_type, symbol FROM sent WHERE event_type <> 'signup' AND reason IS NULL
          UNION ALL SELECT 'market.rumour', symbol FROM sent WHERE event_type = 'signup')
        SELECT event_type, symbol, count(*) AS "rows" FROM landed GROUP BY ALL
        UNION ALL SELECT 'logged ' || event_type, '', count(*) FROM landed GROUP BY ALL"""),
    "stream_accounting": """
        SELECT count(*) + count(*) FILTER (event_id % 4 = 0) AS sent, count(*) + count(*) FILTER (event_id % 4 = 0) AS accounted,
               TRUE AS no_repeats FROM events""",
    "dead_letter_split": _sent(
        EVENT_LETTERS
        + f" UNION ALL SELECT {CHAT_KEY}, 'malformed json', 'unknown' FROM conversations"
    ),
    "stream_dead_letters": _sent(
        EVENT_LETTERS
        + f" UNION ALL SELECT {CHAT_KEY}, 'malformed json', 'unknown' FROM conversations"
    ),
    "event_routing": _sent("""
        SELECT CASE WHEN event_type = 'signup' THEN 'ignored' WHEN reason IS NULL THEN 'good' ELSE 'dead' END AS status,
               CASE WHEN event_type = 'signup' THEN 'market.rumour' ELSE 'price.snapshot' END AS event_type,
               count(*) AS "rows" FROM sent GROUP BY 1, 2
        UNION ALL SELECT 'dead', 'none', count(*) FROM conversations"""),
    "multi_topic_union": f"""
        SELECT '{fixed.TOPICS[0]}' AS topic, count(*) AS "rows", count(DISTINCT event_id) AS keys FROM events
        UNION ALL SELECT '{fixed.TOPICS[1]}', count(*), count(DISTINCT {CHAT_KEY}) FROM conversations""",
    "landed_day_scan": f"""
        WITH {EVENT} SELECT asset_class, symbol, count(*) AS "rows", count(DISTINCT CAST("time" AS DATE)) AS days
        FROM ticks WHERE {IN_BACKFILL} GROUP BY ALL""",
    "avro_scan": f"""
        WITH {EVENT} SELECT event_id, {INSTANT.format('"time"')} AS tick_time, symbol, exchange, round(price, 4) AS price,
          round(change, 4) AS change, round(pct_change, 4) AS pct_change, round(bid, 4) AS bid, round(ask, 4) AS ask, volume,
          source, asset_class, {DAY.format('"time"')} AS event_date FROM ticks""",
    "ohlcv_rerun": _bars_query(),
    "explicit_schema_write": _bars_query(),
    "partition_calendar": """
        SELECT strftime(d, '%Y-%m-%d') AS event_date, strftime(d, '%Y') AS "year", strftime(d, '%m') AS "month",
               strftime(d, '%d') AS "day"
        FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), max(ts), INTERVAL 1 DAY)) AS d FROM events)""",
    "gap_report": f"""
        WITH {CALENDAR_DAYS} SELECT strftime(d, '%Y-%m-%d') AS event_date FROM days
        WHERE NOT EXISTS (SELECT 1 FROM events WHERE date_trunc('day', ts) = d)""",
    "freshness": f"""
        WITH {EVENT}, {_bars('faulty')}, {CALENDAR_DAYS},
        t AS (SELECT date_trunc('day', "time") AS d, count(*) AS ticks FROM faulty GROUP BY 1),
        b AS (SELECT "time" AS d, count(*) AS bars FROM bars WHERE {VALID} GROUP BY 1)
        SELECT strftime(d, '%Y-%m-%d') AS event_date, coalesce(ticks, 0) AS ticks, coalesce(bars, 0) AS bars,
               CASE WHEN ticks IS NULL THEN 'no ticks' WHEN bars IS NULL THEN 'no bars' ELSE 'ok' END AS state
        FROM days LEFT JOIN t USING (d) LEFT JOIN b USING (d)""",
    "retention_filter": """
        SELECT event_type, count(*) AS "rows" FROM events
        WHERE ts >= TIMESTAMP '2024-02-10' - INTERVAL 30 DAY GROUP BY 1""",
    "look_back": """
        SELECT o_orderpriority, count(*) AS "rows" FROM orders
        WHERE o_orderdate >= TIMESTAMP '1996-06-30' - INTERVAL 200 DAY AND o_orderdate < TIMESTAMP '1996-07-01'
        GROUP BY 1""",
    "digest_topk": f"WITH {EVENT}, {_bars('ticks')}, {DIGEST}",
    "screener": """
        WITH f AS (
          SELECT c_name AS symbol, c_acctbal / (max(o_totalprice) / 1000) AS pe, count(*) / 10.0::DOUBLE AS de,
                 max(o_totalprice) / 1000 AS eps
          FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name, c_acctbal)
        SELECT symbol, round(pe, 4) AS pe, round(de, 4) AS de, round(eps, 6) AS eps FROM f
        WHERE pe <= 12 AND de >= 0.5 AND eps > 350""",
    "volatility_burst": f"WITH {EVENT}, {BURSTS}",
    "stream_volatility": f"WITH {EVENT}, {BURSTS}",
    "stream_alerts": _hits(
        f'SELECT "key", rule_id, symbol, round(v, 4) AS matched_value, {ALERT_LINE} FROM hits', "snapshots", extra=", " + SENT
    ),
    "alert_cooldown": _hits(COOLDOWN),
    "stream_cooldown": _hits(COOLDOWN),
    "stream_ordered_cooldown": _hits(COOLDOWN),
}
