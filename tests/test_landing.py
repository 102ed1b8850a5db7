import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickloom.operators import envelope, extract
from tickloom.sources import messages as topics
from tickloom.streaming import landing

TS = "2023-11-21T03:17:42+00:00"
FULL = {"price": 61.75, "change": -0.25, "pct_change": -0.4, "volume": 7_300, "bid": 61.5, "ask": 62.125}


def message(**changes):
    body = {"event_type": "price.snapshot", "symbol": "VCB", "exchange": "HOSE", "timestamp": TS,
            "source": "vnstock/KBS", "payload": FULL, **changes}
    return json.dumps({name: value for name, value in body.items() if value is not ...})


CASES = {
    "full": (message(), "good", None),
    "no exchange": (message(exchange=...), "good", None),
    "no source": (message(source=...), "good", None),
    "extra field": (message(payload={**FULL, "open_interest": 5}), "good", None),
    "no symbol": (message(symbol=...), "dead", "missing symbol"),
    "null symbol": (message(symbol=None), "dead", "missing symbol"),
    "no payload": (message(payload=...), "dead", "missing payload"),
    "payload not an object": (message(payload="x"), "dead", "bad field type"),
    "bad timestamp": (message(timestamp="soon"), "dead", "bad timestamp"),
    "no timestamp": (message(timestamp=...), "dead", "missing timestamp"),
    "infinite volume": (message(payload={**FULL, "volume": "inf"}), "dead", "volume out of range"),
    "huge volume": (message(payload={**FULL, "volume": 1e30}), "dead", "volume out of range"),
    "not json": ("price went up", "dead", "malformed json"),
    "blank": ("  ", "dead", "malformed json"),
    "null": (None, "dead", "malformed json"),
    "a number": ("12", "dead", "malformed json"),
    "an array": ("[1, 2]", "dead", "malformed json"),
    "cut off": (message()[:-5], "dead", "malformed json"),
    "unknown type": (message(event_type="market.rumour"), "ignored", None),
    "unknown type, bad rest": (message(event_type="market.rumour", symbol=..., payload="x"), "ignored", None),
    "no type": (message(event_type=...), "ignored", None),
    "empty object": ("{}", "ignored", None),
}


@pytest.fixture(scope="module")
def classified(spark):
    rows = [(name, text) for name, (text, _, _) in CASES.items()]
    frame = spark.createDataFrame(rows, "key string, value string")
    return landing.classified(frame).cache()


@pytest.mark.parametrize("name", CASES)
def test_classification(classified, name):
    row = classified.filter(F.col("key") == name).first()
    assert (row["status"], row["reason"]) == CASES[name][1:]


def test_every_message_is_accounted_for(classified):
    assert classified.count() == len(CASES)


def test_typed_tick(classified):
    tick = extract.ticks_of(classified, keep=("key",)).filter("key = 'full'").first()
    assert tick["time"] == datetime(2023, 11, 21, 3, 17, 42)
    assert [tick[name] for name in ("symbol", "exchange", "price", "change", "pct_change", "volume", "bid", "ask")] == [
        "VCB", "HOSE", *FULL.values()]
    assert tick["asset_class"] == "stock"
    other = {row["key"]: row for row in extract.ticks_of(classified, keep=("key",)).collect()}
    assert other["no exchange"]["exchange"] == "" and other["no source"]["asset_class"] == "unknown"


def test_unreadable_numbers_become_zero(spark):
    text = message(payload={"price": "N/A", "volume": "1234.9", "bid": None})
    frame = spark.createDataFrame([(text,)], "value string")
    tick = extract.ticks_of(landing.classified(frame)).first()
    assert (tick["price"], tick["volume"], tick["bid"], tick["ask"]) == (0.0, 1234, 0.0, 0.0)


def test_event_day_is_the_utc_day(spark):
    frame = spark.createDataFrame([(message(timestamp="2024-05-10T02:00:00+07:00"),)], "value string")
    assert str(extract.ticks_of(landing.classified(frame)).first()["event_date"]) == "2024-05-09"


def test_dead_letter_keeps_the_message(classified):
    letter = extract.dead_letters_of(classified, keep=("key",)).filter("key = 'not json'").first()
    assert (letter["message"], letter["event_type"]) == ("price went up", "unknown")


def test_envelope_defaults(spark):
    board = spark.createDataFrame([("vcb", None, "1.5")], "symbol string, exchange string, close_price string")
    row = envelope.normalise_stock_board(board).first()
    assert (row["key"], row["symbol"], row["exchange"], row["source"]) == ("VCB", "VCB", "HOSE", "vnstock/KBS")
    assert row["event_type"] == "price.snapshot" and row["timestamp"].endswith("+00:00")
    assert row["payload"].asDict() == {"price": 1.5, "change": 0.0, "pct_change": 0.0, "volume": 0, "bid": 0.0, "ask": 0.0}


def test_envelope_keys_and_given_timestamp(spark):
    tickers = spark.createDataFrame([("BTC/USDT", 1.0)], "symbol string, last double")
    frame = envelope.normalise_crypto_tickers(tickers, timestamp=F.lit(TS))
    row = frame.first()
    assert (row["key"], row["timestamp"], row["source"]) == ("BTC-USDT", TS, "ccxt/binance")
    sent = json.loads(envelope.to_messages(frame).first()["value"])
    assert list(sent) == ["event_type", "symbol", "exchange", "timestamp", "source", "payload"]


def test_empty_timestamp_means_now(spark):
    tickers = spark.createDataFrame([("BTC/USDT", 1.0)], "symbol string, last double")
    row = envelope.normalise_crypto_tickers(tickers, timestamp=F.lit("")).first()
    assert row["timestamp"].startswith("20")


def test_landing_stream_with_restart(spark, tmp_path):
    """Two runs on one checkpoint land each message once; good and dead rows split."""
    inbox = tmp_path / "in"
    inbox.mkdir()
    raw, letters, checkpoint = (str(tmp_path / name) for name in ("raw", "letters", "checkpoint"))

    def put(name, texts):
        (inbox / name).write_text("\n".join(json.dumps({"key": "k", "value": text}) for text in texts))

    def run():
        source = topics.stream_messages(spark, str(inbox))
        for writer in (
            landing.tick_sink(source, raw, checkpoint + "/t", None),
            landing.dead_letter_sink(source, letters, checkpoint + "/d", None),
        ):
            writer.start().awaitTermination()

    put("a.json", [message(), message(symbol=...), "noise"])
    run()
    put("b.json", [message(source="ccxt/binance", symbol="BTC/USDT", timestamp="2024-05-11T00:00:00+00:00")])
    run()
    ticks = spark.read.parquet(raw)
    assert sorted((r["asset_class"], str(r["event_date"]), r["symbol"]) for r in ticks.collect()) == [
        ("crypto", "2024-05-11", "BTC/USDT"), ("stock", "2023-11-21", "VCB")]
    reasons = spark.read.json(letters)
    assert sorted(r["reason"] for r in reasons.collect()) == ["malformed json", "missing symbol"]


def test_union_of_topics(spark):
    left = spark.createDataFrame([("a", "1")], "key string, value string")
    right = spark.createDataFrame([("2",)], "value string")
    assert topics.union_topics(left, right).count() == 2
