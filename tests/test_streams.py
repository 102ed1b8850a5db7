"""Landing in one query, cooldown in any order of arrival, keyed tables, late and repeated rows."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.operators import reports
from tickloom.operators.extract import EXTRACTORS
from tickloom.plans import queries
from tickloom.sources import avro, messages
from tickloom.streaming import alerts as stream, keyed, landing, progress

START = datetime(2024, 5, 10)


def message(symbol="VCB", at=START, price=61.75, event_type="price.snapshot", **changes):
    body = {"event_type": event_type, "symbol": symbol, "exchange": "HOSE", "timestamp": at.isoformat() + "+00:00", "source": "vnstock/KBS",
            "payload": {"price": price, "volume": 10}, **changes}
    return json.dumps(body)


class Inbox:
    def __init__(self, folder):
        self.folder, self.files = folder, 0
        folder.mkdir()

    def put(self, *texts):
        (self.folder / f"{self.files:03}.json").write_text("\n".join(json.dumps({"key": "k", "value": t}) for t in texts))
        self.files += 1

    def stream(self, spark):
        return messages.stream_messages(spark, str(self.folder), max_files=1)


@pytest.mark.parametrize("fmt", ["parquet", avro.FORMAT])
def test_a_repeated_batch_lands_nothing_twice(spark, tmp_path, monkeypatch, fmt):
    """The job dies between the ticks and the dead letters, is restarted, and goes on with another file."""
    inbox, out = Inbox(tmp_path / "in"), str(tmp_path / "out")

    def run():
        query = landing.land(inbox.stream(spark), f"{out}/raw", f"{out}/letters", f"{out}/log", f"{out}/cp", None, fmt).start()
        query.awaitTermination()

    inbox.put(message(), message("BTC/USDT", source="ccxt/x"), "noise", message(event_type="market.rumour"))
    write = landing.write_batch

    def dies(rows, number, path, *rest, **options):
        if path.endswith("letters"):
            raise RuntimeError("lost")
        write(rows, number, path, *rest, **options)

    monkeypatch.setattr(landing, "write_batch", dies)
    with pytest.raises(Exception, match="lost"):
        run()
    assert landing.landed(spark, f"{out}/raw", fmt=fmt).count() == 2
    monkeypatch.setattr(landing, "write_batch", write)
    inbox.put(message(at=START + timedelta(days=1)), message(symbol=None))
    run()
    rows = landing.landed(spark, f"{out}/raw", fmt=fmt).select("symbol", "asset_class", F.col("event_date").cast("string").alias("d")).collect()
    assert sorted(map(tuple, rows)) == [("BTC/USDT", "crypto", "2024-05-10"), ("VCB", "stock", "2024-05-10"), ("VCB", "stock", "2024-05-11")]
    assert sorted(r["reason"] for r in spark.read.json(f"{out}/letters").collect()) == ["malformed json", "missing symbol"]
    log = landing.landing_log(spark, f"{out}/log")
    assert {(r["status"], r["event_type"], r["batch"]): r["rows"] for r in log.collect()} == {
        ("good", "price.snapshot", 0): 2, ("dead", "none", 0): 1, ("ignored", "market.rumour", 0): 1, ("good", "price.snapshot", 1): 1, ("dead", "price.snapshot", 1): 1}


def test_every_message_is_parsed_once(spark, tmp_path):
    """One scan and one JSON parser in the plan that both sinks read."""
    inbox = Inbox(tmp_path / "in")
    inbox.put(message(), "noise")
    seen = []

    def both(batch, number):
        parsed = landing.classified(batch).persist()
        parsed.count()
        letters = landing.dead_letters_of(parsed)._jdf.queryExecution().executedPlan().toString()
        seen.append((letters.count("InMemoryTableScan"), letters.split("InMemoryRelation")[0].count("from_json")))
        parsed.unpersist()

    inbox.stream(spark).writeStream.option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(both).trigger(availableNow=True).start().awaitTermination()
    assert seen == [(1, 0)]


def test_event_types_have_their_own_tables(spark, tmp_path):
    inbox, out = Inbox(tmp_path / "in"), str(tmp_path / "out")
    inbox.put(message(), message("HPG", event_type=queries.RUMOUR), message("HPG", event_type="other"))
    extractors = {**EXTRACTORS, queries.RUMOUR: queries.RUMOUR_EXTRACTOR}
    landing.land(inbox.stream(spark), f"{out}/raw", f"{out}/letters", f"{out}/log", f"{out}/cp", None, extractors=extractors).start().awaitTermination()
    assert landing.landed(spark, f"{out}/raw").first()["price"] == 61.75
    rumour = landing.landed(spark, f"{out}/raw", queries.RUMOUR)
    assert rumour.columns == ["time", "symbol", "source", "asset_class", "event_date"] and rumour.first()["symbol"] == "HPG"


def test_broker_batches_start_at_rows_or_time():
    assert messages.batch_bounds(None, 500, "30 seconds") == {"minOffsetsPerTrigger": "500", "maxTriggerDelay": "30s"}
    assert messages.batch_bounds(9000, None, "30 seconds") == {"maxOffsetsPerTrigger": "9000"}


def greedy(times, wait):
    kept, ready = [], None
    for time in sorted(times):
        if ready is None or time >= ready:
            kept.append(time)
            ready = time + wait
    return kept


def test_ordered_cooldown_of_shuffled_alerts(spark, tmp_path):
    """Alerts arrive in any order over five micro-batches and a restart; the result is the greedy pass in order of time."""
    rng = random.Random(4)
    minutes = {"A": sorted(rng.sample(range(600), 120)), "B": [3, 8, 500]}
    alerts = [(s, 1, str(START + timedelta(minutes=m))) for s, ms in minutes.items() for m in ms]
    rng.shuffle(alerts)
    alerts.append(alerts[0])
    inbox, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    inbox.mkdir()
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", stream.ROCKSDB)
    try:
        lots = [alerts[i::4] for i in range(4)] + [[("", 0, str(START + timedelta(days=30)))]]
        for part in (lots[:2], lots[2:]):
            for lot in part:
                name = f"{len(list(inbox.iterdir()))}.json"
                (inbox / name).write_text("\n".join(json.dumps({"symbol": s, "rule_id": r, "time": t}) for s, r, t in lot))
            source = spark.readStream.schema("symbol string, rule_id int, time timestamp").option("maxFilesPerTrigger", 1).json(str(inbox))
            kept = stream.with_ordered_cooldown(source, 5, lateness="1 day")
            kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    found = {}
    for row in spark.read.parquet(out).filter("rule_id = 1").collect():
        found.setdefault(row["symbol"], []).append(row["time"])
    again = (alerts[0][0], datetime.fromisoformat(alerts[0][2]))
    for symbol, ms in minutes.items():
        want = greedy([START + timedelta(minutes=m) for m in ms], timedelta(minutes=5))
        # The alert that came twice is one instant: both are kept or none.
        assert sorted(found[symbol]) == sorted(want + [t for t in want if (symbol, t) == again])


def test_windows_of_several_batches(spark, tmp_path):
    """A window grows over micro-batches, one more falls below the threshold when a price of 0 comes, and none is lost."""
    inbox, path = tmp_path / "in", str(tmp_path / "t")
    inbox.mkdir()
    rows = [("A", 0, 10.0), ("A", 1, 11.0), ("B", 2, 5.0), ("A", 3, 20.0), ("B", 3, 9.0), ("B", 4, 0.0)]
    ticks = [(s, str(START + timedelta(minutes=m)), p) for s, m, p in rows]
    for i in range(3):
        (inbox / f"{i}.json").write_text("\n".join(json.dumps({"symbol": s, "time": t, "price": p}) for s, t, p in ticks[2 * i : 2 * i + 2]))
    schema = "symbol string, time timestamp, price double"
    windows = reports.price_windows(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(inbox)), "5 minutes", "5 minutes")
    keyed.keyed_sink(windows, path, str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    stored = keyed.newest(spark, path, windows.schema, ("window_start", "symbol"))
    assert {(r["symbol"], r["low"], r["high"], r["ticks"]) for r in stored.collect()} == {("A", 10.0, 20.0, 3), ("B", 0.0, 9.0, 3)}
    table = reports.volatility_bursts(spark.createDataFrame([(s, datetime.fromisoformat(t), p) for s, t, p in ticks], schema), "5 minutes", "5 minutes")
    assert [r["symbol"] for r in reports.bursts_of(stored).collect()] == [r["symbol"] for r in table.collect()] == ["A"]
    keyed.compact(spark, path, windows.schema, ("window_start", "symbol"), str(tmp_path / "small"))
    assert keyed.newest(spark, str(tmp_path / "small"), windows.schema, ("window_start", "symbol")).count() == 2


def test_repeats_and_late_rows_are_counted(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    tick = lambda m, v=1: {"symbol": "A", "exchange": "X", "time": str(START + timedelta(minutes=m)), "price": 1.0, "volume": v}
    lots = [[tick(0), tick(0), tick(60)], [tick(60), tick(61)], [tick(5), tick(61, 2)], [tick(7)]]
    for i, lot in enumerate(lots):
        (inbox / f"{i}.json").write_text("\n".join(map(json.dumps, lot)))
        # Files of the same time are read in any order.
        os.utime(inbox / f"{i}.json", (START.timestamp() + i,) * 2)
    source = spark.readStream.schema("symbol string, exchange string, time timestamp, price double, volume bigint").option("maxFilesPerTrigger", 1).json(str(inbox))
    log, path = progress.ProgressLog(), str(tmp_path / "out")
    spark.streams.addListener(log)
    try:
        query = landing.distinct_ticks(source).writeStream.queryName("distinct").format("parquet").option("path", path).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    kept = spark.read.parquet(path).count()
    for counts in (progress.table_of(spark, query).collect(), [dict(zip(("query", "batch", "rows", "late", "duplicates"), c)) for c in log.counts]):
        total = {name: sum(c[name] for c in counts) for name in ("rows", "late", "duplicates")}
        assert total == {"rows": 8, "late": 2, "duplicates": 2} and kept == 4
    log.write(spark, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).agg(F.sum("rows")).first()[0] == 8 and not log.counts
