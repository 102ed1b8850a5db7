import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom import __main__ as cli, schemas, session
from tickloom.operators import bars, calendar, reports
from tickloom.plans import jobs
from tickloom.sources import config, tables

START = datetime(2024, 1, 1)


def ticks(spark, days=3, symbols=("VCB", "BTC/USDT"), price=100.0):
    rows = [
        (START + timedelta(days=d, hours=h), s, "X", price + d + h, 0.0, 0.0, 10, 0.0, 0.0, "crypto" if "/" in s else "stock")
        for d in range(days) for h in (1, 2, 3) for s in symbols
    ]
    return spark.createDataFrame(rows, schemas.TICK + ", asset_class string")


def folders(path):
    return sorted(os.path.relpath(root, path) for root, _, files in os.walk(path) if any(f.endswith(".parquet") for f in files))


def test_layouts(spark, tmp_path):
    daily, ymd = str(tmp_path / "daily"), str(tmp_path / "ymd")
    tables.write_days(ticks(spark, 1), daily)
    tables.write_days(ticks(spark, 1), ymd, "ymd")
    assert folders(daily) == ["asset_class=crypto/event_date=2024-01-01", "asset_class=stock/event_date=2024-01-01"]
    assert folders(ymd) == ["asset_class=crypto/year=2024/month=01/day=01", "asset_class=stock/year=2024/month=01/day=01"]
    assert tables.read_days(spark, ymd, "2024-01-01", layout="ymd").count() == 6
    assert tables.read_days(spark, ymd, "2024-01-02", layout="ymd").count() == 0


def test_rerun_replaces_touched_days_only(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_days(ticks(spark, 3), path)
    tables.write_days(ticks(spark, 3, price=500.0).filter("time >= '2024-01-02' and time < '2024-01-03'"), path)
    lows = {str(r["event_date"]): r["low"] for r in tables.read_table(spark, path).groupBy("event_date").agg(F.min("price").alias("low")).collect()}
    assert lows == {"2024-01-01": 101.0, "2024-01-02": 502.0, "2024-01-03": 103.0}
    tables.write_days(ticks(spark, 3), path)
    assert tables.read_table(spark, path).count() == 18


def test_day_read_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_days(ticks(spark, 5), path)
    picked = tables.read_days(spark, path, "2024-01-02", "2024-01-03")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(picked.inputFiles()) >= 4 and picked.count() == 12
    # The symbol column is data, never a path level.
    assert {r["symbol"] for r in picked.select("symbol").distinct().collect()} == {"VCB", "BTC/USDT"}


def test_ohlcv_job(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "bars")
    bad = ticks(spark, 1, ("BAD",)).withColumn("volume", F.lit(-1).cast("bigint"))
    tables.write_days(ticks(spark, 3).unionByName(bad), raw)
    assert jobs.run_ohlcv(spark, raw, out, "2024-01-01", "2024-01-03") == {"bars": 7, "dropped": 1}
    assert jobs.run_ohlcv(spark, raw, out, "2024-02-01") is None
    assert jobs.run_ohlcv(spark, raw, out, "2024-01-02") == {"bars": 2, "dropped": 0}
    stored = tables.read_table(spark, out)
    assert stored.count() == 6
    row = stored.filter("symbol = 'VCB' and event_date = '2024-01-02'").first()
    assert (row["open"], row["high"], row["low"], row["close"], row["volume"]) == (102, 104, 102, 104, 30)
    with pytest.raises(ValueError, match="negative"):
        jobs.run_ohlcv(spark, raw, out, "2024-01-01", gate=True)
    assert jobs.run_ohlcv(spark, raw, out, "2024-01-03", gate=True) == {"bars": 2, "dropped": 0}
    assert tables.read_table(spark, out).count() == 6


def test_indicator_jobs_agree_and_can_be_looked_up(spark, tmp_path):
    store, full, state, inc = (str(tmp_path / name) for name in ("bars", "full", "state", "inc"))
    daily = bars.ohlcv(ticks(spark, 40)).drop("ticks")
    tables.write_days(daily, store)
    jobs.run_indicators(spark, store, full, "2024-02-05")
    jobs.run_indicators(spark, store, full, "2024-02-09")
    jobs.run_indicators_incremental(spark, store, state, inc, "2024-02-05")
    jobs.run_indicators_incremental(spark, store, state, inc, "2024-02-09", since="2024-02-05")
    for day in ("2024-02-05", "2024-02-09"):
        left = tables.lookup(tables.read_table(spark, full), day, "VCB").first()
        right = tables.lookup(tables.read_table(spark, inc), day, "VCB").first()
        # The series ends on 2024-02-09: a later bar must not reach the earlier snapshot.
        assert left["time"].date() == date.fromisoformat(day) == right["time"].date()
        for name in ("sma20", "bb_upper", "rsi14", "macd", "macd_signal", "macd_hist"):
            assert left[name] == pytest.approx(right[name], abs=1e-9)
        assert left["sma50"] is None and right["sma50"] is None
    assert folders(full) == ["as_of=2024-02-05", "as_of=2024-02-09"]


def test_snapshot_ymd_layout(spark, tmp_path):
    path = str(tmp_path / "s")
    tables.write_snapshot(spark.createDataFrame([("A", 1.0)], "symbol string, rsi14 double"), path, "2024-02-05", "ymd")
    assert folders(path) == ["year=2024/month=02/day=05"]


def test_calendar(spark):
    days = calendar.partition_calendar(spark, "2024-02-27", "2024-03-01")
    assert [str(r[0]) for r in days.orderBy("event_date").collect()] == ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01"]
    assert calendar.partition_calendar(spark, calendar.today(), None).count() == 1
    some = ticks(spark, 2)
    assert calendar.missing_days(calendar.partition_calendar(spark, "2024-01-01", "2024-01-04"), some, F.to_date("time")).count() == 2
    assert calendar.calendar_of(some.filter("false"), F.to_date("time")).count() == 0
    assert calendar.has_day(some, "2024-01-02") and not calendar.has_day(some, "2024-01-03")
    assert calendar.retained(some, "2024-02-01", 30).count() == 6
    assert calendar.look_back(some, "2024-01-02", 1).count() == 12
    assert calendar.up_to(some, "2024-01-01").count() == 6


def test_target_day():
    assert calendar.target_day("2024-05-10") == date(2024, 5, 10)
    assert calendar.target_day(None, 1) == calendar.today("UTC") - timedelta(days=1)
    assert calendar.day_texts(date(2024, 5, 3)) == ("2024", "05", "03")


def test_explicit_schema_write(spark, tmp_path):
    path = str(tmp_path / "b")
    tables.write_rows(bars.ohlcv(ticks(spark, 1)), path, schemas.BAR)
    assert spark.read.parquet(path).columns == schemas.BAR_COLUMNS
    assert any(".snappy." in name for name in os.listdir(path))


def test_text_and_json_sinks(spark, tmp_path):
    frame = spark.createDataFrame([("a", "x"), ("b", "y")], "kind string, value string")
    tables.write_text(frame, str(tmp_path / "t"))
    tables.write_json(frame, str(tmp_path / "j"), ("kind",))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "t")).collect()) == ["x", "y"]
    assert spark.read.json(str(tmp_path / "j")).filter("kind = 'a'").first()["value"] == "x"


def test_screen(spark):
    frame = spark.createDataFrame([("A", 5.0, 1.0), ("B", 15.0, 1.0), ("C", None, 1.0)], "symbol string, pe double, de double")
    passed = reports.screen(frame, [{"field": "pe", "operator": "<", "threshold": 10}, {"field": "de", "operator": "==", "threshold": 1}])
    assert [r["symbol"] for r in passed.collect()] == ["A"]
    assert reports.screen(frame, []).count() == 3
    with pytest.raises(ValueError):
        reports.screen(frame, [{"field": "pe", "operator": "~", "threshold": 1}])


def test_digest_over_one_day(spark):
    rows = [("A", 0, 100.0, 5), ("A", 1, 110.0, 5), ("B", 0, 100.0, 9), ("B", 1, 90.0, 9), ("C", 1, 50.0, 7)]
    frame = spark.createDataFrame([(START + timedelta(days=d), s, "X", c, v) for s, d, c, v in rows],
                                  "time timestamp, symbol string, exchange string, close double, volume bigint")
    board = {(r["time"].day, r["board"], r["place"]): (r["symbol"], round(r["value"], 6)) for r in reports.daily_digest(frame, 2).collect()}
    assert board == {
        (1, "volume", 1): ("B", 9), (1, "volume", 2): ("A", 5),
        (2, "gainers", 1): ("A", 10), (2, "losers", 1): ("B", -10), (2, "volume", 1): ("B", 9), (2, "volume", 2): ("C", 7),
    }


def test_digest_job_equals_digest_of_all_days(spark, tmp_path):
    store, out = str(tmp_path / "bars"), str(tmp_path / "digest")
    daily = bars.ohlcv(ticks(spark, 4, ("A", "B", "C/USDT")).filter("symbol <> 'B' or time < '2024-01-03'")).drop("ticks")
    moved = daily.withColumn("close", F.when(F.col("symbol") == "A", -F.day("time") + 50.0).otherwise(F.col("close")))
    tables.write_days(moved, store)
    jobs.run_digest(spark, store, out, "2024-01-04")
    columns = ["time", "board", "place", "symbol", "exchange", "value"]
    want = reports.daily_digest(moved).filter("time = '2024-01-04'").select(columns)
    got = tables.read_table(spark, out).select(columns)
    assert got.exceptAll(want).isEmpty() and got.count() == want.count() > 0


def test_volatility_windows(spark):
    frame = spark.createDataFrame(
        [(START, "A", 100.0), (START + timedelta(minutes=4), "A", 104.0), (START + timedelta(minutes=30), "A", 200.0)],
        "time timestamp, symbol string, price double")
    found = reports.volatility_bursts(frame).collect()
    # Only one five-minute window holds both of the first two ticks.
    assert [(r["window_start"], r["low"], r["high"], r["ticks"]) for r in found] == [(START, 100.0, 104.0, 2)]


def test_scratch_folder():
    def fake(master, **conf):
        return type("Session", (), {"conf": conf, "sparkContext": type("Context", (), {"master": master})()})()

    shared = {"spark.checkpoint.dir": "hdfs://shared/scratch/"}
    assert session.scratch_root(fake("yarn", **shared)) == "hdfs://shared/scratch"
    assert os.path.isdir(session.scratch_root(fake("local[2]")))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(fake("yarn"))
    assert session.scratch_path(fake("yarn", **shared), "x") != session.scratch_path(fake("yarn", **shared), "x")


def test_command_line(spark, tmp_path, capsys):
    """The whole pipeline: boards to messages to ticks to bars to indicators, digest and gaps."""
    def at(name):
        return str(tmp_path / name)

    (tmp_path / "stock.json").write_text('{"symbol": "vcb", "close_price": "85.5", "volume_accumulated": 10}\n{"symbol": "acb", "close_price": "N/A"}')
    (tmp_path / "crypto.json").write_text('{"symbol": "BTC/USDT", "last": 60000.5, "percentage": -6.5}')
    cli.main(["stock-price-producer", "--board", at("stock.json"), "--out", at("messages")])
    cli.main(["crypto-price-producer", "--board", at("crypto.json"), "--out", at("messages")])
    for _ in range(2):
        cli.main(["storage-consumer", "--messages", at("messages"), "--checkpoint", at("c"), "--once", "--raw", at("raw"), "--dead-letters", at("dead")])
    landed = spark.read.parquet(at("raw"))
    assert landed.count() == 3
    today = str(landed.first()["event_date"])
    cli.main(["ohlcv-daily-ingest", "--date", today, "--raw", at("raw"), "--bars", at("bars")])
    assert f"{today}: 3 bars, 0 dropped" in capsys.readouterr().out
    cli.main(["technical", "--date", today, "--bars", at("bars"), "--out", at("indicators")])
    assert spark.read.parquet(at("indicators")).count() == 3
    cli.main(["digest", "--date", today, "--bars", at("bars"), "--out", at("digest")])
    assert spark.read.parquet(at("digest")).filter("board = 'volume'").count() == 3
    cli.main(["gaps", "--table", at("bars"), "--first", today, "--last", today])
    assert today not in capsys.readouterr().out
    (tmp_path / "t.json").write_text('[{"field": "close", "operator": ">", "threshold": 80}]')
    cli.main(["screener", "--date", today, "--fundamentals", at("bars"), "--out", at("screen"), "--thresholds", at("t.json")])
    assert spark.read.parquet(at("screen")).count() == 2
    cli.main(["price-alerts", "--messages", at("messages"), "--checkpoint", at("a"), "--once"])
    assert len(config.load_json(spark, at("t.json"))) == 1


def test_no_tick_is_lost_in_another_session_zone(spark, tmp_path):
    """Two days are run one after the other; ticks lie on both sides of the zone's midnight."""
    raw, out = str(tmp_path / "raw"), str(tmp_path / "bars")
    hours = [1, 16, 17, 18, 23]
    stamps = [f"2024-01-0{d}T{h:02}:30:00Z" for d in (1, 2) for h in hours]
    schema = "stamp string, symbol string, exchange string, price double, volume bigint, asset_class string"
    rows = spark.createDataFrame([(t, "VCB", "X", 10.0 + i, 1, "stock") for i, t in enumerate(stamps)], schema)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
    try:
        tables.write_days(rows.withColumn("time", F.to_timestamp("stamp")).drop("stamp"), raw)
        for day in ("2024-01-01", "2024-01-02"):
            jobs.run_ohlcv(spark, raw, out, day)
        found = tables.read_table(spark, out).select("event_date", F.unix_seconds("time").alias("s"), "open", "close", "volume").orderBy("s").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    begin = 1704067200
    assert [tuple(r) for r in found] == [(date(2024, 1, 1), begin, 10.0, 14.0, 5), (date(2024, 1, 2), begin + 86400, 15.0, 19.0, 5)]


def test_units_of_bars(spark):
    frame = spark.createDataFrame([(datetime(2024, 5, 16, 13, 47, 9), "A", "X", 1.0, 1)], "time timestamp, symbol string, exchange string, price double, volume bigint")
    starts = {"year": datetime(2024, 1, 1), "quarter": datetime(2024, 4, 1), "month": datetime(2024, 5, 1), "week": datetime(2024, 5, 13), "day": datetime(2024, 5, 16), "hour": datetime(2024, 5, 16, 13)}
    for unit, start in starts.items():
        row = bars.ohlcv(frame, unit=unit).select(F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("t")).first()
        assert row["t"] == f"{start:%Y-%m-%d %H:%M:%S}", unit


def test_up_to_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_days(ticks(spark, 5), path)
    picked = calendar.up_to(tables.read_table(spark, path), "2024-01-03")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters")[1].split("]")[0]
    assert picked.select("event_date").distinct().count() == 3


def test_incremental_job_needs_its_state(spark, tmp_path):
    path = str(tmp_path / "bars")
    tables.write_days(bars.ohlcv(ticks(spark, 4)), path)
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    jobs.run_indicators_incremental(spark, path, state, out, "2024-01-02")
    with pytest.raises(ValueError, match="no state of 2024-01-01"):
        jobs.run_indicators_incremental(spark, path, state, out, "2024-01-03", since="2024-01-01")
    jobs.run_indicators_incremental(spark, path, state, out, "2024-01-03", since="2024-01-02")


def test_compaction_keeps_the_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    for symbol in ("A", "B", "C"):
        ticks(spark, 2, (symbol,)).withColumn("event_date", F.to_date("time")).write.mode("append").partitionBy("asset_class", "event_date").parquet(path)
    before = sorted(map(str, tables.read_table(spark, path).select("time", "symbol", "price").collect()))
    files = len([f for f in tables.read_table(spark, path).inputFiles()])
    tables.compact_days(spark, path, "2024-01-01", "2024-01-02")
    assert sorted(map(str, tables.read_table(spark, path).select("time", "symbol", "price").collect())) == before
    assert len(tables.read_table(spark, path).inputFiles()) == 2 < files


def test_bars_are_keyed_by_symbol_and_exchange(spark):
    """Ticks of a day that were landed with several classes are one bar, of a known class."""
    mixed = ticks(spark, 1, ("VCB",)).withColumn("asset_class", F.when(F.hour("time") == 2, "unknown").otherwise(F.col("asset_class")))
    found = bars.ohlcv(mixed).collect()
    assert [(r["asset_class"], r["volume"]) for r in found] == [("stock", 30)]


def test_bars_without_a_finite_price_are_invalid(spark):
    frame = ticks(spark, 1, ("A", "B")).withColumn("price", F.when((F.col("symbol") == "A") & (F.hour("time") == 2), float("nan")).otherwise(F.col("price")))
    assert [r["symbol"] for r in bars.valid_bars(bars.ohlcv(frame)).collect()] == ["B"]


def test_bar_states_merge_like_their_ticks(spark):
    """Random lots with ties, unknown classes and empty lots: merged states give the bars of all ticks."""
    import random

    from tickloom.operators import bar_states

    rng = random.Random(8)
    rows = [(START + timedelta(hours=rng.randint(0, 60)), rng.choice("AB"), "X", float(rng.randint(1, 9)), 0.0, 0.0, rng.randint(0, 50), 0.0, 0.0,
             rng.choice(["stock", "crypto", "unknown"])) for _ in range(400)]
    schema = schemas.TICK + ", asset_class string"
    lots = [spark.createDataFrame(rows[i::3] if i < 3 else [], schema) for i in range(4)]
    for volume in ("sum", "max", "last"):
        whole = bars.ohlcv(spark.createDataFrame(rows, schema), volume=volume)
        got = bar_states.bars_of(bar_states.merged(*map(bar_states.bar_states, lots)), volume=volume).select(whole.columns)
        assert got.count() == whole.count() > 0 and got.exceptAll(whole).isEmpty()


def test_asof_join_against_a_plain_search(spark):
    import random

    from tickloom.operators.asof import asof_join

    rng = random.Random(6)
    given = [(k, START + timedelta(minutes=rng.randint(0, 5000)), rng.randint(0, 99)) for k in "AB" for _ in range(60)]
    asked = [(k, START + timedelta(minutes=rng.randint(-500, 6000)), i) for i, k in enumerate("ABC" * 50)] + [("A", START, 900), ("A", START, 900)]
    left, right = spark.createDataFrame(asked, "k string, t timestamp, i int"), spark.createDataFrame(given, "k string, at timestamp, v int")
    want = []
    for k, t, i in asked:
        early = [(at, v) for key, at, v in given if key == k and at <= t]
        want.append((k, t, i, *(max(early) if early else (None, None))))
    for cell in (None, 600, 10**9):
        got = [tuple(r) for r in asof_join(left, right, ("k",), "t", "at", cell).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    with pytest.raises(ValueError):
        asof_join(left, right.withColumnRenamed("v", "i"), ("k",), "t", "at")


def test_digest_from_the_last_bars_alone(spark, tmp_path):
    store, full, state, out = (str(tmp_path / name) for name in ("bars", "full", "state", "out"))
    tables.write_days(bars.ohlcv(ticks(spark, 6)).drop("ticks"), store)
    jobs.run_digest(spark, store, out, "2024-01-03", state_path=state)
    jobs.run_digest(spark, store, out, "2024-01-06", state_path=state, since="2024-01-03")
    for day in ("2024-01-03", "2024-01-06"):
        jobs.run_digest(spark, store, full, day)
    one, two = (tables.read_table(spark, path).drop("as_of") for path in (out, full))
    assert one.count() == two.count() > 0 and one.exceptAll(two).isEmpty()
    with pytest.raises(ValueError, match="no last bars"):
        jobs.run_digest(spark, store, out, "2024-01-06", state_path=state, since="2024-01-04")


def test_late_lots_of_ticks(spark, tmp_path):
    states, out = str(tmp_path / "states"), str(tmp_path / "bars")
    first, late = ticks(spark, 3).filter("hour(time) <> 1"), ticks(spark, 3).filter("hour(time) = 1 and day(time) = 2")
    for lot, rows in ((1, first), (2, late), (2, late)):
        jobs.run_bar_lot(spark, rows, states, out, lot)
    opened = {str(r["event_date"]): (r["open"], r["volume"]) for r in tables.read_table(spark, out).filter("symbol = 'VCB'").collect()}
    assert opened == {"2024-01-01": (102.0, 20), "2024-01-02": (102.0, 30), "2024-01-03": (104.0, 20)}
