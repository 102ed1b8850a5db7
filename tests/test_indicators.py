import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions.ema import Macd
from tickloom.operators import incremental, indicators, series
from tickloom.schemas import INDICATOR_COLUMNS

LENGTHS = {"A": 4500, "B": 1999, "C": 2000, "D": 13, "E": 14, "F": 25, "G": 26, "H": 199, "I": 200, "J": 1}


def closes(symbol, n, start="2000-01-01"):
    rng = np.random.default_rng(n)
    times = pd.date_range(start, periods=n, freq="D")
    return pd.DataFrame(
        {"symbol": symbol, "exchange": "X", "time": times, "close": np.round(500 + np.cumsum(rng.normal(0, 3, n)), 2)}
    )


def expected(group):
    out, close = group.copy(), group["close"]
    n = np.arange(1, len(close) + 1)
    for bars in (20, 50, 200):
        out[f"sma{bars}"] = close.rolling(bars).mean()
    spread = 2 * close.rolling(20).std(ddof=0)
    out["bb_mid"], out["bb_upper"], out["bb_lower"] = out["sma20"], out["sma20"] + spread, out["sma20"] - spread
    change = close.diff().fillna(0)
    gain, loss = (part.rolling(14).sum() for part in (change.clip(lower=0), -change.clip(upper=0)))
    with np.errstate(divide="ignore", invalid="ignore"):
        value = np.where(loss.abs() < 1e-9, 100.0, 100 - 100 / (1 + gain / loss))
    out["rsi14"] = np.where(n < 14, np.nan, value)
    line = close.ewm(span=12, adjust=False).mean() - close.ewm(span=26, adjust=False).mean()
    signal = line.ewm(span=9, adjust=False).mean()
    for name, values in (("macd", line), ("macd_signal", signal), ("macd_hist", line - signal)):
        out[name] = np.where(n < 26, np.nan, values)
    return out


@pytest.fixture(scope="module")
def history():
    return pd.concat([closes(symbol, n) for symbol, n in LENGTHS.items()], ignore_index=True)


@pytest.fixture(scope="module")
def bars(spark, history):
    return spark.createDataFrame(history).cache()


@pytest.fixture(scope="module")
def wanted(history):
    return pd.concat([expected(group) for _, group in history.groupby("symbol")], ignore_index=True)


def same(got, want, columns=INDICATOR_COLUMNS):
    order = ["symbol", "time"]
    got, want = (frame.sort_values(order).reset_index(drop=True) for frame in (got, want))
    assert got[order].equals(want[order].astype(got[order].dtypes))
    for name in columns:
        np.testing.assert_allclose(
            got[name].astype(float), want[name].astype(float), rtol=0, atol=2e-9, equal_nan=True, err_msg=name
        )


def test_full_series(bars, wanted):
    same(indicators.indicators(bars).toPandas(), wanted)


@pytest.mark.parametrize("days, block", [(7, 200), (365, 256)])
def test_cuts_do_not_change_results(bars, wanted, days, block):
    """Small cells and blocks: every series is cut many times."""
    rolled = indicators.rolling_indicators(bars, cell_seconds=days * series.DAY, block_rows=block)
    same(rolled.toPandas(), wanted, ["sma20", "sma50", "sma200", "bb_mid", "bb_upper", "bb_lower", "rsi14"])


def test_macd_blocks_of_other_lengths(bars, wanted, monkeypatch):
    monkeypatch.setattr(Macd, "block_rows", lambda self: 577)
    same(indicators.macd_series(bars, cell_seconds=30 * series.DAY).toPandas(), wanted, ["macd", "macd_signal", "macd_hist"])


@pytest.mark.parametrize("missing", [None, float("nan"), float("inf")])
def test_bars_without_a_close_are_no_part_of_a_series(spark, missing):
    """One such bar changes nothing in any variant, stored states included."""
    start = datetime(2024, 1, 1)
    closes = [100 + 7 * math.sin(i / 3) + i / 10 for i in range(120)]
    schema = "symbol string, exchange string, time timestamp, close double"
    whole = spark.createDataFrame([("A", "X", start + timedelta(days=i), c) for i, c in enumerate(closes)], schema)
    broken = whole.union(spark.createDataFrame([("A", "X", start + timedelta(days=40, hours=1), missing), ("A", "X", start + timedelta(days=119, hours=1), missing)], schema))
    line = pd.Series(closes).ewm(span=12, adjust=False).mean() - pd.Series(closes).ewm(span=26, adjust=False).mean()
    for operator in (indicators.latest_indicators, indicators.latest_macd_of, lambda b: incremental.snapshot(incremental.indicator_state(b))):
        got, want = operator(broken).first(), operator(whole).first()
        assert got["macd"] == pytest.approx(line.iloc[-1])
        numbers = [name for name, value in want.asDict().items() if isinstance(value, float)]
        assert [got[n] for n in numbers] == pytest.approx([want[n] for n in numbers])
    assert indicators.macd_series(broken).count() == 120


def test_a_state_refuses_older_bars(spark):
    schema = "symbol string, exchange string, time timestamp, close double"
    rows = [("A", "X", datetime(2024, 1, 1) + timedelta(days=i), float(i)) for i in range(5)]
    state = incremental.indicator_state(spark.createDataFrame(rows, schema))
    with pytest.raises(Exception, match="not newer"):
        incremental.advance_state(state, spark.createDataFrame(rows[4:], schema)).collect()
    assert incremental.advance_state(state, spark.createDataFrame([("B", *rows[0][1:])], schema)).count() == 2


def test_latest(bars, wanted):
    last = wanted.sort_values("time").groupby("symbol").tail(1)
    same(indicators.latest_indicators(bars).toPandas(), last)


def test_other_spans(bars, history):
    got = indicators.macd_series(bars, macd=Macd(8, 40, 13)).toPandas()

    def lines(group):
        close = group["close"]
        line = close.ewm(span=8, adjust=False).mean() - close.ewm(span=40, adjust=False).mean()
        signal = line.ewm(span=13, adjust=False).mean()
        late = np.arange(1, len(close) + 1) < 26
        return group.assign(macd=line.mask(late), macd_signal=signal.mask(late), macd_hist=(line - signal).mask(late))

    want = pd.concat([lines(group) for _, group in history.groupby("symbol")])
    same(got, want, ["macd", "macd_signal", "macd_hist"])


@pytest.mark.parametrize("spans", [(1, 26, 9), (12, 26, 12), (9, 26, 9)])
def test_unsupported_spans_are_refused(spans):
    with pytest.raises(ValueError):
        Macd(*spans)


def test_flat_and_rising_series(spark):
    times = pd.date_range("2024-01-01", periods=40, freq="D")
    flat = pd.DataFrame({"symbol": "F", "exchange": "X", "time": times, "close": 100.0})
    rising = pd.DataFrame({"symbol": "R", "exchange": "X", "time": times, "close": 100.0 + np.arange(40)})
    got = indicators.latest_indicators(spark.createDataFrame(pd.concat([flat, rising]))).toPandas().set_index("symbol")
    assert got.loc["F", "rsi14"] == 100 and got.loc["R", "rsi14"] == 100
    assert got.loc["F", "macd"] == pytest.approx(0, abs=1e-9)
    assert got.loc["R", "macd"] > 0
    assert got.loc["R", "bb_lower"] < got.loc["R", "bb_mid"] < got.loc["R", "bb_upper"]
    assert got.loc["R", "macd_hist"] == got.loc["R", "macd"] - got.loc["R", "macd_signal"]


def test_exchanges_interleave_or_stay_apart(spark):
    left, right = closes("S", 40), closes("S", 40).assign(exchange="Y")
    frame = spark.createDataFrame(pd.concat([left, right]))
    together = indicators.rolling_indicators(frame).agg(F.max("bar_number")).first()[0]
    apart = indicators.rolling_indicators(frame, ("symbol", "exchange"), ties=()).agg(F.max("bar_number")).first()[0]
    assert (together, apart) == (80, 40)
    assert indicators.indicators(frame).count() == 80


def test_number_rows(bars, history):
    got = series.number_rows(bars, ("symbol",), ties=("exchange",), cell_seconds=10 * series.DAY).toPandas()
    want = history.sort_values(["symbol", "time"]).groupby("symbol").cumcount() + 1
    got = got.sort_values(["symbol", "time"])
    assert (got["_n"].to_numpy() == want.to_numpy()).all()
    assert (got["_total"] == got["symbol"].map(LENGTHS)).all()


def test_halo_must_fit(bars):
    numbered = series.number_rows(bars, ("symbol",))
    with pytest.raises(ValueError):
        series.with_halo(numbered, 10, 11)


def test_no_block_exceeds_its_size(bars):
    blocks = series.with_halo(series.number_rows(bars, ("symbol",)), 256, 199)
    assert blocks.groupBy("symbol", "_block").count().agg(F.max("count")).first()[0] <= 256 + 199
    assert blocks.filter("_own").count() == sum(LENGTHS.values())


def test_with_previous(bars, history):
    got = series.with_previous(bars, "close", "before", ("symbol",), cell_seconds=5 * series.DAY, block_rows=4).toPandas()
    want = history.sort_values(["symbol", "time"])
    got = got.sort_values(["symbol", "time"])
    pd.testing.assert_series_equal(
        got["before"].reset_index(drop=True), want.groupby("symbol")["close"].shift().reset_index(drop=True), check_names=False
    )


def test_latest_rows_has_a_total_order(spark):
    day = datetime(2024, 1, 1)
    frame = spark.createDataFrame([("A", "X", day, 1.0), ("A", "Y", day, 2.0)], "symbol string, exchange string, time timestamp, close double")
    assert series.latest_rows(frame, ("symbol",), ties=("exchange",)).first()["close"] == 2.0


@pytest.mark.parametrize("split", ["2000-01-10", "2000-07-01", "2003-01-01"])
def test_incremental_equals_full(spark, bars, wanted, split):
    """Keys that end before the split, start after it (none here) or continue."""
    at = F.lit(split).cast("timestamp")
    state = incremental.indicator_state(bars.filter(F.col("time") < at))
    advanced = incremental.advance_state(state, bars.filter(F.col("time") >= at))
    last = wanted.sort_values("time").groupby("symbol").tail(1)
    same(incremental.snapshot(advanced).toPandas(), last)
    assert advanced.agg(F.max(F.size("tail"))).first()[0] == 200


def test_incremental_new_symbol(spark, bars, wanted):
    state = incremental.indicator_state(bars.filter("symbol <> 'A'"))
    advanced = incremental.advance_state(state, bars.filter("symbol = 'A'"))
    same(incremental.snapshot(advanced).toPandas(), wanted.sort_values("time").groupby("symbol").tail(1))


def test_cells_follow_each_key(spark):
    """A key with a row a second gets short cells; neither it nor a single bar shortens those of a sparse key."""
    dense = spark.range(20_000).select(F.lit("A").alias("symbol"), F.timestamp_seconds("id").alias("time"))
    sparse = spark.range(9000).select(F.lit("B").alias("symbol"), F.timestamp_seconds(F.col("id") * series.DAY).alias("time"))
    single = spark.range(1).select(F.lit("C").alias("symbol"), F.timestamp_seconds("id").alias("time"))
    rows = dense.union(sparse).union(single)
    lengths = {r["symbol"]: r["_length"] for r in series.cells_of(rows, ("symbol",)).collect()}
    assert lengths["A"] == series.CELL_ROWS and lengths["B"] == pytest.approx(series.CELL_ROWS * series.DAY, rel=1e-3)
    sizes = series.with_cells(rows, ("symbol",)).groupBy("symbol", "_cell").count().groupBy("symbol").count().collect()
    assert {r["symbol"]: r["count"] for r in sizes} == {"A": 5, "B": 3, "C": 1}
    assert series.cells_of(rows.limit(0), ("symbol",)).count() == 0


def recursion(closes, fast=12, slow=26, signal=9):
    f = s = closes[0]
    g, out = 0.0, []
    for i, x in enumerate(closes):
        if i:
            f += 2 / (fast + 1) * (x - f)
            s += 2 / (slow + 1) * (x - s)
            g += 2 / (signal + 1) * (f - s - g)
        out.append((f, s, g))
    return out


@pytest.mark.parametrize("block", [None, 64])
def test_macd_never_forgets(spark, monkeypatch, block):
    """Prices fall from 1e300 to 1e-3: thousands of bars later the old ones still outweigh all new ones."""
    if block:
        monkeypatch.setattr(Macd, "block_rows", lambda self: block)
        monkeypatch.setattr(indicators, "RUN", 4)
    closes = [1e300] * 30 + [1e-3] * 9000 + [5.0] * 10
    start = datetime(2000, 1, 1)
    rows = [("A", "X", start + timedelta(days=i), c) for i, c in enumerate(closes)]
    bars = spark.createDataFrame(rows, "symbol string, exchange string, time timestamp, close double")
    want = recursion(closes)
    got = {r["time"]: r for r in indicators.macd_series(bars).collect()}
    for i in [25, 29, 30, 40, 600, 577 + 30, 2000, 2575, 2576, 2577, 5000, 5153, 7000, 8999, len(closes) - 1]:
        f, s, g = want[i]
        row = got[rows[i][2]]
        size = max(abs(f), abs(s), abs(g))
        assert row["macd"] == pytest.approx(f - s, rel=1e-9, abs=1e-9 * size)
        assert row["macd_signal"] == pytest.approx(g, rel=1e-9, abs=1e-9 * size)
    f, s, g = want[-1]
    last = indicators.latest_macd_of(bars).first()
    assert last["macd"] == pytest.approx(f - s, rel=1e-9) and last["macd_signal"] == pytest.approx(g, rel=1e-9)


def test_latest_reads_the_bars_twice(spark, tmp_path, history):
    """Once for the cells' lengths and once for the rows; nothing is numbered."""
    path = str(tmp_path / "bars")
    spark.createDataFrame(history).write.parquet(path)
    plan = indicators.latest_indicators(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert sum(line.count("FileScan") for line in plan.split("== Initial Plan ==")[0].splitlines() if "bars" in line) == 1
    assert "Window" not in plan


def test_replay_of_changed_bars(spark, bars, wanted, history):
    """States of three days; bars of two keys changed, one key's removed after its first, one key new in the past."""
    ladder = None
    for as_of in ("2000-02-01", "2001-01-01", "2008-01-01"):
        early = bars.filter((F.col("time") <= F.lit(as_of).cast("timestamp")) & (F.col("symbol") != "E"))
        state = incremental.indicator_state(early).withColumn("as_of", F.lit(as_of).cast("date"))
        ladder = state if ladder is None else ladder.unionByName(state)
    changed = history.copy()
    at = lambda day: pd.Timestamp(day)
    changed.loc[(changed["symbol"] == "A") & (changed["time"] == at("2000-12-24")), "close"] += 50.0
    changed.loc[(changed["symbol"] == "B") & (changed["time"] == at("2000-01-05")), "close"] -= 70.0
    changed = changed[(changed["symbol"] != "H") | (changed["time"] < at("2000-03-01"))]
    changed = changed[changed["time"] <= at("2008-01-01")]
    times = [("A", datetime(2000, 12, 24)), ("B", datetime(2000, 1, 5)), ("H", datetime(2000, 3, 1)), ("E", datetime(2000, 1, 1))]
    changes = spark.createDataFrame(times, "symbol string, changed_from timestamp")
    got = incremental.snapshot(incremental.replayed_state(ladder, spark.createDataFrame(changed), changes)).toPandas()
    want = pd.concat([expected(group).tail(1) for _, group in changed.groupby("symbol")])
    same(got, want)
