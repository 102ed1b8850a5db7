from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Observation, functions as F

from tickloom.operators import bars
from tickloom.operators.quality import gate, quality_report

DAY = datetime(2024, 5, 10)
SCHEMA = "time timestamp, symbol string, exchange string, price double, volume bigint"


def ticks(spark, *rows):
    return spark.createDataFrame(
        [(DAY + timedelta(seconds=s), symbol, "HOSE", float(price), volume) for s, symbol, price, volume in rows], SCHEMA
    )


def bar(df, **options):
    return bars.ohlcv(df, **options).first()


def test_one_tick(spark):
    row = bar(ticks(spark, (5, "VCB", 10, 7)))
    assert (row["open"], row["high"], row["low"], row["close"], row["volume"], row["ticks"]) == (10, 10, 10, 10, 7, 1)
    assert row["time"] == DAY and row["asset_class"] == "stock"


def test_open_and_close_follow_time(spark):
    row = bar(ticks(spark, (30, "VCB", 12, 1), (10, "VCB", 11, 2), (20, "VCB", 15, 3), (25, "VCB", 9, 4)))
    assert (row["open"], row["high"], row["low"], row["close"], row["volume"]) == (11, 15, 9, 12, 10)


def test_equal_times_open_low_close_high(spark):
    row = bar(ticks(spark, (1, "VCB", 12, 1), (1, "VCB", 11, 1), (9, "VCB", 13, 1), (9, "VCB", 14, 1)))
    assert (row["open"], row["close"]) == (11, 14)


def test_midnight_belongs_to_the_new_day(spark):
    found = bars.ohlcv(ticks(spark, (86_399, "VCB", 1, 1), (86_400, "VCB", 2, 1)))
    assert sorted(r["time"] for r in found.collect()) == [DAY, DAY + timedelta(days=1)]


@pytest.mark.parametrize("mode, volume", [("sum", 9), ("last", 3), ("max", 4)])
@pytest.mark.parametrize("unique", [False, True])
def test_volume_modes(spark, mode, volume, unique):
    df = ticks(spark, (1, "VCB", 5, 2), (2, "VCB", 5, 4), (3, "VCB", 5, 3))
    assert bar(df, volume=mode, unique_times=unique)["volume"] == volume


def test_unknown_volume_mode(spark):
    with pytest.raises(ValueError):
        bars.ohlcv(ticks(spark, (1, "VCB", 5, 2)), volume="mean")


def test_dedupe_removes_exact_repeats_only(spark):
    df = ticks(spark, (1, "VCB", 5, 2), (1, "VCB", 5, 2), (1, "VCB", 6, 2))
    assert bar(df)["volume"] == 6 and bar(df, dedupe=True)["volume"] == 4


def test_hash_plan_for_unique_times(spark):
    df = ticks(spark, (1, "VCB", 5, 2))
    plan = bars.ohlcv(df, unique_times=True)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(0, 3 * 86_400), st.sampled_from(["A", "B/USDT"]), st.integers(0, 50), st.integers(-5, 50)),
        min_size=1, max_size=60,
    )
)
def test_bars_against_plain_python(spark, rows):
    want = {}
    for second, symbol, price, volume in rows:
        want.setdefault((symbol, second // 86_400), []).append((second, float(price), volume))
    found = bars.ohlcv(ticks(spark, *rows)).collect()
    assert len(found) == len(want)
    for row in found:
        group = want[row["symbol"], (row["time"] - DAY).days]
        first, last = min(s for s, _, _ in group), max(s for s, _, _ in group)
        prices = [p for _, p, _ in group]
        assert row["open"] == min(p for s, p, _ in group if s == first)
        assert row["close"] == max(p for s, p, _ in group if s == last)
        assert (row["high"], row["low"], row["volume"]) == (max(prices), min(prices), sum(v for _, _, v in group))


def test_valid_bars_counts_in_one_pass(spark):
    df = bars.ohlcv(ticks(spark, (1, "VCB", 5, 2), (1, "ACB", 5, -2)))
    counts = Observation("test")
    assert [r["symbol"] for r in bars.valid_bars(df, counts).collect()] == ["VCB"]
    assert counts.get == {"bars": 2, "dropped": 1}


def test_null_volume_makes_a_bar_invalid(spark):
    df = bars.ohlcv(ticks(spark, (1, "VCB", 5, None)))
    assert bars.valid_bars(df).count() == 0


def test_day_filter_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    picked = bars.day_filter(events, "2024-01-10", "2024-01-11", "ts")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-01-10T00:00), LessThan(ts,2024-01-12T00:00)]" in plan
    assert {str(d[0]) for d in picked.select(F.to_date("ts")).distinct().collect()} == {"2024-01-10", "2024-01-11"}


def test_quality_gate(spark):
    df = ticks(spark, (1, "VCB", 5, 2), (2, "VCB", 6, 2))
    report = quality_report(bars.ohlcv(df, fault_counts=True))
    gate(report)
    assert {r["check"]: r["failed"] for r in report.collect()}["fewer than two ticks"] == 0
    bad = ticks(spark, (1, "VCB", 0, 2))
    with pytest.raises(ValueError, match="price not positive: 1 of 1"):
        gate(quality_report(bars.ohlcv(bad, fault_counts=True)))
    empty = quality_report(bars.ohlcv(df.filter("false"), fault_counts=True))
    assert {(r["rows"], r["failed"]) for r in empty.collect()} == {(0, 0)}
