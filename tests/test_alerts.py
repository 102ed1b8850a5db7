import json
from datetime import datetime, timedelta

import numpy as np
import pytest

from tickloom import fixed_values as fixed
from tickloom.operators import alerts
from tickloom.operators.cooldown import cooldown
from tickloom.streaming import alerts as stream

TICK = "symbol string, source string, payload map<string,string>"
DROP = {"symbol": "*", "field": "pct_change", "operator": "<=", "threshold": -3.0, "message": "Sharp drop"}
RISE = {"symbol": "VCB", "field": "pct_change", "operator": ">=", "threshold": 2.0, "message": "VCB rose"}
ZERO = {"symbol": "*", "field": "price", "operator": "==", "threshold": 0.0, "message": "Zero price"}


def hits(spark, rules, symbol, payload, source=""):
    texts = {name: None if value is None else str(value) for name, value in payload.items()}
    ticks = spark.createDataFrame([(symbol, source, texts)], TICK)
    return alerts.evaluate_rules(ticks, alerts.rules_table(spark, rules)).orderBy("rule_id").collect()


@pytest.mark.parametrize(
    "rule, symbol, payload, fires",
    [
        (DROP, "MWG", {"price": 61, "pct_change": -4.75}, True),
        (DROP, "FPT", {"price": 7, "pct_change": -3}, True),
        (DROP, "MWG", {"pct_change": -2.999}, False),
        (RISE, "VCB", {"pct_change": 6.125}, True),
        (RISE, "vcb", {"pct_change": 6.125}, False),
        (ZERO, "FPT", {"price": "-0"}, True),
        (ZERO, "FPT", {"price": 1e-9}, False),
        (DROP, "VCB", {"price": 31.0}, False),
        (DROP, "VCB", {"pct_change": None}, False),
        (DROP, "VCB", {"pct_change": "much"}, False),
        (RISE, "VCB", {"pct_change": "nan"}, False),
        ({**RISE, "operator": ">"}, "VCB", {"pct_change": "nan"}, False),
        ({**RISE, "operator": "=="}, "VCB", {"pct_change": "nan"}, False),
        (RISE, "VCB", {"pct_change": "inf"}, True),
    ],
)
def test_single_rules(spark, rule, symbol, payload, fires):
    assert bool(hits(spark, [rule], symbol, payload)) is fires


@pytest.mark.parametrize("op", ["<", ">", "<=", ">=", "=="])
def test_operators_at_and_beside_the_threshold(spark, op):
    rule = {"symbol": "*", "field": "volume", "operator": op, "threshold": 0.25, "message": "m"}
    for value in (-7.5, 0.25, 0.250001):
        assert bool(hits(spark, [rule], "MWG", {"volume": value})) is eval(f"{value} {op} 0.25")


def test_source_scope(spark):
    rules = [{**DROP, "source": "crypto"}, {**DROP, "source": "stock"}, {**DROP, "source": "*"}, DROP]
    found = hits(spark, rules, "VCB", {"pct_change": -9}, "vnstock/KBS")
    assert [row["rule_id"] for row in found] == [2, 3, 4]
    assert [row["rule_id"] for row in hits(spark, rules, "X", {"pct_change": -9}, "other")] == [3, 4]


@pytest.mark.parametrize("more", [0, 400])
def test_a_symbol_that_reads_like_all_fires_once(spark, more):
    others = [{**DROP, "symbol": f"S{i}"} for i in range(more)]
    assert [r["rule_id"] for r in hits(spark, [DROP, *others], "*", {"pct_change": -9})] == [1]


@pytest.mark.parametrize("more", [0, 400])
def test_of_a_repeated_key_the_last_value_counts(spark, more):
    rules = alerts.rules_table(spark, [{**ZERO, "operator": ">="}, *[{**DROP, "symbol": f"S{i}"} for i in range(more)]])
    text = '{"event_type": "price.snapshot", "symbol": "A", "source": "x", "payload": {"price": 5, "price": 7}}'
    found = stream.alert_rows(spark.createDataFrame([(text,)], "value string"), rules).collect()
    assert [(r["rule_id"], r["matched_value"]) for r in found] == [(1, 7.0)]


def test_text_columns(spark):
    ticks = spark.createDataFrame([("A", "x", "12.5"), ("B", "x", "many"), ("C", "x", None)], "symbol string, source string, price string")
    found = alerts.evaluate_rules(ticks, alerts.rules_table(spark, [{**ZERO, "operator": ">"}])).collect()
    assert [(r["symbol"], r["matched_value"]) for r in found] == [("A", 12.5)]


def test_hits_carry_rule_and_value(spark):
    row = hits(spark, [{**DROP, "threshold": -2.0}, DROP], "VCB", {"price": 85, "pct_change": -3.5})
    assert [r["rule_id"] for r in row] == [1, 2]
    assert (row[0]["matched_field"], row[0]["matched_value"], row[0]["message"]) == ("pct_change", -3.5, "Sharp drop")


def test_validation(spark):
    bad = [{**DROP, "operator": "~~"}, {**DROP, "operator": None}]
    table = alerts.rules_table(spark, [DROP, *bad])
    assert [r["rule_id"] for r in alerts.validate_rules(table).collect()] == [1]
    assert sorted(r["rule_id"] for r in alerts.rejected_rules(table).collect()) == [2, 3]
    assert hits(spark, bad, "VCB", {"pct_change": -9}) == []
    assert alerts.validate_rules(alerts.rules_table(spark, [])).count() == 0


def test_rules_file(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps([DROP, {**RISE, "source": "stock"}], indent=2))
    rows = alerts.load_rules(spark, str(path)).orderBy("rule_id").collect()
    assert [(r["rule_id"], r["source"], r["symbol"], r["threshold"]) for r in rows] == [(1, "*", "*", -3.0), (2, "stock", "VCB", 2.0)]
    assert len(fixed.ALERT_RULES) == alerts.rules_table(spark).count() == 11


def test_compiled_rules_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "ticks")
    frame = spark.createDataFrame([("HPG", "stock", 1.0, -4.0)], "symbol string, asset_class string, price double, pct_change double")
    frame.write.parquet(path)
    found = alerts.evaluate_rules(spark.read.parquet(path), alerts.rules_table(spark))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Or(" in plan.split("PushedFilters")[1] and "Join" not in plan and "Exchange" not in plan
    assert found.count() == 1


def test_large_rule_tables(spark):
    rules = [{**DROP, "symbol": f"S{i % 500}", "threshold": -float(i % 7)} for i in range(1000)]
    ticks = spark.createDataFrame([(f"S{i}", "x", {"pct_change": "-3.5"}) for i in range(20)], TICK)
    found = alerts.evaluate_rules(ticks, alerts.rules_table(spark, rules))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Cartesian" not in plan
    want = sorted((f"S{i}", n) for n, r in enumerate(rules, 1) for i in range(20) if r["symbol"] == f"S{i}" and -3.5 <= r["threshold"])
    assert sorted((r["symbol"], r["rule_id"]) for r in found.collect()) == want


def test_broken_rules_are_reported(spark, tmp_path):
    lame = [{**DROP, "threshold": None}, {**DROP, "symbol": None}, {**DROP, "field": None}, DROP]
    table = alerts.rules_table(spark, lame)
    assert sorted(r["rule_id"] for r in alerts.rejected_rules(table).collect()) == [1, 2, 3]
    assert [r["rule_id"] for r in hits(spark, lame, "VCB", {"pct_change": -9})] == [4]
    for number, text in enumerate(('[{"symbol": "*", "field": "pri', '[{"symbol": "*", "threshold": "high"}]')):
        path = tmp_path / f"{number}.json"
        path.write_text(text)
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
            alerts.load_rules(spark, str(path)).collect()


@pytest.mark.parametrize("minutes", [0, -1])
def test_a_cooldown_takes_time(spark, minutes):
    frame = spark.createDataFrame([("A", 1, datetime(2024, 1, 1))], "symbol string, rule_id int, time timestamp")
    for operator in (cooldown, stream.with_cooldown):
        with pytest.raises(ValueError):
            operator(frame, minutes)


def message(symbol, pct, at):
    return json.dumps({"event_type": "price.snapshot", "symbol": symbol, "exchange": "HOSE", "source": "vnstock/KBS",
                       "timestamp": at.isoformat() + "+00:00", "payload": {"price": 84.5, "pct_change": pct}})


def test_alert_line(spark):
    frame = spark.createDataFrame([(message("VCB", -4.25, datetime(2024, 5, 10, 8)),)], "value string")
    rows = stream.alert_rows(frame, alerts.rules_table(spark)).orderBy("rule_id").collect()
    assert [r["rule_id"] for r in rows] == [1, 3]
    assert rows[1]["alert"] == (
        "[ALERT 2024-05-10T08:00:00] VCB        | VCB dropped 2% or more | price=84.50  pct=-4.25%  pct_change=-4.25"
    )


def test_alert_line_without_price(spark):
    text = json.dumps({"event_type": "price.snapshot", "symbol": "VCB", "source": "vnstock", "payload": {"pct_change": 5}})
    row = stream.alert_rows(spark.createDataFrame([(text,)], "value string"), alerts.rules_table(spark, [RISE])).first()
    assert row["alert"] == "[ALERT ] VCB        | VCB rose | price=0.00  pct=+5.00%  pct_change=5"


def greedy(times, wait):
    kept, ready = [], None
    for time in sorted(times):
        if ready is None or time >= ready:
            kept.append(time)
            ready = time + wait
    return kept


def test_cooldown_stream_over_restarts(spark, tmp_path):
    """State carries over micro-batches and restarts; compared with a plain greedy pass."""
    start, inbox = datetime(2024, 5, 10), tmp_path / "in"
    inbox.mkdir()
    minutes = {"A": [0, 1, 4, 5, 6, 9, 10, 30, 31, 36], "B": [2, 3, 8, 40]}
    batches = [(0, 7), (7, 20), (20, 60)]
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for number, (low, high) in enumerate(batches):
        rows = [(s, 1, str(start + timedelta(minutes=m))) for s, ms in minutes.items() for m in ms if low <= m < high]
        lines = [json.dumps({"symbol": s, "rule_id": r, "time": t}) for s, r, t in rows]
        (inbox / f"{number}.json").write_text("\n".join(lines))
        source = spark.readStream.schema("symbol string, rule_id int, time timestamp").json(str(inbox))
        kept = stream.with_cooldown(source, 5)
        (kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())
    found = {}
    for row in spark.read.parquet(out).collect():
        found.setdefault(row["symbol"], []).append(row["time"])
    wait = timedelta(minutes=5)
    for symbol, ms in minutes.items():
        assert sorted(found[symbol]) == greedy([start + timedelta(minutes=m) for m in ms], wait)


@pytest.mark.parametrize("spacing, minutes, span_hours", [(7, 5, 6), (37, 60, 1), (600, 2, 24), (1, 0.5, 1)])
def test_cooldown_table_against_a_greedy_pass(spark, spacing, minutes, span_hours):
    """Sparse, dense and bursty keys; spans are much shorter than the series."""
    rng = np.random.default_rng(spacing)
    start = datetime(2024, 5, 10)
    gaps = {"A": rng.exponential(spacing, 400), "B": np.full(400, spacing), "C": rng.choice([1, 40 * spacing], 400)}
    times = {key: [start + timedelta(seconds=float(s)) for s in np.cumsum(gap)] for key, gap in gaps.items()}
    rows = [(key, 1, time) for key, stamps in times.items() for time in [*stamps, stamps[0]]]
    frame = spark.createDataFrame(rows, "symbol string, rule_id int, time timestamp")
    found = {}
    for row in cooldown(frame, minutes, span_us=span_hours * 3_600_000_000).collect():
        found.setdefault(row["symbol"], []).append(row["time"])
    for key, stamps in times.items():
        # The first alert comes twice, and both are kept.
        assert sorted(found[key]) == [stamps[0], *greedy(stamps, timedelta(minutes=minutes))]


def test_stream_equals_table(spark, sf_dir, tmp_path):
    from tickloom.plans import views

    rules = alerts.rules_table(spark)
    table = stream.alert_rows(views.event_messages(views.events(spark, sf_dir)), rules)
    live = stream.alert_rows(views.event_messages(views.streamed_events(spark, sf_dir)), rules)
    out = str(tmp_path / "out")
    (live.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c"))
     .trigger(availableNow=True).start().awaitTermination())
    stored = spark.read.parquet(out)
    assert stored.count() == table.count() > 0
    assert stored.select(table.columns).exceptAll(table).isEmpty()
