"""Threshold alert rules over ticks: validation, and evaluation on tables and streams."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom import fixed_values as fixed, schemas
from tickloom.functions.coerce import all_of, any_of, asset_class_of_source, once, to_double
from tickloom.functions.text import alert_text

HIT_COLUMNS = ["rule_id", "message", "matched_field", "operator", "threshold", "matched_value"]


RULE_ARRAY = "array<struct<" + ", ".join(field.replace(" ", ": ", 1) for field in schemas.RULE.split(", ")) + ">>"


def _parsed(documents: DataFrame, value: str) -> DataFrame:
    """JSON arrays of rules as rows; ``rule_id`` counts from 1 in the order of the array. Broken JSON raises."""
    document = F.from_json(value, RULE_ARRAY, {"mode": "FAILFAST"})
    rules = documents.select(F.posexplode(document).alias("_at", "_rule"))
    return rules.select((F.col("_at") + 1).alias("rule_id"), "_rule.*").withColumn(
        "source", F.coalesce("source", F.lit("*"))
    )


def rules_table(spark: SparkSession, rules: list[dict] | None = None) -> DataFrame:
    """Rule dictionaries (default: the shipped set) as a table."""
    document = json.dumps(fixed.ALERT_RULES if rules is None else rules)
    return _parsed(spark.range(1).select(F.lit(document).alias("value")), "value")


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    """Read a JSON array of rules; the file is one configuration document."""
    return _parsed(spark.read.text(path, wholetext=True), "value")


def rule_usable() -> Column:
    """A known operator, and a symbol, a field and a threshold."""
    known = F.coalesce(F.col("operator").isin(*fixed.RULE_OPERATORS), F.lit(False))
    return known & all_of(F.col(name).isNotNull() for name in ("symbol", "field", "threshold"))


def validate_rules(rules: DataFrame) -> DataFrame:
    """Rules that can be evaluated."""
    return rules.filter(rule_usable())


def rejected_rules(rules: DataFrame) -> DataFrame:
    """Rules that ``validate_rules`` drops."""
    return rules.filter(~rule_usable())


def payload_text(df: DataFrame, payload: str = "payload"):
    """Reads a field's text from a payload, a struct or a map; of a repeated key the last, as JSON parsers do."""
    kind = df.schema[payload].dataType
    if kind.typeName() == "struct":
        return lambda field: F.col(payload)[field] if field in kind.names else F.lit(None).cast("string")
    named = lambda field: F.filter(F.map_entries(payload), lambda entry: entry["key"] == field)
    return lambda field: F.try_element_at(named(field), F.lit(-1))["value"]


def payload_value(df: DataFrame, payload: str = "payload"):
    """Reads a field of a payload as a number; absent or non-numeric texts are null."""
    text = payload_text(df, payload)
    return lambda field: text(field).try_cast("double")


def column_value(df: DataFrame):
    """Reads a field from a column of that name as a number; null when the table has none or it is no number."""
    return lambda field: (F.col(field) if field in df.columns else F.lit(None)).try_cast("double")


# Comparisons by operator. NaN sorts above every number in Spark, hence the upper bound:
# unlike isnan() it is a plain comparison that can be pushed into a scan.
COMPARISONS = {
    "<": lambda value, threshold: value < threshold,
    ">": lambda value, threshold: (value > threshold) & (value <= float("inf")),
    "<=": lambda value, threshold: value <= threshold,
    ">=": lambda value, threshold: (value >= threshold) & (value <= float("inf")),
    "==": lambda value, threshold: value == threshold,
}


def threshold_met(operator: Column, value: Column, threshold: Column) -> Column:
    """The comparison named by the ``operator`` column; null and NaN values never match."""
    cases = [F.when(operator == name, compare(value, threshold)) for name, compare in COMPARISONS.items()]
    return F.coalesce(*cases, F.lit(False))


def _no_hits() -> list[Column]:
    kinds = ["int", "string", "string", "string", "double", "double"]
    return [F.lit(None).cast(kind).alias(name) for name, kind in zip(HIT_COLUMNS, kinds)]


def _may_fire(rules: list, value_of) -> Column:
    """True for every tick that a rule fires on, and few others: for each field one range for each kind of comparison.

    Plain comparisons of columns, so that they reach the scan; their number is that of the fields, not of the rules.
    """
    ranges = []
    for field in dict.fromkeys(rule.field for rule in rules):
        of = lambda *names: [r.threshold for r in rules if r.field == field and r.operator in names]  # noqa: E731, B023
        value = value_of(field)
        if below := of("<", "<="):
            ranges.append(value <= max(below))
        if above := of(">", ">="):
            ranges.append((value >= min(above)) & (value <= float("inf")))
        if same := of("=="):
            ranges.append(value.between(min(same), max(same)))
    return any_of(ranges)


def evaluate_rules(ticks: DataFrame, rules: DataFrame, value_of=None) -> DataFrame:
    """Every (tick, rule) pair that fires: the tick's columns plus the rule's.

    ``ticks`` carries ``symbol`` and ``source`` (or ``asset_class``). ``value_of`` maps a field name to a Column; the
    default reads the ``payload`` when there is one, else columns. The rules are one configuration document: they become
    constants, those of one symbol under its name and those of all apart, so a tick looks at the rules of its symbol and
    the general ones. No join, no state and no shuffle, whatever their number; works on streams in append mode.
    """
    has_payload = "payload" in ticks.columns
    if value_of is None:
        value_of = payload_value(ticks) if has_payload else column_value(ticks)
    asset_class = (
        F.col("asset_class")
        if "asset_class" in ticks.columns
        else asset_class_of_source(F.coalesce("source", F.lit("")))
    )
    table = validate_rules(rules).orderBy("rule_id").collect()
    if not table:
        return ticks.filter(F.lit(False)).select("*", *_no_hits())
    fields = list(dict.fromkeys(rule.field for rule in table))
    if not has_payload:
        ticks = ticks.filter(_may_fire(table, value_of))
    # Every field and the asset class are read once per tick, not once per rule.
    prepared = once(ticks, _class=asset_class, _values=F.array(*[value_of(field) for field in fields]))
    if has_payload:
        prepared = prepared.filter(_may_fire(table, lambda field: F.col("_values")[fields.index(field)]))
    kind = "array<struct<rule_id: int, at: int, " + RULE_ARRAY[13:]
    general: list[dict] = []
    by_symbol: dict[str, list[dict]] = {}
    for rule in table:
        own = general if rule.symbol == "*" else by_symbol.setdefault(rule.symbol, [])
        own.append({**rule.asDict(), "at": fields.index(rule.field)})
    constant = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)
    candidates = constant(general, kind)
    if by_symbol:
        own = F.try_element_at(constant(by_symbol, f"map<string, {kind}>"), F.col("symbol"))
        candidates = F.concat(candidates, F.coalesce(own, F.array().cast(kind)))
    fires = lambda rule: (rule["source"].isin("*") | (rule["source"] == F.col("_class"))) & threshold_met(
        rule["operator"], F.col("_values")[rule["at"]], rule["threshold"]
    )
    hits = prepared.select("*", F.explode(F.filter(candidates, lambda rule: F.coalesce(fires(rule), F.lit(False)))).alias("_rule"))
    rule = F.col("_rule")
    cells = [rule["rule_id"], rule["message"], rule["field"], rule["operator"], rule["threshold"], F.col("_values")[rule["at"]]]
    return hits.select(*ticks.columns, *[cell.alias(name) for cell, name in zip(cells, HIT_COLUMNS)])


def with_alert_text(hits: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """Add ``alert``, the printable line. Payload ticks print the payload's own value text."""
    has_payload = "payload" in hits.columns
    if has_payload:
        text_of = payload_text(hits)
        price, change = to_double(text_of("price")), to_double(text_of("pct_change"))
        kind = hits.schema["payload"].dataType
        if kind.typeName() == "struct":
            value = F.coalesce(*[F.when(F.col("matched_field") == name, text_of(name)) for name in kind.names])
        else:
            value = text_of(F.col("matched_field"))
    else:
        price, change = F.col("price").cast("double"), F.col("pct_change").cast("double")
        value = F.col("matched_value").cast("string")
    stamp = timestamp if timestamp is not None else (F.col("timestamp") if "timestamp" in hits.columns else
                                                     F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss"))
    text = alert_text(stamp, F.col("symbol"), F.col("message"), price, change, F.col("matched_field"), value)
    return hits.withColumn("alert", text)
