"""Decode JSON messages, route them by event type and split good ticks from dead letters.

Everything is a projection: no shuffle, no Python, the same code on a table and on a stream.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tickloom import fixed_values as fixed, schemas
from tickloom.functions.coerce import (
    any_of,
    asset_class_of_source,
    beyond_bigint,
    number,
    once,
    parse_iso,
    to_bigint,
    to_double,
    utc_date,
)

GOOD, DEAD, IGNORED = "good", "dead", "ignored"


def decode(messages: DataFrame, value: str = "value", payload_fields: list[str] | None = None) -> DataFrame:
    """Parse the JSON text into envelope columns, keeping the text as ``message``.

    ``payload`` is a map of texts, or a struct of just ``payload_fields``, which is cheaper
    to parse. ``parse_error`` is null for a JSON object whose fields fit the envelope.
    """
    schema = schemas.ENVELOPE
    if payload_fields:
        fields = ", ".join(f"`{name.replace('`', '``')}`: string" for name in payload_fields)
        schema = schema.replace("map<string,string>", f"struct<{fields}>")
    corrupt = "parse_error"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    parsed = F.from_json("message", f"{schema}, {corrupt} string", options)
    others = [name for name in messages.columns if name != value]
    texts = messages.select(*others, F.col(value).cast("string").alias("message"))
    # As in once(): each text is parsed one time. A null struct yields a row of nulls.
    decoded = texts.select("*", F.inline(F.array(parsed)))
    # A blank text parses to nothing at all; only a JSON object lists keys.
    blank = F.coalesce(F.trim("message"), F.lit("")) == ""
    not_object = blank | (F.col(corrupt).isNotNull() & F.json_object_keys("message").isNull())
    return decoded.withColumn(
        corrupt,
        F.when(not_object, F.lit("malformed json")).when(F.col(corrupt).isNotNull(), F.lit("bad field type")),
    )


def snapshot_values() -> dict[str, Column]:
    """What both the fault and the tick of a ``price.snapshot`` need, evaluated once per row."""
    payload = F.col("payload")
    return {f"_{name}": number(payload[name]) for name in fixed.PAYLOAD_BIGINTS}


def snapshot_fault() -> Column:
    """Why a ``price.snapshot`` envelope cannot become a tick; null when it can."""
    beyond = any_of(beyond_bigint(F.col(f"_{name}")) for name in fixed.PAYLOAD_BIGINTS)
    return (
        F.when(F.col("timestamp").isNull(), F.lit("missing timestamp"))
        .when(F.col("time").isNull(), F.lit("bad timestamp"))
        .when(F.col("symbol").isNull(), F.lit("missing symbol"))
        .when(F.col("payload").isNull(), F.lit("missing payload"))
        .when(beyond, F.lit("volume out of range"))
    )


def snapshot_tick() -> list[Column]:
    """Typed tick columns of a ``price.snapshot`` envelope."""
    payload = F.col("payload")
    cells = {
        "time": F.col("time"),
        "symbol": F.col("symbol"),
        "exchange": F.coalesce("exchange", F.lit("")),
        **{name: to_double(payload[name]) for name in fixed.PAYLOAD_DOUBLES},
        **{name: to_bigint(F.col(f"_{name}"), text=False) for name in fixed.PAYLOAD_BIGINTS},
    }
    return [cells[name].alias(name) for name in schemas.TICK_COLUMNS]


class Extractor(NamedTuple):
    """How one event type is landed: shared values, the fault, and the columns."""

    values: Callable[[], dict[str, Column]]
    fault: Callable[[], Column]
    columns: Callable[[], list[Column]]


# One entry per event type that is landed.
EXTRACTORS = {fixed.PRICE_SNAPSHOT: Extractor(snapshot_values, snapshot_fault, snapshot_tick)}


def of_type(envelopes: DataFrame, *event_types: str) -> DataFrame:
    """Keep the given event types; other types and null drop out."""
    return envelopes.filter(F.col("event_type").isin(*event_types))


def classify(envelopes: DataFrame, extractors: dict[str, Extractor] = EXTRACTORS) -> DataFrame:
    """Add the parsed ``time``, ``status`` (good, dead or ignored) and the dead-letter ``reason``."""
    known = F.coalesce(F.col("event_type").isin(*extractors), F.lit(False))
    fault = F.lit(None).cast("string")
    values = {"time": parse_iso(F.col("timestamp"))}
    for event_type, extractor in extractors.items():
        values |= extractor.values()
        fault = F.when(F.col("event_type") == event_type, extractor.fault()).otherwise(fault)
    error = F.col("parse_error")
    reason = F.when(error == "malformed json", error).when(known, F.coalesce(error, fault))
    status = F.when(F.col("reason").isNotNull(), F.lit(DEAD)).when(known, F.lit(GOOD)).otherwise(F.lit(IGNORED))
    return once(once(envelopes, **values), reason=reason).withColumn("status", status)


def ticks_of(
    classified: DataFrame, event_type: str = fixed.PRICE_SNAPSHOT, keep: tuple[str, ...] = (),
    extractors: dict[str, Extractor] = EXTRACTORS,
) -> DataFrame:
    """Good rows of one event type as its typed rows plus ``asset_class`` and ``event_date``."""
    good = classified.filter((F.col("status") == GOOD) & (F.col("event_type") == event_type))
    source = F.coalesce("source", F.lit(""))
    return good.select(
        *keep,
        *extractors[event_type].columns(),
        asset_class_of_source(source).alias("asset_class"),
        utc_date(F.col("time")).alias("event_date"),
    )


def dead_letters_of(classified: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows that could not be landed, with the reason, the original message and when it was read."""
    return classified.filter(F.col("status") == DEAD).select(
        *keep,
        "reason",
        "message",
        F.coalesce("event_type", F.lit("unknown")).alias("event_type"),
        F.current_timestamp().alias("ingest_ts"),
    )
