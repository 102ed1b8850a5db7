"""Alert rules on a stream, and the cooldown that keeps a rule from firing on every tick."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickloom import fixed_values as fixed
from tickloom.functions.coerce import parse_iso
from tickloom.operators.alerts import evaluate_rules, validate_rules, with_alert_text
from tickloom.operators.extract import decode, of_type


def alert_rows(messages: DataFrame, rules: DataFrame) -> DataFrame:
    """Messages -> one row per tick and firing rule, with the printable line. No state, no shuffle."""
    # Only what the rules and the line read is parsed; of a repeated key the last value counts, as in landing.
    fields = [row["field"] for row in validate_rules(rules).select("field").distinct().orderBy("field").collect()]
    snapshots = of_type(decode(messages, payload_fields=[*dict.fromkeys([*fields, "price", "pct_change"])]), fixed.PRICE_SNAPSHOT)
    hits = evaluate_rules(snapshots.drop("parse_error", "message"), rules)
    payload = F.col("payload")
    return with_alert_text(hits).select(
        *[name for name in messages.columns if name not in ("value", "message")],
        parse_iso(F.col("timestamp")).alias("time"),
        "symbol", "rule_id", "message", "matched_field", "matched_value",
        payload["price"].try_cast("double").alias("price"),
        payload["pct_change"].try_cast("double").alias("pct_change"),
        "alert",
    )


def console(alerts: DataFrame, checkpoint: str) -> DataStreamWriter:
    return (
        alerts.select("alert").writeStream.queryName("alerts").format("console")
        .option("truncate", False).option("checkpointLocation", checkpoint)
    )


def with_cooldown(
    alerts: DataFrame, minutes: float, keys: tuple[str, ...] = ("symbol", "rule_id"), lateness: str = "10 minutes"
) -> DataFrame:
    """Of each key, only alerts at least ``minutes`` after the last one kept, with all their columns.

    Alerts of one instant in a micro-batch are kept together.

    The watermark decides what counts: alerts later than ``lateness`` are dropped by the stream, and within a micro-batch
    alerts are taken in time order, so an alert that arrives after a later one was kept is in its cooldown. State is one timestamp per key, removed once the watermark shows that the cooldown is
    over; the source's rate limit bounds how many alerts of a key a micro-batch holds.
    """
    if minutes <= 0:
        raise ValueError("a cooldown takes more than 0 minutes")
    wait_us = int(minutes * 60_000_000)
    alerts = alerts.withWatermark("time", lateness)

    def keep(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches), ignore_index=True)
        of_row = rows["time"].to_numpy("datetime64[us]").view("int64")
        stamps = np.sort(of_row)
        ready = state.get[0] + wait_us if state.exists else stamps[0]
        kept = []
        # Each step jumps over one whole cooldown by binary search.
        while (at := int(np.searchsorted(stamps, ready))) < len(stamps):
            kept.append(stamps[at])
            ready = stamps[at] + wait_us
        state.update((int(ready - wait_us),))
        over_ms = int(ready // 1000) + 1
        if over_ms > state.getCurrentWatermarkMs():
            state.setTimeoutTimestamp(over_ms)
        else:
            state.remove()
        if kept:
            yield rows[np.isin(of_row, kept)]

    return alerts.groupBy(*keys).applyInPandasWithState(
        keep, alerts.schema, "last_us bigint", "append", GroupStateTimeout.EventTimeTimeout
    )


class _HeldCooldown(StatefulProcessor):
    """Holds a key's alerts until the watermark has passed them, then takes them in the order of time."""

    def __init__(self, wait_us: int, columns: list[str]) -> None:
        self.wait_us, self.columns = wait_us, columns

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "us bigint, row binary")
        self.last = handle.getValueState("last", "us bigint")

    def handleInputRows(self, key, rows, timerValues):
        newest, added = None, []
        for frame in rows:
            stamps = frame["time"].to_numpy("datetime64[us]").view("int64").tolist()
            for us, row in zip(stamps, frame[self.columns].itertuples(index=False, name=None), strict=True):
                added.append((us, pickle.dumps(row)))
            newest = max(stamps) if newest is None else max(newest, *stamps)
        if added:
            self.held.appendList(added)
            # Fires once nothing earlier can come any more.
            self.handle.registerTimer(max(newest // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark_us = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted(self.held.get(), key=lambda r: r[0]) if self.held.exists() else []
        due, rest = [r for r in rows if r[0] < watermark_us], [r for r in rows if r[0] >= watermark_us]
        last = self.last.get()[0] if self.last.exists() else None
        kept = []
        for us, row in due:
            # Alerts of one instant are kept together.
            if last is None or us >= last + self.wait_us or us == last and kept and kept[-1][0] == us:
                last = us
                kept.append((us, row))
        self.held.put(rest) if rest else self.held.clear()
        if last is not None and last + self.wait_us > watermark_us:
            self.last.update((last,))
            self.handle.registerTimer((last + self.wait_us) // 1000 + 1)
        elif self.last.exists():
            self.last.clear()
        if kept:
            yield pd.DataFrame([pickle.loads(bytes(row)) for _, row in kept], columns=self.columns)

    def close(self) -> None:
        pass


def with_ordered_cooldown(
    alerts: DataFrame, minutes: float, keys: tuple[str, ...] = ("symbol", "rule_id"), lateness: str = "10 minutes"
) -> DataFrame:
    """``with_cooldown`` whatever the order of arrival: the result is that of the table, as late as ``lateness``.

    Alerts wait in the state until the watermark has passed them; state holds the alerts of that span and one time per
    key, and goes once the cooldown is over. Needs the RocksDB state store (``use_rocksdb``). What waits at the end of a
    bounded run comes out when a later alert of any key (``end_mark``) moves the watermark on.
    """
    if minutes <= 0:
        raise ValueError("a cooldown takes more than 0 minutes")
    names = list(alerts.columns)
    return alerts.withWatermark("time", lateness).groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_HeldCooldown(int(minutes * 60_000_000), names), outputStructType=alerts.schema, outputMode="Append", timeMode="EventTime"
    )


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
