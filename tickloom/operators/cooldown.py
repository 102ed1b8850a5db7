"""Alert cooldown on stored alerts: the table twin of the streaming cooldown.

Which alerts are kept depends on the last one kept, back to the first alert of the key. To
avoid walking a whole key in one task, time is cut into spans:

1. each (key, span) is summarised by a step function from "ready again at" on entry to the
   same on exit; entries that lead to the same exit share a step, so it has few steps;
2. the step functions of a key are chained, which needs no alerts any more;
3. each (key, span) now knows its entry and picks its alerts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

DAY_US = 86_400_000_000
NEVER = -(2**62)


def cooldown(
    alerts: DataFrame, minutes: float, keys: tuple[str, ...] = ("symbol", "rule_id"), span_us: int = DAY_US
) -> DataFrame:
    """Of each key, only alerts at least ``minutes`` after the last one kept, with all their columns.

    Alerts of one instant are kept together. ``alerts`` should be a stored table, as it is read again for the columns.
    A task holds the distinct alert times of one key in one span (at least 64 cooldowns
    long), never those of a whole key.
    """
    if minutes <= 0:
        raise ValueError("a cooldown takes more than 0 minutes")
    wait = int(minutes * 60_000_000)
    span = max(span_us, 64 * wait)
    names = list(keys)
    types = ", ".join(f"{name} {kind}" for name, kind in alerts.dtypes if name in keys)
    times = (
        alerts.select(*names, F.unix_micros("time").alias("_t"))
        .distinct()
        .withColumn("_span", F.floor(F.col("_t") / span))
    )

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        stamps = np.sort(pdf["_t"].to_numpy())
        size = len(stamps)
        # Last alert kept when starting from each alert, by doubling the jumps.
        jump, last = np.searchsorted(stamps, stamps + wait), np.arange(size)
        while (inside := jump < size).any():
            target = jump[inside]
            last[inside], jump[inside] = last[target], jump[target]
        # The first kept alert lies in the first cooldown of the span, or right after it.
        start = int(pdf["_span"].iloc[0]) * span
        entries = min(int(np.searchsorted(stamps, start + wait)), size - 1) + 1
        leaves = stamps[last[:entries]] + wait
        step_ends = np.append(leaves[1:] != leaves[:-1], True)
        head = {name: pdf[name].iloc[0] for name in names}
        steps = {"_span": pdf["_span"].iloc[0], "_upto": stamps[:entries][step_ends], "_exit": leaves[step_ends]}
        return pd.DataFrame({**head, **steps})

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        ready, entries = NEVER, []
        for number, steps in pdf.sort_values(["_span", "_upto"]).groupby("_span"):
            entries.append((number, ready))
            at = int(np.searchsorted(steps["_upto"].to_numpy(), ready))
            if at < len(steps):
                ready = int(steps["_exit"].iloc[at])
        head = {name: pdf[name].iloc[0] for name in names}
        return pd.DataFrame({**head, "_span": [s for s, _ in entries], "_ready": [r for _, r in entries]})

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        stamps, ready, kept = np.sort(pdf["_t"].to_numpy()), int(pdf["_ready"].iloc[0]), []
        while (at := int(np.searchsorted(stamps, ready))) < len(stamps):
            kept.append(int(stamps[at]))
            ready = kept[-1] + wait
        head = {name: [pdf[name].iloc[0]] * len(kept) for name in names}
        return pd.DataFrame({**head, "_t": np.array(kept, "int64")})

    steps = times.groupBy(*names, "_span").applyInPandas(summarise, f"{types}, _span bigint, _upto bigint, _exit bigint")
    entries = steps.groupBy(*names).applyInPandas(chain, f"{types}, _span bigint, _ready bigint")
    picked = (
        times.join(entries, [*names, "_span"])
        .groupBy(*names, "_span")
        .applyInPandas(pick, f"{types}, _t bigint")
    )
    kept = picked.select(*names, F.timestamp_micros("_t").alias("time"))
    return alerts.join(kept, [*names, "time"], "left_semi").select(*alerts.columns)
