"""Exponential moving averages as weighted sums.

With ``a = 1 - alpha`` and ``alpha = 2 / (span + 1)`` the recursion
``ema = alpha * x + a * ema_before`` unrolls to ``sum(alpha * a**age * x) + a**rows * start``,
where age 0 is the newest row. A sum needs no order, so EMAs of whole series come out of
an ordinary (partially aggregated) group-by, and EMAs inside a block out of a running sum.
The signal line is an EMA of a difference of EMAs, hence also a weighted sum of the closes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

from tickloom import fixed_values as fixed


def decay(span: int) -> float:
    return 1.0 - 2.0 / (span + 1.0)


def weight(span: int, age: Column) -> Column:
    """Weight of a row ``age`` rows before the newest one."""
    return F.lit(1.0 - decay(span)) * F.pow(F.lit(decay(span)), age)


@dataclass(frozen=True)
class Macd:
    """MACD of a fast and a slow EMA with a signal EMA; state is (fast, slow, signal)."""

    fast: int = fixed.MACD_FAST
    slow: int = fixed.MACD_SLOW
    signal: int = fixed.MACD_SIGNAL

    def __post_init__(self):
        spans = self._spans()
        if min(spans) < 2 or self.signal in (self.fast, self.slow):
            raise ValueError("spans must be at least 2, and the signal span unlike the others")

    def _spans(self) -> list[int]:
        return [self.fast, self.slow, self.signal]

    def block_rows(self) -> int:
        """Rows per block such that the growing weights over a block stay below e**575."""
        return int(575 / -math.log(min(map(decay, self._spans()))))

    def _through_signal(self, span: int, rows: Column) -> Column:
        """Signal weight left by an EMA that decays freely from 1 over ``rows`` rows."""
        a, s = decay(span), decay(self.signal)
        factor = (1.0 - s) * a / (a - s)
        return F.lit(factor) * (F.pow(F.lit(a), rows) - F.pow(F.lit(s), rows))

    def signal_weight(self, age: Column) -> Column:
        """Weight in the signal line of a close ``age`` rows before the newest one."""
        parts = [
            F.lit((1.0 - decay(span)) / decay(span)) * self._through_signal(span, age + 1)
            for span in (self.fast, self.slow)
        ]
        return parts[0] - parts[1]

    def sums(self, close: Column, age: Column) -> list[Column]:
        """Aggregates of a run of rows that starts from the zero state."""
        return [
            F.sum(close * weight(self.fast, age)),
            F.sum(close * weight(self.slow, age)),
            F.sum(close * self.signal_weight(age)),
        ]

    def carried(self, fast: Column, slow: Column, signal: Column, rows: Column) -> list[Column]:
        """What a state contributes after ``rows`` further rows."""
        return [
            fast * F.pow(F.lit(decay(self.fast)), rows),
            slow * F.pow(F.lit(decay(self.slow)), rows),
            fast * self._through_signal(self.fast, rows)
            - slow * self._through_signal(self.slow, rows)
            + signal * F.pow(F.lit(decay(self.signal)), rows),
        ]


    def after(self, state: Column, rows: Column, added: Column) -> Column:
        """The state (a struct ``fast, slow, signal``) after ``rows`` more rows that add ``added`` from the zero state."""
        carried = self.carried(state["fast"], state["slow"], state["signal"], rows)
        return F.struct(*[(part + added[name]).alias(name) for part, name in zip(carried, STATE)])

    def step(self, state: Column, close: Column) -> Column:
        """The state after one more close: the recursion itself."""
        fast, slow = (
            F.lit(decay(span)) * state[name] + F.lit(1.0 - decay(span)) * close for span, name in ((self.fast, "fast"), (self.slow, "slow"))
        )
        signal = F.lit(decay(self.signal)) * state["signal"] + F.lit(1.0 - decay(self.signal)) * (fast - slow)
        return F.struct(fast.alias("fast"), slow.alias("slow"), signal.alias("signal"))


STATE = ("fast", "slow", "signal")


def state_of(fast: Column, slow: Column, signal: Column) -> Column:
    return F.struct(fast.cast("double").alias("fast"), slow.cast("double").alias("slow"), signal.cast("double").alias("signal"))


def running_ema(value: Column, span: int, position: Column, window) -> Column:
    """EMA from the zero state, along ``window`` (an ordered running window starting at position 0).

    Growing and shrinking weights are powers of the same number, so that its rounding
    cancels out.
    """
    a = decay(span)
    total = F.sum(value * F.pow(F.lit(a), -position)).over(window)
    return F.lit(1.0 - a) * F.pow(F.lit(a), position) * total
