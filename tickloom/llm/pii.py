"""Personal data: patterns with checks, and a character-level bidirectional LSTM with CRF transitions that adds to them.

The model is written and trained in numpy, from labelled spans: windows of a bounded sample of documents, labelled by the
patterns, and the same windows with further forms planted (a phone number without its plus sign, a card with dots, a
spaced at sign), which the patterns don't know. It labels characters as outside, or as the beginning or inside of a
kind. Every kind holds a digit or an at sign, so only what lies within `REACH` characters of one is read, with the whole
runs of address characters that this cuts, however long. Such regions are cut into overlapping windows, each window is
decoded by Viterbi, and the windows are reconciled over the whole text: each character takes its label from the window
that sees most on both sides of it, and spans are read from the joined labels. An address takes the whole runs of address
characters at its ends, and a part of one the other side of its at sign. A span that touches one of the patterns' is
dropped for theirs, and each must hold what its kind needs (digits, Luhn's check, parts of an address).

Defined results: a null or empty text has no spans; null ids, repeated rows and other columns are kept as they are; texts
are read whole, whatever their length; without any labelled document in the sample no model is fitted and the patterns'
spans are the result. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tickloom.llm.common import map_batches, passes

KINDS = ("email", "ip", "card", "phone")
#: Different texts whose windows train the model: those with the least hashes, of all that hold a trigger.
SAMPLE_DOCS = 400
#: Characters of each that are used for training.
SAMPLE_CHARS = 20_000
WINDOW = 64
STRIDE = 32
REACH = 20

Span = tuple[str, int, int]

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# A run of digits is tried from its first one only, as later starts end alike.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_SIGN = re.compile(r" ?@ ?")
#: Not part of a span at its ends.
_AROUND = " \t\r\n.,;:-"
_TRIGGER = np.zeros(256, bool)
_TRIGGER[[*range(48, 58), 64]] = True


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """The pattern with its local part read backwards from each at sign, as the run before it starts all matches there."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield "email", start, end
        at = text.find("@", max(end, at + 1))


def base_spans(text: str) -> list[Span]:
    """The patterns' spans, by start and then by kind."""
    spans = list(_emails(text))
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    spans += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def valid(kind: str, piece: str) -> bool:
    """What a span of the model must hold."""
    digits = "".join(_DIGIT.findall(piece))
    if kind == "email":
        left, sign, right = piece.partition("@")
        return bool(sign) and any(c.isalnum() for c in left) and any(c.isalnum() for c in right)
    if kind == "ip":
        parts = re.findall(r"[0-9]+", piece)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    return 14 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 10 <= len(digits) <= 15


# ---- the model

_CODES = np.full(256, 2, np.int64)  # 0 is outside the text, 1 beyond Latin-1
_CODES[32:127] = np.arange(3, 98)
_CODES[[9, 10, 13]] = 98
_CODES[192:] = 99
#: By code: the characters of an address's parts.
_ADDRESS = np.zeros(100, bool)
_ADDRESS[[_CODES[ord(c)] for c in map(chr, range(32, 127)) if _LOCAL.match(c)]] = True
SYMBOLS, LABELS = 100, 1 + 2 * len(KINDS)


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 256, _CODES[np.minimum(points, 255)], 1)


def labels(length: int, spans: list[Span]) -> np.ndarray:
    out = np.zeros(length, np.int64)
    for kind, start, end in spans:
        out[start:end] = 2 + 2 * KINDS.index(kind)
        out[start] -= 1
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


@dataclass
class Tagger:
    """Symbol table, an LSTM in each direction, emissions, and CRF transitions; float32 weights by name."""

    hidden: int = 20
    width: int = 12
    seed: int = 7
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.weights:
            return
        rng = np.random.default_rng(self.seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        h = self.hidden
        self.weights = {"symbols": draw(SYMBOLS, self.width) * 3, "out": draw(2 * h, LABELS), "out_bias": np.zeros(LABELS, np.float32), "moves": np.zeros((LABELS, LABELS), np.float32)}
        for way in ("on", "back"):
            bias = np.zeros(4 * h, np.float32)
            bias[h : 2 * h] = 1
            self.weights |= {f"{way}_in": draw(self.width, 4 * h), f"{way}_state": draw(h, 4 * h), f"{way}_bias": bias}

    def _run(self, x: np.ndarray, way: str, keep: list | None = None) -> np.ndarray:
        """States of one direction, (time, batch, hidden); `keep` gets what the gradient needs."""
        w, h, steps = self.weights, self.hidden, x.shape[1]
        table = w["symbols"] @ w[f"{way}_in"] + w[f"{way}_bias"]
        state = cell = np.zeros((len(x), h), np.float32)
        out = np.empty((steps, len(x), h), np.float32)
        for t in range(steps) if way == "on" else range(steps - 1, -1, -1):
            gates = table[x[:, t]] + state @ w[f"{way}_state"]
            open_ = _sigmoid(gates[:, : 3 * h])
            new = np.tanh(gates[:, 3 * h :])
            before, cell = cell, open_[:, h : 2 * h] * cell + open_[:, :h] * new
            bent = np.tanh(cell)
            if keep is not None:
                keep.append((t, state, before, open_, new, bent))
            state = open_[:, 2 * h :] * bent
            out[t] = state
        return out

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(time, batch, label) scores."""
        states = np.concatenate([self._run(x, "on"), self._run(x, "back")], 2)
        return states @ self.weights["out"] + self.weights["out_bias"]

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best label sequence of each window."""
        scores, moves = self.emissions(x), self.weights["moves"]
        best, back = scores[0], []
        for t in range(1, len(scores)):
            ways = best[:, :, None] + moves
            back.append(ways.argmax(1))
            best = ways.max(1) + scores[t]
        path = [best.argmax(1)]
        for step in reversed(back):
            path.append(step[np.arange(len(x)), path[-1]])
        return np.stack(path[::-1], 1)

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of the windows and its gradient."""
        w, h, n, steps = self.weights, self.hidden, len(x), x.shape[1]
        kept: dict[str, list] = {"on": [], "back": []}
        states = np.concatenate([self._run(x, way, kept[way]) for way in kept], 2)
        scores, moves = (states @ w["out"] + w["out_bias"]).astype(np.float64), w["moves"].astype(np.float64)
        ahead, behind = [scores[0]], [np.zeros_like(scores[0])]
        for t in range(1, steps):
            ahead.append(_logsumexp(ahead[-1][:, :, None] + moves, 1) + scores[t])
        for t in range(steps - 1, 0, -1):
            behind.append(_logsumexp(moves + (scores[t] + behind[-1])[:, None, :], 2))
        behind.reverse()
        total = _logsumexp(ahead[-1], 1)
        d_scores, d_moves = np.empty_like(scores), np.zeros_like(moves)
        rows, loss = np.arange(n), total.sum()
        for t in range(steps):
            d_scores[t] = np.exp(ahead[t] + behind[t] - total[:, None])
            d_scores[t][rows, y[:, t]] -= 1
            loss -= scores[t][rows, y[:, t]].sum()
            if t:
                d_moves += np.exp(ahead[t - 1][:, :, None] + moves + (scores[t] + behind[t])[:, None, :] - total[:, None, None]).sum(0)
                np.add.at(d_moves, (y[:, t - 1], y[:, t]), -1)
                loss -= moves[y[:, t - 1], y[:, t]].sum()
        d_scores = (d_scores / n).astype(np.float32)
        grads = {"moves": (d_moves / n).astype(np.float32), "out": np.einsum("tbh,tbl->hl", states, d_scores), "out_bias": d_scores.sum((0, 1)), "symbols": np.zeros_like(w["symbols"])}
        d_states = d_scores @ w["out"].T
        for way, part in (("on", d_states[:, :, :h]), ("back", d_states[:, :, h:])):
            d_table, d_recurrent = np.zeros((SYMBOLS, 4 * h), np.float32), np.zeros_like(w[f"{way}_state"])
            d_state, d_cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
            for t, state, before, open_, new, bent in reversed(kept[way]):
                d_state = d_state + part[t]
                take, forget, give = open_[:, :h], open_[:, h : 2 * h], open_[:, 2 * h :]
                d_cell = d_cell + d_state * give * (1 - bent**2)
                d_open = np.concatenate([d_cell * new, d_cell * before, d_state * bent], 1) * open_ * (1 - open_)
                d_gates = np.concatenate([d_open, d_cell * take * (1 - new**2)], 1)
                np.add.at(d_table, x[:, t], d_gates)
                d_recurrent += state.T @ d_gates
                d_state, d_cell = d_gates @ w[f"{way}_state"].T, d_cell * forget
            grads |= {f"{way}_in": w["symbols"].T @ d_table, f"{way}_bias": d_table.sum(0), f"{way}_state": d_recurrent}
            grads["symbols"] += d_table @ w[f"{way}_in"].T
        return float(loss / n), grads

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        rng = np.random.default_rng(self.seed)
        first, second, step, losses = ({k: np.zeros_like(v) for k, v in self.weights.items()} for _ in range(2)), None, 0, []
        first, second = first
        for epoch in range(epochs):
            order, sums = rng.permutation(len(x)), 0.0
            pace = rate * (1 - epoch / epochs) + rate / 10
            for at in range(0, len(x), batch):
                rows, step = order[at : at + batch], step + 1
                loss, grads = self.gradient(x[rows], y[rows])
                sums += loss * len(rows)
                size = np.sqrt(sum(float((g**2).sum()) for g in grads.values()))
                for name, grad in grads.items():
                    grad = grad / max(1.0, size / 5)
                    first[name] = 0.9 * first[name] + 0.1 * grad
                    second[name] = 0.999 * second[name] + 0.001 * grad**2
                    self.weights[name] = (self.weights[name] - pace * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            losses.append(sums / len(x))
        return losses


# ---- windows


def regions(triggers: np.ndarray, length: int) -> list[tuple[int, int]]:
    """What lies within reach of a trigger, as runs."""
    if not len(triggers):
        return []
    cut = np.flatnonzero(np.diff(triggers) > 2 * REACH) + 1
    return [(max(int(p[0]) - REACH, 0), min(int(p[-1]) + REACH + 1, length)) for p in np.split(triggers, cut)]


def whole_runs(runs: list[tuple[int, int]], text: np.ndarray) -> list[tuple[int, int]]:
    """Runs of a text's codes, extended over the address characters that touch their ends; those that meet become one."""
    gaps = np.flatnonzero(~_ADDRESS[text])
    out: list[tuple[int, int]] = []
    for start, end in runs:
        before, after = np.searchsorted(gaps, (start, end))
        start, end = int(gaps[before - 1]) + 1 if before else 0, int(gaps[after]) if after < len(gaps) else len(text)
        if out and start <= out[-1][1]:
            start, end = out[-1][0], max(end, out.pop()[1])
        out.append((start, end))
    return out


def windows(start: int, end: int) -> list[int]:
    """Where overlapping windows of a run begin; the last reaches its end."""
    return [start] if end - start <= WINDOW else [*range(start, end - WINDOW, STRIDE), end - WINDOW]


def triggers_of(text: np.ndarray) -> np.ndarray:
    """Places of digits and at signs in a text's codes."""
    return np.flatnonzero((text >= _CODES[48]) & (text <= _CODES[57]) | (text == _CODES[64]))


def _cut(text: np.ndarray, at: int, end: int) -> np.ndarray:
    out = np.zeros(WINDOW, np.int64)
    piece = text[at : min(at + WINDOW, end)]
    out[: len(piece)] = piece
    return out


def model_spans(texts: list[str], model: Tagger) -> list[list[Span]]:
    """The model's spans of each text, reconciled over all windows that see a character."""
    cut: list[tuple[int, int, int, int]] = []
    pieces: list[np.ndarray] = []
    for i, text in enumerate(texts):
        own = codes(text)
        for start, end in whole_runs(regions(triggers_of(own), len(own)), own):
            for at in windows(start, end):
                cut.append((i, start, end, at))
                pieces.append(_cut(own, at, end))
    spans: list[list[Span]] = [[] for _ in texts]
    if not cut:
        return spans
    found = np.concatenate([model.decode(np.stack(pieces[a : a + 2048])) for a in range(0, len(pieces), 2048)])
    k = 0
    while k < len(cut):
        i, start, end, _ = cut[k]
        joined, depth = np.zeros(end - start, np.int64), np.full(end - start, -1)
        while k < len(cut) and cut[k][:2] == (i, start):
            at = cut[k][3] - start
            size = min(WINDOW, end - start - at)
            inside = np.arange(size)
            seen = np.minimum(inside + (WINDOW if at == 0 else 0), size - 1 - inside + (WINDOW if at + size == end - start else 0))
            better = seen > depth[at : at + size]
            joined[at : at + size] = np.where(better, found[k][:size], joined[at : at + size])
            depth[at : at + size] = np.maximum(seen, depth[at : at + size])
            k += 1
        spans[i] += _read(joined, start)
    return spans


def _read(joined: np.ndarray, start: int) -> list[Span]:
    out: list[Span] = []
    kind = (joined + 1) // 2
    edges = np.flatnonzero(np.append(True, (kind[1:] != kind[:-1]) | (joined[1:] % 2 == 1)))
    for a, b in zip(edges, np.append(edges[1:], len(joined)), strict=True):
        if kind[a]:
            out.append((KINDS[kind[a] - 1], start + int(a), start + int(b)))
    return out


def _address(text: str, start: int, end: int, low: int, high: int) -> tuple[int, int]:
    """A part of an address with the whole runs at its ends, and its other side if it has no at sign, within low and high."""

    def left(at: int) -> int:
        while at > low and _LOCAL.match(text, at - 1):
            at -= 1
        return at

    def right(at: int) -> int:
        while at < high and _LOCAL.match(text, at):
            at += 1
        return at

    start, end = left(start), right(end)
    if "@" not in text[start:end]:
        if found := _SIGN.match(text, end, high):
            end = right(found.end())
        elif text[max(start - 2, low) : start].rstrip(" ").endswith("@"):
            sign = text.rindex("@", low, start)
            start = left(sign - 1 if sign > low and text[sign - 1] == " " else sign)
    piece = text[start:end].rstrip(_AROUND)
    return start + len(piece) - len(piece.lstrip(_AROUND)), start + len(piece)


def added_spans(texts: list[str], bases: list[list[Span]], model: Tagger | None) -> list[list[Span]]:
    """The model's valid spans that touch none of the patterns'."""
    if model is None:
        return [[] for _ in texts]
    out = []
    for text, base, found in zip(texts, bases, model_spans(texts, model), strict=True):
        own = []
        for kind, start, end in found:
            piece = text[start:end].rstrip(_AROUND)
            end = start + len(piece)
            start = end - len(piece.lstrip(_AROUND))
            if kind == "email" and start < end:
                if own and start < own[-1][2]:
                    continue
                # Nothing of the spans beside it.
                low = max([e for _, _, e in [*base, *own[-1:]] if e <= start], default=0)
                start, end = _address(text, start, end, low, min([b for _, b, _ in base if b >= end], default=len(text)))
            if valid(kind, text[start:end]) and not any(start < e and b < end for _, b, e in base):
                own.append((kind, start, end))
        out.append(own)
    return out


# ---- training data


def _planted(rng: np.random.Generator) -> tuple[str, str]:
    """A kind and a piece of text in a form that the patterns don't know."""
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    letters = lambda n: "".join(chr(97 + int(c)) for c in rng.integers(0, 26, n))
    form = int(rng.integers(0, 6))
    if form == 0:
        return "phone", f"({digits(3)}) {digits(3)}-{digits(4)}"
    if form == 1:
        return "phone", f"{digits(3)}-{digits(3)}-{digits(4)}"
    if form == 2:
        return "phone", f"{digits(3)}.{digits(3)}.{digits(4)}"
    if form == 3:
        body = "4" + digits(14)
        card = next(body + c for c in "0123456789" if luhn(body + c))
        return "card", ".".join(card[i : i + 4] for i in range(0, 16, 4))
    # Half of the addresses have long parts.
    long = bool(rng.integers(0, 2))
    name = ".".join(letters(int(rng.integers(6, 17))) for _ in range(int(rng.integers(1, 4)))) if long else letters(int(rng.integers(3, 9)))
    if form == 4:
        host = f"{letters(int(rng.integers(4, 12)))}.{letters(int(rng.integers(6, 17)))}" if long else f"{letters(5)}{digits(1)}"
        return "email", f"{name}{digits(0 if long else 2)} @ {host}.example.com"
    return "email", f"{name}.{digits(2)}@{letters(int(rng.integers(12, 31)) if long else 7)}"


def training_windows(texts: list[str], seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all regions with the patterns' labels, and of random places with planted forms."""
    rng = np.random.default_rng(seed)
    x, y = [], []

    def add(text: str, spans: list[Span], runs: list[tuple[int, int]]) -> None:
        own, own_labels = codes(text), labels(len(text), spans)
        for start, end in runs:
            for at in windows(start, end):
                x.append(_cut(own, at, end))
                y.append(_cut(own_labels, at, end))

    for text in texts:
        own = codes(text)
        add(text, base_spans(text), whole_runs(regions(triggers_of(own), len(own)), own))
        for _ in range(4):
            # A planted form between words of this text that hold no trigger, sometimes at a text's begin or end.
            at, left, right = int(rng.integers(0, max(len(text) - 40, 1))), int(rng.integers(0, 40)), int(rng.integers(0, 40))
            before, after = text[max(at - left, 0) : at].rpartition(" ")[0], text[at : at + right].partition(" ")[2]
            kind, piece = _planted(rng)
            before = f"{before} " if before else ""
            whole = f"{before}{piece} {after}" if after else f"{before}{piece}"
            if not _DIGIT.search(before + after) and "@" not in before + after:
                start = len(before)
                span = (kind, start, start + len(piece))
                # Cut like any text, so that windows begin where they do when it is read.
                place = codes(whole)
                add(whole, [span], whole_runs(regions(triggers_of(place), len(place)), place))
    return (np.stack(x), np.stack(y)) if x else (np.zeros((0, WINDOW), np.int64), np.zeros((0, WINDOW), np.int64))


def train(docs: DataFrame, text: str = "text", sample: int = SAMPLE_DOCS) -> Tagger | None:
    """A model fitted on the windows of at most `sample` documents."""
    hashed = docs.where(F.col(text).rlike("[0-9@]")).select(F.xxhash64(text).alias("h"), F.substring(text, 1, SAMPLE_CHARS).alias("t"))
    # Hashes first, so that no task sends texts that are not taken.
    least = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(sample).collect()]
    if not least:
        return None
    taken = hashed.where(F.col("h") <= max(least)).groupBy("h").agg(F.min("t").alias("t"))
    texts = [r["t"] for r in sorted(taken.collect(), key=lambda r: r["h"])]
    x, y = training_windows(texts)
    if not y.any():
        return None
    model = Tagger()
    model.fit(x, y)
    return model


# ---- operators


def _found(column: pa.Array, model: Tagger | None) -> Iterator[tuple[str, list[Span], list[Span]]]:
    """Each text, '' if it has no trigger, its patterns' spans and the added ones."""
    row = 0
    for first, end, texts in passes(column):
        has = texts.per_text(_TRIGGER[texts.data]) > 0
        some = column.slice(first, end - first).filter(pa.array(has)).to_pylist()
        bases = [base_spans(t) for t in some]
        made = iter(zip(some, bases, added_spans(some, bases, model), strict=True))
        for i in range(end - first):
            yield next(made) if has[i] else ("", [], [])
        row = end
    assert row == len(column)


def _said(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def find(docs: DataFrame, model: Tagger | None, text: str = "text") -> DataFrame:
    """`docs` with n_email, n_ip, n_card, n_phone, base_sha256 and spans."""
    results = [StructField(f"n_{k}", LongType()) for k in KINDS] + [StructField("base_sha256", StringType()), StructField("spans", StringType())]
    named = {f.name for f in results}
    schema = StructType([f for f in docs.schema.fields if f.name not in named] + results)
    at = docs.columns.index(text)
    others = [i for i, c in enumerate(docs.columns) if c not in named]

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: list[list[int]] = [[] for _ in KINDS]
        digests, spans = [], []
        for _, base, added in _found(batch.column(at), model):
            for kind, column in zip(KINDS, counts, strict=True):
                column.append(sum(s[0] == kind for s in base))
            digests.append(hashlib.sha256(_said(base).encode()).hexdigest())
            spans.append(_said(base + added))
        made = [*(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())]
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in others), *made], names=[f.name for f in schema.fields])

    return map_batches(docs, each, schema)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, or run of overlapping ones, as the name of its first kind in brackets."""
    out, at, covered = [], 0, 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])):
        if start >= covered:
            out += [text[at:start], f"[{kind.upper()}]"]
        covered = at = max(covered, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: Tagger | None, text: str = "text") -> DataFrame:
    """`docs` with all spans replaced in the text."""
    at = docs.columns.index(text)
    schema = docs.schema

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(at)
        changed = {i: redacted(t, b + a) for i, (t, b, a) in enumerate(_found(column, model)) if b or a}
        if changed:
            texts = column.to_pylist()
            for i, new in changed.items():
                texts[i] = new
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, column.type))
        return batch

    return map_batches(docs, each, schema)


def report(docs: DataFrame) -> DataFrame:
    """The registered query's rows."""
    docs = docs.select("doc_id", "text")
    return find(docs, train(docs)).select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans")
