"""License scan: an exact set-similarity join of text blocks (windows of words) with license templates.

A block is any run of `SLACK` times as many words as the template has, wherever lines break. It matches a template if it
holds at least `THRESHOLD` of the template's distinct words. Words are put in the global order of their counts in the
whole table, the rarest first (one pass over all texts, summed in Spark). By that order a block that matches must hold
one of the template's first `n - need + 1` words (prefix filter, by an index from those words to templates), and `need` words
of the template at all (length filter). Its words are then counted in that order, and it is dropped as soon as those found
and all that could follow behind the current place are fewer than `need` (positional filter). So every match is found and
nothing else; of blocks that overlap, the one with the most words (then the first to end) is the match. Templates are a
list given by the caller and go to the tasks with the code; texts are never moved.

Base phrases are found where their words stand one after another, across lines as well.

Defined results: a null or empty text has no words, no labels and score 0; null ids and repeated rows are scanned like
others; other columns are kept, those named like a result are replaced; an empty table gives no rows. Texts are scanned
whole. Equal counts are ordered by the word itself.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from tickloom.llm.common import SpanHash, Texts, map_batches, passes

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# The sentences by which licenses are granted, with their labels.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "lgpl-2.1": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc0-1.0": "dedicated to the public domain under the Creative Commons CC0 1.0 Universal",
    "no-copies": "No part of this publication may be reproduced or transmitted in any form or by any means without prior written permission",
}

THRESHOLD = 0.9
#: Words of a block for each of its template's, so that a few words may stand between.
SLACK = 1.25

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_OUTSIDE = np.zeros(256, bool)
_OUTSIDE[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words_of(text: str) -> list[str]:
    return _WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def need(size: int, threshold: float) -> int:
    """The least overlap of a template of `size` words; the margin undoes rounding errors of the product."""
    return max(math.ceil(threshold * size - 1e-9), 1)


def _hashes(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    size = np.array([len(w) for w in raw], np.int64)
    end = np.cumsum(size)
    return SpanHash(np.frombuffer(b"".join(raw), np.uint8)).of(end - size, end)


class Lookup:
    """Numbers of some words, by hash; a bit table of the hash's low bits rules most other words out."""

    def __init__(self, words: list[str]) -> None:
        hashes = _hashes(words)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.bits = np.zeros(1 << 16, bool)
        self.bits[hashes & np.uint64(0xFFFF)] = True

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are of these words, and their numbers."""
        some = np.flatnonzero(self.bits[hashes & np.uint64(0xFFFF)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[some]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[some]
        return some[hit], self.order[at[hit]]


def _cut(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and line number (over all texts) of each word."""
    lowered = Texts(_LOWER[texts.data], texts.bounds)
    start, end, text = lowered.runs(_OUTSIDE)
    line = np.searchsorted(np.flatnonzero(texts.data == 0x0A), start) + text
    return SpanHash(lowered.data).of(start, end), text, line


def word_counts(docs: DataFrame, words: list[str], text: str = "text") -> dict[str, int]:
    """How often each of a short list of words is in the texts of all rows."""
    lookup = Lookup(words)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = np.zeros(len(words), np.int64)
        for _, _, texts in passes(batch.column(0)):
            counts += np.bincount(lookup.of(_cut(texts)[0])[1], minlength=len(words))
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(words))), pa.array(counts)], names=["word", "n"])

    # One row a word, however large the table.
    rows = map_batches(docs.select(text), each, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r["word"]: r["n"] for r in rows}
    return {w: found.get(i, 0) for i, w in enumerate(words)}


@dataclass
class Index:
    """Templates over the globally ordered words: word number is rank."""

    words: list[str]
    labels: list[str]
    member: np.ndarray  # (template, rank)
    place: np.ndarray  # of each rank within each template, -1 if not in it
    size: np.ndarray
    need: np.ndarray
    block: np.ndarray  # words of a block of each template
    by_prefix: dict[int, list[int]]  # templates by each of their first words

    @classmethod
    def of(cls, templates: Mapping[str, str], counts: Mapping[str, int], threshold: float) -> Index:
        words = sorted(counts, key=lambda w: (counts[w], w))
        rank = {w: i for i, w in enumerate(words)}
        member = np.zeros((len(templates), len(words)), bool)
        for row, text in zip(member, templates.values(), strict=True):
            row[[rank[w] for w in words_of(text)]] = True
        size = member.sum(1)
        block = [math.ceil(SLACK * len(words_of(t))) for t in templates.values()]
        place, needs = np.where(member, member.cumsum(1) - 1, -1), np.array([need(int(n), threshold) for n in size])
        by_prefix: dict[int, list[int]] = {}
        for k, own in enumerate(place):
            for word in np.flatnonzero((own >= 0) & (own <= size[k] - needs[k])).tolist():
                by_prefix.setdefault(word, []).append(k)
        return cls(words, list(templates), member, place, size, needs, np.array(block), by_prefix)

    def matches(self, where: np.ndarray, rank: np.ndarray, end_of_text: np.ndarray) -> list[tuple[int, int, int]]:
        """Place of the first word, template and overlap of all matches; (where, rank) are the known words, in order."""
        out: list[tuple[int, int, int]] = []
        seen = np.unique(rank)
        # Templates of whose first words one is here.
        for k in np.unique([t for word in seen.tolist() for t in self.by_prefix.get(word, ())]).astype(int).tolist():
            # A block with the most words begins at one of them.
            own = np.flatnonzero(self.member[k][rank])
            at, kind = where[own], rank[own]
            end = np.minimum(at + self.block[k], end_of_text[own])
            upto = np.searchsorted(at, end)
            prefix = np.append(0, np.cumsum(self.place[k][kind] <= self.size[k] - self.need[k]))
            place = np.arange(len(at))
            some = np.flatnonzero((upto - place >= self.need[k]) & (prefix[upto] > prefix[place]))
            begin, end = at[some], end[some]
            overlap, last = np.zeros(len(some), np.int64), begin.copy()
            for position, word in enumerate(np.flatnonzero(self.member[k])):
                places = at[kind == word]
                if len(places):
                    i = np.searchsorted(places, begin)
                    found = places[np.minimum(i, len(places) - 1)]
                    held = (i < len(places)) & (found < end)
                    overlap += held
                    last = np.where(held, np.maximum(last, found), last)
                able = overlap + (self.size[k] - 1 - position) >= self.need[k]
                if not able.all():
                    begin, end, overlap, last = begin[able], end[able], overlap[able], last[able]
            out += [(b, k, n) for b, n in _apart(begin, last, overlap)]
        return out


def _apart(begin: np.ndarray, last: np.ndarray, overlap: np.ndarray) -> list[tuple[int, int]]:
    """Begin and overlap of blocks that don't overlap each other, taken by most words, first to end, last to begin."""
    taken: list[tuple[int, int, int]] = []
    for i in np.lexsort((-begin, last, -overlap)).tolist():
        a, b = int(begin[i]), int(last[i])
        at = bisect.bisect(taken, (a, b, 0))
        if (at == 0 or taken[at - 1][1] < a) and (at == len(taken) or taken[at][0] > b):
            taken.insert(at, (a, b, int(overlap[i])))
    return [(a, n) for a, _, n in taken]


def _places(hashes: np.ndarray, text: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Where the words of a phrase stand consecutively in one text."""
    size = len(phrase)
    at = np.flatnonzero(hashes[: max(len(hashes) - size + 1, 0)] == phrase[0])
    for i in range(1, size):
        at = at[hashes[at + i] == phrase[i]]
    return at[text[at] == text[at + size - 1]]


RESULTS = [
    *(StructField(n, LongType()) for n in ("n_words", "n_base", "first_word", "last_word")),
    StructField("base_labels", StringType()),
    StructField("labels", StringType()),
    StructField("score", DoubleType()),
    StructField("matches", ArrayType(StructType([StructField("line", LongType()), StructField("label", StringType()), StructField("containment", DoubleType())]))),
]


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, phrases: Mapping[str, str] = PHRASES, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """`docs` with base phrases, labels, score (1 with a base phrase, else the best containment, else 0) and matches with the line where each begins."""
    words = sorted({w for t in templates.values() for w in words_of(t)})
    index = Index.of(templates, word_counts(docs, words, text), threshold)
    lookup = Lookup(index.words)
    spelled = [(_hashes(words_of(p)), label) for p, label in phrases.items()]
    named = {f.name for f in RESULTS}
    schema = StructType([f for f in docs.schema.fields if f.name not in named] + RESULTS)
    at = docs.columns.index(text)
    others = [i for i, c in enumerate(docs.columns) if c not in named]
    matched = pa.list_(pa.struct([("line", pa.int64()), ("label", pa.string()), ("containment", pa.float64())]))

    def some(texts: Texts) -> list[tuple]:
        n = len(texts)
        hashes, of, line = _cut(texts)
        n_words = np.bincount(of, minlength=n)
        first = np.cumsum(n_words) - n_words
        n_base, low, high = np.zeros(n, np.int64), np.full(n, len(hashes)), np.full(n, -1)
        base: dict[int, set[str]] = {}
        for phrase, label in spelled:
            places = _places(hashes, of, phrase)
            n_base += np.bincount(of[places], minlength=n)
            np.minimum.at(low, of[places], places - first[of[places]])
            np.maximum.at(high, of[places], places - first[of[places]])
            for i in np.unique(of[places]).tolist():
                base.setdefault(i, set()).add(label)
        where, rank = lookup.of(hashes)
        text_line = np.searchsorted(np.flatnonzero(texts.data == 0x0A), texts.bounds[:-1]) + np.arange(n)
        found: dict[int, list[tuple[int, str, float]]] = {}
        for begin, template, common in sorted(index.matches(where, rank, np.cumsum(n_words)[of[where]])):
            i = int(of[begin])
            found.setdefault(i, []).append((int(line[begin] - text_line[i]), index.labels[template], common / int(index.size[template])))
        rows = []
        for i in range(n):
            own, hits = base.get(i, set()), found.get(i, [])
            score = 1.0 if own else max((c for *_, c in hits), default=0.0)
            ends = (int(low[i]), int(high[i])) if n_base[i] else (None, None)
            rows.append((int(n_words[i]), int(n_base[i]), *ends, ",".join(sorted(own)), ",".join(sorted(own | {h[1] for h in hits})), score, [{"line": a, "label": b, "containment": c} for a, b, c in hits]))
        return rows

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = list(zip(*(row for _, _, texts in passes(batch.column(at)) for row in some(texts)), strict=True))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), matched]
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in others), *(pa.array(c, k) for c, k in zip(made, kinds, strict=True))], names=[f.name for f in schema.fields])

    return map_batches(docs, each, schema)


def report(docs: DataFrame) -> DataFrame:
    """The registered query's rows."""
    return scan(docs.select("doc_id", "text")).select("doc_id", *[f.name for f in RESULTS[:-1]])


def oracle() -> str:
    """The same rows in DuckDB's SQL, every window of words against every template of which the text has enough words."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    sets = ", ".join(f"('{k}', {sorted(set(words_of(t)))!r}, {need(len(set(words_of(t))), THRESHOLD)}, {math.ceil(SLACK * len(words_of(t)))})" for k, t in TEMPLATES.items())
    phrases = ", ".join(f"('{label}', {words_of(p)!r})" for p, label in PHRASES.items())
    return f"""
    WITH t AS (SELECT doc_id, {low} AS text, regexp_extract_all({low}, {word}) AS w FROM documents),
    p(label, words) AS (VALUES {phrases}),
    s(label, words, need, block) AS (VALUES {sets}),
    i AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM t),
    b AS (SELECT doc_id, label, i - 1 AS i FROM i JOIN p ON w[i] = words[1] AND w[i:i + len(words) - 1] = words),
    bb AS (SELECT doc_id, count(*) AS n, min(i) AS low, max(i) AS high FROM b GROUP BY doc_id),
    l AS (SELECT doc_id, label, words, need, block, w, unnest(range(1, len(w) + 1)) AS i FROM t JOIN s ON len(list_intersect(w, words)) >= need),
    g AS (SELECT doc_id, label, need, words, len(list_intersect(list_distinct(w[i:i + block - 1]), words)) AS n FROM l WHERE list_contains(words, w[i])),
    m AS (SELECT doc_id, label, n / len(words) AS c FROM g WHERE n >= need),
    mm AS (SELECT doc_id, max(c) AS c FROM m GROUP BY doc_id),
    bl AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT DISTINCT doc_id, label FROM b) GROUP BY doc_id),
    al AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM b UNION SELECT doc_id, label FROM m) GROUP BY doc_id)
    SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(bb.n, 0) AS BIGINT) AS n_base, CAST(bb.low AS BIGINT) AS first_word,
        CAST(bb.high AS BIGINT) AS last_word, coalesce(bl.labels, '') AS base_labels, coalesce(al.labels, '') AS labels,
        CASE WHEN bb.n > 0 THEN 1.0::DOUBLE ELSE coalesce(mm.c, 0)::DOUBLE END AS score
    FROM t LEFT JOIN bb USING (doc_id) LEFT JOIN mm USING (doc_id) LEFT JOIN bl USING (doc_id) LEFT JOIN al USING (doc_id)"""
