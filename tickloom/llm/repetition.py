"""Quality rules from a suffix array over the words of each document.

The suffixes of all documents of a batch are sorted together by prefix doubling, where a word's symbol names its
document, so that suffixes of different documents never share a prefix. Only suffixes that are still tied are sorted
again. Whenever a tie splits, the longest common prefix of the two neighbours follows from the ranks of the earlier
rounds. The neighbours' larger value is the length of the longest repeat that starts at a suffix; the union of these
spans is the union of all maximal repeats (the LCP intervals), from which a document's covered fraction and longest
repeat are read.

Defined results: a null or empty text has no words and fails the base rules; a null id stays null; repeated rows are
judged each for itself; other columns are kept by `judge` and `keep_good` and ignored by the rules. An input column
that is named like a result is replaced by the result. A document is judged whole, whatever its length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from tickloom.llm.common import SPACE, SpanHash, Texts, map_batches, mix, passes

#: Characters that the base rules count as symbols.
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Limits:
    """A repeat counts from `min_repeat` words on."""

    min_words: int = 50
    max_repeat_percent: int = 50
    min_repeat: int = 8
    max_covered_percent: int = 40
    max_longest: int = 400


METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True


def repeat_lengths(symbols: np.ndarray) -> np.ndarray:
    """For each position the length of the longest repeat that starts there: its larger LCP in the suffix array.

    `symbols` are any comparable values; equal values are equal symbols.
    """
    n = len(symbols)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    order = np.argsort(symbols, kind="stable")
    rank, tied = _ranked(symbols[order], order, np.zeros(n, np.int64), np.arange(n))
    levels = [np.append(rank, -1)]
    span = 1
    while len(tied):
        rank = levels[-1]
        ahead = np.minimum(tied + span, n)
        # Within its tie, a suffix is placed by the rank of what follows the common prefix.
        order = np.argsort(rank[tied] * np.int64(n + 1) + rank[ahead] + 1, kind="stable")
        tied, ahead = tied[order], ahead[order]
        first, second = tied[:-1], tied[1:]
        same_tie = rank[first] == rank[second]
        split = same_tie & (rank[ahead[:-1]] != rank[ahead[1:]])
        one, two = first[split], second[split]
        common = np.full(len(one), span, np.int64)
        for level in range(len(levels) - 2, -1, -1):
            ranks = levels[level]
            equal = ranks[np.minimum(one + common, n)] == ranks[np.minimum(two + common, n)]
            common += np.where(equal, 1 << level, 0)
        longest[one] = np.maximum(longest[one], common)
        longest[two] = np.maximum(longest[two], common)
        new = rank.copy()
        starts_tie = np.append(True, ~same_tie)
        starts_group = np.append(True, ~same_tie | split)
        place = np.arange(len(tied))
        tie_at = np.maximum.accumulate(np.where(starts_tie, place, 0))
        group_at = np.maximum.accumulate(np.where(starts_group, place, 0))
        new[tied] = rank[tied] + (group_at - tie_at)
        alone = starts_group & np.append(starts_group[1:], True)
        levels.append(new)
        tied = tied[~alone]
        span *= 2
    return longest


def _ranked(values: np.ndarray, order: np.ndarray, rank: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks (a group's first place) of sorted values, and the positions that share theirs."""
    starts = np.append(True, values[1:] != values[:-1])
    rank[order] = np.maximum.accumulate(np.where(starts, place, 0))
    alone = starts & np.append(starts[1:], True)
    return rank, order[~alone]


def _covered(n: int, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which of n places the spans cover."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, start + length, -1)
    return np.cumsum(steps[:-1]) > 0


def measure(texts: Texts, limits: Limits) -> dict[str, np.ndarray]:
    """The metrics of every text."""
    n = len(texts)
    start, end, text = texts.runs(SPACE)
    hashes = SpanHash(texts.data)
    own = mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
    lead = (texts.data & 0xC0) != 0x80
    line_start, line_end, line_text = texts.lines()
    has_word = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_text = line_text[has_word]
    keys = hashes.of(line_start[has_word], line_end[has_word]) ^ own[line_text]
    order = np.argsort(keys, kind="stable")
    again = np.append(False, keys[order][1:] == keys[order][:-1]) if len(keys) else np.zeros(0, bool)
    repeat = repeat_lengths(hashes.of(start, end) ^ own[text])
    window = np.flatnonzero(repeat >= 3)
    in_window = _covered(len(start), window, np.full(len(window), 3))
    counted = np.flatnonzero(repeat >= limits.min_repeat)
    covered = _covered(len(start), counted, repeat[counted])
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, text[counted], repeat[counted])
    per_text = lambda which: np.bincount(text[which], minlength=n).astype(np.int64)
    return {
        "n_words": np.bincount(text, minlength=n).astype(np.int64),
        "word_chars": texts.per_text(lead & ~SPACE[texts.data]),
        "n_symbols": texts.per_text(_SYMBOL[texts.data]),
        "n_dup_lines": np.bincount(line_text[order][again], minlength=n).astype(np.int64),
        "n_repeat_words": per_text(in_window),
        "covered_words": per_text(covered),
        "longest_repeat": longest,
    }


def verdicts(m: dict[str, np.ndarray], limits: Limits) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base_failed, long_repeat, kept."""
    failed = (m["n_words"] < limits.min_words) | (100 * m["n_repeat_words"] > limits.max_repeat_percent * m["n_words"])
    long_repeat = m["longest_repeat"] > limits.max_longest
    kept = ~failed & ~long_repeat & (100 * m["covered_words"] <= limits.max_covered_percent * m["n_words"])
    return failed, long_repeat, kept


def _measured(column: pa.Array, limits: Limits) -> dict[str, np.ndarray]:
    parts = [measure(texts, limits) for _, _, texts in passes(column)]
    return {k: np.concatenate([p[k] for p in parts]) for k in METRICS}


def judge(docs: DataFrame, limits: Limits = Limits(), text: str = "text") -> DataFrame:
    """`docs` with every metric, covered_fraction, base_failed, long_repeat and kept."""
    results = [StructField(k, LongType()) for k in METRICS]
    results += [StructField("covered_fraction", DoubleType())]
    results += [StructField(k, BooleanType()) for k in ("base_failed", "long_repeat", "kept")]
    named = {f.name for f in results}
    schema = StructType([f for f in docs.schema.fields if f.name not in named] + results)
    at = docs.columns.index(text)
    others = [i for i, name in enumerate(docs.columns) if name not in named]

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = _measured(batch.column(at), limits)
        failed, long_repeat, kept = verdicts(m, limits)
        fraction = m["covered_words"] / np.maximum(m["n_words"], 1)
        columns = [batch.column(i) for i in others] + [pa.array(v) for v in (*(m[k] for k in METRICS), fraction, failed, long_repeat, kept)]
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return map_batches(docs, each, schema)


def keep_good(docs: DataFrame, limits: Limits = Limits(), text: str = "text") -> DataFrame:
    """The rows of `docs` whose text is kept, with the columns of `docs`."""
    at = docs.columns.index(text)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(verdicts(_measured(batch.column(at), limits), limits)[2]))

    return map_batches(docs, each, docs.schema)


def report(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The registered query's rows."""
    judged = judge(docs.select("doc_id", "text"), limits)
    return judged.select("doc_id", *METRICS[:5], "base_failed", "kept", "covered_words", "long_repeat")


def oracle(limits: Limits = Limits()) -> str:
    """The same rows in DuckDB's SQL: a word lies in a repeat of k words or more if some k-word window with it recurs."""
    k, long = limits.min_repeat, limits.max_longest + 1
    again = "i + {less} <= len(words) AND count(*) OVER (PARTITION BY doc_id, words[i:i + {less}]) > 1"
    near = "max(CAST({flag} AS INT)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN {less} PRECEDING AND CURRENT ROW)"
    return f"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
    w AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS i FROM t),
    f AS (SELECT doc_id, i, {again.format(less=2)} AS r3, {again.format(less=k - 1)} AS rk FROM w JOIN t USING (doc_id)),
    n AS (SELECT doc_id, {near.format(flag="r3", less=2)} AS c3, {near.format(flag="rk", less=k - 1)} AS ck FROM f),
    c AS (SELECT doc_id, sum(c3) AS n3, sum(ck) AS nk FROM n GROUP BY doc_id),
    gl AS (SELECT DISTINCT doc_id FROM (SELECT doc_id, md5(array_to_string(words[i:i + {long - 1}], ' ')) AS h
        FROM w JOIN t USING (doc_id) WHERE i + {long - 1} <= len(words) AND doc_id IN (SELECT doc_id FROM c WHERE nk >= {long})) GROUP BY doc_id, h HAVING count(*) > 1),
    l AS (SELECT doc_id, sum(c - 1) AS n FROM (SELECT doc_id, line, count(*) AS c
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t) WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id, line) GROUP BY doc_id),
    m AS (SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n3, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(c.nk, 0) AS BIGINT) AS covered_words, t.doc_id IN (SELECT doc_id FROM gl) AS long_repeat
        FROM t LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.max_repeat_percent} * n_words AS base_failed,
        NOT (n_words < {limits.min_words} OR 100 * n_repeat_words > {limits.max_repeat_percent} * n_words) AND NOT long_repeat
            AND 100 * covered_words <= {limits.max_covered_percent} * n_words AS kept, covered_words, long_repeat
    FROM m"""
