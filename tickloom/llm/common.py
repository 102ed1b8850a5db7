"""Shared helpers: whole-batch views of UTF-8 text, batch mapping, cut lineage, connected components.

Text columns are handled as the bytes of an Arrow batch, so that words, lines and hashes of thousands of documents are
found by a few numpy calls instead of a Python loop over rows.
"""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass handles; a longer document is a pass of its own.
PASS_BYTES = 1 << 19

#: Links that a task handles in a round of `components`.
LINKS = 100_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def table_of(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _own_folder() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="checkpoints-", ignore_cleanup_errors=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, which driver and executors share.

    Only where it is unset and Spark runs inside this process (as in tests) is a folder of this machine taken; on a
    cluster the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(_own_folder().name)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written once to the shared folder; a lost executor costs nothing that was written."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def packed(df: DataFrame, **others: Column) -> DataFrame:
    """All columns of `df` as the struct `row`, beside `others`, so that helpers' names never meet its own."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[value.alias(name) for name, value in others.items()])


def unpacked(df: DataFrame, columns: list[str], **replaced: Column) -> DataFrame:
    """The struct `row` as columns again, some with another value."""
    return df.select(*[replaced[c].alias(c) if c in replaced else F.col(f"row.`{c}`").alias(c) for c in columns])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: A prime with cheap remainders: sums of its multiples fit 64 bits.
_PRIME = np.uint64((1 << 31) - 1)
#: Two hashes modulo the prime by different bases make one.
_BASES = (0x2545F491, 0x5851F42D)
_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    """1, base, base^2 ... modulo the prime, as 32 bits each; kept for the next call."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, PASS_BYTES + (PASS_BYTES >> 1))
        have = np.ones(size, np.uint32)
        known = 1
        while known < size:
            more = min(known, size - known)
            factor = np.uint64(pow(base, known, int(_PRIME)))
            have[known : known + more] = have[:more].astype(np.uint64) * factor % _PRIME
            known += more
        _POWERS[base] = have
    return have[:n]


#: Below the prime, so that products stay below 2^62.
_BYTE_VALUES = [mix(np.arange(1, 257, dtype=np.uint64) * _ODD + np.uint64(i)) % (_PRIME - np.uint64(1)) + np.uint64(1) for i in range(2)]


class SpanHash:
    """64-bit hashes of any byte spans of a buffer, from two prefix sums of polynomials modulo a prime.

    Two fixed different spans are equal with a probability of about their length in 2^62.
    """

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self.sums = []
        for values, base in zip(_BYTE_VALUES, _BASES, strict=True):
            terms = values[data]
            terms *= _powers(n, base)
            # Half reduced, below 2^32, so that prefix sums of any text stay within 64 bits.
            terms = (terms & _PRIME) + (terms >> np.uint64(31))
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(terms, out=sums[1:])
            self.sums.append(sums)
        self.undo = [_powers(n + 1, pow(base, -1, int(_PRIME))) for base in _BASES]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        one, two = ((sums[end] - sums[start]) % _PRIME * undo[start] % _PRIME for sums, undo in zip(self.sums, self.undo, strict=True))
        return mix((one << np.uint64(31) | two) + (end - start).astype(np.uint64) * _ODD)


SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@dataclass
class Texts:
    """The bytes of some documents one after another; document i is data[bounds[i]:bounds[i + 1]]."""

    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """How many of the marked bytes each text has."""
        sums = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(marks, out=sums[1:])
        return sums[self.bounds[1:]] - sums[self.bounds[:-1]]

    def runs(self, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of the longest runs of bytes that `outside` (by byte value) doesn't hold."""
        n = len(self.data)
        if not n:
            none = np.zeros(0, np.int64)
            return none, none, none
        inside = ~outside[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.bounds] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:n]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[1:n]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        return start, end, np.searchsorted(self.bounds, start, "right") - 1

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of the \\n-separated lines; every text has at least one."""
        breaks = np.flatnonzero(self.data == 0x0A)
        of_break = np.searchsorted(self.bounds, breaks, "right") - 1
        text = np.concatenate([np.arange(len(self)), of_break])
        start = np.concatenate([self.bounds[:-1], breaks + 1])
        order = np.lexsort((start, text))
        start, text = start[order], text[order]
        end = np.concatenate([start[1:] - 1, [0]])
        final = np.append(text[1:] != text[:-1], True)
        end[final] = self.bounds[1:]
        return start, end, text


def utf8(column: pa.Array) -> Texts:
    """The texts of an Arrow string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, bounds, data = column.buffers()
    at = np.frombuffer(bounds, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(raw[at[0] : at[-1]], at - at[0])


def passes(column: pa.Array, limit: int = PASS_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """First row, end row and texts of slices with about `limit` bytes."""
    texts = utf8(column)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(texts.bounds, texts.bounds[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(texts))
        bounds = texts.bounds[row : end + 1]
        yield row, end, Texts(texts.data[bounds[0] : bounds[-1]], bounds - bounds[0])
        row = end


def parts(batch: pa.RecordBatch, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, so that no more than these rows are held as Python values."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def map_batches(df: DataFrame, each: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """`each` over the Arrow batches of `df`, some rows at a time."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                if (out := each(part)) is not None and out.num_rows:
                    yield out

    return df.mapInArrow(over, schema)


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that can be reached over `edges`, for every node that has one.

    Alternating large-star and small-star steps: every node's neighbours are linked to the smallest one, until nothing
    changes. A hot node never gathers its neighbours in a task: its minimum is a partially aggregated group-by, joined
    back to its edges, whose skew adaptive execution can split. Each round is cut by a checkpoint. Tasks are as many as
    the links need, `LINKS` each.
    """
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    links = checkpointed(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    tasks = 8 + links.count() // LINKS
    fewer = tasks < int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sized = lambda df: df.coalesce(tasks) if fewer else df
    links = sized(links)
    before = None
    for _ in range(max_rounds):
        both = links.union(links.select("v", "u")).toDF("u", "v")
        least = sized(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        # Large star: each neighbour above the node links to the least of the neighbourhood.
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = sized(sized(large).distinct())
        # Small star: a node and its lesser neighbours link to the least of them.
        least = sized(large.groupBy("u").agg(F.min("v").alias("m")))
        small = sized(large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        links = checkpointed(sized(small.union(least.select("u", "m")).distinct()))
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("node", F.col("node").alias("root")))
