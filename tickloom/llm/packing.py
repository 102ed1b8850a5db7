"""Bounded-space online packing of tokenized documents into sequences of at most `size` tokens.

Each partition keeps a fixed number of open windows. A document is cut into full windows and a rest; the rest goes to the
open window with the least room that still fits it. If none fits and all places are taken, the fullest window is
emitted and a new one opened. What is open at a partition's end are its leftovers: these windows, moved as wholes, are
merged by best fit in groups of partitions, then the least full of each group in groups of groups, until one is left.
Memory is bounded by the open windows, and a merge task gets at most `FAN * open_windows` of them.

Tokens are those of the tokenizers library; pieces of text that a worker has met before are looked up (`words`).

Defined results: a null or empty text has the end token alone; documents keep null and repeated ids, each row is a
document of its own; other columns of the input are ignored; an empty table gives no pieces; a document of any length
is cut into as many pieces as it needs.
"""

from __future__ import annotations

import functools
import os
import string
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from tickloom.llm.common import checkpointed, passes
from tickloom.llm.words import PieceTable, ragged

SIZE = 4096
OPEN_WINDOWS = 64
#: The id after each document.
END_ID = 2
#: Groups of partitions, or of such groups, whose leftovers one task merges.
FAN = 64
_OUT_ROWS = 8192


class Encoder:
    """The tokenizers library over pieces that have not been met."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        self.final = np.zeros(max(vocabulary.values()) + 1, bool)
        self.final[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.table = PieceTable(self.encode_pieces)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of letters or of punctuation alone are one word, which ends with its only final token: one call for all."""
        plain = [p.isalpha() or not p.strip(string.punctuation) for p in pieces]
        words = [p for p, is_word in zip(pieces, plain, strict=True) if is_word]
        ids = self.encode(" ".join(words))
        ends = np.flatnonzero(self.final[ids]) + 1
        if len(ends) != len(words):
            ids, ends = np.zeros(0, np.int32), np.zeros(0, np.int64)
            plain = [False] * len(pieces)
        others = [self.encode(p) for p, is_word in zip(pieces, plain, strict=True) if not is_word]
        sizes = np.concatenate([np.diff(ends, prepend=0), np.fromiter(map(len, others), np.int64, len(others))])
        flat = np.concatenate([ids, *others])
        order = np.argsort(np.argsort(~np.array(plain, bool), kind="stable"), kind="stable")
        return flat[ragged((np.cumsum(sizes) - sizes)[order], sizes[order])], sizes[order]


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(column: pa.Array, path: str, end_id: int) -> Iterator[np.ndarray]:
    """Each text's ids and the end id, as unsigned 32-bit numbers."""
    own = encoder(path)
    for _, _, texts in passes(column):
        ids, bounds = own.table.ids_of(texts)
        out = np.insert(ids, bounds[1:], end_id).astype("<u4")
        yield from np.split(out, bounds[1:-1] + np.arange(1, len(texts)))


class OpenWindows:
    """Best fit into a bounded number of windows; `place` gives the window, its fill before and a window to emit."""

    def __init__(self, size: int, places: int) -> None:
        self.size, self.places = size, places
        self.room: list[tuple[int, int]] = []
        self.next = 0

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, length: int) -> tuple[int, int, int | None]:
        at, emitted = bisect_left(self.room, (length, -1)), None
        if at < len(self.room):
            room, window = self.room.pop(at)
        else:
            if len(self.room) == self.places:
                emitted = self.room.pop(0)[1]
            room, window = self.size, self.new()
        if room > length:
            insort(self.room, (room - length, window))
        elif emitted is None:
            emitted = window
        else:  # a full new window; the fullest old one need not go
            raise AssertionError("full windows are not placed")
        return window, self.size - room, emitted


def _pieces(docs: DataFrame, path: str, size: int, places: int, with_ids: bool, doc_id: str, text: str) -> DataFrame:
    key = docs.schema[doc_id]
    schema = StructType(
        [StructField(doc_id, key.dataType)]
        + [StructField(n, LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "part", "window", "offset")]
        + [StructField("left", BooleanType())]
        + ([StructField("ids", ArrayType(IntegerType()))] if with_ids else [])
    )

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, part = OpenWindows(size, places), TaskContext.get().partitionId()
        held: dict[int, list[tuple]] = {}
        out: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            ids = [pa.array(columns[9], pa.list_(pa.int32()))] if with_ids else []
            arrays = [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:8]), pa.array(columns[8], pa.bool_()), *ids]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema.fields])

        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            for key, all_ids in zip(batch.column(0).to_pylist(), encoded(batch.column(1), path, END_ID), strict=True):
                total, start = len(all_ids), 0
                while start < total:
                    length = min(size, total - start)
                    ids = all_ids[start : start + length]
                    # A full piece is a sequence of its own and takes no open place.
                    window, offset, emitted = (windows.new(), 0, None) if length == size else windows.place(length)
                    row = (key, start, length, zlib.crc32(ids), total, part, window, offset, False, ids.astype(np.int32) if with_ids else None)
                    if length == size:
                        out.append(row)
                    else:
                        held.setdefault(window, []).append(row)
                    if emitted is not None:
                        out.extend(held.pop(emitted))
                    start += length
                if len(out) >= _OUT_ROWS:
                    yield flushed()
        for rows in held.values():
            out.extend((*row[:8], True, row[9]) for row in rows)
        while out:
            rest, out[:] = out[_OUT_ROWS:], out[:_OUT_ROWS]
            yield flushed()
            out.extend(rest)

    return docs.select(doc_id, text).mapInArrow(over, schema)


def _merge_step(windows: DataFrame, group: str, size: int, places: int, last: bool) -> DataFrame:
    """Best fit decreasing of whole windows in each group: each window's host, its place there, and whether the host stays open."""
    schema = "part long, window long, host_part long, host_window long, base long, host_fill long, open boolean, level_group long"

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["fill", "part", "window"], ascending=[False, True, True], ignore_index=True)
        fills: list[int] = []
        room: list[tuple[int, int]] = []
        host, base = [], []
        for fill in rows["fill"].tolist():
            at = bisect_left(room, (fill, -1))
            left, bin_ = room.pop(at) if at < len(room) else (size, len(fills))
            if bin_ == len(fills):
                fills.append(0)
            host.append(bin_)
            base.append(fills[bin_])
            fills[bin_] += fill
            insort(room, (left - fill, bin_))
        first: dict[int, int] = {}
        for row, bin_ in enumerate(host):
            first.setdefault(bin_, row)
        least = set() if last else {b for _, b in sorted((f, b) for b, f in enumerate(fills))[:places]}
        at = [first[b] for b in host]
        return pd.DataFrame({
            "part": rows["part"], "window": rows["window"],
            "host_part": rows["part"].to_numpy()[at], "host_window": rows["window"].to_numpy()[at],
            "base": base, "host_fill": [fills[b] for b in host], "open": [b in least for b in host], "level_group": rows[group],
        })

    return windows.groupBy(group).applyInPandas(merge, schema)


def _merged(left: DataFrame, parts: int, size: int, places: int) -> DataFrame:
    """(part, window) of every leftover window to the (host_part, host_window, base) where it ends up."""
    windows = left.groupBy("part", "window").agg(F.sum("length").alias("fill"))
    windows = windows.withColumn("g", F.expr(f"part div {FAN}"))
    groups = -(-parts // FAN)
    mapping = None
    while True:
        step = checkpointed(_merge_step(windows, "g", size, places, groups == 1))
        if mapping is None:
            mapping = step.select("part", "window", "host_part", "host_window", "base")
        else:
            move = step.select(F.col("part").alias("host_part"), F.col("window").alias("host_window"), F.col("host_part").alias("p"), F.col("host_window").alias("w"), F.col("base").alias("b"))
            mapping = mapping.join(move, ["host_part", "host_window"], "left").select(
                "part", "window", F.coalesce("p", "host_part").alias("host_part"), F.coalesce("w", "host_window").alias("host_window"), (F.col("base") + F.coalesce("b", F.lit(0))).alias("base")
            )
        if groups == 1:
            return mapping
        hosts = step.where("open and part = host_part and window = host_window")
        windows = hosts.select("part", "window", F.col("host_fill").alias("fill"), F.expr(f"level_group div {FAN}").alias("g"))
        groups = -(-groups // FAN)


def pack(
    docs: DataFrame, path: str, size: int = SIZE, open_windows: int = OPEN_WINDOWS, with_ids: bool = False, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The pieces of all documents with their sequence and the place there, and on demand their ids."""
    pieces = checkpointed(_pieces(docs, path, size, open_windows, with_ids, doc_id, text))
    left = pieces.where("left")
    parts = (left.agg(F.max("part")).first()[0] or 0) + 1
    sequence = lambda part, window: (F.shiftleft(F.col(part), 32) + F.col(window)).alias("sequence_id")
    columns = [doc_id, "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    done = pieces.where("not left").select(*columns, sequence("part", "window"), "offset")
    moved = left.join(_merged(left, parts, size, open_windows), ["part", "window"])
    moved = moved.select(*columns, sequence("host_part", "host_window"), (F.col("offset") + F.col("base")).alias("offset"))
    return done.unionByName(moved)
