"""SimHash near-duplicates over a Gray-order hierarchical index.

A document's fingerprint has a bit set where over half of its shingles' XXH64 hashes have it. Of the distinct ones, two
that differ in at most `max_bits` bits agree in a whole one of `max_bits + 1` runs of bits. A level of the index has a
copy of each fingerprint for every run, moved to the front; copies that agree there are a group, which holds a link for
sure. Groups of more than `NODE` fingerprints go on to the next level, where the bits that are still free are cut into
runs again, so a group never gets larger, however many documents there are: each level fixes some of the 64 bits, and
with few free ones a group can't hold more than `NODE`.

Within a level Spark range-partitions the copies by Gray rank, which puts those with long common patterns side by side.
Over a group a task builds a tree: every `FAN` neighbours are factored into an upper node, with the bits on which all
agree (mask) and their values (pattern), upper nodes likewise into higher ones. Pairs of nodes are compared from the
top down. A pair's difference is carried from its parents and grows by the bits that its own masks add, and once it
exceeds `max_bits` all fingerprints below are pruned together; at the bottom the sum is the exact distance.

A pair that agrees in several runs counts in the first of them only. As many links are kept as connect what they
connect, so a group of n gives at most n - 1.

Defined results: a null, empty or blank text has fingerprint 0, linked like any other; repeated rows are linked by their
text and stay rows of their own in `groups`; a null doc_id is in a group by its text and is not the group's smallest
id, unless all are null; an empty table gives no rows. Other columns are kept by `keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tickloom.llm.common import SPACE, Texts, checkpointed, components, map_batches, packed, passes, unpacked

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Fingerprints of a group that a task compares; at least 2 ** max_bits.
NODE = 8192
#: Children of an upper node.
FAN = 8
#: Pairs of nodes that are expanded at once.
_PAIRS = 1 << 13
#: Parts of a large group that are joined with its size in different tasks.
_SALTS = 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fingerprints(texts: Texts, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of every text, as unsigned 64-bit numbers."""
    n = len(texts)
    lowered = Texts(_LOWER[texts.data], texts.bounds)
    start, end, text = lowered.runs(SPACE)
    # The words, each with one space after it, so that a shingle is a slice.
    size = end - start
    after = np.cumsum(size + 1)
    joined = np.full(int(after[-1]) if len(after) else 0, 0x20, np.uint8)
    at = after - size - 1
    ahead = np.repeat(at - start, size) + (np.repeat(start - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(int(size.sum())))
    joined[ahead] = lowered.data[ahead - np.repeat(at - start, size)]
    words = np.bincount(text, minlength=n)
    first = np.cumsum(words) - words
    count = np.where(words >= shingle, words - shingle + 1, np.minimum(words, 1))
    of = np.repeat(np.arange(n), count)
    begin = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    last = begin + np.minimum(words, shingle)[of] - 1
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(at[begin].tolist(), (after[last] - 1).tolist(), strict=True)), np.uint64, len(begin))
    return majority(hashes, np.append(0, np.cumsum(count)))


def majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of hashes[bounds[i]:bounds[i + 1]], the bits that over half have."""
    n = len(bounds) - 1
    ones = np.zeros((n, 64), np.int64)
    step = 1 << 15
    for low in range(0, len(hashes), step):
        # Counts of a slice, each text's part by itself.
        part = hashes[low : low + step]
        a, b = np.searchsorted(bounds, low, "right") - 1, np.searchsorted(bounds, low + len(part), "left")
        cuts = np.clip(bounds[a : b + 1] - low, 0, len(part))
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        some = np.flatnonzero(cuts[1:] > cuts[:-1])
        ones[a + some] += np.add.reduceat(bits, cuts[some], axis=0, dtype=np.int32)
    total = np.diff(bounds)
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, name: str = "_print") -> DataFrame:
    """`docs` without the text, with the fingerprint as a signed number."""
    schema = StructType([f for f in docs.schema.fields if f.name not in (text, name)] + [StructField(name, LongType())])
    at = docs.columns.index(text)
    others = [i for i, c in enumerate(docs.columns) if c not in (text, name)]

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [fingerprints(texts, shingle) for _, _, texts in passes(batch.column(at))]
        return pa.RecordBatch.from_arrays([*(batch.column(i) for i in others), pa.array(np.concatenate(made).view(np.int64))], names=[f.name for f in schema.fields])

    return map_batches(docs, each, schema)


class Forest:
    """Links that connect places not connected so far."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def kept(self, a: list[int], b: list[int]) -> list[tuple[int, int]]:
        out = []
        for i, j in zip(a, b, strict=True):
            x, y = self.root(i), self.root(j)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                out.append((i, j))
        return out


def _sizes(level: int, max_bits: int) -> tuple[int, int]:
    """The bits that are fixed before a level, and those of each run that it cuts."""
    fixed = size = 0
    for _ in range(level):
        fixed += size
        size = max((64 - fixed) // (max_bits + 1), 1)
    return fixed, size


def _bits(first: int, count: int) -> np.uint64:
    """A mask of `count` bits, the highest of which is the `first` one from above."""
    return np.uint64(((1 << count) - 1) << (64 - first - count))


def _moved(values: np.ndarray, fixed: int, size: int, run: int) -> np.ndarray:
    """The values with a run of their free bits put before the other free ones."""
    own, before = _bits(fixed + run * size, size), _bits(fixed, run * size)
    return (values & ~(own | before)) | ((values & own) << np.uint64(run * size)) | ((values & before) >> np.uint64(size))


def _restored(values: np.ndarray, fixed: int, size: int, run: int) -> np.ndarray:
    """The inverse of `_moved`."""
    own, before = _bits(fixed, size), _bits(fixed + size, run * size)
    return (values & ~(own | before)) | ((values & own) >> np.uint64(run * size)) | ((values & before) << np.uint64(size))


def _original(values: np.ndarray, path: int, level: int, max_bits: int) -> np.ndarray:
    """Fingerprints from their copies at a level; the path has the run taken at each one as a digit."""
    for step in range(level, 0, -1):
        values = _restored(values, *_sizes(step, max_bits), path % (max_bits + 1))
        path //= max_bits + 1
    return values


def _counted_before(differ: np.ndarray, path: int, level: int, max_bits: int) -> np.ndarray:
    """Whether pairs of copies, given by the bits in which they differ, agree in an earlier run of any level too."""
    out = np.zeros(len(differ), bool)
    for step in range(level, 0, -1):
        fixed, size = _sizes(step, max_bits)
        run = path % (max_bits + 1)
        differ = _restored(differ, fixed, size, run)
        for other in range(run):
            out |= differ & _bits(fixed + other * size, size) == 0
        path //= max_bits + 1
    return out


def gray_rank(values: np.ndarray) -> np.ndarray:
    for shift in (1, 2, 4, 8, 16, 32):
        values = values ^ (values >> np.uint64(shift))
    return values


def _tree(values: np.ndarray, prefix: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(start, end, mask, pattern) of the nodes of each level of a Gray-sorted run, from the values up to one node for each prefix.

    `start` and `end` are places of the level below; a node's values have the first `prefix` bits in common.
    """
    every = some = values
    place = np.arange(len(values))
    levels = [(place, place + 1, np.full(len(values), ~np.uint64(0)), values)]
    group = values & _bits(0, prefix)
    while True:
        new = np.append(True, group[1:] != group[:-1])
        if new.all():
            return levels
        place = np.arange(len(group))
        since = place - np.maximum.accumulate(np.where(new, place, 0))
        start = np.flatnonzero(since % FAN == 0)
        every, some = np.bitwise_and.reduceat(every, start), np.bitwise_or.reduceat(some, start)
        levels.append((start, np.append(start[1:], len(group)), ~(every ^ some), every))
        group = group[start]


def near_pairs(values: np.ndarray, max_bits: int, prefix: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i < j of values of a Gray-sorted run that share their first `prefix` bits and differ in at most `max_bits`."""
    levels = _tree(values, prefix)
    top = np.arange(len(levels[-1][0]))
    # Pairs of nodes that may hold a link, with the bits in which all below them are known to differ.
    todo = [(len(levels) - 1, top, top, np.zeros(len(top), np.uint8))]
    while todo:
        level, a, b, known = todo.pop()
        if level == 0:
            apart = a < b
            if apart.any():
                yield a[apart], b[apart]
            continue
        if len(a) > _PAIRS:
            todo.append((level, a[_PAIRS:], b[_PAIRS:], known[_PAIRS:]))
            a, b, known = a[:_PAIRS], b[:_PAIRS], known[:_PAIRS]
        start, end, mask, _ = levels[level]
        wide, high = end[a] - start[a], end[b] - start[b]
        cells = wide * high
        pair = np.repeat(np.arange(len(a)), cells)
        cell = np.arange(len(pair)) - np.repeat(np.cumsum(cells) - cells, cells)
        i, j = start[a][pair] + cell // high[pair], start[b][pair] + cell % high[pair]
        upper = a[pair] <= b[pair]
        upper &= i <= j
        i, j, pair = i[upper], j[upper], pair[upper]
        _, _, mask_below, pattern = levels[level - 1]
        added = mask_below[i] & mask_below[j] & ~(mask[a] & mask[b])[pair]
        differ = known[pair] + np.bitwise_count((pattern[i] ^ pattern[j]) & added)
        near = differ <= max_bits
        todo.append((level - 1, i[near], j[near], differ[near]))


def connecting(values: np.ndarray, path: int, level: int, max_bits: int) -> np.ndarray:
    """Pairs of original fingerprints, as rows, that connect whatever links connect in a Gray-sorted run of copies."""
    forest, root = Forest(len(values)), np.arange(len(values))
    kept: list[tuple[int, int]] = []
    for i, j in near_pairs(values, max_bits, sum(_sizes(level, max_bits))):
        new = root[i] != root[j]
        i, j = i[new], j[new]
        own = ~_counted_before(values[i] ^ values[j], path, level, max_bits)
        links = forest.kept(i[own].tolist(), j[own].tolist())
        if links:
            kept += links
            root = np.array(forest.parent)
            while (root[root] != root).any():
                root = root[root]
    at = np.array(kept, np.int64).reshape(-1, 2)
    return _original(values[at], path, level, max_bits).view(np.int64)


_ROWS = "path long, v long, rank long"
_LINKS = "a long, b long"


def _copies(rows: DataFrame, level: int, max_bits: int) -> DataFrame:
    """(path, v, rank): of the (path, members) of a level's groups the copies that the next level compares."""
    fixed, size = _sizes(level, max_bits)
    runs = max_bits + 1

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = np.frombuffer(raw, np.uint64)
                made = np.concatenate([_moved(own, fixed, size, run) for run in range(runs)])
                paths = np.repeat(np.arange(path * runs, path * runs + runs), len(own))
                # The Gray rank is an unsigned number; with the highest bit turned it is in signed order.
                rank = gray_rank(made) ^ np.uint64(1 << 63)
                yield pa.RecordBatch.from_arrays([pa.array(paths), pa.array(made.view(np.int64)), pa.array(rank.view(np.int64))], names=["path", "v", "rank"])

    return rows.select("path", "members").mapInArrow(each, _ROWS)


def _index(copies: DataFrame, level: int, max_bits: int) -> DataFrame:
    """Links of the groups that lie within a node, and as `members` the parts of those at a node's edges."""
    node = NODE
    prefix = _bits(0, sum(_sizes(level, max_bits)))
    schema = f"{_LINKS}, path long, prefix long, part long, n long, members binary"

    def nodes(paths: np.ndarray, values: np.ndarray, part: int) -> Iterator[tuple]:
        for path in np.unique(paths).tolist():
            own = values[paths == path]
            group = own & prefix
            inner = (group != group[0]) & (group != group[-1])
            for a, b in connecting(own[inner], path, level, max_bits).tolist():
                yield (a, b) + (None,) * 5
            for edge in np.unique(group[[0, -1]]):
                members = own[group == edge]
                yield None, None, path, int(edge.view(np.int64)), part, len(members), members.tobytes()

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        paths, values = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def made(upto: int) -> pa.RecordBatch:
            kinds = [*[pa.int64()] * 6, pa.binary()]
            columns = zip(*nodes(paths[:upto], values[:upto], part), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["a", "b", "path", "prefix", "part", "n", "members"])

        for batch in batches:
            paths = np.concatenate([paths, batch.column(0).to_numpy()])
            values = np.concatenate([values, batch.column(1).to_numpy().view(np.uint64)])
            while len(values) >= node:
                yield made(node)
                part += 1
                paths, values = paths[node:], values[node:]
        if len(values):
            yield made(len(values))

    ordered = copies.repartitionByRange("path", "rank").sortWithinPartitions("path", "rank")
    return ordered.select("path", "v").mapInArrow(over, schema)


def _gathered(parts: DataFrame, level: int, max_bits: int) -> DataFrame:
    """Links of groups of at most `NODE` fingerprints whose parts lie at the edges of nodes."""

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, members in zip(frame["path"], frame["members"], strict=True):
                values = np.frombuffer(b"".join(members), np.uint64)
                values = values[np.argsort(gray_rank(values))]
                links = connecting(values, path, level, max_bits)
                yield pd.DataFrame({"a": links[:, 0], "b": links[:, 1]})

    return parts.groupBy("path", "prefix").agg(F.collect_list("members").alias("members")).select("path", "members").mapInPandas(each, _LINKS)


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): links that connect all of the distinct numbers `p` that chains of at most `max_bits` differing bits connect."""
    found = []

    def singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(0).to_numpy().tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([raw], pa.binary())], names=["path", "members"])

    rows, level = prints.select("p").mapInArrow(singles, "path long, members binary"), 1
    while True:
        index = checkpointed(_index(_copies(rows, level, max_bits), level, max_bits))
        found.append(index.where("a is not null").select("a", "b"))
        parts = index.where("a is null").select("path", "prefix", F.pmod("part", F.lit(_SALTS)).alias("salt"), "n", "members")
        large = parts.groupBy("path", "prefix").agg(F.sum("n").alias("n")).where(F.col("n") > NODE)
        large = checkpointed(large.select("path", "prefix", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt")))
        found.append(_gathered(parts.join(large, ["path", "prefix", "salt"], "left_anti"), level, max_bits))
        if large.isEmpty():
            return reduce(DataFrame.union, found)
        rows, level = parts.join(large, ["path", "prefix", "salt"], "left_semi"), level + 1


def _grouped(docs: DataFrame, doc_id: str, text: str, max_bits: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Each row's (doc_id, _text, _print), and each distinct _print with its group's _root."""
    keyed = docs.select(doc_id, text, F.xxhash64(F.coalesce(text, F.lit(""))).alias("_text"))
    prints = checkpointed(with_fingerprints(keyed, text, shingle))
    distinct = prints.select("_print").distinct()
    roots = components(near_links(distinct.select(F.col("_print").alias("p")), max_bits))
    rooted = distinct.join(roots, F.col("_print") == F.col("node"), "left")
    return prints, rooted.select("_print", F.coalesce("root", "_print").alias("_root"))


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, _print, component_id), a row for each of `docs`: its fingerprint and the smallest id that links reach."""
    prints, rooted = _grouped(docs, doc_id, text, max_bits, shingle)
    # By fingerprint first, so that copies are one row in the join with the groups.
    least = prints.groupBy("_print").agg(F.min(doc_id).alias("_least")).join(rooted, "_print")
    of_root = least.groupBy("_root").agg(F.min("_least").alias("component_id"))
    ids = least.join(of_root, "_root").select("_print", "component_id")
    return prints.join(ids, "_print").select(doc_id, "_print", "component_id")


def report(docs: DataFrame) -> DataFrame:
    """The registered query's rows."""
    return groups(docs).select("doc_id", F.lpad(F.lower(F.hex("_print")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """`docs` with one row of each group: that of its smallest id (nulls last), by text hash and other columns if ids are equal."""
    prints, rooted = _grouped(docs, doc_id, text, max_bits, shingle)
    key = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col("_text").alias("text"))
    first = prints.groupBy("_print").agg(F.min(key).alias("k")).join(rooted, "_print").groupBy("_root").agg(F.min("k").alias("k"))
    first = first.select(F.col("k.id").alias("of_id"), F.col("k.text").alias("of_text"))
    # Packed, so that no column of `docs` meets a helper's name.
    rows = packed(docs, id=F.col(doc_id), th=F.xxhash64(F.coalesce(text, F.lit(""))))
    here = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("th") == F.col("of_text"))
    rows = rows.join(first, here, "left_semi")
    # Rows that repeat an id and its text are left more than once.
    again = prints.groupBy(doc_id, "_text").count().where("count > 1").select(F.col(doc_id).alias("of_id"), F.col("_text").alias("of_text"))
    # One of them is a minimum for each id and text, summed in the tasks first, so that no key gathers its rows.
    many = rows.join(again, here, "left_semi").groupBy("id", "th").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return unpacked(rows.join(again, here, "left_anti").select("row").union(many.select("row")), docs.columns)
