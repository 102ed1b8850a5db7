"""MinHash fingerprints of documents, and classes of near-duplicates from them.

A text's words (white-space separated, A-Z lowered) give shingles of five words, or one of all words if there are
fewer. `PERMUTATIONS` universal hashes, applied to all shingles of a batch at once in numpy, give the signature: each
one's least value, of which 16 bits are kept. Two signatures agree in about the share of the texts' Jaccard similarity.

Classes: `BANDS` bands of the signature are joined in Spark. Within a band's bucket every text is compared with the
bucket's first one, by the exact Jaccard similarity of the shingle sets, so a family of copies costs one comparison for
each and not one for each pair. In buckets that hold several classes after that, the texts of different classes are
compared by their signatures in blocks; pairs that come near the threshold, and share no earlier band, are verified at once,
nearest first, unless links found so far join them already. So a cell emits a forest, and never more links than it has texts.
Classes are the connected components of verified pairs. A pair at the threshold shares a band with probability 0.9996; the
bound for the signatures lies 3.5 standard deviations below it.

The neighbour of a document in the order of ids is found without one task for all: ids are cut into ranges at
quantiles that are ids themselves, and a range's first document is sent to the range before it as well. Texts are
compressed for the one shuffle that moves them.

What is written on the way stays on disk until Spark's cleaner finds it unused, so little is: bands are shuffled once and only
those that texts share are kept, members of buckets are read from them, and of texts that are compared neither texts nor
signatures are written but for the shuffles that bring them together.

Defined results: a null text is empty; a text without words has a signature of its own and is near another only if that
has none either; null ids come after all others in the descending order, equal ids in the order of their texts' hashes; repeated
rows stay rows; an only document is its own neighbour; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from tickloom.llm.common import SPACE, SpanHash, Texts, checkpointed, components, map_batches, mix, parts, passes

SHINGLE = 5
BANDS, ROWS = 20, 5
PERMUTATIONS = BANDS * ROWS
THRESHOLD = 0.8
#: Pairs of signatures that agree in at least this share are verified.
NEAR = 0.66
#: Keys and ids that may be sent to every task, 16 bytes each; more are joined by a shuffle, of what a bitmap lets through.
SENT_ROWS = 100_000
#: Bits of that bitmap.
FILTER_BITS = 1 << 24
#: Texts that a task remembers, so as to sign equal ones once.
SEEN_KEYS = 1_000_000
#: Texts of a bucket, and bytes of them, that one task compares with as many others.
BLOCK = 2048
BLOCK_BYTES = 16 << 20
#: Texts that a bucket's first one is compared with in one task.
FAMILY = 2048
#: Ranges of ids at most, whose bounds every task knows.
MOST_RANGES = 1 << 16
#: Bytes of text that are hashed at a time.
TEXT_BYTES = 1 << 19
#: Higher levels take more time than the bytes that they save are worth.
LEVEL = 6

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.default_rng(20240229)
_FACTOR = _rng.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
_PLACES = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and where each text's begin."""
    n = len(texts)
    lowered = Texts(_LOWER[texts.data], texts.bounds)
    start, end, text = lowered.runs(SPACE)
    hashes = SpanHash(lowered.data).of(start, end)
    words = np.bincount(text, minlength=n)
    count = np.where(words >= SHINGLE, words - SHINGLE + 1, np.minimum(words, 1))
    first = np.cumsum(words) - words
    begin = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    left = np.repeat(first + words, count) - begin
    out = np.zeros(len(begin), np.uint64)
    for i, factor in enumerate(_PLACES):
        there = left > i
        out[there] += mix(hashes[begin[there] + i]) * factor
    return mix(out), np.append(0, np.cumsum(count))


def signatures(texts: Texts) -> np.ndarray:
    """(text, permutation) as 16-bit numbers."""
    hashes, bounds = shingles(texts)
    folded = (hashes >> np.uint64(32)).astype(np.uint32)
    some = np.flatnonzero(np.diff(bounds))
    least = np.full((PERMUTATIONS, len(texts)), 0xFFFFFFFF, np.uint32)
    if len(some):
        for i in range(PERMUTATIONS):
            least[i, some] = np.minimum.reduceat(folded * _FACTOR[i] + _SHIFT[i], bounds[some])
    # Bits that don't depend on how small a minimum is.
    return (mix(least.T.astype(np.uint64)) >> np.uint64(48)).astype("<u2")


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(1)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets of hashes; two empty ones are equal."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    total = len(a) + len(b) - common
    return common / total if total else 1.0


def _sets(texts: list[str]) -> Iterator[np.ndarray]:
    """The sorted shingle hashes of each text, a pass of some megabytes after the other."""
    for _, _, part in passes(pa.array(texts, pa.large_string()), TEXT_BYTES):
        hashes, bounds = shingles(part)
        yield from (np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True))


def _signatures_of(texts: pa.Array) -> list[bytes]:
    return [row.tobytes() for _, _, part in passes(texts, TEXT_BYTES) for row in signatures(part)]


def _packed(text: str) -> bytes:
    raw = text.encode()
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=LEVEL).compress(raw, asbytes=True)


def _unpacked(raw: bytes) -> str:
    return pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True).decode() if len(raw) else ""


def _sets_of_packed(column: pa.Array) -> Iterator[np.ndarray]:
    """`_sets` of compressed texts, of which no more than about a pass is unpacked at a time."""
    held, size = [], 0
    for i in range(len(column)):
        raw = column[i].as_py()
        held.append(_unpacked(raw))
        size += len(held[-1])
        if size >= TEXT_BYTES:
            yield from _sets(held)
            held, size = [], 0
    yield from _sets(held)


# ---- classes


def _key(text: str):
    return F.xxhash64(F.coalesce(text, F.lit(""))).alias("key")


def _signed(docs: DataFrame, text: str) -> DataFrame:
    """(key, sig) of each distinct text; one that several tasks read comes once from each."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in (part for whole in batches for part in parts(whole)):
            keys = batch.column(0).to_pylist()
            new = [i for i, k in enumerate(keys) if not (k in seen or seen.add(k))]
            if len(seen) > SEEN_KEYS:
                seen.clear()
            if new:
                taken = batch.take(pa.array(new))
                yield pa.RecordBatch.from_arrays([taken.column(0), pa.array(_signatures_of(taken.column(1)), pa.binary())], names=["key", "sig"])

    return docs.select(_key(text), text).mapInArrow(over, "key long, sig binary")


def _banded(signed: DataFrame) -> DataFrame:
    """(key, band): a hash of each band, whose last five bits say which one it is."""
    size = 2 * ROWS
    bands = [F.shiftleft(F.xxhash64(F.substring("sig", 1 + i * size, size)), 5).bitwiseOR(F.lit(i).cast("long")) for i in range(BANDS)]
    return signed.select("key", F.explode(F.array(*bands)).alias("band"))


def _located(docs: DataFrame, keys: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(key, least, chars): the least id that has each of the given texts, and the text's length."""
    ids = docs.select(_key(text), F.col(doc_id).alias("id"), F.length(text).alias("chars"))
    ids = ids.groupBy("key").agg(F.min("id").alias("least"), F.coalesce(F.max("chars"), F.lit(0)).alias("chars"))
    return checkpointed(keys.join(ids, "key"))


def _marks(bits: DataFrame) -> np.ndarray:
    """A bitmap of the numbers below `FILTER_BITS` in column `bit`."""
    words = bits.groupBy(F.expr("bit div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).toArrow()
    marks = np.zeros(FILTER_BITS // 64, np.int64)
    marks[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return marks.view(np.uint64)


def _made(docs: DataFrame, located: DataFrame, doc_id: str, text: str, make: Callable[[pa.Array], list[bytes]]) -> DataFrame:
    """(key, made): what `make` gives for each of the located texts, and if they are many for some others, once each."""
    wanted = located.select(F.col("key").alias("k"), "least")
    match = (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("least"))
    bit = lambda *names: F.pmod(F.xxhash64(*names), F.lit(FILTER_BITS)).alias("bit")
    rows = docs.select(_key(text), F.col(doc_id).alias("id"), F.coalesce(text, F.lit("")).alias("t"))
    few = located.limit(SENT_ROWS + 1).count() <= SENT_ROWS
    marks = None if few else _marks(located.select(bit("key", "least")))
    rows = rows.join(F.broadcast(wanted), match, "left_semi") if few else rows
    rows = rows.select("key", "t", bit("key", "id"))

    def each(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        if marks is not None:
            at = batch.column(2).to_numpy().astype(np.uint64)
            batch = batch.filter(pa.array(marks[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1) == 1))
        if not batch.num_rows:
            return None
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(make(batch.column(1)), pa.binary())], names=["key", "made"])

    # Rows may repeat an id and its text.
    return map_batches(rows, each, "key long, made binary").groupBy("key").agg(F.first("made").alias("made"))


def _texts(docs: DataFrame, located: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(key, t): the located texts, compressed."""
    return _made(docs, located, doc_id, text, lambda texts: [_packed(t) for t in texts.to_pylist()]).withColumnRenamed("made", "t")


def _verified(docs: DataFrame, pairs: DataFrame, doc_id: str, text: str, threshold: float) -> DataFrame:
    """(a, b, near): each pair with whether the exact similarity of its texts reaches the threshold.

    A text is sent once for each pair it is second in, and its first once for each `FAMILY` of its pairs.
    """
    pairs = checkpointed(pairs)
    located = _located(docs, pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct(), doc_id, text)
    salts = pairs.groupBy("a").agg(F.expr(f"count(*) div {FAMILY} + 1").alias("salts"))
    pairs = pairs.join(salts, "a").select("a", F.pmod(F.xxhash64("b"), "salts").alias("salt"), "b")
    second = pairs.select(F.col("b").alias("key"), "a", "salt", "b")
    first = pairs.select("a", "salt").distinct().select(F.col("a").alias("key"), "a", "salt", F.lit(None).cast("long").alias("b"))
    rows = first.union(second).join(_texts(docs, located, doc_id, text), "key").select("a", "salt", "b", "t")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, np.zeros(0, np.uint64)
        for batch in (part for whole in batches for part in parts(whole)):
            a, salts, b = (batch.column(i).to_pylist() for i in range(3))
            out = []
            for i, shingled in enumerate(_sets_of_packed(batch.column(3))):
                if b[i] is None:
                    at, own = (a[i], salts[i]), shingled
                else:
                    assert at == (a[i], salts[i])
                    out.append((a[i], b[i], jaccard(own, shingled) >= threshold))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["a", "b", "near"])

    dealt = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return checkpointed(dealt.mapInArrow(over, "a long, b long, near boolean"))


class _Labels:
    """Which texts of a cell are linked: one label for each linked set."""

    def __init__(self, kinds: np.ndarray) -> None:
        _, self.of = np.unique(kinds, return_inverse=True)

    def link(self, i: int, j: int) -> None:
        self.of[self.of == self.of[j]] = self.of[i]


def _likely(sigs: np.ndarray, i: int, other: np.ndarray, band: int, near: float) -> tuple[np.ndarray, np.ndarray]:
    """Those of `other` whose signatures agree with i's in enough places, and no band before this one whole; and their likeness."""
    equal = sigs[other] == sigs[i]
    likeness_ = equal.mean(1)
    earlier = equal.reshape(len(other), BANDS, ROWS).all(2)[:, :band].any(1)
    good = (likeness_ >= near) & ~earlier
    return other[good], likeness_[good]


def _meeting(keys: np.ndarray, kinds: np.ndarray, sigs: np.ndarray, sides: np.ndarray, alone: bool, band: int, near: float) -> np.ndarray:
    """Which texts of a cell are in a pair that `_forest` may verify."""
    out = np.zeros(len(keys), bool)
    for i in range(len(keys)):
        other, _ = _likely(sigs, i, np.flatnonzero((kinds != kinds[i]) & (keys > keys[i]) & (alone | (sides != sides[i]))), band, near)
        out[other] = True
        out[i] |= len(other) > 0
    return out


def _forest(keys: np.ndarray, kinds: np.ndarray, sigs: np.ndarray, sets: list[np.ndarray], sides: np.ndarray, alone: bool, band: int, threshold: float, near: float) -> list[tuple[int, int]]:
    """Links that connect all texts of different classes that are similar, of the pairs of one cell.

    Pairs that share an earlier band meet there.
    """
    labels, out = _Labels(kinds), []
    for i in range(len(keys)):
        other = np.flatnonzero((labels.of != labels.of[i]) & (keys > keys[i]) & (alone | (sides != sides[i])))
        other, likeness_ = _likely(sigs, i, other, band, near)
        other = other[np.argsort(-likeness_, kind="stable")]
        for j in other.tolist():
            if labels.of[i] != labels.of[j] and jaccard(sets[i], sets[j]) >= threshold:
                labels.link(i, j)
                out.append((int(keys[i]), int(keys[j])))
    return out


def _cells(members: DataFrame, blocks: str) -> DataFrame:
    """Members of a band dealt into `blocks` + 1 blocks; each two blocks meet once, in the cell of the lesser and the greater."""
    size = members.groupBy("band").agg((F.expr(blocks) + 1).alias("blocks"))
    cells = members.join(size, "band").withColumn("own", F.pmod(F.xxhash64("key"), "blocks"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return cells.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("blocks", "other")


def _column(rows: pa.Table, name: str) -> pa.Array:
    return rows.column(name).combine_chunks()


def _cell(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool, int]:
    """Keys, classes, signatures and blocks of a cell, whether that is a block with itself, and which band it is."""
    sigs = np.stack([np.frombuffer(s, "<u2") for s in _column(rows, "sig").to_pylist()])
    keys, kinds, own = (_column(rows, name).to_numpy() for name in ("key", "class", "own"))
    low, high, band = (_column(rows, name)[0].as_py() for name in ("low", "high", "band"))
    return keys, kinds, sigs, own, low == high, band & 31


def _across(docs: DataFrame, reps: DataFrame, tested: DataFrame, doc_id: str, text: str, threshold: float) -> DataFrame:
    """Verified links between different classes that share a bucket with a failed comparison."""
    failed = tested.where("not near").select(F.col("a").alias("rep"), F.col("b").alias("key"))
    bands = checkpointed(reps.join(failed, ["rep", "key"], "left_semi").select("band").distinct())
    found = components(tested.where("near").select("a", "b"))
    shared = reps.join(bands, "band", "left_semi")
    members = shared.select("band", "key").union(shared.select("band", F.col("rep").alias("key"))).distinct()
    members = members.join(found, members["key"] == found["node"], "left").select("band", "key", F.coalesce("root", "key").alias("class"))
    members = checkpointed(members)
    # Most of these buckets hold one class by now, linked by other bands.
    mixed = members.groupBy("band").agg(F.min("class").alias("one"), F.max("class").alias("two")).where("one <> two")
    members = checkpointed(members.join(mixed.select("band"), "band", "left_semi"))
    located = _located(docs, members.select("key").distinct(), doc_id, text)
    sigs = _made(docs, located, doc_id, text, _signatures_of).withColumnRenamed("made", "sig")

    def meet(rows: pa.Table) -> pa.Table:
        keys, kinds, sig, own, alone, band = _cell(rows)
        return rows.filter(pa.array(_meeting(keys, kinds, sig, own, alone, band, NEAR))).select(["band", "key", "class", "sig"])

    # Most members meet all their like in other bands; texts are sent for the others only.
    met = _cells(members, f"count(*) div {BLOCK}").join(sigs, "key").groupBy("band", "low", "high").applyInArrow(meet, "band long, key long, class long, sig binary")
    members = checkpointed(met.distinct())
    located = located.join(members.select("key").distinct(), "key", "left_semi")
    texts = _texts(docs, located, doc_id, text)

    def compare(rows: pa.Table) -> pa.Table:
        keys, kinds, sig, own, alone, band = _cell(rows)
        links = _forest(keys, kinds, sig, list(_sets_of_packed(_column(rows, "t"))), own, alone, band, threshold, NEAR)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    cells = _cells(members.join(located.select("key", "chars"), "key"), f"greatest(count(*) div {BLOCK}, sum(chars) div {BLOCK_BYTES})")
    return cells.join(texts, "key").groupBy("band", "low", "high").applyInArrow(compare, "a long, b long")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(key, class) of each distinct text that is near another; key is the text's XXH64."""
    least = F.min("key").over(Window.partitionBy("band")).alias("rep")
    reps = checkpointed(_banded(_signed(docs, text)).select("band", least, "key").where("key <> rep"))
    tested = _verified(docs, reps.select(F.col("rep").alias("a"), F.col("key").alias("b")).distinct(), doc_id, text, threshold)
    near = tested.where("near").select("a", "b")
    if tested.where("not near").limit(1).count():
        near = near.union(_across(docs, reps, tested, doc_id, text, threshold))
    return checkpointed(components(near).select(F.col("node").alias("key"), F.col("root").alias("class")))


# ---- neighbours in the order of ids


def _ranges(docs: DataFrame, doc_id: str) -> list[int]:
    """Ids that end ranges of about equal counts, ascending; the last is the largest."""
    ids = docs.select(F.col(doc_id).cast("long").alias("i")).where("i is not null")
    n, largest = ids.agg(F.count("*"), F.max("i")).first()
    if not n:
        return []
    parts = int(min(max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // 5000), MOST_RANGES))
    at = [i / parts for i in range(1, parts)]
    # approxQuantile works on doubles; percentile_approx keeps whole numbers and gives values that occur.
    cuts = ids.agg(F.percentile_approx("i", F.array(*map(F.lit, at)), 20 * parts)).first()[0] if at else []
    return sorted({*map(int, cuts), int(largest)})


RESULTS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "class_id")


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The registered query's rows: fingerprints of each text and of its edited text, their likenesses, and the class."""
    key_type = docs.schema[doc_id].dataType
    ranges = np.array(_ranges(docs, doc_id), np.int64)
    found = classes(docs, doc_id, text)
    # Each class by its smallest id; one small row for each text in one goes along to its documents' range.
    ids = docs.select(F.col(doc_id).cast("long").alias("id"), _key(text))
    keys = ids.groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("n")).join(found, "key", "left")
    keys = keys.select("key", F.coalesce("class", "key").alias("class"), "least", "n")
    least = keys.groupBy("class").agg(F.min("least").alias("class_id"), F.sum("n").alias("n")).where("n > 1").drop("n")
    of_doc = ids.join(keys.join(least, "class").select("key", "class_id"), "key").select("id", "key", "class_id")

    def range_of(ids: pa.Array) -> np.ndarray:
        # Nulls come last in the descending order: in the range of the smallest ids.
        at = np.searchsorted(ranges, ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), "left")
        return np.minimum(at, max(len(ranges) - 1, 0))

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        id_, keys, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
        own = range_of(id_)
        packed = [_packed(t or "") for t in texts]
        # A document at a range's end is the first one there; the range above ends with it as a guest.
        ends = {int(v): i for i, v in enumerate(ranges)}
        guests = [(i, (ends[v] + 1) % len(ranges)) for i, v in enumerate(id_.to_pylist()) if v in ends]
        rows = np.array([*range(len(texts)), *[i for i, _ in guests]], np.int64)
        part = np.concatenate([own, np.array([p for _, p in guests], np.int64)])
        guest = np.arange(len(rows)) >= len(texts)
        take = pa.array(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int64)), pa.array(guest), id_.take(take), keys.take(take), pa.array(packed, pa.binary()).take(take), pa.nulls(len(rows), pa.int64())],
            names=["part", "guest", "id", "key", "t", "class_id"],
        )

    schema = "part long, guest boolean, id long, key long, t binary, class_id long"
    rows = map_batches(docs.select(F.col(doc_id).cast("long"), _key(text), text), pack, schema)

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        part = range_of(batch.column(0))
        n = batch.num_rows
        return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), pa.array(np.zeros(n, bool)), batch.column(0), batch.column(1), pa.nulls(n, pa.binary()), batch.column(2)], names=["part", "guest", "id", "key", "t", "class_id"])

    rows = rows.unionByName(map_batches(of_doc.distinct(), place, schema))
    order = [F.col("part"), F.col("guest"), F.col("id").desc_nulls_last(), F.col("key"), F.col("t").isNotNull()]
    dealt = rows.repartition(max(len(ranges), 1), "part").sortWithinPartitions(*order).select("part", "guest", "id", "key", "t", "class_id")
    out = StructType([StructField(doc_id, key_type)])
    for name, kind in zip(RESULTS, ("long", "string", "string", "string", "double", "double", "long"), strict=True):
        out = out.add(name, kind)

    def finish(rows: list[tuple], following: str) -> pa.RecordBatch:
        """rows: (id, text, class id) of documents one after another; `following` comes after the last."""
        own = [t for _, t, _ in rows]
        after = [*own[1:], following]
        edited = []
        for mine, other in zip(own, after, strict=True):
            cut = len(mine) // 3
            edited.append(mine[: len(mine) - cut] + other[:cut])
        sigs = [np.concatenate([signatures(t) for _, _, t in passes(pa.array(x, pa.large_string()), TEXT_BYTES)]) for x in ([*own, following], edited)]
        said = [[row.tobytes().hex() for row in s] for s in (sigs[0][:-1], sigs[1])]
        columns = [
            pa.array([i for i, _, _ in rows], pa.int64()), pa.array([len(t) for t in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()), pa.array(said[0], pa.string()), pa.array(said[1], pa.string()),
            pa.array(likeness(sigs[0][:-1], sigs[1])), pa.array(likeness(sigs[0][:-1], sigs[0][1:])), pa.array([i if c is None else c for i, _, c in rows], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays([columns[0].cast(arrow_id), *columns[1:]], names=[doc_id, *RESULTS])

    arrow_id = to_arrow_type(key_type)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting, size, known = None, [], 0, None
        first: str | None = None
        ended = False

        def close() -> Iterator[pa.RecordBatch]:
            # Without a guest after it (ids are all null), the order goes round within the range.
            if waiting and not ended:
                yield finish(waiting, first or "")

        for batch in (part for whole in batches for part in parts(whole)):
            for p, guest, id_, key, t, class_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part:
                    yield from close()
                    part, waiting, size, known, first, ended = p, [], 0, None, None, False
                if t is None:
                    known = (id_, key, class_id)
                    continue
                if ended:
                    continue
                text_ = _unpacked(t)
                if guest:
                    if waiting:
                        yield finish(waiting, text_)
                    waiting, ended = [], True
                    continue
                first = text_ if first is None else first
                waiting.append((id_, text_, known[2] if known is not None and known[:2] == (id_, key) else None))
                size += len(text_)
                if size > TEXT_BYTES and len(waiting) > 1:
                    yield finish(waiting[:-1], text_)
                    waiting, size = waiting[-1:], len(text_)
        yield from close()

    return dealt.mapInArrow(over, out)

