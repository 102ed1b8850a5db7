"""BPE encoding and decoding by speculation and verification.

A word's tokens are guessed by greedy longest match. A token sequence is the result of the merges exactly if every
token is reachable by merges and no adjacent pair would have merged across its boundary; numpy tests the pairs of all
guessed words at once. Only words with a failing pair are merged exactly. The test of a pair (a, b): while a and b are
built, the symbols next to the boundary are those on the right spine of a and the left spine of b; a merge of such x
and y crosses the boundary if it ranks before the merges that use up x in a and y in b (of equal ones, the left goes
first).

Pieces that a worker has met before are looked up instead (`words`).

Defined results: a null or empty text has no tokens; null ids, repeated rows and texts of any length are encoded like
others. `encode` keeps all columns of its input, a column named like a result is replaced.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType
from tokenizers import Regex, Tokenizer, pre_tokenizers

from tickloom.llm.common import map_batches, passes
from tickloom.llm.words import PieceTable, ragged

#: Stands for the end of a word in token strings; no byte of a text maps to it.
END = "\n"
#: Up to here Python and the tokenizers library agree on every letter's case, class and composition.
LAST_LATIN = "\u024f"
#: Pairs of tokens whose test a worker remembers.
KNOWN_PAIRS = 1_000_000
#: Symbols from which on a word is merged by itself, by a heap.
LONG = 128
_INFINITE = np.int64(1) << 40


@functools.cache
def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next free one from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Merges:
    """A vocabulary with its merges, from a tokenizer file of type BPE with word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        inner = lambda token: token[: -len(suffix)] + END if token.endswith(suffix) else token
        self.raw = {i: t for t, i in model["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {inner(t): i for t, i in model["vocab"].items()}
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.size = max(self.raw) + 1
        pairs: dict[tuple[int, int], int] = {}
        left, right, rank_of = (np.full(self.size, -1, np.int64) for _ in range(3))
        self.result = np.zeros(len(model["merges"]), np.int64)
        for rank, (a, b) in enumerate(model["merges"]):
            pair, merged = (self.ids[inner(a)], self.ids[inner(b)]), self.ids[inner(a + b)]
            self.result[pairs.setdefault(pair, rank)] = merged
            if rank_of[merged] < 0:
                left[merged], right[merged], rank_of[merged] = *pair, rank
        keys = np.array([a * self.size + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.array(list(pairs.values()), np.int64)[order]
        self.lookup = dict(zip(keys.tolist(), pairs.values(), strict=True))
        self.right_spine, self.right_used = self._spine(right, rank_of)
        self.left_spine, self.left_used = self._spine(left, rank_of)
        inner_ids, final_ids = np.zeros(512, np.int64), np.zeros(512, np.int64)
        for c in byte_symbols():
            inner_ids[ord(c)], final_ids[ord(c)] = self.ids[c], self.ids[c + END]
        self.base = inner_ids, final_ids
        self.words = self._reachable()
        # A trie of the tokens: sorted (node, symbol) keys and the node that each leads to.
        nodes: dict[str, int] = {"": 0}
        for token in self.words:
            for n in range(1, len(token) + 1):
                nodes.setdefault(token[:n], len(nodes))
        del nodes[""]
        edges = np.array([(nodes.get(t[:-1], 0) * 512 + ord(t[-1])) for t in nodes], np.int64)
        order = np.argsort(edges)
        self.edges, self.edge_to = edges[order], np.array(list(nodes.values()), np.int64)[order]
        self.token_at = np.full(len(nodes) + 1, -1, np.int64)
        for token, i in self.words.items():
            self.token_at[nodes[token]] = i
        self.longest = max(map(len, self.words))

    def _reachable(self) -> dict[str, int]:
        """The tokens that merging their own text gives; other entries of the vocabulary never come up."""
        tokens = list(self.ids)
        ids, at = self.merged(tokens)
        return {t: self.ids[t] for i, t in enumerate(tokens) if at[i + 1] - at[i] == 1 and ids[at[i]] == self.ids[t]}

    def _spine(self, child: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each token and its outer children, -1 after the last; the rank of the merge that uses each up."""
        levels, used = [np.arange(self.size)], [np.full(self.size, _INFINITE)]
        while (levels[-1] >= 0).any():
            at = levels[-1]
            levels.append(np.where(at >= 0, child[at], -1))
            used.append(np.where(at >= 0, rank[at], -1))
        return np.stack(levels[:-1], 1), np.stack(used[:-1], 1)

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The exact merges of many words, flat ids and the number of each word's first one.

        Each round merges, in every word at once, the pair of the lowest rank, the leftmost of equal ones.
        """
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        word = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        ends = np.flatnonzero(points == ord(END))
        inner, final = self.base
        ids = inner[points]
        ids[ends - 1] = final[points[ends - 1]]
        ids, word = np.delete(ids, ends), np.delete(word, ends)
        rank = np.full(len(ids), _INFINITE)
        inside = np.flatnonzero(word[1:] == word[:-1])
        rank[inside] = self.rank_of(ids[inside], ids[inside + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(start, len(ids)))
            least = np.repeat(np.minimum.reduceat(rank, start), size)
            going = least < _INFINITE
            if not going.all():
                done.append((word[~going], ids[~going]))
                ids, word, rank, least = ids[going], word[going], rank[going], least[going]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == least)
            at = at[np.append(True, word[at][1:] != word[at][:-1])]
            ids[at] = self.result[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            ids, word, rank = ids[keep], word[keep], rank[keep]
            after = np.append(word[1:] == word[:-1], False)
            rank[at] = _INFINITE
            for place in (at[after[at]], at[at > 0][after[at[at > 0] - 1]] - 1):
                rank[place] = self.rank_of(ids[place], ids[place + 1])
        word, ids = (np.concatenate([d[i] for d in done]) for i in (0, 1))
        order = np.argsort(word, kind="stable")
        return ids[order], np.append(0, np.cumsum(np.bincount(word, minlength=len(words))))

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _INFINITE)

    def merged_long(self, word: str) -> list[int]:
        """The exact merges of one long word: a heap of pairs over a linked list of its parts."""
        last = len(word) - 2
        inner, final = self.base
        parts = [int(inner[ord(c)]) for c in word[:-1]]
        parts[last] = int(final[ord(word[last])])
        after, before = list(range(1, last + 2)), list(range(-1, last))
        ranks = self.rank_of(np.array(parts[:-1], np.int64), np.array(parts[1:], np.int64)).tolist() if last else []
        heap = [(r, i, parts[i], parts[i + 1]) for i, r in enumerate(ranks) if r < _INFINITE]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j > last or parts[j] != b:
                continue
            parts[i], parts[j] = int(self.result[rank]), -1
            after[i] = after[j]
            if after[i] <= last:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y <= last and (at := self.lookup.get(parts[x] * self.size + parts[y])) is not None:
                    heapq.heappush(heap, (at, x, parts[x], parts[y]))
        return [p for p in parts if p >= 0]

    def guesses(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches of many words, word numbers and tokens in order; the end mark never stands alone.

        All words walk the trie together; each step reads one symbol of every unfinished word.
        """
        text = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        end = np.cumsum(size)
        word, at = np.arange(len(words)), end - size
        read, node = at.copy(), np.zeros(len(words), np.int64)
        token, stop = np.full(len(words), -1, np.int64), at.copy()
        out: list[tuple[np.ndarray, np.ndarray]] = []
        while len(word):
            key = node * 512 + text[np.minimum(read, end - 1)]
            edge = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            on = (self.edges[edge] == key) & (read < end)
            node = np.where(on, self.edge_to[edge], 0)
            read = read + on
            match = on & (self.token_at[node] >= 0) & (read != end - 1)
            token, stop = np.where(match, self.token_at[node], token), np.where(match, read, stop)
            off = ~on
            if off.any():
                out.append((word[off], token[off]))
                read = np.where(off, stop, read)
                open_ = ~off | (read < end)
                if not open_.all():
                    word, end, read, node, token, stop = (x[open_] for x in (word, end, read, node, token, stop))
        word, token = (np.concatenate([o[i] for o in out]) for i in (0, 1))
        order = np.argsort(word, kind="stable")
        return word[order], token[order]

    def crosses(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of tokens would have merged across their boundary."""
        found = np.zeros(len(a), bool)
        for i in range(self.right_spine.shape[1]):
            x, x_used = self.right_spine[a, i], self.right_used[a, i]
            if not (x >= 0).any():
                break
            for j in range(self.left_spine.shape[1]):
                y = self.left_spine[b, j]
                open_ = np.flatnonzero((x >= 0) & (y >= 0) & ~found)
                if not len(open_):
                    break
                rank = self.rank_of(x[open_], y[open_])
                found[open_] |= (rank < x_used[open_]) & (rank <= self.left_used[b[open_], j]) & (rank < _INFINITE)
        return found


@functools.cache
def merges(path: str) -> Merges:
    return Merges(path)


class Encoder:
    """Encodes texts; the ids of pieces are remembered."""

    def __init__(self, path: str) -> None:
        self.merges = merges(path)
        self.table = PieceTable(self.encode_pieces)
        self.known = np.zeros(0, np.int64)
        self.known_crosses = np.zeros(0, bool)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.merges.special)) + ")")
        # The library's own Unicode tables, for what lies outside the Latin blocks.
        self.normalizer = Tokenizer.from_file(path).normalizer
        self.split = pre_tokenizers.Split(Regex(self.merges.pattern.pattern), "removed", invert=True)
        numbers = [f"{i} ".encode() for i in range(self.merges.size)]
        tokens = [f"{self.merges.raw.get(i, '')} ".encode() for i in range(self.merges.size)]
        self.numbers, self.tokens = Strings(numbers), Strings(tokens)

    def pieces(self, chunk: str) -> list[str | int]:
        """Ids of special tokens, and words as strings of byte symbols with the end mark."""
        if "<|" in chunk:
            out: list[str | int] = []
            for part in self.specials.split(chunk):
                out += [self.merges.special[part]] if part in self.merges.special else self.pieces_of_plain(part) if part else []
            return out
        return self.pieces_of_plain(chunk)

    def pieces_of_plain(self, chunk: str) -> list[str | int]:
        if chunk.isascii():
            lowered = chunk.lower()
            if lowered.isalpha():
                return [lowered + END]
            if lowered[-1] in ".," and lowered[:-1].isalpha():
                return [lowered[:-1] + END, lowered[-1] + END]
            symbols = None
            words = self.merges.pattern.findall(lowered)
        elif max(chunk) <= LAST_LATIN and "İ" not in chunk:
            lowered = unicodedata.normalize("NFC", chunk).lower()
            symbols = byte_symbols()
            if lowered.isalpha():
                return ["".join([symbols[b] for b in lowered.encode()]) + END]
            words = self.merges.pattern.findall(lowered)
        else:
            lowered = self.normalizer.normalize_str(chunk)
            symbols = byte_symbols()
            words = [w for w, _ in self.split.pre_tokenize_str(lowered)]
        if symbols is None and lowered.isprintable():
            return [w + END for w in words]
        symbols = byte_symbols()
        return ["".join([symbols[b] for b in w.encode()]) + END for w in words]

    def crossing(self, keys: np.ndarray) -> np.ndarray:
        """`Merges.crosses` for distinct pairs, remembered."""
        at = np.minimum(np.searchsorted(self.known, keys), max(len(self.known) - 1, 0))
        new = self.known[at] != keys if len(self.known) else np.ones(len(keys), bool)
        if new.any():
            fresh = keys[new]
            answers = self.merges.crosses(fresh // self.merges.size, fresh % self.merges.size)
            if len(self.known) > KNOWN_PAIRS:
                self.known, self.known_crosses = np.zeros(0, np.int64), np.zeros(0, bool)
                return self.crossing(keys)
            all_keys = np.concatenate([self.known, fresh])
            order = np.argsort(all_keys, kind="stable")
            self.known, self.known_crosses = all_keys[order], np.concatenate([self.known_crosses, answers])[order]
            at = np.searchsorted(self.known, keys)
        return self.known_crosses[at]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Guess all words, test all adjacent pairs, merge the failing words exactly."""
        long = {i: self.merges.merged_long(w) for i, w in enumerate(words) if len(w) > LONG}
        short = [i for i in range(len(words)) if i not in long]
        result: list[list[int]] = [long.get(i, []) for i in range(len(words))]
        if not short:
            return result
        of, flat = self.merges.guesses([words[i] for i in short])
        at, ids = np.append(0, np.cumsum(np.bincount(of, minlength=len(short)))).tolist(), flat.tolist()
        for k, i in enumerate(short):
            result[i] = ids[at[k] : at[k + 1]]
        pairs = np.flatnonzero(of[1:] == of[:-1])
        if len(pairs):
            keys, inverse = np.unique(flat[pairs] * self.merges.size + flat[pairs + 1], return_inverse=True)
            failing = [short[i] for i in np.unique(of[pairs[self.crossing(keys)[inverse]]]).tolist()]
            if failing:
                merged, at = self.merges.merged([words[i] for i in failing])
                ids, at = merged.tolist(), at.tolist()
                for k, i in enumerate(failing):
                    result[i] = ids[at[k] : at[k + 1]]
        return result

    def encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cut = list(map(self.pieces, pieces))
        words = [w for ws in cut for w in ws if isinstance(w, str)]
        made = iter(self.encode_words(words))
        ids = [list(chain.from_iterable(next(made) if isinstance(w, str) else [w] for w in ws)) for ws in cut]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes


class Strings:
    """Byte strings by number, joined by numpy."""

    def __init__(self, parts: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        self.size = np.fromiter(map(len, parts), np.int64, len(parts))
        self.at = np.cumsum(self.size) - self.size

    def joined(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The strings of ids[bounds[i]:bounds[i + 1]] together, without the last byte."""
        size = self.size[ids]
        raw = self.data[ragged(self.at[ids], size)].tobytes()
        at = np.append(0, np.cumsum(size))[bounds].tolist()
        return [raw[a : max(b - 1, a)] for a, b in zip(at, at[1:], strict=False)]


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encoded(column: pa.Array, path: str) -> Iterator[tuple[np.ndarray, bytes, bytes]]:
    """For each text its ids, and ids and tokens each joined by one space."""
    own = encoder(path)
    for _, _, texts in passes(column):
        ids, bounds = own.table.ids_of(texts)
        yield from zip(np.split(ids, bounds[1:-1]), own.numbers.joined(ids, bounds), own.tokens.joined(ids, bounds), strict=True)


def decode(ids: Iterable[int], path: str) -> str:
    """The tokens joined by one space, as the tokenizer file names no decoder; unknown ids are left out."""
    raw = merges(path).raw
    return " ".join([raw[i] for i in ids if i in raw])


def _mapped(docs: DataFrame, text: str, results: list[StructField], row) -> DataFrame:
    named = {f.name for f in results}
    schema = StructType([f for f in docs.schema.fields if f.name not in named] + results)
    at = docs.columns.index(text)
    others = [i for i, name in enumerate(docs.columns) if name not in named]

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = list(zip(*row(batch.column(at)), strict=True))
        columns = [batch.column(i) for i in others] + [pa.array(v, type=t) for v, t in zip(made, arrow, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    kinds = {LongType(): pa.int64(), StringType(): pa.string(), ArrayType(IntegerType()): pa.list_(pa.int32())}
    arrow = [kinds[f.dataType] for f in results]
    return map_batches(docs, each, schema)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`docs` with ids (array) and decoded (text)."""

    def row(column):
        return [(ids, tokens.decode()) for ids, _, tokens in encoded(column, path)]

    return _mapped(docs, text, [StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())], row)


def digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`docs` with n_tokens and the SHA-256 of its ids and of its decoded text."""

    def row(column):
        sha = lambda s: hashlib.sha256(s).hexdigest()
        return [(len(ids), sha(numbers), sha(tokens)) for ids, numbers, tokens in encoded(column, path)]

    names = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    return _mapped(docs, text, names, row)


def report(docs: DataFrame, path: str) -> DataFrame:
    """The registered query's rows."""
    return digests(docs.select("doc_id", "text"), path).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
