"""Token ids of whole batches of texts for a tokenizer that drops white space and case.

Texts are cut at ASCII white space, and between a letter or digit and the punctuation that ends a chunk: this tokenizer
always separates there, whatever the rest. Equal pieces, apart from the case of A-Z, have equal tokens, so only pieces
that a worker has not met are encoded; all others are looked up by a 64-bit hash. The table of met pieces is bounded and
emptied when full, which changes no result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tickloom.llm.common import SPACE, SpanHash, Texts

#: Pieces that a worker remembers.
TABLE_SIZE = 800_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def _folded(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A-Z lowered, but for chunks where case can matter: before a combining mark, and in special tokens."""
    out = _LOWER[data]
    odd = (data == 0xCC) | (data == 0xCD)
    odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    at = np.flatnonzero(odd)
    if len(at):
        chunk = np.unique(np.searchsorted(start, at, "right") - 1)
        for c in chunk[chunk >= 0].tolist():
            out[start[c] : end[c]] = data[start[c] : end[c]]
    return out


def pieces(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The folded bytes, and start, end and text number of the pieces in order."""
    start, end, text = texts.runs(SPACE)
    data = texts.data
    folded = _folded(data, start, end)
    if not len(start):
        return folded, start, end, text
    # The last byte of each chunk that isn't punctuation.
    place = np.where(_PUNCTUATION[data], -1, np.arange(len(data)))
    body = np.maximum(np.maximum.accumulate(place)[end - 1] + 1, start)
    last = data[np.maximum(body - 1, 0)]
    before = data[np.maximum(body - 2, 0)]
    # Two-byte letters U+00C0 to U+023F, but for the signs of multiplication and division, and for U+0130, whose lower case
    # ends in a mark that joins what follows.
    letter = (before == 0xC3) & (last != 0x97) & (last != 0xB7) | (before >= 0xC4) & (before <= 0xC8) & ~((before == 0xC4) & (last == 0xB0))
    cut = (body < end) & (body > start) & (_ALNUM[last] | (last >= 0x80) & letter & (body - 2 >= start))
    # A special token's end is no punctuation.
    close = np.flatnonzero((data[:-1] == 0x7C) & (data[1:] == 0x3E))
    cut[np.searchsorted(start, close, "right") - 1] = False
    body_end = np.where(cut, body, end)
    order = np.argsort(np.concatenate([start, body[cut]]), kind="stable")
    return folded, np.concatenate([start, body[cut]])[order], np.concatenate([body_end, end[cut]])[order], np.concatenate([text, text[cut]])[order]


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start[i], start[i] + 1 ... of all i, `size` each."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)


class PieceTable:
    """Ids of pieces by their hash; `encode` gives flat ids and the number of each piece's.

    The hashes are a sorted array, which takes a tenth of a dictionary's memory.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = TABLE_SIZE) -> None:
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.known, self.row = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.at, self.size, self.rows = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32), 0

    def _add(self, hashes: np.ndarray, pieces: list[str]) -> None:
        """Sorted hashes that are not known yet, and their pieces."""
        ids, sizes = self.encode(pieces)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.rows + len(sizes) > len(self.at):
            self.at, self.size = np.concatenate([self.at, np.zeros_like(self.at)]), np.concatenate([self.size, np.zeros_like(self.size)])
        new = slice(self.rows, self.rows + len(sizes))
        self.flat[self.used : self.used + len(ids)] = ids
        self.at[new], self.size[new] = self.used + np.cumsum(sizes) - sizes, sizes
        place = np.searchsorted(self.known, hashes)
        self.known, self.row = np.insert(self.known, place, hashes), np.insert(self.row, place, np.arange(new.start, new.stop))
        self.used, self.rows = self.used + len(ids), new.stop

    def ids_of(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the place of each text's first one and the end."""
        data, start, end, text = pieces(texts)
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        hashes = SpanHash(data).of(start, end)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if self.rows + len(distinct) > self.limit and self.rows:
            self.clear()
        place = np.searchsorted(self.known, distinct)
        met = place < len(self.known)
        met[met] = self.known[place[met]] == distinct[met]
        if len(missing := np.flatnonzero(~met)):
            raw, at = data.tobytes(), first[missing]
            self._add(distinct[missing], [raw[a:b].decode() for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)])
        row = self.row[np.searchsorted(self.known, distinct)][inverse]
        size = self.size[row].astype(np.int64)
        per_text = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(np.bincount(text, weights=size, minlength=len(texts)).astype(np.int64), out=per_text[1:])
        return self.flat[ragged(self.at[row], size)], per_text


