"""What a Python worker holds: two of them share an executor's memory with its JVM."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tickloom.llm import common, repetition, simhash
from tickloom.llm.words import PieceTable


def traced(work):
    """The result, and MB held afterwards and at most."""
    tracemalloc.start()
    try:
        out = work()
        held, most = tracemalloc.get_traced_memory()
        return out, held / 1e6, most / 1e6
    finally:
        tracemalloc.stop()


def texts_of(words):
    return common.utf8(pa.array([" ".join(words)]))


def test_a_met_piece_takes_few_bytes():
    encode = lambda pieces: (np.array([int(p[1:]) for p in pieces], np.int32), np.ones(len(pieces), np.int64))
    lots = [texts_of(f"w{i}" for i in range(low, low + 20_000)) for low in range(0, 200_000, 20_000)]
    table = PieceTable(encode)

    def fill():
        for k, lot in enumerate(lots):
            assert table.ids_of(lot)[0].tolist() == list(range(20_000 * k, 20_000 * k + 20_000))

    fill()
    _, held, _ = traced(lambda: table.clear() or fill())
    assert table.rows == 200_000 and held < 10
    mixed = texts_of(["w7", "w199999", "w200000", "w7", "w0"])
    assert table.ids_of(mixed)[0].tolist() == [7, 199_999, 200_000, 7, 0] and table.rows == 200_001


def test_a_full_table_is_emptied():
    encode = lambda pieces: (np.array([int(p[1:]) for p in pieces for _ in range(2)], np.int32), np.full(len(pieces), 2))
    table = PieceTable(encode, limit=50)
    for low in (0, 30, 10, 45, 0):
        ids, bounds = table.ids_of(texts_of(f"w{i}" for i in range(low, low + 40)))
        assert ids.tolist() == [i for i in range(low, low + 40) for _ in range(2)] and bounds.tolist() == [0, 80]


@pytest.mark.parametrize("work", [lambda t: repetition.measure(t, repetition.Limits()), simhash.fingerprints])
def test_a_pass_over_many_texts(work):
    rng = np.random.default_rng(4)
    column = pa.array([" ".join(f"w{i}" for i in rng.integers(0, 9999, 300)) for _ in range(3000)])
    run = lambda: [work(texts) for _, _, texts in common.passes(column)]
    run()
    assert traced(run)[2] < 60
