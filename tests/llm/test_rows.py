"""Whole rows of registered queries and pipeline stages on awkward tables, against plain versions."""

import hashlib
import itertools
import random
from collections import Counter

import corpus_pipeline as pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_brute_force import plain_simhash, plain_spans, roots
from tokenizers import Tokenizer

from tickloom.llm import bpe, minhash, pii, repetition, simhash
from tickloom.llm.common import table_of
from tickloom.llm.queries import TOKENIZER

SMALL = "/root/testdata/sf0.001"
PROSE = " ".join(f"word{i} and" for i in range(60))
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "one two three"), (None, None), (5, "same text here"), (5, "same text here"), (6, "same text here"),
    (8, "word " * 3000), (9, "\n" * 300), (10, "x\x00y \x1c z　é́ 😀 <|endoftext|> ΑΣ"), (11, "1 2 3 +1 (555) 555-0100 a.b@c.de 10.0.0.1 4111 1111 1111 1111"),
    (12, "é😀 mail a.b@c.de, or +44 20 7946 0958; 300.1.1.1 and 4111-1111-1111-1112"), (13, PROSE), (13, PROSE), (14, PROSE + " once more"),
    (15, f"{PROSE}\nwrite to x@y.org\n{PROSE[::-1]}"), (16, "naïve " * 200 + "192.168.0.1"),
]
#: Columns with the names that operators give their own.
EXTRA = ["_id", "_th", "_print", "_text", "_root", "id", "th", "row", "part", "ids", "kept", "n_words", "spans", "n_email", "component_id", "sequence_id", "offset", "n_dropped", "path", "v", "rank", "members"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, None if i % 5 == 0 else "src", "en", len(r[1] or ""), *[f"{n}{r[0]}" for n in EXTRA]) for i, r in enumerate(AWKWARD)]
    schema = "doc_id long, text string, source string, lang string, n_chars long, " + ", ".join(f"`{n}` string" for n in EXTRA)
    return spark.createDataFrame(rows, schema).repartition(3)


def test_personal_data_rows(spark, docs):
    rows = pii.report(docs).collect() + pii.report(table_of(spark, SMALL, "documents")).collect()
    texts = AWKWARD + [(r["doc_id"], r["text"]) for r in table_of(spark, SMALL, "documents").collect()]
    base = lambda t: plain_spans(t or "")
    said = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    want = [(i, *(sum(s[0] == k for s in base(t)) for k in pii.KINDS), sha(said(base(t)))) for i, t in texts]
    assert Counter(map(str, want)) == Counter(str(tuple(r)[:6]) for r in rows)
    # The base spans stay, in order among the added ones, which touch none of them.
    own = {sha(said(base(t))): base(t) for _, t in texts}
    for r in rows:
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        assert spans == sorted(spans, key=lambda s: (s[1], pii.KINDS.index(s[0]), s[2]))
        added = list((Counter(spans) - Counter(own[r["base_sha256"]])).elements())
        assert len(spans) == len(own[r["base_sha256"]]) + len(added)
        assert all(b <= c or d <= a for _, a, b in added for _, c, d in own[r["base_sha256"]])


def test_best_labels_of_all_sequences():
    model = pii.Tagger(hidden=3, width=3)
    rng = np.random.default_rng(5)
    model.weights["moves"] = rng.standard_normal(model.weights["moves"].shape).astype(np.float32)
    x = rng.integers(0, pii.SYMBOLS, (6, 4))
    scores, moves = model.emissions(x), model.weights["moves"]
    every = np.array(list(itertools.product(range(len(moves)), repeat=4)))
    total = sum(scores[t][:, every[:, t]] for t in range(4)) + sum(moves[every[:, t], every[:, t + 1]] for t in range(3))
    assert model.decode(x).tolist() == every[total.argmax(1)].tolist()


def test_token_rows(docs):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = []
    for i, text in AWKWARD:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False))))
    got = bpe.report(docs, TOKENIZER).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert Counter(map(str, want)) == Counter(str(tuple(r)) for r in got)


def test_simhash_rows(docs):
    prints = [plain_simhash(t or "") for _, t in AWKWARD]
    pairs = [(i, j) for i, j in itertools.combinations(range(len(prints)), 2) if (prints[i] ^ prints[j]).bit_count() <= 3]
    group = roots(len(prints), pairs)
    least = {g: min((i for (i, _), h in zip(AWKWARD, group, strict=True) if h == g and i is not None), default=None) for g in set(group)}
    want = [(i, f"{p:016x}", least[g]) for (i, _), p, g in zip(AWKWARD, prints, group, strict=True)]
    assert Counter(map(str, want)) == Counter(str(tuple(r)) for r in simhash.report(docs).collect())


def test_fingerprint_rows(docs):
    """Equal texts have equal fingerprints and class ids, and a text is wholly like an equal next one."""
    rows = minhash.report(docs).collect()
    assert Counter(str(r["doc_id"]) for r in rows) == Counter(str(i) for i, _ in AWKWARD)
    text = {i: t or "" for i, t in AWKWARD if i is not None}
    by_text = {}
    for r in rows:
        if r["doc_id"] is not None:
            assert r["n_chars"] == len(text[r["doc_id"]]) and 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
            by_text.setdefault(text[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())


def through(spark, folder, docs):
    """Each stage's name, the rows that it got and those that it gave."""
    for name, stage in pipeline.STAGES:
        got = docs.collect()
        out = stage(spark, docs, SMALL)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
        yield name, got, docs


def test_stages_on_awkward_rows(spark, docs, tmp_path):
    for name, got, out in through(spark, tmp_path, docs):
        rows = out.collect()
        if name == "packing":
            ids = Counter(str(r["doc_id"]) for r in got)
            assert {str(r["doc_id"]) for r in rows} == set(ids)
            tokenizer = Tokenizer.from_file(TOKENIZER)
            want = Counter(x for r in got for x in [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2])
            assert Counter(x for r in rows for x in r["ids"]) == want
            continue
        assert out.columns == docs.columns
        # Every other column is the one of its row.
        assert all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in EXTRA)
        texts = lambda of: Counter((str(r["doc_id"]), r["text"]) for r in of)
        if name == "quality_rules":
            good = spark.createDataFrame([(r["doc_id"], r["text"]) for r in got], "doc_id long, text string")
            assert texts(rows) == texts(repetition.judge(good).where("kept").collect()) and rows
        elif name == "line_dedup":
            assert Counter(str(r["doc_id"]) for r in rows) == Counter(str(r["doc_id"]) for r in got)
        elif name == "simhash_near_dedup":
            least = simhash.report(spark.createDataFrame([(r["doc_id"], r["text"]) for r in got], "doc_id long, text string")).collect()
            assert Counter(r["doc_id"] for r in rows) == Counter({r["component_id"] for r in least})
        elif name == "pii":
            assert Counter(str(r["doc_id"]) for r in rows) == Counter(str(r["doc_id"]) for r in got)
            assert not any(plain_spans(r["text"] or "") for r in rows)


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_each_stage_alone(spark, docs, name):
    """Rows that earlier stages would have taken out, and a table without rows."""
    stage = dict(pipeline.STAGES)[name]
    rows = stage(spark, docs, SMALL).collect()
    if name in ("line_dedup", "pii"):
        assert Counter(str(r["doc_id"]) for r in rows) == Counter(str(i) for i, _ in AWKWARD)
    elif name == "packing":
        assert {str(r["doc_id"]) for r in rows} == {str(i) for i, _ in AWKWARD}
    empty = stage(spark, docs.where(F.lit(False)), SMALL)
    assert empty.count() == 0 and (name == "packing" or empty.columns == docs.columns)


@pytest.mark.parametrize("seed", range(2))
def test_stage_of_near_copies_keeps_one_of_each_group(spark, seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choices(["sea", "wind", "hill", "stone", "rain", "dust"], k=12)) for _ in range(20)]
    rows = [(i, rng.choice(texts)) for i in range(200)]
    prints = {t: plain_simhash(t) for t in texts}
    group = roots(200, [(i, j) for i, j in itertools.combinations(range(200), 2) if (prints[rows[i][1]] ^ prints[rows[j][1]]).bit_count() <= 3])
    kept = pipeline.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), SMALL).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(group))
