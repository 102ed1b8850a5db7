"""Operators that SQL can't express, against plain Python, exact round trips and held-out labels."""

import contextlib
import hashlib
import io
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from tickloom.llm import bpe, licenses, line_templates, minhash, packing, pii, preferences, repetition, simhash
from tickloom.llm.common import components, passes, table_of, utf8
from tickloom.llm.queries import TOKENIZER

SF = "/root/testdata/sf0.001"
ODD = [
    "<|endoftext|>a <|startoftext|><|endoftext|>.", "<|ENDOFTEXT|> x", "H̱ H̱. ẖ É É.", "a× b÷, ~ø~", "aaaaaaa aa aaa aaaa", "ΣΑΣ ΌΣΟΣ Σ", "İstanbul ǅ",
    "don't 'sun I'LL we've 'S'", "a\x1cb c\x1f\x1d d", "é ́x à̖", "\x85a\xa0b c d e　f​g﻿h", "123 ４５６ ½ Ⅷ", "日本語 テキスト 한국어", "😀👍🏽 zero 😀.",
    "", "   ", "\x00a\x7f \x01", "≮ x̸>.", "antheris" * 40, "é" * 200, "a" * 1000, "in" * 77 + ".",
]


def random_texts(n, letters="abcin'ther1. é<|%,Ü!", size=40):
    return ["".join(random.Random(i).choices(letters, k=size)) for i in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    return [r["text"] for r in table_of(spark, SF, "documents").collect()]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def roots(n, pairs):
    forest = simhash.Forest(n)
    for a, b in pairs:
        forest.kept([a], [b])
    return [forest.root(i) for i in range(n)]


# ---- words and suffix arrays


def test_longest_repeats():
    rng = random.Random(1)
    for _ in range(300):
        s = [rng.randint(0, 3) for _ in range(rng.randint(0, 40))]
        best = [max([next(q for q in range(len(s)) if max(i, j) + q >= len(s) or s[i + q] != s[j + q]) for j in range(len(s)) if j != i], default=0) for i in range(len(s))]
        assert repetition.repeat_lengths(np.array(s, np.int64)).tolist() == best


def test_repetition_thresholds(spark):
    words = [f"w{i}" for i in range(60)]
    clean, looped = " ".join(words), " ".join(words[:10] * 8)
    rows = repetition.judge(spark.createDataFrame([(1, clean, "x"), (2, looped, "y")], "doc_id long, text string, n_words string")).collect()
    assert [(r["n_words"], r["longest_repeat"], r["kept"]) for r in rows] == [(60, 0, True), (80, 70, False)]
    half = " ".join(words + words[:30])
    assert repetition.judge(spark.createDataFrame([(1, half)], "doc_id long, text string")).first()["covered_fraction"] == 60 / 90


# ---- BPE and packing


def test_bpe_equals_library(texts, tokenizer):
    cases = texts[:80] + ODD + random_texts(500)
    for text, (ids, numbers, tokens) in zip(cases, bpe.encoded(pa.array(cases), TOKENIZER), strict=True):
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected, text[:80]
        assert numbers.decode() == " ".join(map(str, expected))
        assert tokens.decode() == tokenizer.decode(expected, skip_special_tokens=False) == bpe.decode(expected, TOKENIZER)


def test_bpe_pair_test_is_exact(tokenizer):
    own = bpe.merges(TOKENIZER)
    names = sorted(own.words)
    rng = random.Random(5)
    inner = [n for n in names if not n.endswith(bpe.END)]
    pairs = [(rng.choice(inner), rng.choice(names)) for _ in range(3000)]
    crosses = own.crosses(np.array([own.words[a] for a, _ in pairs]), np.array([own.words[b] for _, b in pairs]))
    words = [a + (b if b.endswith(bpe.END) else b + "q" + bpe.END) for a, b in pairs]
    ids, at = own.merged(words)
    for i, (a, b) in enumerate(pairs):
        if b.endswith(bpe.END):
            assert crosses[i] == (ids[at[i] : at[i + 1]].tolist() != [own.words[a], own.words[b]])
        assert own.merged_long(words[i]) == ids[at[i] : at[i + 1]].tolist()


def test_table_of_pieces_is_bounded(texts):
    whole = bpe.Encoder(TOKENIZER)
    small = bpe.Encoder(TOKENIZER)
    small.table.limit = 500
    for _, _, part in passes(pa.array(texts), 20_000):
        assert whole.table.ids_of(part)[0].tolist() == small.table.ids_of(part)[0].tolist()


def check_pieces(pieces, docs, tokenizer):
    expected = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in docs}
    pieces = pieces.sort_values(["sequence_id", "offset"])
    lengths = pieces.groupby("sequence_id")["length"]
    assert (pieces["offset"] == lengths.cumsum() - pieces["length"]).all() and lengths.sum().max() <= 4096
    for i, own in pieces.sort_values(["doc_id", "start"]).groupby("doc_id"):
        assert own["start"].tolist() == np.append(0, own["length"].cumsum()[:-1]).tolist() and own["length"].sum() == own["doc_tokens"].iloc[0] == len(expected[i])
        for start, length, crc in own[["start", "length", "ids_crc32"]].itertuples(index=False):
            assert zlib.crc32(np.array(expected[i][start : start + length], "<u4").tobytes()) == crc
    assert set(pieces["doc_id"]) == set(expected)
    return lengths.sum()


@pytest.mark.parametrize("places, fan, parts", [(64, 64, 1), (3, 2, 9)])
def test_packing(spark, tokenizer, monkeypatch, places, fan, parts):
    monkeypatch.setattr(packing, "FAN", fan)
    docs = table_of(spark, SF, "documents").select("doc_id", "text").repartition(parts, "doc_id")
    rows = docs.collect()
    fills = check_pieces(packing.pack(docs, TOKENIZER, open_windows=places, with_ids=True).toPandas(), rows, tokenizer)
    assert fills.sum() / (4096 * len(fills)) > 0.9


# ---- licenses


def plain_labels(text):
    words, found = licenses.words_of(text), set()
    for label, template in licenses.TEMPLATES.items():
        own = licenses.words_of(template)
        size = -(-len(own) * 5 // 4)
        if any(len(set(own) & set(words[i : i + size])) >= licenses.need(len(set(own)), 0.9) for i in range(len(words))):
            found.add(label)
    return found


def test_licenses_of_wrapped_and_of_one_line_texts(spark):
    rng, filler = random.Random(3), "plain words that stand between notices here".split()
    cases = []
    for label, template in licenses.TEMPLATES.items():
        words = template.split()
        wrapped = " ".join(words[:4]) + "\n" + " ".join(words[4:-2]) + "\n\n * " + " ".join(words[-2:])
        spread = " ".join(" ".join([w, *rng.choices(filler, k=6)]) for w in words)
        cases += [wrapped, spread, " ".join(filler * 30 + words + filler * 30), f"{template}\n{wrapped} {template}"]
        assert label in plain_labels(wrapped) and label not in plain_labels(spread)
    vocabulary = [w for t in licenses.TEMPLATES.values() for w in t.split()]
    for _ in range(200):
        words = rng.choice(list(licenses.TEMPLATES.values())).split()
        for _ in range(rng.randint(0, 5)):
            words.insert(rng.randint(0, len(words)), rng.choice(vocabulary + filler))
        cases.append(rng.choice(" \n").join(words[rng.randint(0, 2) :]) + " " + " ".join(rng.choices(vocabulary, k=20)))
    rows = licenses.scan(spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string"), phrases={}).collect()
    assert {r["doc_id"]: set(filter(None, r["labels"].split(","))) for r in rows} == {i: plain_labels(t) for i, t in enumerate(cases)}
    copies = {r["doc_id"]: r["matches"] for r in rows}
    for i, label in enumerate(licenses.TEMPLATES):
        assert [(m["line"], m["containment"]) for m in copies[4 * i + 3] if m["label"] == label] == [(0, 1.0), (1, 1.0), (4, 1.0)]


# ---- fingerprints


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_of_texts(texts):
    cases = texts[:60] + ["", "  ", "a", "A b", "É a\x1cb\x0bc d"]
    assert simhash.fingerprints(utf8(pa.array(cases))).tolist() == [plain_simhash(t) for t in cases]


def test_simhash_groups(spark, texts):
    docs = table_of(spark, SF, "documents")
    rows = docs.select("doc_id", "text").collect()
    prints = np.array([plain_simhash(r["text"]) for r in rows], np.uint64)
    near = np.argwhere(np.triu(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3, 1))
    group = roots(len(rows), near.tolist())
    least = {g: min(r["doc_id"] for r, h in zip(rows, group, strict=True) if h == g) for g in set(group)}
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.report(docs).collect()}
    assert found == {r["doc_id"]: (f"{p:016x}", least[g]) for r, p, g in zip(rows, prints.tolist(), group, strict=True)}
    assert {r["doc_id"] for r in simhash.keep_one(docs).collect()} == set(least.values())


@pytest.mark.parametrize("node", [16, 64, 8192])
def test_simhash_index_loses_no_link(spark, monkeypatch, node):
    # Families that fill many nodes, so that groups go on to further levels.
    monkeypatch.setattr(simhash, "NODE", node)
    rng = np.random.default_rng(0)
    values = []
    for base in rng.integers(0, 1 << 63, 25, dtype=np.uint64):
        for _ in range(30):
            value = int(base)
            for bit in rng.integers(0, 64, rng.integers(0, 6)):
                value ^= 1 << int(bit)
            values.append(value)
    values = np.unique(np.array([*values, 0, 1, 2, (1 << 64) - 1], np.uint64))
    links = simhash.near_links(spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "p long"))
    place = {int(v): i for i, v in enumerate(values.view(np.int64))}
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 3
    pairs = [(place[r["a"]], place[r["b"]]) for r in links.collect()]
    assert all(near[a, b] for a, b in pairs)
    assert roots(len(values), pairs) == roots(len(values), np.argwhere(np.triu(near, 1)).tolist())


def family(rng, size, flips):
    """Different fingerprints that differ from one in at most so many bits."""
    base, values = int(rng.integers(0, 1 << 63, dtype=np.uint64)), set()
    while len(values) < size:
        values.add(base ^ sum({1 << int(b) for b in rng.integers(0, 64, rng.integers(0, flips + 1))}))
    return values


def test_simhash_of_one_dense_family(spark, monkeypatch):
    # Most fingerprints are of one family, so that many levels are needed; each pair of them may be a link.
    monkeypatch.setattr(simhash, "NODE", 32)
    rng = np.random.default_rng(4)
    values = np.array(sorted(family(rng, 400, 4) | family(rng, 40, 9) | {0, (1 << 64) - 1}), np.uint64)
    links = simhash.near_links(spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "p long")).collect()
    place = {int(v): i for i, v in enumerate(values.view(np.int64))}
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 3
    pairs = [(place[r["a"]], place[r["b"]]) for r in links]
    assert all(near[a, b] for a, b in pairs) and len(set(pairs)) == len(pairs)
    assert roots(len(values), pairs) == roots(len(values), np.argwhere(np.triu(near, 1)).tolist())


@pytest.mark.parametrize("bits, prefix", [(3, 4), (0, 0), (20, 1), (64, 0)])
def test_gray_tree_equals_brute_force(bits, prefix):
    rng = np.random.default_rng(bits)
    values = np.array([*family(rng, 150, 6), *rng.integers(0, 1 << 63, 150, dtype=np.uint64).tolist()], np.uint64)
    values = values[np.argsort(simhash.gray_rank(values))]
    own = values >> np.uint64(63) >> np.uint64(1) if not prefix else values >> np.uint64(64 - prefix)
    near = (np.bitwise_count(values[:, None] ^ values[None, :]) <= bits) & (own[:, None] == own[None, :])
    found = [(i, j) for a, b in simhash.near_pairs(values, bits, prefix) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
    assert sorted(found) == list(map(tuple, np.argwhere(np.triu(near, 1)).tolist()))


@pytest.mark.parametrize("level", range(1, 9))
def test_copies_of_a_level_are_undone(level):
    values = np.random.default_rng(level).integers(0, 1 << 63, 50, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    path = int(np.random.default_rng(level).integers(0, 4**level))
    moved = values
    for step in range(1, level + 1):
        moved = simhash._moved(moved, *simhash._sizes(step, 3), path // 4 ** (level - step) % 4)
    assert simhash._original(moved, path, level, 3).tolist() == values.tolist()


def test_keep_one_of_repeated_rows(spark):
    rows = [(None, "a b c"), (3, "a b c"), (3, "a b c"), (None, None), (None, ""), (4, "other words than these")]
    kept = simhash.keep_one(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _print string")).collect()
    assert sorted(map(str, (r["doc_id"] for r in kept))) == ["3", "4", "None"]


def test_keep_one_of_different_repeated_texts(spark):
    one, two, three = "a b c", "words of another kind stand here", "and a third text that is unlike both"
    rows = [(i, t, n) for i in (3, None) for t in (f"{one} {i}", f"{two} {i}") for n in ("y", "x")] + [(5, three, "x")] * 2
    found = simhash.groups(spark.createDataFrame(rows, "doc_id long, text string, note string"))
    assert found.select("_print").distinct().count() == 5
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, note string")).collect()
    want = [(i, t, "x") for i in (3, None) for t in (f"{one} {i}", f"{two} {i}")] + [(5, three, "x")]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, want))


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)] + [(500, i) for i in range(501, 560)]
    expected = roots(600, edges)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: expected[i] for a, b in edges if a != b for i in (a, b)}


def test_minhash_rows_and_classes(spark):
    docs = table_of(spark, SF, "documents")
    rows = docs.select("doc_id", "text").orderBy("doc_id", ascending=False).collect()
    found = minhash.report(docs).toPandas().set_index("doc_id")
    texts, ids = [r["text"] for r in rows], [r["doc_id"] for r in rows]
    sets = [frozenset(s.tolist()) for s in minhash._sets(texts)]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] & sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    group = roots(len(ids), pairs)
    errors = []
    for i, (own, text) in enumerate(zip(ids, texts, strict=True)):
        cut, following = len(text) // 3, texts[(i + 1) % len(texts)]
        edited = text[: len(text) - cut] + following[:cut]
        row = found.loc[own]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert row["class_id"] == min(ids[j] for j in range(len(ids)) if group[j] == group[i])
        other = frozenset(next(minhash._sets([edited])).tolist())
        errors.append(abs(row["near_edited"] - len(sets[i] & other) / len(sets[i] | other)))
    assert np.mean(errors) < 0.06


def test_minhash_dissimilar_members_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = np.random.default_rng(1)
    base, texts = rng.integers(0, 5000, 200), []
    for _ in range(60):
        words = base.copy()
        words[rng.integers(0, 200, rng.integers(0, 8))] = rng.integers(0, 5000)
        texts.append(" ".join(f"w{w}" for w in words))
    sets = list(minhash._sets(texts))
    group = roots(60, [(a, b) for a in range(60) for b in range(a) if minhash.jaccard(sets[a], sets[b]) >= 0.8])
    found = minhash.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "class_id").collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == {i: min(j for j in range(60) if group[j] == group[i]) for i in range(60)}


def families(n, rng):
    """Texts of which many are about as alike as the threshold asks."""
    base = rng.integers(0, 5000, 200)
    texts = []
    for _ in range(n):
        words = base.copy()
        words[rng.integers(0, 200, rng.integers(0, 8))] = rng.integers(0, 5000)
        texts.append(" ".join(f"w{w}" for w in words))
    return texts


def test_minhash_keeps_little_on_disk(spark, monkeypatch):
    """Bands are shuffled once, and neither the texts nor the signatures of all documents are written aside."""
    written, real = [], minhash.checkpointed

    def told(df):
        plan = io.StringIO()
        with contextlib.redirect_stdout(plan):
            df.explain()
        out = real(df)
        written.append((out.columns, out.count(), plan.getvalue().count("Exchange hashpartitioning(band")))
        return out

    monkeypatch.setattr(minhash, "checkpointed", told)
    texts = families(40, np.random.default_rng(1)) + random_texts(400)
    minhash.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [shuffles for columns, _, shuffles in written if columns == ["band", "rep", "key"]] == [1]
    assert not any("t" in columns for columns, _, _ in written)
    members = [n for columns, n, _ in written if columns == ["band", "key", "class"]][-1]
    assert [n <= members for columns, n, _ in written if "sig" in columns] == [True]


def test_minhash_many_texts_go_through_a_bitmap(spark, monkeypatch):
    rng = np.random.default_rng(2)
    texts = families(40, rng) + random_texts(50) + ["", "   ", None, "two words"]
    rows = [(i if i % 7 else None, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + rows[::3] + [(1000 + i, t) for i, t in enumerate(texts[::2])], "doc_id long, text string")
    found = lambda: Counter(map(str, minhash.classes(docs).collect()))
    want = found()
    assert len(want) > 10
    monkeypatch.setattr(minhash, "SENT_ROWS", 0)
    for bits in (64, 1 << 12):
        monkeypatch.setattr(minhash, "FILTER_BITS", bits)
        assert found() == want


@pytest.mark.parametrize("band", [0, 3, 12])
def test_minhash_texts_left_out_of_a_cell_have_no_links(band):
    rng = np.random.default_rng(3)
    texts = [t for _ in range(4) for t in families(25, rng)]
    keys = rng.permutation(len(texts)).astype(np.int64)
    kinds, sides = keys // 3, keys % 2
    sigs = minhash.signatures(utf8(pa.array(texts)))
    sets = list(minhash._sets(texts))
    for alone in (True, False):
        met = np.flatnonzero(minhash._meeting(keys, kinds, sigs, sides, alone, band, minhash.NEAR))
        whole = minhash._forest(keys, kinds, sigs, sets, sides, alone, band, 0.8, minhash.NEAR)
        part = minhash._forest(keys[met], kinds[met], sigs[met], [sets[i] for i in met], sides[met], alone, band, 0.8, minhash.NEAR)
        assert whole == part and (whole or band)


# ---- lines, conversations, personal data


def test_templates_with_fields(spark):
    names = "bob alice carl dora emil".split()
    rows = [(i, f"Login of user {n} from the server at night\nunique {n} words here only once {i}x\n\nsame line") for i, n in enumerate(names)]
    rows += [(None, "same line"), (9, "same line\nsame line")]
    found = {r["doc_id"]: (r["n_dropped"], r["text"]) for r in line_templates.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[0] == (0, rows[0][1]) and found[9] == (2, "") and found[None] == (1, "")
    assert found[3] == (2, "unique dora words here only once 3x\n")


def test_common_prefix(spark):
    turn = lambda r, t: {"role": r, "text": t}
    head = [turn("user", "q"), turn("assistant", "a")]
    rows = [(1, [*head, turn("user", "x")], [*head, turn("user", "y")]), (2, head, head), (3, head, head[:1]), (4, head, [])]
    pairs = spark.createDataFrame(rows, "pair_id long, chosen array<struct<role: string, text: string>>, rejected array<struct<role: string, text: string>>")
    found = {r["pair_id"]: r for r in preferences.format_pairs(pairs).collect()}
    assert [(found[i]["n_common"], found[i]["status"]) for i in (1, 2, 3, 4)] == [(2, "pair"), (2, "same"), (1, "prefix"), (0, "prefix")]
    assert found[1]["prompt"] == "<|user|>\nq<|end|>\n<|assistant|>\na<|end|>\n"
    assert found[3]["chosen"] == "<|assistant|>\na<|end|>\n" and found[3]["chosen_mask"] == "m14,t9" and found[3]["rejected"] == ""


def plain_spans(text):
    spans = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        spans += [("card", *m.span())] * (14 <= len(digits) <= 19 and pii.luhn(digits))
    spans += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(spans, key=lambda s: (s[1], pii.KINDS.index(s[0]), s[2]))


def test_patterns(texts):
    rng = random.Random(3)
    for text in texts + ["".join(rng.choices("0123@a.+- ()%b", k=rng.randint(0, 50))) for _ in range(5000)]:
        assert pii.base_spans(text) == plain_spans(text), text


def test_patterns_on_long_runs():
    for text in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "+1 " * 60_000, "a@" * 100_000):
        pii.base_spans(text)


def test_gradient():
    model, rng = pii.Tagger(hidden=3, width=2), np.random.default_rng(0)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x, y = rng.integers(0, pii.SYMBOLS, (3, 6)), rng.integers(0, pii.LABELS, (3, 6))
    grads = model.gradient(x, y)[1]
    for name, weight in model.weights.items():
        at = (int(x[0, 0]), 0) if name == "symbols" else tuple(int(rng.integers(0, s)) for s in weight.shape)
        kept, losses = weight[at], []
        for step in (1e-3, -1e-3):
            weight[at] = kept + step
            losses.append(model.gradient(x, y)[0])
        weight[at] = kept
        assert abs((losses[0] - losses[1]) / 2e-3 - grads[name][at]) < 1e-3, name


def test_held_out_labels(spark):
    texts = [r["text"] for r in table_of(spark, "/root/testdata/sf0.1", "documents").where("text rlike '[0-9@]'").orderBy("doc_id").limit(500).collect()]
    model = pii.Tagger()
    model.fit(*pii.training_windows(texts[:350]))
    x, y = pii.training_windows(texts[350:], seed=5)
    found = model.decode(x)
    assert (found == y).mean() > 0.98 and (found == y)[y > 0].mean() > 0.9
    said = ["call (212) 555-0101 now or write", "the year 1999 and version 2.0.1 cost 12,345.67", "no digits"]
    added = pii.added_spans(said, [pii.base_spans(t) for t in said], model)
    assert added[0] == [("phone", 5, 19)] and added[1:] == [[], []]


def test_redaction():
    text = "mail a.b@c.de or +1 (555) 555-0100, ip 10.0.0.1."
    assert pii.redacted(text, pii.base_spans(text)) == "mail [EMAIL] or [PHONE], ip [IP]."
    assert pii.redacted("abcdef", [("email", 1, 4), ("ip", 2, 5)]) == "a[EMAIL]f"


def test_windows_cover_a_run():
    for length in (1, 63, 64, 65, 500):
        at = pii.windows(7, 7 + length)
        seen = set().union(*(range(a, min(a + pii.WINDOW, 7 + length)) for a in at))
        assert seen == set(range(7, 7 + length))


def test_long_addresses_are_whole(spark):
    class Near:
        def decode(self, x):
            return np.where(pii._ADDRESS[x] | (x == pii._CODES[64]), 2, 0)

    long = ["christopherbartholomew.featherstonehaugh@" + "department" * 3, "x" * 300 + "@" + "y" * 300]
    for piece in long:
        text = f"{'words, ' * 30}{piece}, {'words, ' * 30}"
        assert pii.added_spans([text], [[]], Near()) == [[("email", 210, 210 + len(piece))]]

    texts = [r["text"] for r in table_of(spark, "/root/testdata/sf0.1", "documents").where("text rlike '[0-9@]'").orderBy("doc_id").limit(350).collect()]
    model = pii.Tagger()
    model.fit(*pii.training_windows(texts))
    for piece in ["christopher.featherstonehaugh @ mail.department.example.com", "bartholomew.montgomery.wellington @ archive.universities.example.com", "maximiliana.constantinopolis.17@internationaldepartments"]:
        text = f"please write to {piece} before the end of the week"
        assert pii.added_spans([text], [pii.base_spans(text)], model) == [[("email", 16, 16 + len(piece))]]


def test_spans_are_whole_across_windows():
    class Digits:
        def decode(self, x):
            inside = (x >= pii._CODES[48]) & (x <= pii._CODES[57])
            before = np.pad(inside[:, :-1], ((0, 0), (1, 0)))
            return np.where(inside, np.where(before, 8, 7), 0)

    text = "x " * 30 + "1" * 150 + " y" * 30 + "22"
    assert pii.model_spans([text], Digits()) == [[("phone", 60, 210), ("phone", 270, 272)]]


