"""Manifest, whitening and page extraction against plain versions and on awkward tables."""

import hashlib
import html as entities
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from tokenizers import Tokenizer

from tickloom.llm import bpe, hostrank, licenses, line_templates, manifest, minhash, packing, page_text, repetition, simhash, whitening
from tickloom.llm.common import SpanHash, table_of
from tickloom.llm.queries import TOKENIZER

SF = "/root/testdata/sf0.001"


# ---- manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    """The contract word by word, over (doc_id, source, lang, n_chars, text) rows with distinct ids."""

    def leaf(row, text):
        return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))

    def fold(nodes):
        """The last node, and of each start node the (left, right) digests level by level."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
            for k, place in enumerate(at):
                run, own = runs[place // 16], place % 16
                paths[k].append((run[:own], run[own + 1 :]))
                at[k] = place // 16
            nodes = [H(*run) for run in runs]
        return nodes[0], paths

    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: r[0])
        trees[s] = own, *fold([leaf(r, r[4]) for r in own])
    root, heads = fold([trees[s][1] for s in sources])
    out = {}
    for k, s in enumerate(sources):
        own, subroot, paths = trees[s]
        for row, path in zip(own, paths, strict=True):
            path = path + heads[k]
            lowered = zlib.crc32(str(row[0]).encode()) % 5 == 0
            text = "".join(c.lower() if c.isascii() else c for c in row[4]) if lowered and row[4] is not None else row[4]
            folded = leaf(row, text)
            for left, right in path:
                folded = H(*left, folded, *right)
            proof = H(*(d for left, right in path for d in (*left, *right)))
            out[row[0]] = (leaf(row, row[4]), subroot, root, proof, folded, folded == root)
    return out


COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def documents(sizes, start=0):
    rng, rows = random.Random(7), []
    for source, n in sizes:
        for _ in range(n):
            text = rng.choice([None, "", "Größe", "plain low", f"Text {len(rows)}"])
            rows.append((start + len(rows), source, rng.choice(["en", None]), rng.choice([None, len(rows)]), text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [[(None, 2), ("", 1)], [("a", 16), ("b", 17), (None, 256), ("c", 1)], [("hot", 273), *((f"s{i}", 1 + i % 3) for i in range(40))]])
def test_manifest(spark, sizes):
    rows = documents(sizes, start=-3)
    want = plain_manifest(rows)
    got = {r["doc_id"]: tuple(r)[1:] for r in manifest.report(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert got == want
    assert {v[-1] for v in got.values()} <= {True, False} and sum(not v[-1] for v in got.values()) == sum(
        zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None and any(c.isupper() and c.isascii() for c in r[4]) for r in rows
    )


def test_manifest_awkward(spark):
    rows = [(1, "a", "en", 1, "X" * 100_000, "q", 1), (None, None, None, None, None, "q", 1), (None, "a", None, None, "T", "q", 1), (2, "a", "en", 3, "dup", "q", 1), (2, "a", "en", 3, "dup", "q", 1)]
    docs = spark.createDataFrame(rows, COLUMNS + ", tree string, lo int")
    got = manifest.report(docs).collect()
    assert len(got) == 5 and len({r["root"] for r in got}) == 1
    assert len({r["folded_root"] for r in got if r["verified"]}) == 1
    two = [r for r in got if r["doc_id"] == 2]
    assert two[0]["leaf"] == two[1]["leaf"] and two[0]["verified"] == two[1]["verified"]
    single = manifest.report(spark.createDataFrame(rows[:1], docs.schema)).first()
    assert single["leaf"] == single["subroot"] == single["root"] and single["proof_sha256"] == hashlib.sha256(b"").hexdigest()
    assert manifest.report(docs.where("doc_id = 99")).count() == 0


# ---- whitening


def plain_whitening(vectors):
    """Exact covariance in fractions, eigenvectors by eigh."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    cov = [[sum((Fraction(n * r[i] - sums[i], n)) * Fraction(n * r[j] - sums[j], n) for r in x) / n for j in range(d)] for i in range(d)]
    values, axes = np.linalg.eigh(np.array([[float(v) for v in row] for row in cov]))
    values, axes = values[::-1], axes[:, ::-1]
    centred = np.array([[float(Fraction(n * r[i] - sums[i], n)) for i in range(d)] for r in x])
    deviation = [sum((n * r[i] - sums[i]) ** 2 for i in range(d)) for r in x]
    return n, deviation, centred @ axes / np.sqrt(values), values / values.sum()


def rows_by_component(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["vec_id"], {})[r["component"]] = r
    return out


@pytest.mark.parametrize("dimension,count", [(3, 40), (12, 90)])
def test_whitening(spark, dimension, count):
    rng = np.random.default_rng(dimension)
    vectors = (rng.normal(size=(count, dimension)) @ rng.normal(size=(dimension, dimension))).astype(np.float32).tolist()
    n, deviation, whitened, explained = plain_whitening(vectors)
    got = rows_by_component(whitening.report(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")))
    k = min(8, dimension)
    signs = [1 if got[0][c + 1]["whitened"] * whitened[0, c] > 0 else -1 for c in range(k)]
    for i in range(count):
        assert sorted(got[i]) == list(range(1, k + 1))
        for c in range(k):
            r = got[i][c + 1]
            assert r["n"] == n and r["deviation"] == deviation[i] and r["identity_error"] < 1e-8
            assert r["whitened"] == pytest.approx(signs[c] * whitened[i, c], rel=1e-7, abs=1e-8)
            assert r["explained"] == pytest.approx(explained[c], rel=1e-9)


def test_covariance_is_exact():
    rng = np.random.default_rng(3)
    u = rng.integers(-50, 1 << 30, (20, 4))
    sums = [int(s) for s in u.sum(0)]
    mean = np.array([s // 20 for s in sums])
    got = whitening.covariance(20, [s % 20 for s in sums], whitening._squares(u - mean))
    want = [[float(sum(Fraction(20 * int(r[i]) - sums[i], 20) * Fraction(20 * int(r[j]) - sums[j], 20) for r in u) / 20) for j in range(4)] for i in range(4)]
    assert np.allclose(got, want, rtol=1e-15)


def test_whitening_of_the_table(spark):
    table = table_of(spark, SF, "embeddings")
    got = whitening.report(table)
    n = table.count()
    assert got.count() == 8 * n
    first = got.select("n", "identity_error").distinct().collect()
    assert [(r["n"], r["identity_error"] < 1e-6) for r in first] == [(n, True)]


def test_whitening_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.0, 1.0]), (2, [1.0, 0.5]), (2, [1.0, 0.5]), (None, [0.25, -0.75]), (5, None), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, []), (10, [1.0]), (11, [1e300, -1e300])]
    schema = "vec_id int, embedding array<double>, component string, n string, whitened string"
    table = spark.createDataFrame([(*r, "c", "n", "w") for r in rows], schema)
    got = rows_by_component(whitening.report(table))
    assert set(got) == {1, 2, None, 11} and all(r["n"] == 5 for g in got.values() for r in g.values())
    assert got[11][1]["deviation"] is None
    flat = whitening.report(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3)], "vec_id long, embedding array<double>")).collect()
    assert len(flat) == 6 and all(r["whitened"] is None and r["deviation"] == 0 and r["explained"] == 0 and r["identity_error"] == 0 for r in flat)
    assert whitening.report(table.where("vec_id = 5")).count() == 0 and whitening.report(table.where("vec_id = 99")).count() == 0


# ---- page text


def article_of(html):
    """The article of the test tables' pages, whose only blocks are headings and paragraphs."""
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_page_text_of_the_table(spark, scale):
    pages = table_of(spark, f"/root/testdata/{scale}", "pages")
    want = sorted((r["page_id"], r["url"], article_of(r["html"])) for r in pages.collect())
    got = sorted((r["page_id"], r["url"], r["text"]) for r in page_text.report(pages).collect())
    assert got == want
    assert page_text.report(pages).where("n_chars <> char_length(text)").count() == 0


@pytest.mark.parametrize("html,text", [
    ("<p>One  two\n three<p>Four &amp; five&lt;b&gt; &copy 6<div>Seven<br>eight</div> nine", "One two three\nFour & five<b> © 6\nSeven eight\nnine"),
    ("<nav>menu</nav><main><h1>T</h1><p>x<aside>side</aside>y</p></main><p>below</p>", "T\nx\ny"),
    ("<header>top</header><article><header><h1>Title</h1></header><p>a <b>bold</b>ly</p><form>name</form><footer>by</footer></article><div class='comments'><article>me too</article></div>", "Title\na boldly"),
    ("<div class='cookie-notice'>ok?</div><div id=siteFooter>f</div><div role=navigation>n</div><p hidden>h</p><div class='has-sidebar'><p>kept</p></div>", "kept"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><script>var t='</p>'</script><style>p{}</style>end</article>", "one\ntwo\na\nb\nend"),
    ("<article><p>1 < 2 <!-- no > --> and <a href='x>y'>link</a></p><!doctype x></article><p>rest</p>", "1 < 2 and link"),
    ("<article><article class='comment'>no</article><section><p class='ad'>no</p>yes<span class=advert>no</span></section>", "yes"),
    ("", ""), ("plain text", "plain text"), ("<p>open <b", "open"), ("a<script>never closed", "a"), ("<", "<"), ("</b></p></>x", "x"), ("<article></article>", ""),
    ("<div><article>one</article><article>two</article></div>", "one\ntwo"), ("a  b&nbsp;c&#x20;d", "a b c d"), ("<p>&am<p>&amp", "&am\n&"),
])
def test_parse(html, text):
    page = page_text.parse(html)
    inner = [o for o in page.open if o[3]] or page.open
    assert "\n".join(page.article or [o[0] for o in inner]) == text


def test_parse_of_long_pages():
    for html in ("<p>word " * 30_000, "<b>" * 30_000 + "<p>x" * 30_000, "<div>" * 30_000 + "</i>" * 30_000, "<a " * 30_000, "<" * 100_000, "&amp" * 100_000, "<!--" * 50_000):
        page_text.parse(html)


def plain_repeats(streams, groups, several, least):
    windows = {}
    for k, s in enumerate(streams):
        for i in range(len(s) - least + 1):
            windows.setdefault((groups[k], tuple(s[i : i + least])), set()).update([k, -1 - k] if several[k] else [k])
    return [[i for i in range(len(s) - least + 1) if len(windows[groups[k], tuple(s[i : i + least])]) > 1] for k, s in enumerate(streams)]


def test_repeats():
    rng = random.Random(5)
    for round_ in range(150):
        least = rng.choice([1, 2, 4, 8])
        streams = [[rng.randint(0, 2) for _ in range(rng.randint(0, 30))] for _ in range(rng.randint(1, 6))]
        groups, several = [rng.randint(0, 1) for _ in streams], [rng.random() < 0.1 for _ in streams]
        got = page_text.repeats([np.array(s, "<u4") for s in streams], np.array(groups), np.array(several), least)
        assert [g.tolist() for g in got] == plain_repeats(streams, groups, several, least)
        for g in got:
            places = {i for a, b in page_text.spans_of(g, least) for i in range(a, b)}
            assert places == {i + j for i in g.tolist() for j in range(least)}


def unmarked_pages():
    """Pages without a marked article: a template and a rotating teaser around text of their own."""
    rng, rows, want = random.Random(2), [], {}
    words = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    for host, count in (("a.org", 40), ("b.org", 9), ("c.org", 1)):
        top = f"Welcome to {host} where all the news of the day is free"
        teasers = [words(12) for _ in range(4)]
        for i in range(count):
            own = [words(rng.randint(1, 30)) for _ in range(3)]
            body = f"<div>{top}</div><p>{own[0]}</p><p>{own[1]}<p>{own[2]}</p><div class=x1>{teasers[i % 4]}</div>"
            rows.append((len(rows), f"http://{host.upper() if i % 2 else host}/{i}", f"<html><body>{body}</body></html>"))
            want[len(rows) - 1] = "\n".join(([top] if count == 1 else []) + own + ([teasers[i % 4]] if count == 1 else []))
    return rows, want


@pytest.mark.parametrize("bucket", [60, 1 << 20])
def test_boilerplate_goes_and_unique_runs_stay(spark, bucket):
    rows, want = unmarked_pages()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in page_text.report(pages, bucket=bucket).collect()} == want


def test_page_text_awkward(spark):
    page = "<div>the same words on all of these pages here</div><p>own {}</p>"
    rows = [(1, "http://x.org/a", page.format("one")), (1, "http://x.org/a", page.format("one")), (2, "http://X.ORG/b", page.format("two")), (None, None, None), (3, None, "<p>alone"), (4, "no scheme", ""), (5, "http://y.org", "<p>copy of a whole page of ten words and more</p>"), (6, "http://y.org/2", "<p>copy of a whole page of ten words and more</p>")]
    table = spark.createDataFrame([(*r, "h", "t", 1) for r in rows], "page_id long, url string, html string, host string, text string, stream_key int")
    got = sorted(((r["page_id"], r["text"]) for r in page_text.report(table).collect()), key=str)
    copy = "copy of a whole page of ten words and more"
    assert got == sorted([(1, "own one"), (1, "own one"), (2, "own two"), (None, ""), (3, "alone"), (4, ""), (5, copy), (6, copy)], key=str)
    assert page_text.report(table.where("page_id = 99")).count() == 0


# ---- hashes of spans, and token ids beyond Latin


def thue_morse(n):
    return [bin(i).count("1") & 1 for i in range(n)]


def test_span_hashes():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 3, 5000).astype(np.uint8)
    start = rng.integers(0, 4900, 4000)
    end = start + rng.integers(0, 12, 4000)
    seen = {}
    for a, b, h in zip(start.tolist(), end.tolist(), SpanHash(data).of(start, end).tolist(), strict=True):
        seen.setdefault(h, set()).add(data[a:b].tobytes())
    assert all(len(v) == 1 for v in seen.values()) and len(seen) == len({data[a:b].tobytes() for a, b in zip(start, end, strict=True)})


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_thue_morse_words(spark, n):
    one = "".join("ab"[b] for b in thue_morse(n))
    two = "".join("ba"[b] for b in thue_morse(n))
    texts = [one, two, f"{one} {two}", f"{one}\n{two}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = {i: hashlib.sha256(" ".join(map(str, tokenizer.encode(t, add_special_tokens=False).ids)).encode()).hexdigest() for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["ids_sha256"] for r in bpe.report(docs, TOKENIZER).collect()} == want
    rows = {r["doc_id"]: r for r in repetition.report(docs).collect()}
    assert all(r["n_dup_lines"] == 0 and r["n_repeat_words"] == 0 for r in rows.values())
    assert len({r["fingerprint"] for r in minhash.report(docs).collect()}) == 4 - 1


def check_ids(spark, texts):
    """ids and decoded text, through both registered queries' operators, against the tokenizers library."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    tokenizer = Tokenizer.from_file(TOKENIZER)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for i, e in enumerate(tokenizer.encode_batch(texts, add_special_tokens=False)):
        want[i] = (len(e.ids), sha(" ".join(map(str, e.ids))), sha(tokenizer.decode(e.ids, skip_special_tokens=False)), e.ids)
    got = {r["doc_id"]: tuple(r)[1:] for r in bpe.report(docs, TOKENIZER).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    bad = [texts[i] for i in got if got[i] != want[i][:3]]
    assert not bad, bad[:20]
    pieces = {}
    for r in packing.pack(docs, TOKENIZER, with_ids=True).collect():
        pieces.setdefault(r["doc_id"], []).append((r["start"], list(r["ids"])))
    assert {i: sum((p for _, p in sorted(v)), []) for i, v in pieces.items()} == {i: w[3] + [2] for i, w in want.items()}


def test_ids_of_letters_before_punctuation(spark):
    letters = [chr(c) for c in range(0xC0, 0x250)]
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    check_ids(spark, [" ".join(f"x{a}{p} {a}{p}{p} {a}{p}y" for p in marks) for a in letters] + ["HAKKARİ.", "SAHİBİ, ve", "İ!", "İ?", "İ", "İİ. İ̇."])


def test_ids_of_random_unicode(spark):
    rng = random.Random(11)
    points = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(chr(rng.choice(points)) for _ in range(rng.randint(1, 12))) for _ in range(30_000)]
    near = [c for c in range(0x250, 0x2000)]
    texts += ["".join(rng.choice(["a", " ", ".", "'s", "É", chr(rng.choice(near)), chr(rng.choice(near))]) for _ in range(8)) for _ in range(70_000)]
    check_ids(spark, texts)


# ---- licenses wrapped over lines, against the SQL; names that clash; host ranks


def test_wrapped_licenses_equal_sql(spark):
    import duckdb
    import pandas as pd

    rng, rows = random.Random(9), []
    for label, sentence in licenses.TEMPLATES.items():
        words = sentence.split()
        for drop in range(4):
            kept = [w for i, w in enumerate(words) if i not in rng.sample(range(len(words)), drop)]
            for _ in range(rng.randint(0, 3)):
                kept.insert(rng.randint(0, len(kept)), rng.choice(["the", "of", "x", "license"]))
            text = "".join(w + rng.choice([" ", "\n", " ", ", "]) for w in kept)
            rows.append((len(rows), f"{'the of to in ' * rng.randint(0, 3)}{text} and {text if drop == 1 else ''} of the"))
    documents = pd.DataFrame([*rows, (900, None), (901, "")], columns=["doc_id", "text"])  # noqa: F841
    want = duckdb.sql(licenses.oracle()).df()
    got = licenses.report(spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")).toPandas()
    plain = lambda d: sorted(map(str, d[sorted(d.columns)].astype(object).where(d.notna(), None).to_numpy().tolist()))
    number = {"first_word": "float", "last_word": "float", "doc_id": "int", "n_words": "int", "n_base": "int"}
    assert plain(got.astype(number)) == plain(want[got.columns].astype(number))
    assert got["labels"].str.contains("mit").any() and (got["score"] < 0.95).any()


def test_helper_names_never_clash(spark):
    """Input columns named like every helper; values and order of columns come back."""
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    own = ["", "ant hill", "brown bear", "cold water stream", "dry"]
    names = ["_id", "_th", "_places", "_lines", "_cuts", "id", "th", "row", "places", "lines", "cuts", "of_id", "of_th", "of_text", "_hash", "_text", "_print", "n_dropped"]
    rows = [(i, f"{text}\n{own[i]}", *[f"{n}{i}" for n in names]) for i in (1, 2, 3, 4)] + [(4, f"{text}\n{own[4]}", *[f"{n}4" for n in names])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    kept = {r["doc_id"]: r for r in line_templates.dedup(docs).collect()}
    assert [kept[i]["text"] for i in (1, 2)] == [f"{text}\n{own[1]}", own[2]] and kept[3]["_id"] == "_id3" and kept[3]["n_dropped"] == 1
    one = simhash.keep_one(docs).collect()
    assert len(one) == len({r["doc_id"] for r in one}) and 1 in {r["doc_id"] for r in one}
    assert all(r[n] == f"{n}{r['doc_id']}" for r in one for n in names) and simhash.keep_one(docs).columns == docs.columns
    pages = spark.createDataFrame([(1, "http://a.org/x", "", "p", "q", "r")], "page_id long, url string, html string, _by_host string, by_host string, found string")
    judged = hostrank.judge(pages).first()
    assert (judged["_by_host"], judged["by_host"], judged["found"], judged["verdict"]) == ("p", "q", "r", "allow")


def converged(edges, seeds, n, damping=0.85, rounds=600):
    out = [{} for _ in range(n)]
    for (a, b), w in edges.items():
        out[a][b] = w
    score = list(seeds)
    for _ in range(rounds):
        new = [(1 - damping) * s for s in seeds]
        for a in range(n):
            total = sum(out[a].values())
            for b, w in out[a].items():
                new[b] += damping * score[a] * w / total
        score = new
    return score


@pytest.mark.parametrize("graph", ["chain", "random"])
def test_host_ranks_converge(spark, graph):
    rng = random.Random(12)
    n = 40 if graph == "random" else 60
    host = lambda i: f"h{i}x{'' if i else ''}.net"
    links = {(i, i + 1) for i in range(n - 1)} if graph == "chain" else {(rng.randrange(n), rng.randrange(n)) for _ in range(110)}
    links = {(a, b) for a, b in links if a != b}
    blocked = {n - 1} if graph == "chain" else {0, 1, 2}
    allowed = set() if graph == "chain" else {3, 4, 5}
    rules = [("block", host(i), "/") for i in blocked] + [("allow", host(i), "/") for i in allowed]
    pages = [(i, f"http://{host(i)}/", "".join(f'<a href="http://{host(b)}/">' for a, b in sorted(links) if a == i)) for i in range(n)]
    got = {r["page_id"]: r["verdict"] for r in hostrank.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), rules).collect()}
    trust = converged({(a, b): 1 for a, b in links}, [1 / len(allowed) if i in allowed else 0 for i in range(n)], n)
    distrust = converged({(b, a): 1 for a, b in links}, [1 / len(blocked) if i in blocked else 0 for i in range(n)], n)
    for i in range(n):
        if abs(distrust[i] - trust[i]) > 1e-3 * (distrust[i] + trust[i]):
            assert got[i] == ("block" if i in blocked or i not in allowed and distrust[i] > trust[i] else "allow"), i
    if graph == "chain":
        assert set(got.values()) == {"block"}
