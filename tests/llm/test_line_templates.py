"""Line templates against a plain version on made lines, the recall of planted templates, and SQL on the same rows."""

import random
import re
from collections import defaultdict

import duckdb
import pandas as pd
import pytest

from tickloom.llm import line_templates as lt

SCHEMA = "doc_id long, text string"


def plain_dedup(rows):
    """{id: text without dropped lines} of rows with different ids, by comparing whole lines in memory."""
    tokens_of = lambda raw: tuple(lt.FIELD if re.search("[0-9]", t) else t for t in re.findall(r"[^\x20\x09-\x0D]+", raw))
    lines = {i: [tokens_of(raw) for raw in (text or "").split("\n")] for i, text in rows}
    docs = defaultdict(set)
    for i, own in lines.items():
        for line in own:
            docs[line].add(i)
    leaves = defaultdict(list)
    for line in docs:
        if line:
            leaves[len(line), line[: lt.LEADING]].append(line)
    of_line = defaultdict(set)
    for (size, _), own in leaves.items():
        columns = [[line[p] for line in own] for p in range(size)]
        everywhere = {p for p in range(size) if len(set(columns[p])) >= lt.MIN_VALUES}
        for line in own:
            ways = [everywhere, {p for p in range(size) if columns[p].count(line[p]) < lt.MIN_VALUES}]
            for p in range(lt.LEADING, size):
                if sum(o[:p] == line[:p] and o[p + 1 :] == line[p + 1 :] for o in own) >= lt.MIN_VALUES:
                    ways.append({p})
            for fields in ways if len(own) >= lt.MIN_VALUES else []:
                template = tuple(lt.FIELD if p in fields else t for p, t in enumerate(line))
                constants = sum(t != lt.FIELD for t in template[lt.LEADING :])
                if fields and constants >= 2 and 2 * constants >= size - lt.LEADING:
                    of_line[line].add(template)
    having = defaultdict(set)
    for line, templates in of_line.items():
        for template in templates:
            having[template] |= docs[line]
    first = {}
    for line, own in docs.items():
        firsts = [min(having[t]) for t in of_line[line] if len(having[t]) >= lt.MIN_DOCS]
        if firsts or len(own) >= lt.MIN_DOCS and any(t.replace(lt.FIELD, "") for t in line):
            first[line] = min([*firsts, *([] if firsts else [min(own)])])
    left = {}
    for i, text in rows:
        raw = (text or "").split("\n")
        keep = [r for r, line in zip(raw, lines[i], strict=True) if not line or first.get(line, i) == i]
        left[i] = text if len(keep) == len(raw) else "\n".join(keep)
    return left


def found(spark, rows):
    return {r["doc_id"]: r["text"] for r in lt.dedup(spark.createDataFrame(rows, SCHEMA)).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_plain_version_and_sql(spark, seed):
    """Crowded leaves of few and many different tokens, digits, odd white space, blank lines, repeats inside a text."""
    rng = random.Random(seed)
    words = ["of", "a", "b", "c", "x1", "İ", "<*>", "née"] + [f"w{chr(97 + i)}" for i in range(6 * seed)]

    def line():
        own = ["go", "to", rng.choice("st")] + rng.choices(words, k=rng.randint(0, 6))
        return "".join(w + rng.choice([" ", " ", " ", "  ", "\t", " \x0b"]) for w in own) if rng.random() < 0.95 else rng.choice(["", "  ", "7", "go to", "\t9 go"])

    rows = [(i, "\n".join(line() for _ in range(rng.randint(0, 12)))) for i in range(120)] + [(500, None), (501, ""), (502, "\n"), (503, "go to s of a b c\n" * 3)]
    got = found(spark, rows)
    assert got == plain_dedup(rows)
    documents = pd.DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841
    want = {i: (n, None if pd.isna(t) else t) for i, n, t in duckdb.sql(lt.oracle()).df()[["doc_id", "n_dropped", "text"]].itertuples(index=False)}
    assert {r["doc_id"]: (r["n_dropped"], r["text"]) for r in lt.report(spark.createDataFrame(rows, SCHEMA)).collect()} == want


@pytest.mark.parametrize("others", [0, 3, 400])
def test_unlike_lines_hide_no_template(spark, others):
    rng = random.Random(others)
    rows = [(i, f"Login of user {name} from the server at night") for i, name in enumerate("bob alice carl dora emil".split())]
    rows += [(100 + i, "Login of user " + " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(6))) for i in range(others)]
    got = found(spark, rows)
    assert got[0] == rows[0][1] and all(got[i] == "" for i in (1, 2, 3, 4))
    assert all(got[i] == text for i, text in rows[5:])


def test_recall_of_planted_templates(spark):
    """Templates of one to three fields, in leaves crowded by other lines of a small vocabulary; clean lines stay."""
    rng = random.Random(8)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrst"]
    names = [f"{a}{b}{c}{a}" for a in "pqvwz" for b in "aeiou" for c in "bdfgklmn"]
    rows, planted, clean = [], set(), set()
    for k in range(60):
        head, free = ["the", "log", "says"], rng.choices(vocabulary, k=rng.randint(6, 9))
        fields = rng.sample(range(len(free)), rng.randint(1, 3))
        for copy in range(6):
            own = [rng.choice(names) if p in fields else t for p, t in enumerate(free)]
            rows.append((len(rows), " ".join(head + own)))
            if copy:
                planted.add(rows[-1][0])
    for _ in range(600):
        clean.add(len(rows))
        rows.append((len(rows), " ".join(["the", "log", "says"] + rng.choices(vocabulary, k=rng.randint(6, 9)))))
    got = found(spark, rows)
    assert sum(got[i] == "" for i in planted) >= 0.9 * len(planted)
    assert sum(got[i] != "" for i in clean) >= 0.98 * len(clean)


def test_awkward_tables(spark):
    assert found(spark, []) == {}
    # Rows that repeat an id and its text are one document; a null id comes after all others.
    rows = [(7, "one same line here"), (7, "one same line here"), (None, "one same line here"), (9, "one same line here"), (None, None)]
    got = sorted(map(str, ((r["doc_id"], r["n_dropped"], r["text"]) for r in lt.dedup(spark.createDataFrame(rows, SCHEMA)).collect())))
    assert got == sorted(map(str, [(7, 0, rows[0][1]), (7, 0, rows[0][1]), (None, 1, ""), (9, 1, ""), (None, 0, None)]))
    # One very long line, and a text of very many lines.
    long = " ".join(["word"] * 20_000)
    many = "\n".join(f"line of some own words {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(5_000))
    rows = [(1, long), (2, many), (3, f"{long}\nshort"), (4, long)]
    got = found(spark, rows)
    assert got[1] == long and got[3] == "short" and got[4] == "" and got[2] == many
