"""The pipeline operators against their SQL, and all of them on awkward tables."""

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.llm import queries as Q
from tickloom.llm.common import table_of

TABLES = ("documents", "pages", "conversations", "embeddings")


@pytest.mark.parametrize("name", Q.SQL)
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, name, scale):
    folder = f"/root/testdata/{scale}"
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    ours, theirs = Q.QUERIES[name](spark, folder).toPandas(), con.execute(Q.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    plain = lambda v: None if pd.isna(v) else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    rows = lambda d: sorted(([plain(v) for v in r] for r in d[sorted(d.columns)].astype(object).to_numpy().tolist()), key=str)
    assert rows(ours) == rows(theirs)


AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (None, "one two three"), (None, None), (5, "same text here"), (5, "same text here"), (6, "same text here"),
    (7, "a" * 3000), (8, "word " * 5000), (9, "\n" * 500), (10, "x\x00y \x1c z　é́ 😀 <|endoftext|> ΑΣ"), (11, "1 2 3 +1 (555) 555-0100 a.b@c.de 10.0.0.1 4111 1111 1111 1111"),
]
CLASHING = "doc_id long, text string, source string, lang string, n_chars long, kept string, _id int, _th int, _print string, n_words string, part string, ids string, component_id int, spans string, labels string, class_id string"
DOCUMENT_QUERIES = [n for n in Q.QUERIES if n not in ("op6_preferences", "op8_hostrank", "op12_page_text", "op13_whitening")]


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("awkward"))
    rows = [(*r, None if r[0] == 7 else "src", "en", r[0], "k", 1, 2, "p", "n", "q", "i", 4, "s", "l", "c") for r in AWKWARD]
    spark.createDataFrame(rows, CLASHING).write.parquet(f"{folder}/documents.parquet")
    pages = [(1, None, None, "h"), (None, "no scheme", "", "h"), (3, "http://A.ORG/x?y", '<a href="//B.com/">', "h"), (3, "http://A.ORG/x?y", '<a href="//B.com/">', "h"), (4, "://", "x", "h")]
    spark.createDataFrame(pages, "page_id long, url string, html string, host string").write.parquet(f"{folder}/pages.parquet")
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, None, None, "late"), (None, 0, "user", "x"), (2, 0, "user", ""), (2, 0, "user", ""), (0, 0, "assistant", "a" * 5000)]
    spark.createDataFrame([(*t, "p") for t in turns], "conv_id long, turn long, role string, text string, pair_id string").write.parquet(f"{folder}/conversations.parquet")
    spark.createDataFrame([(1, [0.5, 1.0], "w"), (None, [1.0, 0.25], "w"), (2, None, "w")], "vec_id long, embedding array<float>, whitened string").write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.mark.parametrize("name", Q.QUERIES)
def test_awkward_rows(spark, awkward, name):
    rows = Q.QUERIES[name](spark, awkward).collect()
    if name in DOCUMENT_QUERIES and name != "op3_packing":
        ids = [r["doc_id"] for r in rows]
        assert sorted(map(str, ids)) == sorted(str(i) for i, _ in AWKWARD)
    elif name == "op8_hostrank":
        assert [(r["host"], r["path"], r["verdict"]) for r in rows if r["page_id"] == 3] == [("a.org", "/x", "allow")] * 2
    elif name == "op12_page_text":
        assert sorted((str(r["page_id"]), r["text"]) for r in rows) == [("1", ""), ("3", ""), ("3", ""), ("4", "x"), ("None", "")]
    elif name == "op13_whitening":
        assert {r["vec_id"] for r in rows} == {1, None} and len(rows) == 4
    elif name == "op6_preferences":
        assert {r["pair_id"] for r in rows} == {0, 1, 2}


@pytest.mark.parametrize("name", Q.QUERIES)
def test_empty_tables(spark, tmp_path, name):
    for table in TABLES:
        table_of(spark, "/root/testdata/sf0.001", table).where(F.lit(False)).write.parquet(f"{tmp_path}/{table}.parquet")
    assert Q.QUERIES[name](spark, str(tmp_path)).count() == 0
