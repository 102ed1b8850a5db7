"""The pipeline's stages one after another against plain versions on a small table."""

import corpus_pipeline as pipeline
from tickloom.llm import pii, repetition, simhash
from tickloom.llm.common import table_of

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = table_of(spark, SF, "documents")
    columns = docs.columns
    before = {r["doc_id"]: r for r in docs.collect()}
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        rows = docs.collect()
        if name == "packing":
            assert {r["doc_id"] for r in rows} == set(before)
            assert all(len(r["ids"]) == r["length"] for r in rows)
            break
        assert docs.columns == columns
        now = {r["doc_id"]: r for r in rows}
        assert len(now) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in rows)
        if name == "quality_rules":
            kept = {r["doc_id"] for r in repetition.judge(table_of(spark, SF, "documents")).where("kept").collect()}
            assert set(now) == kept and all(now[i] == before[i] for i in now)
        elif name == "line_dedup":
            assert set(now) == set(before)
            for i, row in now.items():
                left = iter(before[i]["text"].split("\n"))
                assert row["text"] == "" or all(line in left for line in row["text"].split("\n"))
        elif name == "simhash_near_dedup":
            groups = spark.createDataFrame([(i, r["text"]) for i, r in before.items()], "doc_id long, text string")
            assert set(now) == {r["component_id"] for r in simhash.report(groups).collect()}
        elif name == "pii":
            assert set(now) == set(before) and not any(pii.base_spans(r["text"]) for r in rows)
        before = now


def test_run(spark):
    assert pipeline.run(spark, SF).count() > 0
    assert pipeline.ORACLE_SQL is None
