"""A training-data pipeline: documents in, packed sequences out, one operator of `tickloom.llm` a stage.

Each stage works on all that its predecessor kept, is written as Parquet to the shared folder and read again, so a lost
executor repeats one stage at most.

Defined results: a null text is empty; the quality rules reject it, as any text of fewer than 50 words. Texts are worked on
whole, whatever their length. Rows that repeat an id and its text are decided alike by the first two stages; of them, as of
all linked rows, the near-copy stage keeps one, that of the smallest id (nulls last). A null id is an id of its own. All
stages but the last keep the columns of their input, whatever their names, and change none but `text` and `n_chars`. A
table without rows gives none at each stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import line_templates, packing, pii, repetition, simhash
from tickloom.llm.common import shared_folder
from tickloom.llm.queries import TOKENIZER


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return repetition.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates."""
    out = line_templates.dedup(docs, counted=False).withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.keep_one(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    out = pii.redact(docs, pii.train(docs)).withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their sequence and the place there."""
    return packing.pack(docs, TOKENIZER, with_ids=True)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("simhash_near_dedup", near_copies), ("pii", private), ("packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
    return docs
