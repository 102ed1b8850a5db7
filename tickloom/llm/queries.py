"""The registered queries of the pipeline operators, over whole tables and with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import bpe, hostrank, licenses, line_templates, manifest, minhash, packing, page_text, pii, preferences, repetition, simhash, whitening
from tickloom.llm.common import table_of

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.report(table_of(spark, sf_dir, "documents"))


def op2_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.report(table_of(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table_of(spark, sf_dir, "documents"), TOKENIZER)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.report(table_of(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table_of(spark, sf_dir, "documents"))


def op6_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.report(table_of(spark, sf_dir, "conversations"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table_of(spark, sf_dir, "documents"))


def op8_hostrank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostrank.report(table_of(spark, sf_dir, "pages"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table_of(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(table_of(spark, sf_dir, "documents"), TOKENIZER)


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.report(table_of(spark, sf_dir, "documents"))


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.report(table_of(spark, sf_dir, "pages"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table_of(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_line_templates, op2_repetition, op3_packing, op4_minhash, op5_licenses,
        op6_preferences, op7_simhash, op8_hostrank, op9_pii, op10_bpe, op11_manifest, op12_page_text, op13_whitening,
    )
}

#: The others are tested against brute force, an exact round trip or held-out labels.
SQL: dict[str, str] = {
    "op1_line_templates": line_templates.oracle(),
    "op2_repetition": repetition.oracle(),
    "op5_licenses": licenses.oracle(),
    "op6_preferences": preferences.oracle(),
    "op8_hostrank": hostrank.oracle(),
    "op11_manifest": manifest.oracle(),
}
