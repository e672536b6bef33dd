"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. Nulls,
empty and very long texts, repeated rows, empty tables and further columns are treated as
the stage's operator says; further columns pass through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerwide.llm import bpe, decontaminate, near_dedup, quality, secret_scan
from ledgerwide.llm.tables import documents, stored

VOCABULARY = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their group's thresholds reject go."""
    return quality.accepted(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates stays: five words, 0.8."""
    return near_dedup.keep_one(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.without_leaks(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; every document stays."""
    return secret_scan.redacted(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) and the digests of ids and decoded text."""
    encoded = bpe.encode(spark, docs, public_tokenizers.path(VOCABULARY))
    return bpe.digests(encoded, "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("token_ids", token_ids),
]

#: SQL has no way to express alignment, merges of a vocabulary or MinHash; tests/llm compares
#: the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
