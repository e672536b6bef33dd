"""Registered queries of the training-data operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerwide.llm import bpe, chat, decontaminate, divergence, html_text, interactions, licences, near_dedup, pii, quality, repeats, secret_scan, token_files
from ledgerwide.llm.sql import SQL  # noqa: F401  (read by the entry module)
from ledgerwide.llm.tables import documents
from ledgerwide.session import scratch_path

VOCABULARY = "word_bpe_49k.json"
END_OF_DOCUMENT = 2


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.digests(pii.find(documents(spark, folder), pii.fitted()))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    return decontaminate.contaminated(spark, documents(spark, folder), benchmark)


def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(bpe.encode(spark, documents(spark, folder), public_tokenizers.path(VOCABULARY)))


def op4_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(documents(spark, folder)))


def op5_chat(spark: SparkSession, folder: str) -> DataFrame:
    talks = spark.read.parquet(f"{folder}/conversations.parquet")
    return chat.format_chats(talks, chat.used_schemas(talks))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.rated(spark, documents(spark, folder))


def op7_html_text(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.extract(spark, spark.read.parquet(f"{folder}/pages.parquet"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op8_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.report(licences.scan(documents(spark, folder)))


def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_path(spark, "token-ids")
    vocabulary = public_tokenizers.path(VOCABULARY)
    manifest = token_files.write_tokens(spark, documents(spark, folder), target, vocabulary, END_OF_DOCUMENT)
    return token_files.digests(token_files.read_tokens(spark, manifest, target))


def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(spark, documents(spark, folder), shingle=3, similarity=0.85).drop("cls")


def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(spark, documents(spark, folder))


def op12_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.without_repeats(spark, documents(spark, folder))


def op13_filter_interactions(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return interactions.interactions(spark, documents(spark, folder), labels)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_decontamination": op2_decontamination,
    "op3_bpe": op3_bpe,
    "op4_secrets": op4_secrets,
    "op5_chat": op5_chat,
    "op6_quality_rules": op6_quality_rules,
    "op7_html_text": op7_html_text,
    "op8_licences": op8_licences,
    "op9_token_files": op9_token_files,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_source_divergence": op11_source_divergence,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_filter_interactions": op13_filter_interactions,
}

QUERIES["pipeline"] = corpus_pipeline.run
