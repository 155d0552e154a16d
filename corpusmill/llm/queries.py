"""The queries of the training-data operators, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import decontamination, divergence, embeddings, jaccard, language, licenses, packing, secrets, substrings, token_counts, token_files, toxicity
from corpusmill.llm.oracles import SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.repeats(_table(spark, sf_dir, "documents"), length=35)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_components(_table(spark, sf_dir, "documents"), n=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), n=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(_table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)
    return found.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(_table(spark, sf_dir, "documents"), at_least=3, top=200)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.written_and_read(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


_QUERIES = (
    op1_substring_dedup,
    op2_embedding_near_dedup,
    op3_ngram_jaccard_join,
    op4_toxicity,
    op5_secret_scans,
    op6_packing,
    op7_benchmark_decontamination,
    op8_license_scans,
    op9_language_id,
    op10_token_counts,
    op11_source_divergence,
    op12_token_files,
)


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
