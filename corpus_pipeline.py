"""A corpus pipeline: toxic documents go, one document of each group of near copies stays, documents with
benchmark passages go, secrets are hidden, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import decontamination, jaccard, packing, secrets, toxicity
from corpusmill.sources.scratch import removed, settled


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold go; the classifier is learnt from the table of labels."""
    return toxicity.clean(docs, _table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by 5-word shingles at a Jaccard similarity of 0.8 or more, the one with the smallest doc_id stays."""
    return jaccard.representatives(docs, n=5, num=80, den=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of ten words (or a whole shorter item) of the benchmark go."""
    return decontamination.clean(docs, _table(spark, sf_dir, "benchmark"), n=10)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts, n_chars follows; every document stays."""
    return secrets.redacted(docs, length="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", hide_secrets),
    ("packing", pack),
]

#: tokenizers and a learnt classifier are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each one's result written and read again; what a stage wrote on the way is removed then, and its result once the next one's is written."""
    docs, before = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        given = docs
        docs, path = settled(spark, name.replace(" ", "-").lower(), lambda stage=stage, given=given: stage(spark, given, sf_dir), compression="zstd")
        if before:
            removed(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
