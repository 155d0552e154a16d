"""Build a corpus for retrieval from a table of documents: what is embedded, what is left out and why, and a report.

    python -m jobs.corpus_build --documents DIR/documents.parquet --output DIR [--config FILE]

Of equal contents one text is embedded, bulk spreadsheets and texts too short to compare are left out.  Output, each
part overwritten whole by a rerun, so that the same documents give the same rows and nothing of older ones stays:

    embedded/corpus=...          the cleaned texts and their index rows (Parquet)
    excluded/exclude_reason=...  index rows of the others, with the text they are duplicates of (Parquet)
    report/                      files, embedded files and characters of each corpus (JSON)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import index
from corpusmill.sources.scratch import cleared
from jobs.common import DOCUMENTS, log, main, mirror

#: corpora whose texts come from other files than plain text, and whether formats that are not embedded lose their rank among equal contents
SETTINGS = {"formats": {}, "rank_after_exclusion": False}


def _written(df: DataFrame, path: str, by: str) -> int:
    """df as Parquet, a folder a value; files are of like size however unlike the values are in number."""
    df.hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(by).parquet(path)
    n = df.sparkSession.read.schema(df.schema).parquet(path).count()
    log.info("wrote %d rows to %s", n, path)
    return n


def corpus_build(spark: SparkSession, documents: str, output: str, formats: dict[str, str] = SETTINGS["formats"], rank_after_exclusion: bool = SETTINGS["rank_after_exclusion"]) -> DataFrame:
    """Build a corpus from documents; returns what lies in output then: an index row a document, with the embedded text's SHA-256 and its corpus's counts.

    Nulls: see mirror().  Repeated rows are rows of their own, of which all that share the embedded path are embedded.  An
    empty table gives empty output.
    """
    output = output.rstrip("/")
    docs = spark.read.schema(DOCUMENTS).parquet(documents)
    with cleared(spark):
        found = index.embed_index(index.described(mirror(docs, formats), keep=("text",)), rank_after_exclusion)
        common = ("text_path", "corpus", "source_format", "chars", "content_sha256", "dup_group_size")
        embedded = found.filter("embed = 'yes'").select(*common, X.clean_whitespace(F.col("text")).alias("text"))
        excluded = found.filter("embed = 'no'").select(*common, "duplicate_of", "exclude_reason")
        n = _written(embedded, f"{output}/embedded", "corpus") + _written(excluded, f"{output}/excluded", "exclude_reason")
        log.info("read %d documents from %s", n, documents)
        index.by_corpus(found).write.mode("overwrite").json(f"{output}/report")
    return built(spark, output)


def built(spark: SparkSession, output: str) -> DataFrame:
    """What corpus_build() has left, read back."""
    kinds = "text_path string, source_format string, chars long, content_sha256 string, dup_group_size long"
    embedded = spark.read.schema(f"{kinds}, text string, corpus string").parquet(f"{output}/embedded")
    excluded = spark.read.schema(f"{kinds}, corpus string, duplicate_of string, exclude_reason string").parquet(f"{output}/excluded")
    report = spark.read.schema("corpus string, files long, embed long, embed_chars long").json(f"{output}/report")
    report = report.select("corpus", F.col("files").alias("corpus_files"), F.col("embed").alias("corpus_embedded"), F.col("embed_chars").alias("corpus_chars"))
    embedded = embedded.withColumn("text_sha256", X.sha256(F.col("text"))).drop("text")
    rows = embedded.unionByName(excluded, allowMissingColumns=True)
    rows = rows.withColumn("exclude_reason", F.coalesce("exclude_reason", F.lit(""))).withColumn("duplicate_of", F.coalesce("duplicate_of", F.lit("")))
    return rows.join(report, "corpus")


if __name__ == "__main__":
    main(corpus_build, SETTINGS, ("documents", "output"))
