"""The driver's tables in the shapes that the engine's operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df's rows dealt out evenly over a shuffle's tasks: a file is read by few tasks if it is small, and costly functions of its rows would run in those alone."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def mirror(spark: SparkSession, sf_dir: str, formats: bool = False) -> DataFrame:
    """documents as a text mirror; with formats, every tenth comes from a spreadsheet."""
    docs = table(spark, sf_dir, "documents")
    fmt = F.when(F.col("doc_id") % 10 == 0, ".xlsx").otherwise(".txt") if formats else F.lit(".txt")
    path = F.concat(F.lit("_TEXT/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return docs.select(path.alias("text_path"), F.col("source").alias("corpus"), fmt.alias("source_format"), "text", "doc_id")


MIRROR_SQL = "SELECT '_TEXT/' || source || '/' || doc_id || '.txt' AS text_path, source AS corpus, {fmt} AS source_format, text, doc_id FROM documents"


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as a manifest of files <doc_id>.txt."""
    docs = table(spark, sf_dir, "documents")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    return docs.select(F.col("source").alias("corpus"), name.alias("relative_path"), F.concat(F.lit("https://docs.example.org/"), name).alias("source_url"), "lang", F.octet_length("text").cast("long").alias("bytes"), F.sha2("text", 256).alias("sha256"))
