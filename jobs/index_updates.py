"""Keep the duplicate index of a growing table of documents up to date: new files are read once, the rest never again.

    python -m jobs.index_updates --documents DIR/documents.parquet --output DIR --checkpoint DIR [--config FILE]

A file stream takes the files that its checkpoint does not know, a few at a time, until none is left.  Their texts
become rows of hashes and lengths (rows/batch=...); a batch that is repeated after a failure has the same number and
overwrites its own folder only.  The index is then made anew from the rows, without any text, since a new file may
hold a shorter path, or one more copy, of an old content:

    rows/batch=...    what is known of each text (Parquet)
    index/corpus=...  which text of each content is embedded (Parquet)

Files are known by name: one that is written anew under its old name is not taken again.  Output and checkpoint belong
together; to begin anew, take new folders for both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators import index
from corpusmill.sources.scratch import cleared
from jobs.common import DOCUMENTS, log, main, mirror

#: files of a batch, and see corpus_build
SETTINGS = {"files_per_batch": 16, "formats": {}, "rank_after_exclusion": False}

_ROW = "text_path string, corpus string, source_format string, chars long, content_sha256 string"


def index_updates(spark: SparkSession, documents: str, output: str, checkpoint: str, files_per_batch: int = SETTINGS["files_per_batch"], formats: dict[str, str] = SETTINGS["formats"], rank_after_exclusion: bool = SETTINGS["rank_after_exclusion"]) -> DataFrame:
    """Take up what is new in documents; returns the whole index as it lies in output then.

    Nulls: see mirror().  Repeated rows are rows of their own.  Without a file ever seen the index is empty.
    """
    output = output.rstrip("/")
    rows = f"{output}/rows"
    # as a pattern that only this name matches: the stream takes a single file as it takes a folder of files then
    found = documents.rstrip("/")
    new = spark.readStream.schema(DOCUMENTS).option("maxFilesPerTrigger", str(files_per_batch)).parquet(f"{found[:-1]}[{found[-1]}]")

    def take(batch: DataFrame, number: int) -> None:
        described = index.described(mirror(batch, formats)).withColumn("batch", F.lit(number).cast("long"))
        described.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(rows)
        log.info("batch %d written to %s", number, rows)

    stream = new.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    stream.awaitTermination()
    log.info("read %d new documents from %s", sum(p["numInputRows"] for p in stream.recentProgress), documents)

    spark.createDataFrame([], f"{_ROW}, batch long").write.mode("append").partitionBy("batch").parquet(rows)  # the folder is there even if nothing came
    known = spark.read.schema(f"{_ROW}, batch long").parquet(rows).drop("batch")
    with cleared(spark):
        index.embed_index(known, rank_after_exclusion).hint("rebalance", "corpus").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("corpus").parquet(f"{output}/index")
    log.info("wrote the index to %s/index", output)
    return indexed(spark, output)


def indexed(spark: SparkSession, output: str) -> DataFrame:
    """What index_updates() has left, read back."""
    kinds = "text_path string, source_format string, chars long, content_sha256 string, embed string, exclude_reason string, duplicate_of string, dup_group_size long, corpus string"
    return spark.read.schema(kinds).parquet(f"{output}/index").select("text_path", "corpus", "source_format", "chars", "content_sha256", "embed", "exclude_reason", "duplicate_of", "dup_group_size")


if __name__ == "__main__":
    main(index_updates, SETTINGS, ("documents", "output", "checkpoint"))
