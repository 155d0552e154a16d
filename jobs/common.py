"""What the jobs share: their settings files, their log and the texts they read."""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import session

log = logging.getLogger("jobs")

#: the columns of documents that the jobs read; others are left alone
DOCUMENTS = "doc_id long, text string, source string"


def settings(spark: SparkSession, path: str, known: dict) -> dict:
    """A JSON file of settings over those known; unknown names are errors, so that a slip is no silent default."""
    found = json.loads("\n".join(r.value for r in spark.read.option("wholetext", "true").text(path).collect()))
    if odd := sorted(set(found) - set(known)):
        raise ValueError(f"{path}: unknown settings {', '.join(odd)}; known are {', '.join(sorted(known))}")
    return known | found


def mirror(docs: DataFrame, formats: dict[str, str] | None = None) -> DataFrame:
    """documents (doc_id, text, source) as mirror texts (text_path, corpus, source_format, text).

    formats gives a corpus's source format where it is not .txt.  Null texts are empty, null sources the corpus `unknown`.
    """
    corpus = F.coalesce(F.nullif(F.col("source"), F.lit("")), F.lit("unknown"))
    fmt = F.lit(".txt")
    for name, own in sorted((formats or {}).items()):
        fmt = F.when(corpus == name, own).otherwise(fmt)
    path = F.concat(F.lit("_TEXT/"), corpus, F.lit("/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(".txt"))
    return docs.select(path.alias("text_path"), corpus.alias("corpus"), fmt.alias("source_format"), F.coalesce("text", F.lit("")).alias("text"))


def main(job: Callable, known: dict, paths: tuple[str, ...], argv: list[str] | None = None) -> None:
    """The command line of a job: its paths, and a settings file that has a place beside it."""
    args = argparse.ArgumentParser(description=job.__doc__)
    args.add_argument("--config", default=str(Path(__file__).with_name(f"{job.__name__}.json")))
    for p in paths:
        args.add_argument(f"--{p}", required=True)
    given = vars(args.parse_args(argv))
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = session(job.__name__)
    try:
        job(spark, *[given[p] for p in paths], **settings(spark, given["config"], known))
    finally:
        spark.stop()
