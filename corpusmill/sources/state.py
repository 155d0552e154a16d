"""Small state as JSON files, by the file system of their path: captures, results of builds and checks, lists of files to read again."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def load(spark: SparkSession, path: str, default=None):
    """The value of a file; default where there is none."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return default
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def save(spark: SparkSession, path: str, value) -> None:
    """The value beside its place, then in it, so that readers find the old one or the new one, whole."""
    p, fs = _fs(spark, path)
    part, _ = _fs(spark, f"{path}.{uuid.uuid4().hex}.part")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray((json.dumps(value, indent=1, ensure_ascii=False, default=str) + "\n").encode()))
    finally:
        stream.close()
    if fs.exists(p):
        fs.delete(p, False)
    fs.rename(part, p)


def names(spark: SparkSession, folder: str) -> list[str]:
    p, fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def captures(spark: SparkSession, folder: str) -> DataFrame:
    """(corpus, captured_at) as recorded."""
    return spark.createDataFrame([*load(spark, f"{folder}/captures.json", {}).items()], "corpus string, captured_at string")


def record_capture(spark: SparkSession, folder: str, corpus: str, date: str) -> None:
    save(spark, f"{folder}/captures.json", load(spark, f"{folder}/captures.json", {}) | {corpus: date})


def checks(spark: SparkSession, folder: str) -> DataFrame:
    """(pack_id, checked_at) of the checks on record."""
    found = [load(spark, f"{folder}/{n}") for n in names(spark, folder) if n.startswith("freshness_") and n.endswith(".json")]
    return spark.createDataFrame([(c["pack"], c["checked_at"]) for c in found], "pack_id string, checked_at string")
