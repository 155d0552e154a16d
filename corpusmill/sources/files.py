"""Trees of files, manifests, specs and case files as DataFrames. Missing inputs give empty, typed tables."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import schemas
from corpusmill.operators.master import latest_wins

#: Files that are not documents.
META = ("manifest.csv", "readme.md", "readme.txt", "sources.md", "sources.txt", "master-index.csv", "_extraction_audit.csv", "_text_dedupe.csv")
MIRROR = "_TEXT"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _relative(root: str):
    """A file's path below root: the scan's path without its scheme and root."""
    plain = F.regexp_replace(F.url_decode(F.regexp_replace("path", r"\+", "%2B")), r"\A[a-z][a-z0-9+.-]*:(//[^/]*)?", "")
    return F.substr(plain, F.lit(len(root.rstrip("/")) + 2))


def _tree(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)


def documents(spark: SparkSession, root: str) -> DataFrame:
    """(corpus, relative_path, modified, size, content) of every document below root; the content is read only if selected. Spark lists no empty files, and there is no text in them."""
    rows = _tree(spark, root).select(_relative(root).alias("relative_path"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"), "content")
    name = F.element_at(F.split("relative_path", "/"), -1)
    kept = ~F.lower(name).isin(*META) & ~name.endswith(".part") & ~F.concat(F.lit("/"), F.col("relative_path")).contains(f"/{MIRROR}/")
    return rows.filter(kept).select(F.substring_index("relative_path", "/", 1).alias("corpus"), "relative_path", "modified", "size", "content")


def mirror(spark: SparkSession, root: str) -> DataFrame:
    """(text_path, corpus, modified, size, text) of the text mirror; bytes that are not UTF-8 become U+FFFD."""
    rows = _tree(spark, f"{root.rstrip('/')}/{MIRROR}")
    path = _relative(root)
    text = F.make_valid_utf8(F.col("content").cast("string"))
    return rows.select(path.alias("text_path"), F.get(F.split(path, "/"), F.lit(1)).alias("corpus"), F.col("modificationTime").alias("modified"), F.col("length").alias("size"), text.alias("text"))


def manifest(spark: SparkSession, root: str, folder: str, kind: str, last: bool = False) -> DataFrame:
    """A corpus's manifest, all strings, empty for missing; with `last`, of rows with one relative_path only the file's last."""
    ddl, path = schemas.manifest(kind), f"{root.rstrip('/')}/{folder}/manifest.csv"
    if not exists(spark, path):
        return spark.createDataFrame([], ddl)
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"', quote='"', enforceSchema=False, schema=ddl)
    found = latest_wins(in_order(rows, "_at"), "_at").select(*rows.columns) if last else rows
    return found.na.fill("")


def in_order(rows: DataFrame, name: str) -> DataFrame:
    """rows of a reader of files with a column by which they sort as they stand in them: by file, by where the split that holds them begins, and by their order in it.

    Rows of a split are read by one task, one after the other, which is the order of increasing ids; so no row is
    moved for it, and files may be read in any number of splits. To be called on the reader's own rows.
    """
    return rows.withColumn(name, F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row")))


def specs(spark: SparkSession, folder: str) -> DataFrame:
    """Pack specs of a folder of JSON files, by name."""
    rows = spark.read.schema(schemas.PACK_SPEC).json(f"{folder.rstrip('/')}/*.json", multiLine=True)
    return rows.withColumn("name", F.regexp_extract(F.input_file_name(), r"([^/]+)\.json\z", 1)).orderBy("name")


def smoke_cases(spark: SparkSession, path: str) -> DataFrame:
    """Cases of a file of JSON lines; lines that begin with # are remarks."""
    lines = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    return lines.select(F.from_json("value", schemas.SMOKE_CASE).alias("c")).select("c.*")


def artifacts(spark: SparkSession, folder: str) -> DataFrame:
    """(artifact, place, bytes) of the packs of a folder: only their listing, whatever their sizes."""
    rows = _tree(spark, folder).filter(F.col("path").endswith(".tar.zst"))
    return rows.select(F.element_at(F.split("path", "/"), -1).alias("artifact"), F.col("path").alias("place"), F.col("length").alias("bytes"))


def write_csv(df: DataFrame, path: str) -> None:
    """A table as CSV with a header, in parts; internal tables are parquet."""
    df.write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="")


def write_texts(rows: DataFrame, folder: str) -> None:
    """Texts (path, text), each in a file of its own below folder, written by the tasks that have them: beside its place and renamed, so it is whole or absent, and a repeated task writes the same. folder must be one that all executors share."""

    def put(batches):
        for batch in batches:
            for path, text in zip(batch.column("path").to_pylist(), batch.column("text").to_pylist(), strict=True):
                place = os.path.join(folder, path)
                os.makedirs(os.path.dirname(place), exist_ok=True)
                part = f"{place}.{uuid.uuid4().hex}.part"
                with open(part, "w", encoding="utf-8") as f:
                    f.write(text)
                os.replace(part, place)
            yield pa.RecordBatch.from_arrays([batch.column("path")], ["path"])

    rows.select("path", "text").mapInArrow(put, "path string").write.format("noop").mode("overwrite").save()


def write_one_csv(df: DataFrame, path: str) -> None:
    """A table as one CSV file with a header, in the rows' order; for manifests and reports that people read. The rows stream through one task."""
    spark = df.sparkSession
    part = f"{path}.parts"
    df.coalesce(1).write.mode("overwrite").csv(part, header=True, escape='"', emptyValue="")
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder, target = jvm.Path(part), jvm.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    (made,) = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".csv")]
    if fs.exists(target):
        fs.delete(target, False)
    fs.rename(made, target)
    fs.delete(folder, True)
