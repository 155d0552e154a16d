"""Tables between the steps of a plan, where computing a step twice would cost more than writing it."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: shuffle files go when the query that made them has ended, not when the driver's memory is next cleared
_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scopes = threading.local()


def folder(spark: SparkSession) -> str:
    """This application's part of the folder of spark.checkpoint.dir, which all executors share; a temporary folder only where that is unset and the executors are threads of this machine."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        made = tempfile.mkdtemp(prefix="corpusmill-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        where = "file://" + made
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where.rstrip('/')}/corpusmill/{spark.sparkContext.applicationId}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for the time of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def stored(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """df, computed once and read back, and where it lies: its lineage is cut, a lost executor costs no recomputation, and what was shuffled for it takes no disk any more."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    with setting(spark, _CLEANED, "true"):
        df.write.options(**options).parquet(path)
    if getattr(_scopes, "open", None):
        _scopes.open[-1].append(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def cleared(spark: SparkSession) -> Iterator[list[str]]:
    """A block at whose end the tables stored in it are removed; gives the list of their places."""
    own: list[str] = []
    _scopes.open = [*getattr(_scopes, "open", []), own]
    try:
        yield own
    finally:
        _scopes.open = [s for s in _scopes.open if s is not own]
        for path in own:
            removed(spark, path)


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame], **options: str) -> tuple[DataFrame, str]:
    """stored() of what make() gives; the tables stored on the way are removed then."""
    with cleared(spark) as own:
        df, path = stored(make(), name, **options)
        own.remove(path)
    if getattr(_scopes, "open", None):
        _scopes.open[-1].append(path)
    return df, path


def once(df: DataFrame, name: str) -> DataFrame:
    return stored(df, name)[0]


def removed(spark: SparkSession, path: str | None = None) -> None:
    """Deletes a stored table that nothing reads any more; without a path, all of this application's, once its results are written."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path or folder(spark))
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
