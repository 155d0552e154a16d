"""Tables between the steps of an operator, in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusmill.sources import scratch
from corpusmill.sources.scratch import stored


def written(df: DataFrame, name: str) -> DataFrame:
    """df, computed once and read back: its lineage is cut, and a lost executor costs no recomputation."""
    return stored(df, name, compression="zstd")[0]


def settled(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What make() gives, written and read back; tables written on the way are removed."""
    return scratch.settled(spark, name, make, compression="zstd")[0]


def fresh_name(name: str, taken: list[str]) -> str:
    """name, with as many underscores as keep it apart from the columns of a table."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
