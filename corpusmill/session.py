"""Spark sessions with the settings the engine's semantics need."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC timestamps; later keys of a header win; a plan that adapts to sizes found at run time
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(name: str = "corpusmill", **more: str) -> SparkSession:
    """The running session, or a new one with SETTINGS and `more`."""
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
