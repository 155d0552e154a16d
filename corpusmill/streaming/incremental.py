"""New mirror texts as a stream: described as they arrive, the first of each content within a watermark kept.

The first to arrive is kept, not the one with the shortest path, so this is no substitute for the batch
index; it keeps work done between two builds from being repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from corpusmill.operators.index import described


def arrivals(stream: DataFrame, within: str = "1 day") -> DataFrame:
    """Rows (text_path, corpus, source_format, text, arrived) as index rows, without later copies of a content."""
    found = described(stream, keep=("arrived",))
    return found.filter("content_sha256 <> 'TOO_SHORT'").withWatermark("arrived", within).dropDuplicatesWithinWatermark(["content_sha256"])


def write(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
