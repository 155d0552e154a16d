"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.kernels import byte_sizes, texts
from corpusmill.llm.store import fresh_name
from corpusmill.llm.tokens import coder


def token_counts(df: DataFrame, tokenizer: str, text: str = "text", limit: int = 512) -> DataFrame:
    """df with n_bytes, n_tokens and over_limit (n_tokens > limit) of its text column.

    Batches are balanced by bytes, long texts are cut at boundaries no token crosses, and only the
    counts leave the worker.  Null and empty texts count 0 bytes and 0 tokens; rows are kept one to
    one, repeated rows too.  Columns of df by these three names are replaced; an empty table gives
    an empty table.
    """

    kept = [c for c in df.columns if c != text and c not in ("n_bytes", "n_tokens", "over_limit")]
    body = fresh_name("body", df.columns)

    def lengths(batches):
        for batch in batches:
            raw = texts(batch.columns[-1])
            got = [len(b) // 4 for b in coder(tokenizer, True).balanced(raw.to_pylist(), byte_sizes(raw))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(got, pa.int64())], [*kept, "n_bytes", "n_tokens"])

    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes")
    source = df.select(*kept, size, F.col(text).alias(body))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("n_tokens", T.LongType())])
    return source.mapInArrow(lengths, schema).withColumn("over_limit", F.col("n_tokens") > limit)
