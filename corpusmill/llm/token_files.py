"""Token ids in ORC files, in ascending order of documents, and reading them back.

Rows are dealt out by ranges of document id and sorted, so a file holds a range of ids and every stripe and row group
a narrow one: their indexes of least and greatest ids, and Bloom filters for single ids, let a reader skip the
rest.  The ids are integers in a list column, which ORC writes in runs (a quick codec after them: a slow one gains little); a stripe can be read by itself, so
readers divide files at stripes.

A row holds at most ROW ids of a document, so no row and no batch of a reader grows with a text's length.  It also
holds where it stands: the file's number, the document's number within it, the ids of the file before the
document, the document's ids before the row, and all it has.  A document's place in the whole is its file's base, a
running sum over one row a file, and its place there; its checksum is the exclusive or of its rows', each carried
over the bytes that follow it.  So the ids are read once, and no row has to wait for another.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.llm.kernels import byte_sizes, texts
from corpusmill.llm.store import partitions
from corpusmill.llm.tokens import coder
from corpusmill.sources.scratch import folder

#: most ids of a row, and about how many of a batch
ROW, BATCH = 4096, 1 << 20
#: bytes of a stripe before it is written, rows between two index entries, and the share of Bloom filter hits that are false
STRIPE, STRIDE, FALSE_HITS = 16 << 20, 1000, 0.01

ROWS = "doc_id long, part int, doc int, at long, first long, total long, n int, ids array<int>"
_NAMES = [x.split()[0] for x in ROWS.split(", ")]


def _batches(docs: Iterator[tuple[int | None, bytes]], part: int) -> Iterator[pa.RecordBatch]:
    """Rows of documents (id, little-endian 32-bit ids), numbered and placed, in batches of about BATCH ids."""
    heads: list[tuple] = []
    held: list[bytes] = []
    at = size = 0

    def batch() -> pa.RecordBatch:
        columns = list(zip(*heads, strict=True))
        kinds = [pa.int64(), *[pa.int32()] * 2, *[pa.int64()] * 3, pa.int32()]
        flat = pa.Array.from_buffers(pa.int32(), size, [None, pa.py_buffer(b"".join(held))])
        ends = np.concatenate([[0], np.cumsum(columns[6])]).astype(np.int32)
        return pa.RecordBatch.from_arrays([*[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], pa.ListArray.from_arrays(pa.array(ends), flat)], _NAMES)

    for doc, (doc_id, ids) in enumerate(docs):
        total = len(ids) // 4
        for first in range(0, max(1, total), ROW):
            n = min(ROW, total - first)
            heads.append((doc_id, part, doc, at, first, total, n))
            held.append(ids[4 * first : 4 * (first + n)])
            size += n
            if size >= BATCH:
                yield batch()
                heads, held, size = [], [], 0
        at += total
    if heads:
        yield batch()


def write(df: DataFrame, path: str, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", stripe: int = STRIPE, files: int | None = None) -> None:
    """The token ids of every text, each document's with end_id after them, as ORC files below path.

    Null texts are empty: their documents are end_id alone.  Documents stand in ascending order of id, null ids first; of
    documents that share an id the order is fixed by a hash of their texts, so that a very frequent id is divided among files.
    Other columns are not written.  An empty table gives files without rows.
    """
    end = np.array([end_id], "<u4").tobytes()

    def encoded(batches):
        code = coder(tokenizer, True)

        def docs():
            for batch in batches:
                raw = texts(batch.column(1))
                for doc, ids in zip(batch.column(0).to_pylist(), code.balanced(raw.to_pylist(), byte_sizes(raw)), strict=True):
                    yield doc, ids + end

        yield from _batches(docs(), TaskContext.get().partitionId())

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keys = ["doc_id", F.xxhash64("text")]
    dealt = rows.repartitionByRange(files or partitions(df.sparkSession), *keys).sortWithinPartitions(*keys)
    options = {"compression": "lz4", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": FALSE_HITS, "orc.create.index": "true", "orc.row.index.stride": STRIDE, "orc.stripe.size": stripe}
    dealt.mapInArrow(encoded, ROWS).write.options(**options).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows of files that write() made; filters on doc_id reach their indexes and Bloom filters."""
    return spark.read.schema(ROWS).orc(path)


#: the polynomial of CRC-32, its highest power last, and a bit for the power 0
_POLYNOMIAL, _ONE = 0xEDB88320, 1 << 31


def _times(a: int, b: int) -> int:
    """The product of two polynomials over bits, by the remainder of CRC-32's."""
    out = 0
    while a:
        if a & _ONE:
            out ^= b
        a = a << 1 & 0xFFFFFFFF
        b = b >> 1 ^ (_POLYNOMIAL if b & 1 else 0)
    return out


def carried(crc: int, n: int) -> int:
    """What a CRC-32 adds to that of its bytes and n more: its product with the polynomial of degree 8 n."""
    step = _ONE >> 8
    while n:
        if n & 1:
            crc = _times(step, crc)
        step, n = _times(step, step), n >> 1
    return crc


def documents(spark: SparkSession, path: str) -> DataFrame:
    """One row a document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, all from what was read.

    Ids are summed up where they are read; only numbers of each row go on, and a row a file for the files' bases.
    """
    rows = read(spark, path)

    def summed(batches):
        for batch in batches:
            lists = batch.column(6)
            flat, ends = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)), np.asarray(lists.offsets)
            size = np.diff(ends)
            after = (batch.column(5).to_numpy() - batch.column(4).to_numpy() - size).tolist()
            crcs = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            crcs = [carried(c, 4 * n) if n else c for c, n in zip(crcs, after, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(size, pa.int64()), pa.array(crcs, pa.int64())], ["doc_id", "part", "doc", "at", "n", "crc"])

    found = rows.select("doc_id", "part", "doc", "at", "first", "total", "ids").mapInArrow(summed, "doc_id long, part int, doc int, at long, n long, crc long")
    docs = found.groupBy("part", "doc").agg(F.min("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = rows.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return docs.join(bases, "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def written_and_read(df: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """documents() of df's files, written to the shared folder."""
    path = f"{folder(df.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write(df, path, tokenizer, end_id, doc_id, text)
    return documents(df.sparkSession, path)
