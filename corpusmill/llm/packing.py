"""Harmonic packing of documents into sequences of a fixed number of tokens.

A document's tokens are cut into pieces: whole sequences first, then one piece for each set bit of the
remainder down to capacity/8, then a tail.  A piece longer than capacity/(k+1) and not longer than
capacity/k is of class k, and a sequence of class k takes k pieces of that class.  The halves, quarters
and eighths fill their sequences exactly; only tails leave padding, at most 1/(k+1) with k >= 8.

Each worker fills its own sequences and numbers them by itself.  Pieces in sequences it could not fill
(fewer than k in each class: a bound that does not depend on the data) are merged in rounds, FAN
workers to one, until one group is left; its rest is packed by first fit, longest first.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import byte_sizes, texts
from corpusmill.llm.store import written
from corpusmill.llm.tokens import coder

#: workers whose unfilled sequences one task merges
FAN = 32
#: words and parts that a worker remembers: workers outlive their tasks, and the next step needs the room
REMEMBERED = 150_000
#: pieces this short share the class of the largest fixed count
SHORTEST = 32

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [x.split()[0] for x in PIECES.split(", ")]


def cuts(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of n tokens."""
    out = [capacity] * (n // capacity)
    rest, part = n % capacity, capacity // 2
    while part >= max(1, capacity // 8):
        if rest >= part:
            out.append(part)
            rest -= part
        part //= 2
    return out + [rest] * (rest > 0)


def count_of(length: int, capacity: int) -> int:
    """The fixed number of pieces of this length that share a sequence."""
    return capacity // max(length, min(SHORTEST, capacity))


class Filler:
    """Open sequences by class; hands out a sequence's pieces once it holds its fixed count."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next, self.open = capacity, first, defaultdict(list)

    def add(self, piece: tuple) -> list[tuple]:
        k = count_of(piece[2], self.capacity)
        held = self.open[k]
        held.append(piece)
        if len(held) < k:
            return []
        self.open[k] = []
        return self.close(held)

    def close(self, held: list[tuple]) -> list[tuple]:
        out, at = [], 0
        for p in held:
            out.append((*p[:5], self.next, at))
            at += p[2]
        self.next += 1
        return out

    def rest(self) -> list[tuple]:
        return [p for k in sorted(self.open) for p in self.open[k]]


def _order(piece: tuple) -> tuple:
    return (piece[0] is None, piece[0] or 0, *piece[1:5])


def first_fit(pieces: list[tuple], capacity: int) -> list[list[tuple]]:
    """Bins of pieces, longest first; called on a rest of bounded size only."""
    bins: list[list[tuple]] = []
    room = np.zeros(0, np.int64)
    for p in sorted(pieces, key=lambda p: (-p[2], *_order(p))):
        fits = np.flatnonzero(room >= p[2])
        if len(fits):
            bins[fits[0]].append(p)
            room[fits[0]] -= p[2]
        else:
            bins.append([p])
            room = np.append(room, capacity - p[2])
    return bins


def _batch(rows: list[tuple], tag: int) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_NAMES)
    arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array([tag] * len(rows), pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, [*_NAMES, "worker"])


def pack(df: DataFrame, tokenizer: str, end_id: int, capacity: int = 4096, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null text counts as empty; every document ends with end_id, so even an empty one is a piece of one
    token.  Rows that repeat are packed each by itself.  Sequence ids are unique, not consecutive.
    Other columns of df are not carried; an empty table gives no piece.
    """

    def fill(batches):
        worker = TaskContext.get().partitionId()
        filler, code = Filler(capacity, worker << 40), coder(tokenizer, False, REMEMBERED)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            raw = texts(batch.column(1))
            for doc, ids in zip(batch.column(0).to_pylist(), code.balanced(raw.to_pylist(), byte_sizes(raw)), strict=True):
                ids += end
                start, total = 0, len(ids) // 4
                for length in cuts(total, capacity):
                    rows += filler.add((doc, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total))
                    start += length
            yield _batch(rows, -1)
        yield _batch([(*p, None, None) for p in filler.rest()], worker)

    found = written(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(fill, PIECES + ", worker long"), "pieces")
    done, rest = found.filter("worker < 0"), found.filter("worker >= 0")
    workers = (rest.agg(F.max("worker")).first()[0] or 0) + 1
    level = 1
    while True:
        last = workers <= FAN
        merged = written(_merged(rest, capacity, level, last), "merged")
        done = done.unionByName(merged.filter("worker < 0"))
        if last:
            return done.select(*_NAMES)
        rest, workers, level = merged.filter("worker >= 0"), -(-workers // FAN), level + 1


def _merged(rest: DataFrame, capacity: int, level: int, last: bool) -> DataFrame:
    def merge(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in _NAMES[:5]), strict=True), key=_order)
        group = table.column("parent")[0].as_py()
        filler = Filler(capacity, (level << 60) | (group << 40))
        out = [x for p in rows for x in filler.add(p)]
        if last:
            for held in first_fit(filler.rest(), capacity):
                out += filler.close(held)
            return pa.Table.from_batches([_batch(out, -1)])
        return pa.Table.from_batches([_batch(out, -1), _batch([(*p, None, None) for p in filler.rest()], group)])

    parents = rest.withColumn("parent", F.expr(f"worker div {FAN}"))
    return parents.groupBy("parent").applyInArrow(merge, PIECES + ", worker long")
