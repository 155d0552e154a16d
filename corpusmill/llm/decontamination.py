"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

Each item gives its windows of n consecutive words (a shorter item is one window).  A window is taken as the
ordered set of its runs of up to three words (shingles).  Shingles are ordered by how often the
corpus has them, and since all of a window's shingles must occur, the necessary prefix is its rarest
one.  Documents are joined on prefix shingles alone.  A match at a position fixes where the window
would begin (positional bound) and end (length bound: within one document); what is left is verified by
a hash of the window and then word by word.

The benchmark is the stated query set: it is taken in blocks of about BLOCK windows.  A block is indexed, used
and let go before the next one is read, so that the driver and the workers never hold more than one,
however many items there are.  Windows are known by a digest of their words; which items have a window is a
table of its own, a row a window and item, that hits are joined with, so a window that many items share is
one window in the index.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.llm.kernels import ALNUM, Words, chunks, lists, run_hashes, signed, texts
from corpusmill.llm.store import fresh_name, written

#: words of a shingle; windows of fewer words have shingles of their own length
SHINGLE = 3
#: windows a block; about 200 bytes each
BLOCK = 250_000


def item_windows(items: DataFrame, n: int, item_id: str, text: str) -> DataFrame:
    """(item, id, words, hash, shingles) of each window of each item that has words; id is the md5 of the words. An item's repeated windows give a row each."""

    def cut(batches):
        for batch in batches:
            names, raw = batch.column("item").to_pylist(), texts(batch.column("text"))
            for first, last, data, offsets in chunks(raw):
                out_item, out_words, out_hash, out_shingles = [], [], [], []
                w = Words(data, offsets, ALNUM, lower=True)
                body = w.data.tobytes()
                for i in range(last - first):
                    a, b = int(w.bounds[i]), int(w.bounds[i + 1])
                    size = min(n, b - a)
                    if not size:
                        continue
                    whole, parts = run_hashes(w.hash[a:b], size), run_hashes(w.hash[a:b], min(SHINGLE, size))
                    found = [body[w.start[j] : w.end[j]].decode() for j in range(a, b)]
                    for at in range(b - a - size + 1):
                        out_item.append(names[first + i])
                        out_words.append(" ".join(found[at : at + size]))
                        out_hash.append(whole[at])
                        out_shingles.append(signed(parts[at : at + size - min(SHINGLE, size) + 1]))
                yield pa.RecordBatch.from_arrays([pa.array(out_item, pa.string()), pa.array(out_words, pa.string()), pa.array(signed(np.array(out_hash, np.uint64)), pa.int64()), lists(out_shingles, pa.int64())], ["item", "words", "hash", "shingles"])

    named = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    return named.mapInArrow(cut, "item string, words string, hash long, shingles array<long>").withColumn("id", F.md5("words"))


def _doc_of(w: Words) -> np.ndarray:
    return np.repeat(np.arange(len(w.bounds) - 1), np.diff(w.bounds))


def frequencies(docs: DataFrame, shingles: dict[int, np.ndarray]) -> dict[int, int]:
    """How often the corpus has each of the given shingles; by shingle size, sorted hashes."""

    def count(batches):
        totals = {s: np.zeros(len(v), np.int64) for s, v in shingles.items()}
        for batch in batches:
            for _, _, data, offsets in chunks(texts(batch.column("text"))):
                w = Words(data, offsets, ALNUM, lower=True)
                doc = _doc_of(w)
                for s, v in shingles.items():
                    runs = run_hashes(w.hash, s)
                    at = np.searchsorted(v, runs)
                    hit = (v[np.minimum(at, len(v) - 1)] == runs) & (doc[: len(runs)] == doc[s - 1 :])
                    totals[s] += np.bincount(at[hit], minlength=len(v))
        for s, v in shingles.items():
            got = np.flatnonzero(totals[s])
            yield pa.RecordBatch.from_arrays([pa.array(signed(v[got]), pa.int64()), pa.array(totals[s][got], pa.int64())], ["shingle", "n"])

    rows = docs.select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).collect()
    return {int(np.int64(r.shingle).view(np.uint64)): r.n for r in rows}


def _index(block: list, often: dict[int, int]) -> list[tuple]:
    """By (shingle size, window size): prefix shingles sorted, the windows behind each, and their offsets, hashes, words, ids."""
    rows = defaultdict(list)
    for r in block:
        size = len(r.words.split(" "))
        parts = np.array(r.shingles, np.int64).view(np.uint64).tolist()
        rare, offset = min((often.get(h, 0), h, j) for j, h in enumerate(parts))[1:]
        if often.get(rare, 0):
            rows[min(SHINGLE, size), size].append((rare, offset, int(np.int64(r.hash).view(np.uint64)), r.words, r.id))
    out = []
    for (s, size), found in sorted(rows.items()):
        found.sort()
        keys = np.array([x[0] for x in found], np.uint64)
        distinct, first, n = np.unique(keys, return_index=True, return_counts=True)
        out.append((s, size, distinct, first, n, np.array([x[1] for x in found]), np.array([x[2] for x in found], np.uint64), [x[3] for x in found], [x[4] for x in found]))
    return out


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", block: int = BLOCK) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hits (array of [first, after) word ranges), items.

    Words are [0-9a-z] and non-ASCII runs after A-Z became a-z.  n_hit counts words inside an
    occurrence of a window; items are those with an occurring window, sorted as strings.  Null and
    empty texts have no words and hit nothing; items without words are left out; the windows of items without
    id count as hits, but there is nothing to name them by in items; rows with equal
    doc_id and text get equal rows; other columns are not carried; an empty table gives an empty table.
    """
    windows = written(item_windows(items, n, item_id, text), "item-windows")
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("key"))
    found = written(_flagged(source, windows, "text", block, "found").select("doc_id", "key", "found.*"), "occurrences")
    # the items behind the windows of each text that has any
    names = windows.filter("item is not null").select(F.col("id").alias("window"), "item").distinct()
    named = found.select("key", F.explode("windows").alias("window")).distinct().join(names, "window").groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    none = F.array().cast("array<string>")
    hit = found.filter("size(hits) > 0").join(named, "key", "left").withColumn("items", F.coalesce("items", none))
    found = hit.unionByName(found.filter("size(hits) = 0").withColumn("items", none))
    # the length of the union of ranges, walked in order
    covered = F.aggregate(
        F.array_sort("hits"),
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("end")),
        lambda acc, r: F.struct((acc["total"] + F.greatest(F.lit(0).cast("long"), r[1] - F.greatest(acc["end"], r[0]))).alias("total"), F.greatest(acc["end"], r[1]).alias("end")),
        lambda acc: acc["total"],
    )
    return found.select("doc_id", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"), "hits", "items")


def flagged(docs: DataFrame, items: DataFrame, n: int = 10, text: str = "text", item_id: str = "item_id", block: int = BLOCK, out: str = "found", item_text: str = "text") -> DataFrame:
    """docs with a struct `out` of n_words, hits and windows (md5 of the words of those that occur); columns and rows are kept."""
    return _flagged(docs, written(item_windows(items, n, item_id, item_text), "item-windows"), text, block, out)


def _flagged(docs: DataFrame, windows: DataFrame, text: str, block: int, out: str) -> DataFrame:
    source = docs.select(F.col(text).alias("text"))
    windows = written(windows.groupBy("id").agg(F.first("words").alias("words"), F.first("hash").alias("hash"), F.first("shingles").alias("shingles")), "distinct-windows")
    blocks = max(1, -(-windows.count() // block))

    def index(b: int) -> list[tuple]:
        """Of one block; nothing of it stays here."""
        rows = windows.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()
        wanted = defaultdict(set)
        for r in rows:
            wanted[min(SHINGLE, len(r.words.split(" ")))].update(r.shingles)
        often = frequencies(source, {s: np.sort(np.array(list(v), np.int64).view(np.uint64)) for s, v in wanted.items()}) if wanted else {}
        return _index(rows, often)

    if blocks == 1:
        return _occurrences(docs, text, index(0), out)
    # every block's hits of each distinct text, by its 128-bit hash, and then the rows again
    key = fresh_name("text_key", docs.columns)
    keyed = docs.withColumn(key, F.md5(F.coalesce(F.col(text), F.lit(""))))
    first = written(_occurrences(keyed, text, index(0), out), "occurrences")
    hits = first.select(F.col(key).alias("k"), f"{out}.hits", f"{out}.windows").filter("size(hits) > 0").dropDuplicates(["k"])
    for b in range(1, blocks):
        more = _occurrences(keyed.select(F.col(key).alias("k"), F.col(text).alias("text")), "text", index(b), "found").select("k", "found.hits", "found.windows")
        hits = hits.unionByName(written(more.filter("size(hits) > 0").dropDuplicates(["k"]), "occurrences"))
    hits = hits.groupBy("k").agg(F.flatten(F.collect_list("hits")).alias("all_hits"), F.flatten(F.collect_list("windows")).alias("all_windows"))
    whole = F.struct(F.col(f"{out}.n_words").alias("n_words"), F.coalesce("all_hits", f"{out}.hits").alias("hits"), F.coalesce("all_windows", f"{out}.windows").alias("windows"))
    return first.join(hits, first[key] == hits["k"], "left").withColumn(out, whole).select(*docs.columns, out)


def clean(docs: DataFrame, items: DataFrame, n: int = 10, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """The rows of docs in which no window of the items occurs, with their columns as they are."""
    out = fresh_name("found", docs.columns)
    return flagged(docs, items, n, text, item_id, out=out).filter(F.size(f"{out}.hits") == 0).drop(out)


def _occurrences(docs: DataFrame, text: str, index: list[tuple], out: str) -> DataFrame:
    """docs with the struct `out` (n_words, hits, windows)."""
    columns = docs.columns

    def search(batches):
        for batch in batches:
            sizes, hits, found = [], [], []
            for first, last, data, offsets in chunks(texts(batch.column(columns.index(text)))):
                w = Words(data, offsets, ALNUM, lower=True)
                doc = _doc_of(w)
                ranges, names = defaultdict(set), defaultdict(set)
                for s, size, keys, begin, n, offset, whole, words, ids in index:
                    runs = run_hashes(w.hash, s)
                    at = np.minimum(np.searchsorted(keys, runs), len(keys) - 1)
                    p = np.flatnonzero(keys[at] == runs)
                    if not len(p):
                        continue
                    key = at[p]
                    times = n[key]
                    window = np.repeat(begin[key], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    p = np.repeat(p, times)
                    start, of = p - offset[window], doc[p]
                    fits = (start >= w.bounds[of]) & (start + size <= w.bounds[of + 1])
                    window, start, of = window[fits], start[fits], of[fits]
                    if not len(start):
                        continue
                    same = run_hashes(w.hash, size)[start] == whole[window]
                    for x, a, d in zip(window[same].tolist(), start[same].tolist(), of[same].tolist(), strict=True):
                        if " ".join(w.data[w.start[j] : w.end[j]].tobytes().decode() for j in range(a, a + size)) == words[x]:
                            base = int(w.bounds[d])
                            ranges[d].add((a - base, a - base + size))
                            names[d].add(ids[x])
                for d in range(last - first):
                    sizes.append(int(w.bounds[d + 1] - w.bounds[d]))
                    hits.append([list(r) for r in sorted(ranges.get(d, ()))])
                    found.append(sorted(names.get(d, ())))
            struct = pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(hits, pa.list_(pa.list_(pa.int64()))), pa.array(found, pa.list_(pa.string()))], ["n_words", "hits", "windows"])
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], [*columns, out])

    kind = T.StructType().add("n_words", "long").add("hits", T.ArrayType(T.ArrayType(T.LongType()))).add("windows", T.ArrayType(T.StringType()))
    return docs.mapInArrow(search, T.StructType([*docs.schema.fields, T.StructField(out, kind)]))
