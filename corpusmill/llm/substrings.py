"""Substring dedup: seed and extend on winnowed anchors, keeping repeats of at least a length.

Seed.  Of the k-word runs inside each window of `length` words the one with the least hash is the
window's anchor.  Equal windows have equal anchors at equal offsets, wherever they stand, so a window
can occur twice only if its anchor occurs at two places.  Anchors are a few for every hundred words;
they alone are counted over the corpus.

Extend.  A place of such an anchor carries the words of all windows that the anchor owns there: it
reaches both ways as far as the anchor stays the least.  Documents are joined on the anchor: places are dealt out by
anchor and sorted, and each meets the first few places of its anchor that differ.  The match is extended from
the anchor both ways, word by word; where it reaches `length` words, its windows are repeats at both places.  Windows
of a place that none of those has can still occur elsewhere; they are counted by a 128-bit digest of
their words.  So an anchor at a million places makes a few million comparisons, not all their pairs, and no
repeat is lost.  The maximal repeats are the unions of neighbouring repeated windows.

Hashes only choose who is compared: what counts as a repeat is decided by words, or by their digest.
Documents with equal texts are one class, found by md5; only its first row goes through the steps
above.  Counts are combined before each shuffle.  An anchor at many places is dealt out in shares of about
SHARE places; the windows of each share's first places are counted with the rest, so shares need not meet.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import NOT_SPACE, Words, chunks, lists, run_hashes, signed, sliding_min, texts
from corpusmill.llm.store import partitions, written

#: words of an anchor: long enough that copies with scattered edits share few
ANCHOR = 12
#: documents with an anchor to a share of its places, places of a share that others are compared with
SHARE, HEADS = 1000, 4
#: the share of an anchor that has only one
ALONE = -1
#: windows whose anchors are looked for at a time
PART = 1 << 16
#: stands for a null doc_id between the steps
NO_ID = -(1 << 63)


def _owners(words: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word runs, and each window's anchor: the least hash among its runs."""
    runs = run_hashes(words, k)
    return runs, sliding_min(runs, length - k + 1)


def _places(words: np.ndarray, wanted: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Of each place of a wanted anchor: the anchor, the first window that it owns, how far behind that window's start it stands, and how many windows it owns."""
    runs, least = _owners(words, length, k)
    hot = np.flatnonzero(np.isin(least, wanted))
    if not len(hot):
        return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    view = np.lib.stride_tricks.sliding_window_view(runs, length - k + 1)
    at = np.concatenate([hot[i : i + PART] + view[hot[i : i + PART]].argmin(1) for i in range(0, len(hot), PART)])  # of equal runs the leftmost, as in every equal window
    begin = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(hot, prepend=-2) != 1))
    return runs[at[begin]], hot[begin], at[begin] - hot[begin], np.diff(np.append(begin, len(hot)))


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Closed ranges, joined where they touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_PLACED = {"doc_id": ("long", pa.int64()), "row": ("long", pa.int64()), "anchor": ("long", pa.int64()), "share": ("int", pa.int32()), "first": ("int", pa.int32()), "lead": ("int", pa.int32()), "windows": ("int", pa.int32()), "words": ("string", pa.string()), "text": ("string", pa.string())}
_MATCHES = {"doc_id": ("long", pa.int64()), "row": ("long", pa.int64()), "first": ("int", pa.int32()), "last": ("int", pa.int32()), "digest": ("binary", pa.binary())}


def _batch(rows: list[tuple], kind: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), kind.values(), strict=True)], list(kind))


def _common(own: list[str], lead: int, its: list[str], other_lead: int, windows: int, length: int) -> tuple[int, int]:
    """[first, after) of the windows of a place that lie in its match with another place, extended both ways from the anchor."""
    if lead == other_lead and own == its:
        return 0, windows
    left, right = 0, 0
    while left < min(lead, other_lead) and own[lead - left - 1] == its[other_lead - left - 1]:
        left += 1
    reach = min(len(own) - lead, len(its) - other_lead)
    while right < reach and own[lead + right] == its[other_lead + right]:
        right += 1
    a = lead - left
    b = min(windows, lead + right - length + 1)
    return (a, b) if a < b else (0, 0)


def repeats(df: DataFrame, length: int = 35, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a row of df: doc_id, n_words, n_removed, kept_sha256, removed (array of [first, after) word ranges).

    A word is removed if it lies in a window of `length` words whose sequence also starts at another
    place of the corpus.  Null text has no words; shorter documents lose nothing; copies lose every
    word, on every copy.  Rows with one doc_id but different texts are documents of their own.  Other
    columns are not carried; an empty table gives an empty table.
    """
    k = min(ANCHOR, length)
    docs = df.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.withColumn("copy", F.md5("text")).withColumn("row", F.xxhash64("text"))

    def seed(batches):
        for batch in batches:
            raw = texts(batch.column("text"))
            sizes, digests, anchors = [], [], []
            for first, last, data, offsets in chunks(raw):
                w = Words(data, offsets, NOT_SPACE, lower=False)
                body = data.tobytes()
                for i in range(last - first):
                    a, b = w.bounds[i], w.bounds[i + 1]
                    sizes.append(b - a)
                    digests.append(hashlib.sha256(b" ".join(body[offsets[i] : offsets[i + 1]].split())).hexdigest())
                    runs, least = _owners(w.hash[a:b], length, k)
                    # a value at two places of one document counts twice
                    values, n = np.unique(runs[np.isin(runs, np.unique(least))], return_counts=True) if len(least) else (least, least)
                    anchors.append(signed(np.concatenate([values, values[n > 1]])) if len(least) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), batch.column("copy"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), lists(anchors, pa.int64())], ["doc_id", "row", "copy", "n_words", "digest", "anchors"])

    base = written(docs.mapInArrow(seed, "doc_id long, row long, copy string, n_words long, digest string, anchors array<long>"), "seeds")
    classes = base.groupBy("copy").agg(F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"))

    # seeds: anchors at two places or more, of each class's first row
    seeds = base.filter("size(anchors) > 0").join(classes.select("copy", "doc_id"), ["copy", "doc_id"]).select("doc_id", "row", F.explode("anchors").alias("anchor"))
    hot = seeds.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor", F.expr(f"cast(ceil(n / {SHARE}) as int)").alias("shares"))
    hot_of = seeds.join(hot, "anchor").groupBy("doc_id", "row").agg(F.collect_set(F.struct("anchor", "shares")).alias("hot"))

    def place(batches):
        """Places of hot anchors with the words around them; windows that a document itself repeats; the texts that have any. Each in rows of their own."""
        for batch in batches:
            raw, hot_lists, docs_, rows_ = texts(batch.column("text")), batch.column("hot"), batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
            for first, last, data, offsets in chunks(raw):
                w = Words(data, offsets, NOT_SPACE, lower=False)
                body = data.tobytes()
                out = []
                for i in range(last - first):
                    anchors, shares = (x.to_numpy(False) for x in hot_lists[first + i].values.flatten())
                    order = np.argsort(anchors)
                    got = _places(w.hash[w.bounds[i] : w.bounds[i + 1]], anchors.view(np.uint64), length, k)
                    if not len(got[0]):
                        continue
                    doc, row = docs_[first + i], rows_[first + i]
                    words = body[offsets[i] : offsets[i + 1]].split()
                    once: dict = {}
                    again = []
                    for anchor, a, lead, n in zip(signed(got[0]).tolist(), *(x.tolist() for x in got[1:]), strict=True):
                        around = b" ".join(words[a : a + n + length - 1])
                        known = once.setdefault((anchor, around), (a, lead, n))
                        if known[0] != a:
                            again += [(a, a + n - 1), (known[0], known[0] + known[2] - 1)]
                    parts = shares[order[np.searchsorted(anchors, [x[0] for x in once], sorter=order)]]
                    salt = hash((doc, row))
                    out += [(doc, row, anchor, (salt + a) % m if m > 1 else ALONE, a, lead, n, around.decode(), None) for ((anchor, around), (a, lead, n)), m in zip(once.items(), parts.tolist(), strict=True)]
                    out += [(doc, row, None, None, a, None, b - a + 1, None, None) for a, b in _merged(again)]
                    out.append((doc, row, None, None, None, None, None, None, raw[first + i].as_py()))
                if out:
                    yield _batch(out, _PLACED)

    source = docs.select("doc_id", "row", "text").join(hot_of, ["doc_id", "row"])
    placed = written(source.mapInArrow(place, ", ".join(f"{c} {t}" for c, (t, _) in _PLACED.items())), "places")
    places = placed.filter("words is not null").select("anchor", "share", "doc_id", "row", "first", "lead", "windows", "words")
    dealt = places.repartition(partitions(df.sparkSession), "anchor", "share").sortWithinPartitions("anchor", "share", "doc_id", "row", "first")

    def extend(batches):
        """Ranges of windows that two places have in common, for both; digests of windows that a place has in common with none it was compared with."""
        name, heads = None, []
        for batch in batches:
            same, rest = set(), []
            for anchor, share, doc, row, first, lead, windows, words in zip(*(batch.column(c).to_pylist() for c in range(8)), strict=True):
                if (anchor, share) != name:
                    name, heads = (anchor, share), []
                left = windows  # windows not yet found elsewhere
                own, open_ = words.split(" "), np.ones(windows, bool)
                for other in heads:
                    a, b = _common(own, lead, other[3], other[4], windows, length)
                    if a < b:
                        same.add((doc, row, first + a, first + b - 1))
                        moved = other[2] + other[4] - lead
                        same.add((other[0], other[1], moved + a, moved + b - 1))
                        open_[a:b] = False
                        left = int(open_.sum())
                        if not left:
                            break
                if left:
                    # the first places of an anchor that has one share meet all others, so what they have in common is found there
                    if len(heads) == HEADS or share != ALONE:
                        rest += [(doc, row, first + s, first + s, hashlib.blake2b(" ".join(own[s : s + length]).encode(), digest_size=16).digest()) for s in np.flatnonzero(open_).tolist()]
                    if len(heads) < HEADS:
                        heads.append((doc, row, first, own, lead))
            if same or rest:
                yield _batch([*[(*x, None) for x in same], *rest], _MATCHES)

    matches = written(dealt.mapInArrow(extend, ", ".join(f"{c} {t}" for c, (t, _) in _MATCHES.items())), "matches")
    rest = matches.filter("digest is not null")
    twice = rest.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    certain = matches.filter("digest is null").select("doc_id", "row", "first", "last")
    inside = placed.filter("words is null and windows is not null").select("doc_id", "row", "first", (F.col("first") + F.col("windows") - 1).alias("last"))
    found = certain.unionByName(inside).unionByName(rest.join(twice, "digest").select("doc_id", "row", "first", "last")).groupBy("doc_id", "row").agg(F.collect_set(F.struct("first", "last")).alias("at"))

    def cut(batches):
        for batch in batches:
            removed, digests, ranges = [], [], []
            for t, at in zip(texts(batch.column("text")).to_pylist(), batch.column("at"), strict=True):
                words = t.encode().split()
                spans = at.values.flatten()
                gone = np.zeros(len(words) + 1, np.int64)
                np.add.at(gone, spans[0].to_numpy(), 1)
                np.add.at(gone, spans[1].to_numpy() + length, -1)
                out = np.cumsum(gone)[:-1] > 0
                turns = np.flatnonzero(np.diff(out, prepend=False, append=False))
                removed.append(int(out.sum()))
                digests.append(hashlib.sha256(b" ".join([words[j] for j in np.flatnonzero(~out)])).hexdigest())
                ranges.append(turns.reshape(-1, 2).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(ranges, pa.list_(pa.list_(pa.int64())))], ["doc_id", "row", "cut", "cut_digest", "ranges"])

    partly = placed.filter("text is not null").select("doc_id", "row", "text").join(found, ["doc_id", "row"])
    cuts = partly.mapInArrow(cut, "doc_id long, row long, cut long, cut_digest string, ranges array<array<long>>").dropDuplicates(["doc_id", "row"])
    copied = classes.filter("copies > 1").select("copy", F.lit(True).alias("copied"))
    whole = F.coalesce(F.col("copied"), F.lit(False)) & (F.col("n_words") >= length)
    return (
        base.drop("anchors")
        .join(copied, "copy", "left")
        .join(cuts, ["doc_id", "row"], "left")
        .select(
            F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"),
            "n_words",
            F.when(whole, F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0))).cast("long").alias("n_removed"),
            F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("cut_digest", "digest")).alias("kept_sha256"),
            F.when(whole, F.array(F.array(F.lit(0).cast("long"), F.col("n_words")))).otherwise(F.coalesce("ranges", F.array().cast("array<array<long>>"))).alias("removed"),
        )
    )
