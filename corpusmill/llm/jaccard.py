"""N-gram Jaccard join by PartEnum signatures.

Sets whose sizes fit a Jaccard similarity of num/den lie in one size band or in neighbouring ones.
For a pair of bands the similarity bounds the symmetric difference by some k.  The feature domain is
hashed into n1 parts, and each of those into n2 smaller ones.  If n1 * (k2 + 1) > k, similar sets have a part in
which at most k2 of the smaller ones are spoiled by a difference, so they agree on some n2 - k2 of them:
every subset of that many is one signature.  Where k is small (short texts), k2 is 1 and n2 is 3; where
it is large, subsets of one undivided part (k2 = 0, n2 = 1) give the fewest signatures for their
selectivity, and a few parts more than needed are taken.  A subset without features is only a signature for the
rare set with so few parts that are not empty that it may have no other one in common.

A worker combines the signatures that it has itself seen in many sets: only one row of those goes on, so a
signature that a third of all documents share sends a row a buffer, not a row a document.  Signature rows
are dealt out by signature, sorted within partitions and streamed, so no bucket is held in memory.  Links
through the least set of each bucket are verified first and joined into components.  In buckets that still hold
several components, members of different ones are compared in tiles, by sketches that never reject a
similar pair; the nearest are verified and joined first, and so on until every pair of different components
that passes has been verified.  Nothing is capped or sampled.  Sketches come before words everywhere, so that only
the texts of sets that are near to another one are shuffled.

Sets are known by a 128-bit digest of their shingles' words, and pairs are verified on the words.
Signature rows carry a 64-bit name; sets that share one are told apart by their digests, and compared, after the
buckets.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Callable
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.components import components
from corpusmill.llm.kernels import BASES, CHUNK, NOT_SPACE, Words, chunks, mix, run_hashes, signed, texts
from corpusmill.llm.store import fresh_name, partitions, settled, written
from corpusmill.sources.scratch import removed, setting, stored

#: signature rows that a worker holds before it puts them out; sets from which on it combines a signature's rows
BUFFER, COMBINED = 1_000_000, 64
#: members of a tile, parts of a sketch and least parts of one that goes by its set's size, pairs that one copy of a first set's text is sent for
TILE, SKETCH, LEAST, SHARED = 512, 512, 64, 1000
#: lowest names of its buckets that a member brings to each of them, so that a pair goes on from the first bucket that both are known to share
NAMES = 16
#: a join with a stored table of any size is preceded by a Bloom filter of its keys, so that few other rows are shuffled
_BLOOM = "spark.sql.optimizer.runtime.bloomFilter."
_FILTERED = {_BLOOM + "enabled": "true", _BLOOM + "applicationSideScanSizeThreshold": "0", _BLOOM + "creationSideThreshold": "1g"}
#: the 48 bits of a signature that are shuffled: of billions of rows one in 100,000 meets a stranger, which sketches rule out
COMPARED = np.uint64(0xFFFFFFFFFFFF0000)
#: largest difference bound for which parts are divided
DIVIDED = 8
#: stands for a null doc_id between the steps
NO_ID = -(1 << 63)


def levels(k: int) -> tuple[int, int, int]:
    """(n1, k2, n2) for a difference bound of k."""
    if 0 < k <= DIVIDED:
        return k // 2 + 1, 1, 3
    return (math.ceil((k + 1) * 1.1) if k else 1), 0, 1


class Scheme:
    """Size bands, difference bounds and part counts for a similarity of num/den; `levels` gives (n1, k2, n2) of a bound."""

    def __init__(self, num: int, den: int, levels=levels):
        self.num, self.den, self.levels = num, den, levels
        self.last = [0]  # largest size of each band; band 0 is empty
        self.plans: dict[int, tuple] = {}

    def bands(self, sizes: np.ndarray) -> np.ndarray:
        top = int(sizes.max(initial=1))
        while self.last[-1] < top:
            self._grow()
        return np.searchsorted(np.array(self.last), sizes)

    def _grow(self) -> None:
        self.last.append(max(self.last[-1] + 1, (self.last[-1] + 1) * self.den // self.num))

    def bound(self, total):
        """Largest symmetric difference of similar sets whose sizes add up to total."""
        return (self.den - self.num) * total // (self.den + self.num)

    def of_band(self, band: int) -> tuple:
        """(parts, subsets, most) of the pairs whose larger set is in this band, or both in the one below: subsets holds each signature's parts, most how many parts may be full without two similar sets having a full signature in common."""
        if band not in self.plans:
            while len(self.last) <= band:
                self._grow()
            k = self.bound(self.last[band - 1] + self.last[band])
            n1, k2, n2 = self.levels(k)
            assert n1 * (k2 + 1) > k and n2 > k2
            chosen = np.array(list(itertools.combinations(range(n2), n2 - k2)))
            subsets = (np.arange(n1)[:, None, None] * n2 + chosen).reshape(-1, n2 - k2)
            self.plans[band] = (n1 * n2, subsets, k // (k2 + 1) * n2 + k % (k2 + 1))
        return self.plans[band]


def shingle_sets(column: pa.Array, n: int, named: bool = False) -> list:
    """Sorted distinct hashes of the n-word shingles of each text; the whole of a shorter text is one. With named, (hashes, digest of the words)."""
    out = []
    for first, last, data, offsets in chunks(column):
        w = Words(data, offsets, NOT_SPACE, lower=True)
        for i in range(last - first):
            a, b = int(w.bounds[i]), int(w.bounds[i + 1])
            size = min(n, b - a)
            features, at = np.unique(run_hashes(w.hash[a:b], size) if size else w.hash[a:b], return_index=True)
            out.append((features, _digest(w, a + at, size) if size else b"") if named else features)
    return out


def _digest(w: Words, at: np.ndarray, n: int) -> bytes:
    """128 bits of the words of the shingles that begin at these words, in this order."""
    h = hashlib.blake2b(digest_size=16)
    part = max(1, CHUNK // (8 * n))
    for i in range(0, len(at), part):
        words = (at[i : i + part, None] + np.arange(n)).ravel()
        start, size = w.start[words], w.end[words] - w.start[words] + 1
        ends = np.cumsum(size)
        if ends[-1] > 16 * CHUNK:  # long words: one by one
            for s, e in zip(w.start[words].tolist(), w.end[words].tolist(), strict=True):
                h.update(w.data[s:e].tobytes() + b" ")
            continue
        # steps of one byte, and jumps from word to word; each word ends with a byte that becomes a space
        place = np.ones(int(ends[-1]), np.int64)
        place[0] = start[0]
        place[ends[:-1]] = start[1:] - (start[:-1] + size[:-1] - 1)
        place = np.cumsum(place)
        body = w.data[np.minimum(place, len(w.data) - 1)]
        body[ends - 1] = 0x20
        h.update(body.tobytes())
    return h.digest()


def set_id(features: np.ndarray) -> int:
    """64 bits of a set's features; never 0, which stands for the empty set. Sets that share them have equal signatures or are told apart by their digests."""
    return (int.from_bytes(hashlib.blake2b(features.tobytes(), digest_size=8).digest(), "little", signed=True) or 1) if len(features) else 0


def signatures(features: np.ndarray, band: int, scheme: Scheme) -> np.ndarray:
    out = []
    low, high = (features & np.uint64(0xFFFFFFFF)).astype(np.float64), (features >> np.uint64(32)).astype(np.float64)
    place = mix(features ^ np.uint64(BASES[1]))
    for b in (band, band + 1):
        parts, subsets, most = scheme.of_band(b)
        part = (place % np.uint64(parts)).astype(np.int64)
        sizes = np.bincount(part, minlength=parts)
        sums = np.bincount(part, low, parts).astype(np.uint64) * np.uint64(BASES[0]) + np.bincount(part, high, parts).astype(np.uint64) * np.uint64(BASES[1])
        own = mix(sums + mix(np.arange(parts, dtype=np.uint64) + np.uint64(parts << 20)))
        h = mix(own[subsets].sum(1, dtype=np.uint64) + mix(np.arange(len(subsets), dtype=np.uint64) + np.uint64(b * BASES[2] & 0xFFFFFFFFFFFFFFFF)))
        out.append(h[sizes[subsets].any(1)] if np.count_nonzero(sizes) > most else h)
    return np.concatenate(out)


def sketch(features: np.ndarray, parts: int = SKETCH) -> bytes:
    """Two bits for each of a power of two of parts of the domain, of four quarters in a byte: whether either half of the part holds an odd number of features. Each unlike bit is due to a feature of its own, so their number never exceeds the symmetric difference."""
    place = mix(features ^ np.uint64(BASES[0]))
    odd = np.bincount((place & np.uint64(parts - 1)).astype(np.int64) * 2 + (place >> np.uint64(40) & np.uint64(1)).astype(np.int64), minlength=2 * parts).astype(np.uint8) & 1
    return packed(odd[::2] | odd[1::2] << 1).tobytes()


def packed(marks: np.ndarray) -> np.ndarray:
    """A sketch's parts, four quarters in a byte."""
    x = marks.reshape(4, -1)
    return x[0] | x[1] << 2 | x[2] << 4 | x[3] << 6


def opened(marks: bytes) -> np.ndarray:
    """A sketch's parts, one in a byte."""
    x = np.frombuffer(marks, np.uint8)
    return np.concatenate([x & 3, x >> 2 & 3, x >> 4 & 3, x >> 6])


def sized_sketch(features: np.ndarray) -> bytes:
    """A sketch of more parts than the set has features, and no more than twice as many, LEAST at least: with fewer, sets a little below the similarity would pass, and in a large group of such sets these pairs grow with its square."""
    return sketch(features, max(LEAST, 1 << len(features).bit_length()))


def folded(marks: np.ndarray, parts: int) -> np.ndarray:
    """A sketch's parts as they would be with fewer of them."""
    while len(marks) > parts:
        half = len(marks) // 2
        marks = marks[:half] ^ marks[half:]
    return marks


_ROWS = "a long, b long, pair boolean"
#: kinds of rows that workers put out: (signature, set) to be met with others; members of a signature that was combined; pairs of its least set and the others
PLAIN, MEMBER, PAIR = 0, 1, 2


def _combined(sig: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
    """Rows (kind, a, b). A signature of more than COMBINED sets goes on as one row; its members and their pairs with the least one are put out at once."""
    sig, own = _distinct(sig, own)
    begin = np.flatnonzero(np.diff(sig, prepend=sig[0] - 1 if sig[0] > np.iinfo(np.int64).min else sig[0] + 1) != 0)
    count = np.diff(np.append(begin, len(sig)))
    hot = np.repeat(count > COMBINED, count)
    leads = begin[count > COMBINED]
    least = np.repeat(own[leads], count[count > COMBINED])
    x, y = least[least != own[hot]], own[hot][least != own[hot]]
    if len(x):
        x, y = _distinct(x, y)
    a = np.concatenate([sig[~hot], sig[leads], sig[hot], x])
    b = np.concatenate([own[~hot], own[leads], own[hot], y])
    kind = np.repeat(np.array([PLAIN, MEMBER, PAIR], np.int8), [int((~hot).sum()) + len(leads), int(hot.sum()), len(x)])
    return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(a), pa.array(b)], ["kind", "a", "b"])


def _rows(a: np.ndarray, b: np.ndarray, pair: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(np.full(len(a), pair), pa.bool_())], ["a", "b", "pair"])


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[fresh], b[fresh]


class _Buckets:
    """Rows (signature, set) sorted by both come in batch by batch; pairs of each bucket's least set with its others go out, and the rows of buckets of several sets. Only the last row is carried over."""

    def __init__(self):
        self.sig = self.own = self.least = None
        self.told = False  # the carried bucket's least set has been put out

    def take(self, a: np.ndarray, b: np.ndarray) -> tuple[pa.RecordBatch, pa.RecordBatch]:
        old = self.sig is not None and a[0] == self.sig
        fresh = np.ones(len(a), bool)
        fresh[1:] = a[1:] != a[:-1]
        leads = b[fresh]
        if old:
            leads[0] = self.least
        least = leads[np.cumsum(fresh) - 1]
        again = np.zeros(len(a), bool)
        again[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        again[0] = old and b[0] == self.own
        other = np.flatnonzero(~again & (b != least))
        lead_sig, where = np.unique(a[other], return_index=True)
        lead = least[other[where]]
        untold = ~((lead_sig == a[0]) & (old and self.told))
        self.told = bool((a[other] == a[-1]).any()) or (old and self.told and a[-1] == a[0])
        self.sig, self.own, self.least = a[-1], b[-1], least[-1]
        rows = _rows(np.concatenate([a[other], lead_sig[untold]]), np.concatenate([b[other], lead[untold]]), False)
        return rows, _rows(*_distinct(least[other], b[other]), True)


def jaccard_components(df: DataFrame, n: int = 3, num: int = 90, den: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a row of df: doc_id, row (xxhash64 of the text, null as empty), n_shingles, set_id, component_id.

    Words are runs of other than ASCII white space, A-Z taken as a-z.  A document's set holds its distinct n-word
    shingles; with fewer words it is the whole sequence, with none it is empty and linked with nothing.
    Sets link when den * intersection >= num * union.  component_id is the smallest doc_id reachable by
    links, the document's own where there is none.  Null text counts as empty; equal rows get equal
    results; documents without doc_id link others as any do, and their ids are no smaller than any other; other columns are not carried; an empty table
    gives an empty table.

    The result is written; the tables between the steps are removed then, those of a round when the next is done.
    """
    return settled(df.sparkSession, "jaccard", lambda: _components_of(df, n, num, den, doc_id, text))


def _components_of(df: DataFrame, n: int, num: int, den: int, doc_id: str, text: str) -> DataFrame:
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("row", F.xxhash64("text"))
    spark = df.sparkSession

    def describe(batches):
        for batch in batches:
            sets = shingle_sets(texts(batch.column("text")), n, named=True)
            columns = [pa.array([len(s) for s, _ in sets], pa.int64()), pa.array([set_id(s) for s, _ in sets], pa.int64()), pa.array([k for _, k in sets], pa.binary()), pa.array([sized_sketch(s) for s, _ in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), *columns], ["doc_id", "row", "n_shingles", "set_id", "key", "sketch"])

    def sign(batches):
        scheme, sigs, owns, held, seen = Scheme(num, den), [], [], 0, set()
        for batch in batches:
            for s in shingle_sets(texts(batch.column("text")), n):
                own = set_id(s)
                if not own or own in seen:
                    continue
                seen.add(own)
                got = signatures(s, int(scheme.bands(np.array([len(s)]))[0]), scheme)
                sigs.append(signed(got & COMPARED))
                owns.append(np.full(len(got), own, np.int64))
                held += len(got)
                if held >= BUFFER:
                    yield _combined(np.concatenate(sigs), np.concatenate(owns))
                    sigs, owns, held, seen = [], [], 0, set()
        if held:
            yield _combined(np.concatenate(sigs), np.concatenate(owns))

    def gather(batches):
        buckets = _Buckets()
        for batch in batches:
            kind, a, b = (batch.column(c).to_numpy(False) for c in ("kind", "a", "b"))
            plain = kind == PLAIN
            if plain.any():
                yield from buckets.take(a[plain], b[plain])
            if not plain.all():
                yield pa.RecordBatch.from_arrays([pa.array(a[~plain]), pa.array(b[~plain]), pa.array(kind[~plain] == PAIR)], ["a", "b", "pair"])

    dealt = F.when(F.col("kind") == PLAIN, F.col("a")).otherwise(F.col("b"))
    spread = docs.select("text").mapInArrow(sign, "kind byte, a long, b long").repartition(partitions(spark), dealt).sortWithinPartitions("kind", "a", "b")
    rows = written(spread.mapInArrow(gather, _ROWS), "buckets")
    buckets = rows.filter("not pair").select(F.col("a").alias("sig"), F.col("b").alias("id"))
    base = written(docs.mapInArrow(describe, "doc_id long, row long, n_shingles long, set_id long, key binary, sketch binary"), "sets")

    # each set once, with a document that has it; of those in any pair or bucket, the sketch
    known_id = F.coalesce("doc_id", F.lit(NO_ID))
    sets = written(base.filter("set_id <> 0").groupBy("key").agg(F.min("set_id").alias("id"), F.min("doc_id").alias("least"), F.min(F.struct(known_id.alias("doc"), "row")).alias("at")), "distinct-sets")
    doubtful = sets.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("id").alias("a"), F.col("id").alias("b"))
    pairs = written(rows.filter("pair").select("a", "b").distinct().unionByName(doubtful), "pairs")
    involved = buckets.select("id").union(pairs.select("a")).union(pairs.select("b")).distinct()
    sketched = base.filter("set_id <> 0").select("key", F.col("set_id").alias("id"), F.col("n_shingles").alias("size"), "sketch")
    facts = written(sketched.join(involved, "id").select("key", "id", "size", "sketch").dropDuplicates(["key"]), "sketches")

    def confirm(batches):
        for batch in batches:  # a doc_id may have several texts
            found = [k for _, k in shingle_sets(texts(batch.column("text")), n, named=True)]
            yield batch.filter(pa.array([x == y for x, y in zip(found, batch.column("key").to_pylist(), strict=True)], pa.bool_()))

    def bodies(pairs: DataFrame) -> DataFrame:
        """(key, id, text) of the sets of these pairs."""
        named = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        chosen = written(sets.join(named, "id").select("key", "id", "at.doc", F.col("at.row").alias("row")), "chosen")
        found = docs.select(known_id.alias("doc"), "row", "text").join(chosen.filter("id <> 0"), ["doc", "row"]).select("key", "id", "text")
        with ExitStack() as held:
            for key, value in _FILTERED.items():
                held.enter_context(setting(spark, key, value))
            return written(found.mapInArrow(confirm, "key binary, id long, text string").dropDuplicates(["key"]), "bodies")

    near = written(_near(pairs, facts, num, den), "near")
    known = components(_verified(near, bodies(near), n, num, den))
    known = _widened(buckets, known, facts, bodies, n, num, den)

    placed = sets.select("key", "least").join(known, "key", "left").select("key", "least", F.coalesce("component", "key").alias("component"))
    roots = placed.groupBy("component").agg(F.min("least").alias("root"))
    of_set = placed.join(roots, "component").select("key", "root")
    return base.join(of_set, "key", "left").select("doc_id", "row", "n_shingles", "set_id", F.coalesce("root", "doc_id").alias("component_id"))


def representatives(df: DataFrame, n: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of df that stay if of each group of linked documents the one with the smallest doc_id does; columns as they are.

    Texts without words are linked with nothing and stay, repeated rows too.  Of rows with that doc_id and equal
    texts one stays.  Rows without doc_id stay unless a row with one has an equal set.
    """
    found = jaccard_components(df, n, num, den, doc_id, text)
    found = found.withColumn("empty", F.col("set_id") == 0)
    stays = found.filter(F.col("empty") | F.col("doc_id").eqNullSafe(F.col("component_id")))
    key, mark, doc, row, bare, n_rows = (fresh_name(c, df.columns) for c in ("text_hash", "single", "stays_id", "stays_hash", "bare", "n_rows"))
    stays = stays.groupBy(F.col("doc_id").alias(doc), F.col("row").alias(row), F.col("empty").alias(bare)).agg(F.count("*").alias(n_rows))
    rows = df.withColumn(key, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    same = rows[doc_id].cast("long").eqNullSafe(stays[doc]) & (rows[key] == stays[row])
    rows = rows.join(stays, same).withColumn(mark, F.col(bare) | (F.col(n_rows) == 1))
    rows = rows.filter(mark).unionByName(rows.filter(~F.col(mark)).dropDuplicates([doc_id, key]))
    return rows.select(*df.columns)


def _shingles(text: str, n: int) -> set[bytes]:
    words = text.encode().lower().split()
    n = min(n, len(words))
    return {b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def _verified(pairs: DataFrame, bodies: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(a, b): the digests of the sets of these pairs of 64-bit names that are similar, on their words.

    Pairs are dealt out by their first set, at most about SHARED to a share, and sorted so that the first set's text comes once, before the others'.
    """
    shares = pairs.groupBy("a").agg(F.expr(f"cast(ceil(count(*) / {SHARED}) as int)").alias("shares"))
    share = F.pmod(F.xxhash64("b"), F.col("shares")).cast("int").alias("share")
    others = pairs.join(shares, "a").select("a", share, "b").join(bodies.select(F.col("id").alias("b"), "key", "text"), "b").select("a", "share", F.lit(False).alias("first"), "key", "text")
    firsts = shares.join(bodies.select(F.col("id").alias("a"), "key", "text"), "a").select("a", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(True).alias("first"), "key", "text")
    dealt = firsts.unionByName(others).repartition(partitions(pairs.sparkSession), "a", "share").sortWithinPartitions("a", "share", F.desc("first"))

    def check(batches):
        name, held = None, []
        for batch in batches:
            out = []
            for a, share, first, key, text in zip(*(batch.column(c) for c in ("a", "share", "first", "key", "text")), strict=True):
                if (a, share) != name:
                    name, held = (a, share), []
                key, x = key.as_py(), _shingles(text.as_py(), n)
                if first.as_py():
                    held.append((key, x))
                    continue
                for k, y in held:
                    if k != key and num * max(len(x), len(y)) <= den * min(len(x), len(y)):
                        both = len(x & y)
                        if den * both >= num * (len(x) + len(y) - both):
                            out.append((k, key))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary())], ["a", "b"])

    return dealt.mapInArrow(check, "a binary, b binary")


def _near(pairs: DataFrame, facts: DataFrame, num: int, den: int) -> DataFrame:
    """Those of these pairs of 64-bit names whose sizes and sketches don't rule out that they are similar."""
    side = lambda c: facts.select(F.col("id").alias(c), F.struct("size", "sketch").alias(f"of_{c}"))

    def compare(batches):
        for batch in batches:
            sizes = [batch.column(c).field("size").to_numpy() for c in ("of_a", "of_b")]
            marks = [batch.column(c).field("sketch").to_pylist() for c in ("of_a", "of_b")]
            fits = num * np.maximum(*sizes) <= den * np.minimum(*sizes)
            most = (den - num) * (sizes[0] + sizes[1]) // (den + num)
            for i in np.flatnonzero(fits).tolist():
                x, y = opened(marks[0][i]), opened(marks[1][i])
                parts = min(len(x), len(y))
                fits[i] = np.bitwise_count(folded(x, parts) ^ folded(y, parts)).sum() <= most[i]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(fits))

    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(compare, "a long, b long").distinct()


def _widened(buckets: DataFrame, known: DataFrame, facts: DataFrame, bodies: Callable[[DataFrame], DataFrame], n: int, num: int, den: int) -> DataFrame:
    """(key, component) of all sets in facts (key, id, size, sketch), from the components of some of the links (id, component), and the buckets (sig, id); bodies() gives the texts of pairs.

    Members of different components that share a bucket are compared by sketches.  Each proposes its nearest ones, which
    are verified and joined, and so on with eight times as many, until no bucket has an unproposed pair of
    different components: a large group of near copies is joined along its nearest links, never by all its pairs.
    """

    known = written(facts.select("key", "id").join(known.select(F.col("id").alias("key"), "component"), "key", "left").withColumn("component", F.coalesce("component", "key")), "components")
    # the rows of all buckets are many: they meet their sets' components at once, and repeated ones go with those of buckets of one component
    placed = buckets.join(known, "id").select("sig", "key", "component")
    take, spent, read = 1, [], None
    while True:
        mixed = placed.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n")).filter("low <> high")
        members, at = stored(placed.join(mixed.select("sig", "n"), "sig").select("sig", "key", "component", "n").distinct().withColumn("sig", F.col("sig").cast("string")), "members", compression="zstd")
        for path in spent:  # what the round before has left: this round's members were its last reader
            removed(facts.sparkSession, path)
        grouped, proposed = _proposed(members, facts, num, den, take)
        proposed, of_round = stored(proposed, "proposed", compression="zstd")
        spent = [at, of_round]
        if proposed.filter("a is not null").isEmpty():
            return known.select("key", "component")
        pairs = proposed.filter("a is not null").select("a", "b").distinct()
        # whoever has a near set in another component proposes its nearest at once: later rounds name no others
        read = bodies(pairs) if read is None else read
        links = _verified(pairs, read, n, num, den)
        of = lambda side: known.select(F.col("key").alias(side), F.col("component").alias(f"c{side}"))
        wider = components(links.join(of("a"), "a").join(of("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        known = known.join(wider.select(F.col("id").alias("component"), F.col("component").alias("wider")), "component", "left")
        known = written(known.select("key", "id", F.coalesce("wider", "component").alias("component")), "components")
        # buckets all of whose pairs have been proposed are done with
        more = proposed.filter("a is null").select("sig")
        if more.isEmpty():
            return known.select("key", "component")
        members, take = grouped.join(more.distinct(), "sig", "left_semi"), take * 8
        placed = members.join(known.select("key", "component"), "key")


def _proposed(members: DataFrame, facts: DataFrame, num: int, den: int, take: int) -> tuple[DataFrame, DataFrame]:
    """(sig, key) of the buckets, small ones with equal members as one; and (sig, a, b): pairs of 64-bit names from different components that share a bucket and that sketches don't rule out, `take` of the nearest for each member. A row without a and b tells that the bucket has others.
    A pair comes from the first bucket, by name, that its members are known to share (NAMES): in most cases once, not once a bucket.

    members: sig, key, component, n (members of the bucket, repeated rows counted; it only tells which way the bucket goes).  A bucket's larger components have tiles of their own,
    the small ones share some, and two tiles of one component never meet: a bucket of one large component and a few
    other sets costs a row a member, not a row a member and tile.
    """
    # small buckets with the same members are one group
    few = members.filter(f"n <= {TILE}").groupBy("sig").agg(F.array_sort(F.collect_set("key")).alias("m")).select(F.md5(F.concat_ws("", F.transform("m", F.hex))).alias("meet"), "m").dropDuplicates(["meet"]).select("meet", F.explode("m").alias("key")).select(F.col("meet").alias("sig"), "meet", "key", F.lit(0).alias("own"))
    many = members.filter(f"n > {TILE}")
    tiled = None if many.isEmpty() else _tiled(many)

    def compare(table: pa.Table) -> pa.Table:
        ids, own, size = (table.column(c).to_numpy() for c in ("id", "own", "size"))
        comp = np.unique(table.column("component").to_numpy(), return_inverse=True)[1]
        marks = table.column("sketch").to_pylist()
        parts = np.array([4 * len(m) for m in marks])
        same = {p: np.stack([packed(folded(opened(m), p)) if 4 * len(m) >= p else np.zeros(p // 4, np.uint8) for m in marks]).view(np.uint64) for p in np.unique(parts).tolist()}
        right = np.flatnonzero(own != 1)
        x, y, far = [], [], []
        for i in np.flatnonzero(own != 2):
            j = right[(comp[right] != comp[i]) & (num * np.maximum(size[right], size[i]) <= den * np.minimum(size[right], size[i]))]
            if own[i] == 0:
                j = j[j > i]
            if len(j):
                apart, least = np.zeros(len(j), np.int64), np.minimum(parts[j], parts[i])
                for p in np.unique(least).tolist():
                    apart[least == p] = np.bitwise_count(same[p][j[least == p]] ^ same[p][i]).sum(1, dtype=np.int64)
                near = apart <= (den - num) * (size[j] + size[i]) // (den + num)
                x.append(np.full(int(near.sum()), i))
                y.append(j[near])
                far.append(apart[near])
        x, y, far = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (x, y, far))
        # each member's pairs by nearness; a pair goes on if it is among the first of either side
        ends, pair = np.concatenate([x, y]), np.tile(np.arange(len(x)), 2)
        order = np.lexsort((pair, np.tile(far, 2), ends))
        begin = np.flatnonzero(np.diff(ends[order], prepend=-1) != 0)
        rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
        kept = np.unique(pair[order][rank < take])
        more = [None] * (len(kept) < len(x))
        # a pair that shares a bucket of a lower name goes on from there, or that bucket has more
        name, names = table.column("name")[0].as_py(), {i: set(table.column("names")[i].as_py()) for i in np.unique([x[kept], y[kept]]).tolist()}
        kept = kept[[min(names[i] & names[j], default=name) >= name for i, j in zip(x[kept].tolist(), y[kept].tolist(), strict=True)]] if len(kept) else kept
        a, b = ids[x[kept]], ids[y[kept]]
        return pa.table({"sig": pa.array([table.column("sig")[0].as_py()] * (len(kept) + len(more)), pa.string()), "a": pa.array([*np.minimum(a, b).tolist(), *more], pa.int64()), "b": pa.array([*np.maximum(a, b).tolist(), *more], pa.int64())})

    grouped = few.select("sig", "key") if tiled is None else few.select("sig", "key").unionByName(many.select("sig", "key"))
    name = F.xxhash64("sig").alias("name")
    names = grouped.select("key", name).groupBy("key").agg(F.slice(F.array_sort(F.collect_set("name")), 1, NAMES).alias("names"))
    of_key = members.select("key", "component").distinct().join(facts, "key").join(names, "key")
    described = (few if tiled is None else few.unionByName(tiled)).select("meet", "key", "own", "sig", name).join(of_key, "key")
    return grouped, described.groupBy("meet").applyInArrow(compare, "sig string, a long, b long")


def _tiled(many: DataFrame) -> DataFrame:
    """(sig, meet, key, own): members of large buckets in each meeting of two tiles; own is 0 where a tile meets itself, else 1 or 2 by side."""
    sized = many.groupBy("sig", "component").agg(F.count("*").alias("n")).withColumn("part", F.when(F.col("n") >= TILE, F.col("component")).otherwise(F.lit(b"")))
    parts = sized.groupBy("sig", "part").agg(F.expr(f"cast(ceil(sum(n) / {TILE}) as int)").alias("tiles"))
    placed = many.join(sized.select("sig", "component", "part"), ["sig", "component"]).join(parts, ["sig", "part"]).select("sig", "key", "part", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int").alias("tile"))
    tiles = parts.select("sig", "part", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    there = tiles.select("sig", F.col("part").alias("to_part"), F.col("tile").alias("to_tile"))
    apart = (F.col("part") < F.col("to_part")) | ((F.col("part") == F.col("to_part")) & (F.col("part") == F.lit(b"")) & (F.col("tile") <= F.col("to_tile")))
    meets = tiles.join(there, "sig").filter(apart).withColumn("meet", F.concat_ws("/", "sig", F.hex("part"), "tile", F.hex("to_part"), "to_tile"))
    alone = (F.col("part") == F.col("to_part")) & (F.col("tile") == F.col("to_tile"))
    here = meets.select("sig", "part", "tile", "meet", F.when(alone, 0).otherwise(1).alias("own"))
    other = meets.filter(~alone).select("sig", F.col("to_part").alias("part"), F.col("to_tile").alias("tile"), "meet", F.lit(2).alias("own"))
    return placed.join(here.unionByName(other), ["sig", "part", "tile"]).select("sig", "meet", "key", "own")
