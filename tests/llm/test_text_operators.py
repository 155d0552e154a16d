import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from corpusmill.llm import decontamination, jaccard, packing, substrings, token_counts
from tests.llm import brute
from tests.llm.conftest import BENCHMARK, DOCUMENTS
from tests.llm.thue import thue_morse


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def same(df, expected, *columns):
    assert rows(df, *columns) == sorted(map(tuple, expected), key=repr)


@pytest.mark.parametrize("length", [35, 12, 3])
def test_substrings(docs, length):
    same(substrings.repeats(docs, length), brute.substrings(DOCUMENTS, length), "doc_id", "n_words", "n_removed", "kept_sha256")


@pytest.mark.parametrize(("share", "heads"), [(1, 4), (2, 1), (1000, 1)])
def test_substrings_in_shares(docs, monkeypatch, share, heads):
    monkeypatch.setattr(substrings, "SHARE", share)
    monkeypatch.setattr(substrings, "HEADS", heads)
    same(substrings.repeats(docs, 35), brute.substrings(DOCUMENTS, 35), "doc_id", "n_words", "n_removed", "kept_sha256")


def test_substring_ranges(docs):
    for r in substrings.repeats(docs, 35).collect():
        assert sum(b - a for a, b in r.removed) == r.n_removed and all(0 <= a < b <= r.n_words for a, b in r.removed)


@pytest.mark.parametrize(("n", "num"), [(3, 90), (5, 80), (1, 50)])
def test_jaccard(docs, n, num):
    same(jaccard.jaccard_components(docs, n, num, 100), brute.jaccard(DOCUMENTS, n, num, 100), "doc_id", "n_shingles", "component_id")


def test_jaccard_large_buckets(docs, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 3)
    same(jaccard.jaccard_components(docs, 5, 80, 100), brute.jaccard(DOCUMENTS, 5, 80, 100), "doc_id", "n_shingles", "component_id")


LEVELS = {"divided": jaccard.levels, "one": lambda k: (k + 1, 0, 1), "two of three": lambda k: (k // 2 + 1, 1, 3), "two of four": lambda k: (k // 3 + 1, 2, 4)}


@pytest.mark.parametrize("levels", LEVELS.values(), ids=LEVELS)
def test_jaccard_schemes(levels):
    """Any two sets that are similar enough share a signature."""
    rng = np.random.default_rng(1)
    for num in (50, 80, 90):
        scheme = jaccard.Scheme(num, 100, levels)
        for size in [1, 2, 3, 5, 9, 10, 11, 19, 20, 40, 81, 90, 100, 400]:
            for _ in range(20):
                a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
                most = scheme.bound(2 * size)
                out, new = rng.integers(0, most + 1), rng.integers(0, most + 1)
                b = np.unique(np.concatenate([a[min(out, size - 1) :], rng.integers(0, 1 << 63, new).astype(np.uint64)]))
                both = len(np.intersect1d(a, b))
                if 100 * both < num * (len(a) + len(b) - both):
                    continue
                sigs = [set(jaccard.signatures(s, int(scheme.bands(np.array([len(s)]))[0]), scheme).tolist()) for s in (a, b)]
                assert sigs[0] & sigs[1], (num, len(a), len(b), both)
                marks = [np.frombuffer(jaccard.sketch(s), np.uint8) for s in (a, b)]
                assert (marks[0] != marks[1]).sum() <= len(a) + len(b) - 2 * both


def test_only_near_texts_are_verified(spark, monkeypatch):
    """Texts that share signatures with others, but are far from them by their sketches, are not read for the words."""
    rng = np.random.default_rng(5)
    body = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 1 << 40, n))
    shared = body(200)
    rows = [(i, f"{shared} {body(100)}") for i in range(40)] + [(100, both := body(1100)), (101, f"{both} end")]
    read, verified = [], jaccard._verified

    def seen(pairs, bodies, *more):
        read.append(bodies.count())
        return verified(pairs, bodies, *more)

    monkeypatch.setattr(jaccard, "_verified", seen)
    same(jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, 100), brute.jaccard(rows, 5, 80, 100), "doc_id", "n_shingles", "component_id")
    assert read and max(read) == 2


@pytest.mark.parametrize("names", [1, 16])
def test_pairs_of_a_family_are_proposed_once(spark, monkeypatch, names):
    """Texts a little below the similarity share many buckets: few of their pairs are proposed, and not once a bucket."""
    rng = np.random.default_rng(7)
    base, rows = [f"w{x}" for x in rng.integers(0, 1 << 40, 300)], []
    for i in range(40):
        words = list(base)
        for at in rng.choice(300, 4, replace=False).tolist():
            words[at] = f"v{i}x{at}"
        rows.append((i, " ".join(words)))
    proposed, stored = [], jaccard.stored

    def seen(df, name, **options):
        out = stored(df, name, **options)
        if name == "proposed":
            proposed.append([(r.a, r.b) for r in out[0].collect() if r.a is not None])
        return out

    monkeypatch.setattr(jaccard, "stored", seen)
    monkeypatch.setattr(jaccard, "NAMES", names, raising=False)
    same(jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80, 100), brute.jaccard(rows, 5, 80, 100), "doc_id", "n_shingles", "component_id")
    found = [len(p) for p in proposed]
    assert names < 16 or all(len(p) <= 2 * len(set(p)) for p in proposed), found
    assert names < 16 or sum(found) < 780, found


@pytest.mark.parametrize("size", [0, 1, 63, 64, 1000, 5000])
def test_folded_sketches(size):
    """A sketch is the same however it was folded, and never shows more differences than there are."""
    rng = np.random.default_rng(size)
    a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
    b = np.unique(np.concatenate([a[size // 9 :], rng.integers(0, 1 << 63, size // 3).astype(np.uint64)]))
    marks = [jaccard.opened(jaccard.sized_sketch(s)) for s in (a, b)]
    for parts in (4, 16, min(map(len, marks))):
        x, y = (jaccard.folded(m, parts) for m in marks)
        assert all((m == jaccard.opened(jaccard.sketch(s, parts))).all() for m, s in ((x, a), (y, b)))
        assert (x != y).sum() <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("levels", LEVELS.values(), ids=LEVELS)
def test_jaccard_links_are_the_same_by_every_subset_scheme(docs, monkeypatch, levels):
    monkeypatch.setattr(jaccard.Scheme.__init__, "__defaults__", (levels,))
    monkeypatch.setattr(jaccard, "COMBINED", 2)
    monkeypatch.setattr(jaccard, "SHARED", 2)
    same(jaccard.jaccard_components(docs, 3, 80, 100), brute.jaccard(DOCUMENTS, 3, 80, 100), "doc_id", "n_shingles", "component_id")


def test_combined_signatures():
    sig = np.array([5] * 70 + [7, 7, 9] + [5] * 3)
    own = np.array([*range(70), 1, 2, 3, 0, 1, 2])
    got = {(r["kind"], r["a"], r["b"]) for r in jaccard._combined(sig, own).to_pylist()}
    assert got == {(0, 7, 1), (0, 7, 2), (0, 9, 3), (0, 5, 0)} | {(1, 5, i) for i in range(70)} | {(2, 0, i) for i in range(1, 70)}


def test_words_that_polynomials_confuse(spark):
    """Texts of other words are neither repeats nor near copies, however alike their bytes are."""
    a, b = thue_morse(2048), thue_morse(2048, flip=True)
    filler = [f"w{i}" for i in range(34)]
    texts = [a, b, " ".join([*filler, a]), " ".join([*filler, b]), " ".join([a, b] * 20), " ".join([b, a] * 20 + ["x"]), " ".join(thue_morse(64)), " ".join(thue_morse(64, flip=True))]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(substrings.repeats(df, 35), brute.substrings(rows, 35), "doc_id", "n_words", "n_removed", "kept_sha256")
    same(jaccard.jaccard_components(df), brute.jaccard(rows, 3, 90, 100), "doc_id", "n_shingles", "component_id")


def test_null_ids_as_bridges(spark):
    """Documents that are linked only through one without id are one component."""
    words = [f"w{i}" for i in range(120)]
    variants = [" ".join(words), " ".join(words[:-5] + [f"x{i}" for i in range(5)]), " ".join([f"y{i}" for i in range(5)] + words[5:-5] + [f"x{i}" for i in range(5)])]
    for ids in ((5, 7, 9), (5, None, 9), (None, None, 9), (5, None, None)):
        df = spark.createDataFrame([*zip(ids, variants, strict=True), (None, variants[1])], "doc_id long, text string")
        found = jaccard.jaccard_components(df, 3, 80, 100).collect()
        assert {r.component_id for r in found} == {min(i for i in ids if i is not None)}, ids


def test_bucket_stream_is_the_same_however_it_is_cut():
    rng = np.random.default_rng(2)
    sig, own = np.sort(rng.integers(0, 30, 300)), rng.integers(0, 12, 300)
    order = np.lexsort((own, sig))
    sig, own = sig[order], own[order]
    results = []
    for step in (300, 7, 1):
        b, bucket, pairs = jaccard._Buckets(), set(), set()
        for at in range(0, 300, step):
            r, p = b.take(sig[at : at + step], own[at : at + step])
            bucket |= {(x["a"], x["b"]) for x in r.to_pylist()}
            pairs |= {(x["a"], x["b"]) for x in p.to_pylist()}
        results.append((bucket, pairs))
    groups = {s: set(own[sig == s].tolist()) for s in set(sig.tolist())}
    assert results[0][0] == {(s, o) for s, g in groups.items() if len(g) > 1 for o in g}
    assert results[0][1] == {(min(g), o) for g in groups.values() for o in g if o != min(g)}
    assert results[0] == results[1] == results[2]


def test_representatives(docs):
    stay = jaccard.representatives(docs)
    assert stay.columns == docs.columns
    expected = brute.jaccard(DOCUMENTS, 5, 80, 100)
    empty = Counter(d for (d, n, _) in expected if not n)
    groups = {root for _, n, root in expected if n}
    got = Counter(r.doc_id for r in stay.collect())
    assert got == empty + Counter(groups) + Counter({23: 1})  # 23 is the id of two texts, each alone


@pytest.mark.parametrize("block", [250_000, 3])
@pytest.mark.parametrize("n", [10, 3])
def test_decontamination(docs, benchmark, n, block):
    found = decontamination.decontaminate(docs, benchmark, n, block=block)
    same(found, brute.decontamination(DOCUMENTS, BENCHMARK, n), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_clean_of_benchmark(docs, benchmark):
    kept = decontamination.clean(docs, benchmark)
    hit = {d for d, *_, bad in brute.decontamination(DOCUMENTS, [(i, t) for i, t in BENCHMARK if i is not None]) if bad}
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, _ in DOCUMENTS if d not in hit)


@pytest.mark.parametrize("capacity", [4096, 64, 8])
def test_packing(docs, capacity, monkeypatch):
    monkeypatch.setattr(packing, "FAN", 2)
    path = public_tokenizers.path("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    unique = docs.filter("doc_id not in (23, 90)")  # ids of several rows
    ids = {r.doc_id: np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4") for r in unique.collect()}
    found = packing.pack(unique, path, 2, capacity).collect()
    whole, sequences = {}, {}
    for r in found:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        whole.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert whole.keys() == ids.keys()
    for spans, total in [(v, len(ids[k])) for k, v in whole.items()] + [(v, None) for v in sequences.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at and length > 0
            at += length
        assert at == total if total else at <= capacity
    assert len(sequences) * capacity <= 1.1 * sum(len(i) for i in ids.values()) + 2 * capacity


def test_packing_repeated_rows(docs):
    found = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2, 4096)
    assert found.filter("start = 0").count() == len(DOCUMENTS)


def test_harmonic_cuts():
    for n in (1, 7, 511, 512, 4095, 4096, 4097, 20000):
        parts = packing.cuts(n, 4096)
        assert sum(parts) == n and all(p > 0 and p * packing.count_of(p, 4096) <= 4096 for p in parts)


def test_token_counts(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    expected = [(d, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for d, t in DOCUMENTS]
    same(token_counts.token_counts(docs, path), expected, "doc_id", "n_bytes", "n_tokens", "over_limit")


def test_empty_tables(spark, docs, empty, benchmark):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert substrings.repeats(empty).count() == 0
    assert jaccard.jaccard_components(empty).count() == 0
    assert jaccard.representatives(empty).count() == 0
    assert decontamination.decontaminate(empty, benchmark).count() == 0
    assert packing.pack(empty, path, 2).count() == 0
    assert token_counts.token_counts(empty, path).count() == 0
    none = decontamination.decontaminate(docs, benchmark.limit(0))
    assert none.count() == len(DOCUMENTS) and none.filter("contaminated").count() == 0


def test_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(None, text), (7, text), (None, None), (None, "alone in here")], "doc_id long, text string")
    assert rows(substrings.repeats(docs), "doc_id", "n_removed") == sorted([(None, 50), (7, 50), (None, 0), (None, 0)], key=repr)
    assert rows(jaccard.jaccard_components(docs), "doc_id", "component_id") == sorted([(None, 7), (7, 7), (None, None), (None, None)], key=repr)
    assert packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2).filter("start = 0").count() == 4
