import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusmill.llm import kernels as K
from tests.llm import brute


def words(texts, table, lower):
    out = []
    for _, _, data, offsets in K.chunks(K.texts(pa.array(texts, pa.string()))):
        w = K.Words(data, offsets, table, lower)
        body = w.data.tobytes()
        for a, b in zip(w.bounds, w.bounds[1:], strict=False):
            out.append(([body[s:e].decode() for s, e in zip(w.start[a:b], w.end[a:b], strict=True)], w.hash[a:b].tolist()))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbZ09 \t\n\x0b\x1c\x85é🙂-_.'"), max_size=30)), max_size=8))
def test_words_are_the_patterns(texts):
    for table, lower, pattern in ((K.NOT_SPACE, False, brute.SPACE_WORDS), (K.ALNUM, True, brute.ALNUM_WORDS)):
        got = words(texts, table, lower)
        assert [g[0] for g in got] == [pattern.findall((t or "").translate(brute.LOWER) if lower else (t or "")) for t in texts]
        named = {}
        for found, hashes in got:
            for x, h in zip(found, hashes, strict=True):
                assert named.setdefault(x, h) == h
        assert len(set(named.values())) == len(named)


def test_hashes_do_not_depend_on_cuts(monkeypatch):
    texts = ["one two " * 50 + "x" * 300, None, "", "two one"] * 3
    whole = words(texts, K.NOT_SPACE, False)
    values = np.arange(1000, dtype=np.uint64) % np.uint64(7)
    runs = K.run_hashes(values, 5)
    monkeypatch.setattr(K, "CHUNK", 64)
    assert words(texts, K.NOT_SPACE, False) == whole
    assert (K.run_hashes(values, 5) == runs).all() and len(set(runs.tolist())) == 7


@pytest.mark.parametrize("w", [1, 2, 3, 5, 8, 24, 31])
def test_sliding_min(w):
    v = np.random.default_rng(w).integers(0, 99, 60)
    assert K.sliding_min(v, w).tolist() == [v[i : i + w].min() for i in range(61 - w)]
    assert len(K.sliding_min(v[: w - 1], w)) == len(K.run_hashes(v[: w - 1].astype(np.uint64), w)) == 0
