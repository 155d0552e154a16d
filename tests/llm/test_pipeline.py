from collections import Counter

import numpy as np
import public_tokenizers
import tokenizers

import corpus_pipeline
from corpusmill.llm import queries, toxicity
from tests.llm import brute
from tests.llm.conftest import BENCHMARK, DOCUMENTS


def test_queries_are_registered():
    names = [*queries.queries()]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 13)]
    assert queries.oracle_sql().keys() <= set(names)


def test_stages(spark, docs, tmp_path):
    spark.createDataFrame([(i, t) for i, t in BENCHMARK], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = [(d, 0, int(d == 23)) for d, _ in DOCUMENTS]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "packing"]
    by_row = lambda df: {r.row: r for r in df.collect()}
    step, seen, tables = docs, [], []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, step, str(tmp_path))
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/step{i}")
        before, step = step, spark.read.parquet(f"{tmp_path}/step{i}")
        seen.append({r.doc_id for r in step.select("doc_id").collect()})
        tables.append((by_row(before), None if i == 4 else by_row(step)))
    assert all(b <= a for a, b in zip(seen, seen[1:], strict=False))
    assert not seen[-1] & {6, 60} and {0, 1, 23, 24, 30, 70} <= seen[-1] | {30}
    # each stage on its own input, by brute force
    before, after = tables[0]
    weights = toxicity.fit(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))

    def score(text):
        words = set(brute.ALNUM_WORDS.findall((text or "").translate(brute.LOWER)))
        total = sum(weights[b] for b in {int(toxicity._buckets(toxicity._hash_of([w]))[0]) for w in words}) + weights[toxicity.WIDTH]
        return 1 / (1 + np.exp(-total))

    assert set(after) == {k for k, r in before.items() if not weights.any() or score(r.text) < toxicity.THRESHOLD} and all(after[k] == before[k] for k in after)
    before, after = tables[1]
    groups = brute.jaccard([(r.doc_id, r.text) for r in before.values()], 5, 80, 100)
    stays = Counter(d for d, n, _ in groups if not n) + Counter({root: 1 for _, n, root in groups if n})
    doubled = [r.doc_id for r in before.values() if r.doc_id == 23]  # two texts of one id, each alone
    assert Counter(r.doc_id for r in after.values()) == stays + Counter({23: len(doubled) - 1}) and all(after[k] == before[k] for k in after)
    before, after = tables[2]
    dirty = [d for d in brute.decontamination([(k, r.text) for k, r in before.items()], BENCHMARK, 10) if d[-1]]
    assert set(after) == set(before) - {d[0] for d in dirty} and dirty and all(after[k] == before[k] for k in after)
    before, after = tables[3]
    assert set(after) == set(before)
    value = "1eb9c654e721b4f812088970e66a6345cee33dd6"
    for k, r in before.items():
        hidden = (r.text or "").replace(value, "[secret]") if r.doc_id == 70 else r.text
        assert (after[k].text, after[k].n_chars) == (hidden, len(hidden) if r.doc_id == 70 else r.n_chars)
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 2]
    packed = step.collect()
    expected = Counter((r.doc_id, len(ids(r.text))) for r in after.values())
    assert Counter((r.doc_id, r.doc_tokens) for r in packed if r.start == 0) == expected
    assert sum(r.length for r in packed) == sum(n * c for (_, n), c in expected.items())
    filled: dict = {}
    for r in sorted(packed, key=lambda r: r.offset):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 4096
    ran = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in ran.collect()} == seen[-1]
