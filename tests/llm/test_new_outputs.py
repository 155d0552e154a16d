"""Source divergence and token files, against plain restatements and the files themselves."""

import random

import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from corpusmill.llm import divergence, token_files
from corpusmill.sources.scratch import folder
from tests.llm import brute
from tests.llm.conftest import DOCUMENTS

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _sources() -> list[tuple]:
    rng = random.Random(5)
    words = ["alpha", "BETA", "b\u00e9ta", "\u0130stanbul", "\u212aelvin", "stra\u00dfe", "don't", "x1y2", "z" * 3000, "\u65e5\u672c", "\U0001f600", "\ue000"]
    out = [(" ".join(rng.choices(words, k=rng.randrange(40))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s10", "", None, "\u00e9", "\U0001f600", "\uffff"])) for _ in range(150)]
    out += [(None, "en", "silent"), ("!!! 123", "en", "digits"), ("", None, None), ("one two three", "few", "a"), ("one", "few", "b"), ("lone lone lone", "alone", "a")]
    out += [("tie tie", "tied", "a"), ("tie", "tied", "b"), ("tie", "tied", "c"), ("odd", "tied", "c")] * 3
    out += [("alpha copy", "en", "hot")] * 200 + [("word " * 30000 + "end", "en", "long")]
    return out


@pytest.mark.parametrize(("at_least", "top"), [(3, 200), (1, 3), (1000, 200)])
def test_divergence(spark, at_least, top):
    made = _sources()
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in made], "text string, lang string, source string, count int, at int, term string").repartition(7)
    assert rows(divergence.divergence(df, at_least, top)) == sorted(brute.divergence(made, at_least, top), key=repr)


def test_divergence_of_nothing(docs, empty):
    assert divergence.divergence(empty).collect() == []
    assert [x[0] for x in divergence.divergence(docs).dtypes] == ["lang", "source", "part", "item", "value", "rank"]


def test_scaled_shares_stay_exact(spark):
    for count, of in ((0, 1), (9_223_372_034, 9_223_372_037), (9_223_372_036, 9_223_372_037), (10**15 + 1, 3 * 10**15), (10**17, 10**17 + 1)):
        assert spark.range(1).select(F.lit(count).cast("long").alias("c"), F.lit(of).cast("long").alias("n")).select(divergence.scaled("c", "n")).first()[0] == 1 + 10**9 * (count + 1) // of


@pytest.mark.parametrize(("row", "batch"), [(token_files.ROW, token_files.BATCH), (7, 50)])
def test_token_files(spark, docs, monkeypatch, row, batch):
    monkeypatch.setattr(token_files, "ROW", row)
    monkeypatch.setattr(token_files, "BATCH", batch)
    known = {}
    made = [(d, known.setdefault(d, t)) for d, t in [*DOCUMENTS, (None, "no id"), (None, "no id")]]
    df = spark.createDataFrame([(*m, 0, b"x", 1) for m in made], "doc_id long, text string, at int, ids binary, part int").repartition(5)
    tok = tokenizers.Tokenizer.from_file(BYTES)
    expected = brute.token_files(made, lambda t: tok.encode(t, add_special_tokens=False).ids, 0)
    assert rows(token_files.written_and_read(df, BYTES, 0)) == sorted(expected, key=repr)


def test_documents_of_one_id_with_different_texts(spark):
    df = spark.createDataFrame([(1, f"text {i % 50}") for i in range(400)], "doc_id long, text string").repartition(6)
    got = sorted(token_files.written_and_read(df, BYTES, 0).collect(), key=lambda r: r.start)
    assert len(got) == 400 and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:])) and got[0].start == 0


def test_token_files_of_nothing(empty):
    assert token_files.written_and_read(empty, BYTES, 0).collect() == []


def test_checksums_of_parts():
    import zlib

    for a, b in ((b"", b""), (b"a", b""), (b"", b"bc"), (b"some bytes", b"and more" * 999)):
        assert token_files.carried(zlib.crc32(a), len(b)) ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_files_have_stripes_indexes_and_filters(spark):
    """Ids in order over files and stripes, runs smaller than the integers, Bloom filters on ids, and a filter that reads few rows."""
    path = f"{folder(spark)}/token-files-test"
    text = F.sha2(F.col("id").cast("string"), 512)
    token_files.write(spark.range(40000).select((F.col("id") * 3).alias("doc_id"), text.alias("text")), path, BYTES, 0, stripe=1 << 18, files=3)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = sorted(s.getPath().toString() for s in jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf).listStatus(jvm.org.apache.hadoop.fs.Path(path)) if s.getPath().getName().endswith(".orc"))
    assert len(found) == 3
    last, stripes, size = -1, 0, 0
    for f in found:
        reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(f), jvm.org.apache.orc.OrcFile.readerOptions(conf))
        kinds = reader.rows()
        for stripe in reader.getStripes():
            streams = {(s.getColumn(), str(s.getKind())) for s in kinds.readStripeFooter(stripe).getStreamsList()}
            assert {(1, "ROW_INDEX"), (1, "BLOOM_FILTER_UTF8")} <= streams
            encodings = kinds.readStripeFooter(stripe).getColumnsList()
            assert str(encodings[encodings.size() - 1].getKind()) == "DIRECT_V2"
            stripes, size = stripes + 1, size + stripe.getLength()
        for x in reader.getStripeStatistics():
            ids = x.getColumnStatistics()[1]
            assert last < ids.getMinimum() <= ids.getMaximum()
            last = ids.getMaximum()
    read = token_files.read(spark, path)
    assert stripes > 6 and size < 3 * read.agg(F.sum("n")).first()[0]
    one = read.filter("doc_id = 60000")
    assert one.count() == 1 and read.filter("doc_id = 60001").count() == 0
    assert "EqualTo(doc_id,60000)" in one._jdf.queryExecution().executedPlan().toString()
