import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import extract, index, master
from corpusmill.plans import registry

RULE = "-" * 72
SAME = "The same text, long enough to be compared with the others of its kind."
MIRROR = [
    ("_TEXT/A/long-name.txt", "A", ".txt", SAME),
    ("_TEXT/A/b.txt", "A", ".txt", "  the SAME text,\nlong enough to be\tcompared with the others of its kind. "),
    ("_TEXT/A/a.txt", "A", ".txt", "Title: x\n" + RULE + "\n\n" + SAME),
    ("_TEXT/B/c.txt", "B", ".pdf", SAME),
    ("_TEXT/B/49.txt", "B", ".txt", "x" * 49),
    ("_TEXT/B/50.txt", "B", ".txt", "x" * 50),
    ("_TEXT/B/49b.txt", "B", ".txt", "x" * 49),
    ("_TEXT/S/s.txt", "S", ".xlsx", "y" * 60),
    ("_TEXT/S/short.txt", "S", ".xlsx", "y"),
    ("_TEXT/S/t-longer.txt", "S", ".txt", "y" * 60),
    ("_TEXT/S/late.txt", "S", ".txt", "z" * 2000 + RULE + "w" * 60),
]


def _expected(rows):
    out, groups = {}, defaultdict(list)
    for path, corpus, fmt, text in rows:
        body = text.split(RULE, 1)[-1] if RULE in text[:2000] else text
        n = " ".join(body.split()).lower()
        key = "TOO_SHORT" if len(n) < 50 else hashlib.sha256(n.encode()).hexdigest()
        groups[key].append(path)
        out[path] = [corpus, fmt, len(body.strip()), key]
    for key, paths in groups.items():
        paths.sort(key=lambda p: (len(p), p))
        for i, p in enumerate(paths):
            rest = ["no", "too-short", "", 1] if key == "TOO_SHORT" else ["no" if i else "yes", "duplicate" if i else "", paths[0] if i else "", len(paths)]
            if out[p][1] == ".xlsx":
                rest[:2] = ["no", "bulk-data-spreadsheet"]
            out[p] += rest
    return {p: tuple(v) for p, v in out.items()}


def _table(spark, rows=MIRROR):
    return spark.createDataFrame(rows, "text_path string, corpus string, source_format string, text string")


def test_embed_index(spark):
    found = index.embed_index(index.described(_table(spark))).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == _expected(MIRROR) and len(found) == len(MIRROR)
    assert index.embed_index(index.described(_table(spark, []))).count() == 0


def test_index_of_documents(spark):
    docs = [(f"_TEXT/{r.source}/{r.doc_id}.txt", r.source, ".txt", r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    found = index.embed_index(index.described(_table(spark, docs))).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == _expected(docs)


def test_ranking_after_exclusion(spark):
    found = {r.text_path: r.embed for r in index.embed_index(index.described(_table(spark)), rank_after_exclusion=True).collect()}
    assert found["_TEXT/S/t-longer.txt"] == "yes" and found["_TEXT/S/s.txt"] == "no"


def test_summaries(spark):
    idx = index.embed_index(index.described(_table(spark))).cache()
    yes = [r for r in idx.collect() if r.embed == "yes"]
    assert {r.corpus: (r.files, r.embed) for r in index.by_corpus(idx).collect()} == {"A": (3, 1), "B": (4, 1), "S": (4, 1)}
    assert {r[0]: r[1] for r in index.exclusions(idx).collect()} == {"duplicate": 4, "too-short": 2, "bulk-data-spreadsheet": 2}
    s = index.storage(idx).first()
    assert (s.embed, s.embed_chars, s.chunks) == (len(yes), sum(r.chars for r in yes), sum(max(1, r.chars // 2000) for r in yes))
    none = index.storage(idx.limit(0)).first()
    assert (none.embed, none.chunks, none.gb_f32) == (0, 0, 0.0)


def test_source_format(spark):
    mirror = spark.createDataFrame([("a",), ("b",), ("c",)], "stem string")
    files = spark.createDataFrame([("a", ".txt"), ("a", ".pdf"), ("b", ".csv")], "stem string, extension string")
    assert {r.stem: r.source_format for r in index.source_format(mirror, files).collect()} == {"a": ".pdf", "b": "", "c": ""}


def test_suffixes_and_unions(spark):
    rows = spark.createDataFrame([(1, "A/x"), (2, "a/X"), (3, "A/x"), (4, "y")], "ord int, stem string").withColumn("ext", F.lit(".pdf"))
    assert [r.path for r in index.suffixed(rows, "stem", "ext", [F.col("ord")]).orderBy("ord").collect()] == ["A/x.pdf", "a/X-1.pdf", "A/x-2.pdf", "y.pdf"]
    a = spark.createDataFrame([("u", "list")], "url string, title string")
    b = spark.createDataFrame([("u",), ("v",)], "url string")
    assert sorted(map(tuple, index.priority_union(a, b, "url").collect())) == [("u", "list"), ("v", None)]
    assert [r.url for r in index.todo(b, a, "url").collect()] == ["v"]


def test_priority_union_keeps_repeated_rows_of_the_first(spark):
    a = spark.createDataFrame([("u", 1), ("u", 2), (None, 3)], "url string, page_id long")
    b = spark.createDataFrame([("u",), ("v",)], "url string")
    assert sorted(map(str, map(tuple, index.priority_union(a, b, "url").collect()))) == ["('u', 1)", "('u', 2)", "('v', None)", "(None, 3)"]


@pytest.mark.parametrize("null", [False, True])
def test_priority_union_query_and_its_sql(spark, tmp_path, null):
    link = '<a href="/a">a</a><a href="https://x.org/b">b</a>'
    rows = [(1, "https://www.example.org/a", link), (2, "https://x.org/c", None), (3, "https://x.org/c", link), *[(4, None, link)] * null]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = registry.queries()["priority_union"](spark, str(tmp_path)).select("url", "origin", "page_id").collect()
    with pytest.importorskip("duckdb").connect() as con:
        con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, con.execute(registry.oracle_sql()["priority_union"]).fetchall()))


def test_classifier(spark):
    rows = [("a.PDF", "x" * 199, 1000), ("b.pdf", "x" * 300, 1024 * 300), ("c.pdf", "x" * 300, 10), ("d.html", " " * 50 + "x" * 39, 5), ("e.zip", "", 9), ("f.odd", "", 9), ("g.txt", "x" * 40, 2048), ("noext", "", 1), ("dir.d/x", "", 1)]
    df = spark.createDataFrame(rows, "relative_path string, text string, size long")
    said = extract.classified(extract.extension(F.col("relative_path")), F.col("text"), extract.kilobytes(F.col("size")))
    got = {r.relative_path: (r.status, r.chars) for r in df.select("relative_path", said.alias("r")).select("relative_path", "r.*").collect()}
    assert got == {"a.PDF": ("none", 199), "b.pdf": ("thin", 300), "c.pdf": ("ok", 300), "d.html": ("thin", 89), "e.zip": ("skip", 0), "f.odd": ("skip", 0), "g.txt": ("ok", 40), "noext": ("skip", 0), "dir.d/x": ("skip", 0)}


def test_up_to_date(spark):
    src = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5), ("d", 5)], "relative_path string, modified int")
    mir = spark.createDataFrame([("a", 5, 1), ("b", 4, 1), ("c", 9, 0)], "relative_path string, modified int, size int")
    assert {r[0]: r.current for r in extract.up_to_date(src, mir).collect()} == {"a": True, "b": False, "c": False, "d": False}


def test_master_index(spark):
    m = {
        "EHS": spark.createDataFrame([("e.pdf", "English", "PDF", "T", "P1", "http://x", "5", "a" * 64)], "relative_path string, language string, format string, title string, publication_id string, source_url string, bytes string, sha256 string"),
        "OSHA-Interpretations": spark.createDataFrame([("l.txt", "T", "", "s" * 200, "id", "http://y", "p", "7", "b" * 64)], "relative_path string, title string, date string, standards_cited string, identifier string, source_url string, publisher string, bytes string, sha256 string"),
        "NFPA": spark.createDataFrame([("n.pdf", "PDF", "T", "70", "2020", "http://z", "http://d", "N", "1", "c" * 64)], "relative_path string, kind string, title string, standard string, edition_year string, source_url string, source_details_page string, publisher string, bytes string, sha256 string"),
        "NFPA-Public": spark.createDataFrame([("q.pdf", "", "Cat", "Spanish", "PDF", "T", "ftp", "pg", "N", "2", "d")], "relative_path string, collection string, category string, language string, format string, title string, source_url string, source_page string, publisher string, bytes string, sha256 string"),
    }
    got = master.from_manifests(m).cache()
    assert got.columns == list(master.COLUMNS)
    by = {r.corpus: r for r in got.collect()}
    assert by["OSHA-Interpretations"].identifier == "s" * 150 and by["NFPA-IBR"].identifier == "70 (2020)" and by["NFPA-Public"].identifier == "Cat"
    assert by["OSHA-Publications"].relative_path == "EHS/e.pdf" and by["NFPA-IBR"].source_page == "http://d" and by["NFPA-IBR"].format == "PDF"
    t = master.totals(got).first()
    assert (t.rows, t.bytes, t.all_have_url, t.all_have_sha) == (4, 15, False, False)
    none = master.totals(got.limit(0)).first()
    assert (none.rows, none.all_have_url) == (0, True)
    disk = spark.createDataFrame([("ehs/E.PDF",), ("other",)], "relative_path string")
    assert tuple(master.reconcile(got, disk).first()) == (4, 2, 3, 1)


def test_latest_row_of_a_path(spark):
    df = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", "3", 1)], "relative_path string, title string, ord int")
    assert sorted((r.relative_path, r.title) for r in master.latest_wins(df, "ord").collect()) == [("a", "2"), ("b", "3")]


def test_suffixes_of_one_hot_path(spark):
    """A path that most rows have is numbered across partitions, in order."""
    rows = [(i, "A/x" if i % 5 else f"b/{i}") for i in range(4000)] + [(5000, None)]
    df = spark.createDataFrame(rows, "id long, stem string").withColumn("ext", F.lit(".txt")).repartition(7)
    got = {r.id: r.path for r in index.suffixed(df, "stem", "ext", [F.col("id")]).collect()}
    same = [i for i, s in rows if s == "A/x"]
    assert [got[i] for i in same] == ["A/x.txt", *[f"A/x-{n}.txt" for n in range(1, len(same))]]
    assert got[5] == "b/5.txt" and got[5000] is None and len(got) == len(rows)
