import io
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import collect, extract
from corpusmill.operators.master import latest_wins
from corpusmill.sources import fetch, files
from corpusmill.streaming import incremental

BASE = "https://www.epa.gov"


def _zip(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), text)
    return out.getvalue()


def docx():
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    p = lambda t: f"<w:p><w:r><w:t>{t}</w:t></w:r></w:p>"
    cells = "".join(f"<w:tc>{p(t)}</w:tc>" for t in ("x", "", "y"))
    return _zip(word__document_dot_xml=f"<w:document {w}><w:body>{p('First paragraph of this file')}{p(' ')}<w:tbl><w:tr>{cells}</w:tr></w:tbl>{p('last one, after the table')}</w:body></w:document>")


def xlsx(rows=3):
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    r = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    body = "".join(f'<row r="{i}"><c t="s"><v>0</v></c><c><v>{i}</v></c><c/></row>' for i in range(1, rows + 1))
    return _zip(
        xl__workbook_dot_xml=f'<workbook {s} {r}><sheets><sheet name="One" r:id="r1"/></sheets></workbook>',
        xl___rels__workbook_dot_xml_dot_rels='<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>'.replace("&", "&amp;"),
        xl__sharedStrings_dot_xml=f"<sst {s}><si><t>name</t></si></sst>",
        xl__worksheets__sheet1_dot_xml=f"<worksheet {s}><sheetData>{body}</sheetData></worksheet>",
    )


def test_docx_and_xlsx(monkeypatch):
    assert extract.docx(docx())[1] == "First paragraph of this file\nlast one, after the table\nx | y"
    assert extract.xlsx(xlsx())[1] == "## Sheet: One\nname | 1\nname | 2\nname | 3"
    monkeypatch.setattr(extract, "SHEET_ROWS", 2)
    assert extract.xlsx(xlsx())[1].endswith("name | 2\n[... truncated at 2 rows]")
    monkeypatch.setattr(extract, "XLSX_BYTES", 10)
    with pytest.raises(ValueError, match="bulk data"):
        extract.xlsx(xlsx())


@pytest.fixture
def tree(tmp_path):
    for name, content in {
        "A/one.txt": b"a plain text that is long enough to be kept", "A/bad.docx": b"PK", "A/sub/page.html": b"<title>T</title><main>" + b"words " * 20 + b"</main>", "A/manifest.csv": b"x", "A/x.part": b"x",
        "_TEXT/A/one.txt": b"ok \xff bytes", "B/w.docx": docx(), "B/s p+c.xlsx": xlsx(), "B/z.zip": b"PK", "B/_TEXT/skipped.txt": b"",
    }.items():
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(content)
    return tmp_path


def test_scan_and_extract(spark, tree):
    docs = files.documents(spark, str(tree))
    assert sorted(r.relative_path for r in docs.select("relative_path").collect()) == ["A/bad.docx", "A/one.txt", "A/sub/page.html", "B/s p+c.xlsx", "B/w.docx", "B/z.zip"]
    got = {r.relative_path: r for r in extract.extract(docs).collect()}
    assert {k: v.status for k, v in got.items()} == {"A/one.txt": "ok", "A/bad.docx": "error", "A/sub/page.html": "ok", "B/w.docx": "ok", "B/s p+c.xlsx": "ok", "B/z.zip": "skip"}
    assert got["A/sub/page.html"].title == "T" and got["A/bad.docx"].note.startswith("BadZipFile") and got["B/z.zip"].note == ".zip not text-extractable here"
    audit = {r.relative_path: r for r in extract.audit(extract.extract(docs)).collect()}
    assert audit["A/one.txt"].source_kb == 1 and audit["A/one.txt"].chars_per_kb == 43.0 and audit["A/one.txt"].corpus == "A"
    texts = files.mirror(spark, str(tree)).collect()
    assert [(r.text_path, r.corpus, r.text) for r in texts] == [("_TEXT/A/one.txt", "A", "ok \ufffd bytes")]
    assert files.documents(spark, str(tree / "nothing")).count() == 0


def test_manifests_and_specs(spark, tmp_path):
    (tmp_path / "EPA").mkdir()
    (tmp_path / "EPA" / "manifest.csv").write_text('\ufeffrelative_path,section,format,title,source_url,source_page,publisher,bytes,sha256\na.pdf,lead,PDF,"Two\nlines, ""quoted""",http://a?x=1,,P,5,abc\n', encoding="utf-8")
    (r,) = files.manifest(spark, str(tmp_path), "EPA", "epa").collect()
    assert r.title == 'Two\nlines, "quoted"' and r.source_page == "" and r.relative_path == "a.pdf"
    assert files.manifest(spark, str(tmp_path), "EHS", "publications").columns[-1] == "sha256"
    (tmp_path / "specs").mkdir()
    (tmp_path / "specs" / "p.json").write_text('{"pack_id": "p", "kind": "meta", "members": ["a"], "refresh": {"cadence_days": 7}, "query_expansion": {"x": ["y"]}}')
    (s,) = files.specs(spark, str(tmp_path / "specs")).collect()
    assert (s.name, s.members, s.refresh.cadence_days, s.query_expansion) == ("p", ["a"], 7, {"x": ["y"]})
    files.write_csv(spark.createDataFrame([("a,b", "")], "x string, y string"), f"{tmp_path}/out")
    assert spark.read.csv(f"{tmp_path}/out", header=True).first().x == "a,b"


def test_ocr(spark):
    rows = spark.createDataFrame([("a.pdf", bytearray(b"ok"), 0), ("b.pdf", bytearray(b"short"), None), ("c.pdf", bytearray(b"fail"), 200), ("d.pdf", bytearray(b"boom"), 0), ("e.pdf", bytearray(b"ok"), 201)], "relative_path string, content binary, have int")

    def provider(content):
        if content == b"boom":
            raise RuntimeError("x")
        return {b"ok": (0, "t" * 200, ""), b"short": (0, "t", "few"), b"fail": (2, "", "bad")}[bytes(content)]

    got = {r.relative_path: (r.status, r.chars, r.note) for r in extract.ocr(rows, provider).collect()}
    assert got == {"a.pdf": ("ok", 200, ""), "b.pdf": ("empty", 1, "few"), "c.pdf": ("fail", 0, "bad"), "d.pdf": ("error", 0, "RuntimeError: x")}
    assert extract.missing_tools(("no-such-tool",)) == ["no-such-tool"]


def test_scope(spark):
    urls = [f"{BASE}/lead/x", f"{BASE}/enforcement/a-settlement", f"{BASE}/enforcement/ok", f"{BASE}/other/x", f"{BASE}/enforcement/case-cd"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(collect.in_scope(F.col("u"), BASE)).collect()] == [True, False, True, False, False]


def test_links(spark):
    one = '<a class=x href="/a.PDF?rev=1&amp;q">First <b>one</b></a><a href="//cdn.epa.gov/b.zip">B</a><a href="https://nepis.epa.gov/c.pdf">C</a><a href="c.pdf">rel</a><a href="https://x.org/d.pdf">D</a><a href="/page.html">no</a>'
    pages = spark.createDataFrame([(f"{BASE}/lead/{i}", one) for i in range(5)] + [(f"{BASE}/lead/9", None)], "url string, body string")
    found = collect.links(pages, BASE, "epa.gov")
    by = {r.key: r for r in collect.first_pages(found).collect()}
    assert set(by) == {f"{BASE}/a.PDF", "https://cdn.epa.gov/b.zip"}
    a = by[f"{BASE}/a.PDF"]
    assert a.url == f"{BASE}/a.PDF?rev=1&q" and a.label == "First one" and a.pages == [f"{BASE}/lead/{i}" for i in range(3)]
    plan = collect.file_plan(collect.first_pages(found), BASE).collect()
    assert [r.path for r in plan] == ["EPA/lead/B__b.zip", "EPA/lead/First-one__a.pdf"] or [r.path for r in plan] == ["EPA/lead/First-one__a.pdf", "EPA/lead/B__b.zip"]


def test_listings(spark):
    row = lambda d, u, t, n: f"<tr><td>{d}</td><td><a href=\"{u}\">{t}</a></td><td>{n}</td></tr>"
    body = "<table>" + row("1/2/2003", "/enforcement/directives/cpl-1", "A &amp; <i>B</i>", "CPL 1") + row("x", "http://www.osha.gov/y", "Y", "") + "<tr><td>lonely</td></tr></table>"
    got = collect.listed(spark.createDataFrame([(0, body), (1, None)], "page int, body string"), "https://www.osha.gov").orderBy("row").collect()
    assert [(r.url, r.title, r.number) for r in got] == [("https://www.osha.gov/enforcement/directives/cpl-1", "A & B", "CPL 1"), ("https://www.osha.gov/y", "Y", "")]
    urls = spark.createDataFrame([("https://o/laws-regs/standardinterpretations/2001-02-03-1",), ("https://o/enforcement/directives/",), ("https://o/enforcement/directives/cpl-02",)], "u string")
    assert [tuple(r) for r in urls.select(collect.dated_letter(F.col("u")), collect.directive_page(F.col("u"))).collect()] == [(True, False), (False, False), (False, True)]


def test_publications(spark):
    item = lambda lang, label, *links: f'{collect.ROW}<b lang={lang}>{label}:</b><span class="views-field-field-publication-id"><span class="field-content">(OSHA 1)</span></span>' + "".join(f'<a href="{h}">{f}</a>' for h, f in links)
    body = "<div>top</div><h3><h5>First &amp; one</h5></h3>" + item("english", "English", ("/sites/default/files/a.pdf#p", "PDF"), ("/publications/all", "HTML")) + item("es", "Español", ("/publications/b1", "HTML"), ("https://x.org/c.pdf", "PDF")) + "<h3><h5>Second</h5></h3>" + item("vi", "Việt(Vietnamese)", ("/sites/default/files/a.pdf", "PDF")) + item("english", "English", ("/sites/default/files/a.pdf", "PDF"))
    got = collect.publications(spark.createDataFrame([(0, body)], "page int, body string"), "https://www.osha.gov").collect()
    assert sorted((r.url.rsplit("/", 1)[-1], r.language, r.format, r.title, r.publication_id) for r in got) == [("a.pdf", "English", "PDF", "First & one", "OSHA 1"), ("a.pdf", "Vietnamese", "PDF", "Second", "OSHA 1"), ("b1", "Spanish", "HTML", "First & one", "OSHA 1")]
    df = spark.createDataFrame([("English",), ("Spanish",), ("Tiếng Việt",), ("!!",)], "l string")
    assert [r[0] for r in df.select(collect.folder(F.col("l"))).collect()] == ["EHS/English", "EHS/Espanol", "EHS/Other-Languages/Tiếng-Việt", "EHS/Other-Languages/Unknown"]


def test_media_and_pages(spark):
    page = '"/-/media/a.pdf?rev=1" \'/-/media/b.PDF\' /-/media/Images/c.pdf /-/media/d.png "/-/media/a.pdf?rev=1" /-/media/' + "x" * 500 + ".pdf"
    df = spark.createDataFrame([(page,)], "p string")
    (r,) = df.select(collect.media(F.col("p")).alias("m"), collect.only_here(collect.media(F.col("p")), F.array(F.lit("/-/media/a.pdf?rev=2"))).alias("o")).collect()
    assert r.m == ["/-/media/a.pdf?rev=1", "/-/media/b.PDF"] and r.o == ["/-/media/b.PDF"]
    urls = spark.createDataFrame([("https://n.org/downloadable-resources/home-fires/x",), ("https://n.org/downloadable-resources/social-media/x",), ("https://n.org/education-and-research/research/fire-protection-research-foundation/y",), ("https://n.org/z",)], "url string")
    assert sorted((r.kind, r.category) for r in collect.resource_pages(urls, "https://n.org").collect()) == [("Public-Education", "home-fires"), ("Research-Reports", "FPRF")]


def test_directive_link(spark):
    page = '<a href="/sites/default/files/enforcement/directives/osha2254.pdf"><a href="/sites/default/files/enforcement/directives/CPL_02-00-1.pdf">'
    df = spark.createDataFrame([(page, "cpl-02-00-1"), (page, "other"), ("<p>", "x")], "p string, i string")
    assert [r[0] and r[0].rsplit("/", 1)[-1] for r in df.select(collect.directive_link(F.col("p"), F.col("i"), "https://o")).collect()] == ["CPL_02-00-1.pdf", "osha2254.pdf", None]


def test_sitemaps(spark):
    index = spark.createDataFrame([("<loc>s1</loc><loc>s2</loc>",)], "body string")
    pages = spark.createDataFrame([("s1", "<loc>b</loc><loc>a</loc>"), ("s2", "<loc>a</loc>"), ("s3", "<loc>zz</loc>")], "url string, body string")
    assert [r.url for r in collect.sitemap_index(index, pages).collect()] == ["a", "b"]


def test_letters(spark):
    body = "<article><p>" + "A letter about rules. " * 20 + "</p></article><title>Title | Occupational Safety and Health Administration</title>"
    pages = spark.createDataFrame([("https://o/x/2001-02-03-1", body), ("https://o/x/2002-01-01", "<article>short</article>")], "url string, body string")
    known = spark.createDataFrame([], "url string, title string, date string, standards string")
    (r,) = collect.letters(pages, known).collect()
    assert (r.identifier, r.date, r.title, r.archived) == ("2001-02-03-1", "02/03/2001", "Title", False) and r.text.startswith("Title: Title\nDate: 02/03/2001\n")


def test_fetching(spark):
    replies = {"https://www.epa.gov/ok": [(200, b"x" * 4000)], "https://www.epa.gov/gone": [(404, b"")], "https://www.epa.gov/slow": [(429, b""), (500, b""), (200, b"late")]}
    slept = []

    def client(url, headers):
        if url not in replies:
            raise OSError("down")
        return replies[url].pop(0)

    got = {u: fetch.fetch_one(u, 0.1, 60, client, slept.append) for u in [*replies, "https://www.epa.gov/down"]}
    assert [g[0] for g in got.values()] == ["ok", "gone", "ok", "failed"]
    assert slept[0] == 0.1 and 60 <= slept[1] <= 70 and slept[2] == 4 and slept[3] == 0.1 and slept[4] == 2
    urls = spark.createDataFrame([("https://www.epa.gov/a",), ("https://nepis.epa.gov/b",), ("https://www.epa.gov/c",)], "url string")
    rows = fetch.fetch(urls, lambda u, h: (200, b"body") if u.endswith("a") else (410, b""), lambda s: None)
    assert {r.url[-1]: (r.outcome, r.body) for r in rows.collect()} == {"a": ("ok", "body"), "b": ("forbidden", None), "c": ("gone", None)}
    assert {r.outcome: r.requests for r in fetch.counters(rows).collect()} == {"ok": 1, "forbidden": 1, "gone": 1}
    cache = spark.createDataFrame([("https://www.epa.gov/a", "y" * 3000), ("https://www.epa.gov/c", "small")], "url string, body string")
    asked = lambda u: u.select("url", F.lit("ok").alias("outcome"), F.lit("new").alias("body"))
    assert {r.url[-1]: r.body[:3] for r in fetch.cached(urls, cache, asked).collect()} == {"a": "yyy", "b": "new", "c": "new"}
    assert {r.body for r in fetch.cached(urls, cache, asked, refresh=True).collect()} == {"new"}


def test_stream(spark, tmp_path):
    rows = [(f"_TEXT/A/{i}.txt", "A", ".txt", "the same body of text " * 4 if i % 2 else f"body number {i} " * 6, datetime(2026, 1, 1, 0, i)) for i in range(6)]
    spark.createDataFrame(rows, "text_path string, corpus string, source_format string, text string, arrived timestamp").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).parquet(f"{tmp_path}/in")
    q = incremental.write(incremental.arrivals(stream), f"{tmp_path}/out", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.count() == 4 and got.select("content_sha256").distinct().count() == 4


def test_downloads(spark, tmp_path):
    (tmp_path / "EPA").mkdir()
    (tmp_path / "EPA" / "have.pdf").write_bytes(b"old")
    plan = spark.createDataFrame([(f"https://www.epa.gov/{n}", f"EPA/{n}") for n in ("have.pdf", "new.pdf", "page.pdf", "gone.pdf")] + [("https://nepis.epa.gov/x.pdf", "EPA/x.pdf")], "url string, path string")

    def client(url, headers):
        return (404, b"") if "gone" in url else (200, b"<html>" if "page" in url else b"%PDF-1")

    got = {r.path: r.outcome for r in fetch.download(plan, str(tmp_path), client, lambda s: None).collect()}
    assert got == {"EPA/have.pdf": "already", "EPA/new.pdf": "ok", "EPA/page.pdf": "wrong_type", "EPA/gone.pdf": "gone", "EPA/x.pdf": "forbidden"}
    assert sorted(p.name for p in (tmp_path / "EPA").iterdir()) == ["have.pdf", "new.pdf"] and (tmp_path / "EPA" / "have.pdf").read_bytes() == b"old"


def test_regulations(spark):
    titles = spark.createDataFrame([('{"titles": [{"number": 29, "up_to_date_as_of": "2026-08-01"}, {"number": 49, "up_to_date_as_of": "2026-08-02"}]}',)], "body string")
    assert [r[0] for r in collect.issue_date(titles, 49).collect()] == ["2026-08-02"] and collect.issue_date(titles, 7).count() == 0
    block = lambda n, s: f'<DIV8 N="{n}" TYPE="SECTION"><HEAD>§ {n} {s}.</HEAD><P>{"words " * 20}</P></DIV8>'
    parts = spark.createDataFrame([("173", "Shippers", block("173.10", "Ten") + block("173.4", "Four") + block("173.4a", "Four a"))], "part string, part_name string, xml string")
    got = collect.regulations(parts, 49, "2026-08-02", "Regulation", "See also").collect()
    assert [r.section for r in got] == ["173.4", "173.4a", "173.10"] and got[0].relative_path == "Sections/173.4__Four.txt"
    assert got[0].text.startswith("Citation: 49 CFR 173.4\nSubject: Four\nPart: 49 CFR 173 - Shippers\nIssue date: 2026-08-02 (eCFR 'up to date as of')\nSource: https://www.ecfr.gov/current/title-49/part-173/section-173.4\nType: Regulation\nNote: See also\n-----")


def test_directives_and_manifests(spark):
    link = '<a href="/sites/default/files/enforcement/directives/CPL_1.pdf">pdf</a>'
    pages = spark.createDataFrame([("https://o/enforcement/directives/cpl-1", f"<article>stub {link}</article>"), ("https://o/enforcement/directives/cpl-2", "<article>" + "long text " * 80 + "</article>")], "url string, body string")
    known = spark.createDataFrame([("https://o/enforcement/directives/cpl-1", "One", "01/02/2003", "CPL 1")], "url string, title string, date string, number string")
    got = {r.identifier: r for r in collect.directives(pages, known, "https://o").collect()}
    assert got["cpl-1"].stub and got["cpl-1"].pdf.endswith("CPL_1.pdf") and got["cpl-1"].name == "One__cpl-1" and not got["cpl-2"].stub and got["cpl-2"].pdf is None
    files_ = spark.createDataFrame([("Text/One__cpl-1.txt", bytearray(got["cpl-1"].text.encode())), ("Text/x__2001-02-03.txt", bytearray(b"Title: X\n---\n"))], "relative_path string, content binary")
    a, b = collect.header_manifest(files_, collect.DIRECTIVE_COLUMNS).collect()
    assert (a.title, a.date, a.directive_number, a.identifier) == ("One", "2003-01-02", "CPL 1", "cpl-1") and (b.title, b.date, b.identifier) == ("X", "2001-02-03", "2001-02-03")
    assert sorted(r.identifier for r in collect.identifiers(files_).collect()) == ["2001-02-03", "cpl-1"]


def test_twins(spark):
    rows = [("a.md", "# A\n"), ("a.txt", "A\n=\n"), ("b.md", "b"), ("b.txt", "old"), ("c/d.md", "d"), ("dist/e.md", "e")]
    df = spark.createDataFrame(rows, "relative_path string, text string")
    assert {r.relative_path: r.stale for r in extract.twins(df).collect()} == {"a.txt": False, "b.txt": True, "c/d.txt": True}


def test_last_row_of_a_manifest(spark, tmp_path):
    """Of rows with one path the file's last is taken, by the reader alone; line ends within fields and blank fields make no difference."""
    (tmp_path / "EPA").mkdir()
    columns = files.manifest(spark, str(tmp_path), "EPA", "epa").columns
    at = columns.index("relative_path")
    line = lambda path, title: ",".join(path if i == at else f'"{title}"' for i in range(len(columns)))
    rows = [line("a.pdf", "z\nfirst"), line("b.pdf", "only"), line("a.pdf", "y, second"), line("c.pdf", "m"), line("a.pdf", "x\nlast"), line("c.pdf", "")]
    (tmp_path / "EPA" / "manifest.csv").write_text("\n".join([",".join(columns), *rows]) + "\n")
    title = next(c for c in columns if c != "relative_path")
    assert files.manifest(spark, str(tmp_path), "EPA", "epa").count() == 6
    found = files.manifest(spark, str(tmp_path), "EPA", "epa", last=True)
    assert found.columns == columns
    assert {r.relative_path: r[title] for r in found.collect()} == {"a.pdf": "x\nlast", "b.pdf": "only", "c.pdf": ""}
    assert files.manifest(spark, str(tmp_path / "none"), "EPA", "epa", last=True).count() == 0


def test_file_order_over_splits(spark, tmp_path):
    """The last row of a path is the same however many splits a file is read in."""
    lines = [f"p{i % 97},{i}" for i in range(20000)]
    (tmp_path / "m.csv").write_text("relative_path,title\n" + "\n".join(lines) + "\n")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "8192")
    try:
        rows = spark.read.csv(str(tmp_path / "m.csv"), header=True, schema="relative_path string, title string")
        assert rows.rdd.getNumPartitions() > 5
        found = latest_wins(files.in_order(rows, "at"), "at").collect()
    finally:
        spark.conf.set(name, before)
    assert {r.relative_path: int(r.title) for r in found} == {f"p{i % 97}": i for i in range(20000)}
