"""Crawls of sites from a canned client: what they find, how they go on, what the publishers' stages write."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.sources import fetch, files, publishers
from corpusmill.sources.crawl import KNOWN, crawl

LONG = "<article><p>" + "The letter says what holds. " * 20 + "</p></article>"
PDF = b"%PDF-1.4 canned"
S, A, N = publishers.SAFETY, publishers.AGENCY, publishers.FIRE


def _loc(*urls):
    return "".join(f"<loc>{u}</loc>" for u in urls)


def _row(date, url, title, number):
    return f'<tr><td>{date}</td><td><a href="{url}">{title}</a></td><td>{number}</td></tr>'


FILES = "/sites/default/files"
SITE = {
    f"{S}/sitemap.xml": _loc(f"{S}/laws-regs/standardinterpretations/2001-02-03", f"{S}/laws-regs/standardinterpretations/2002-01-01-1", f"{S}/about", f"{S}/enforcement/directives/cpl-03", f"{S}/enforcement/directives/std-9.pdf", f"{S}/enforcement/directives/directives"),
    f"{S}/laws-regs/interpretations?page=0": "<table>" + _row("02/03/2001", "/laws-regs/standardinterpretations/2001-02-03", "Guards &amp; rails", "1910.23") + _row("", "/other", "No letter", "") + "</table>",
    f"{S}/laws-regs/standardinterpretations/2001-02-03": LONG,
    f"{S}/laws-regs/standardinterpretations/2002-01-01-1": "<title>Second | Occupational Safety and Health Administration</title>" + LONG,
    f"{S}/enforcement/directives/search?page=0": "<table>" + _row("05/06/2007", "/enforcement/directives/cpl-01", "First directive", "CPL 01") + _row("", "/enforcement/directives/cpl-02.pdf", "Second one", "CPL 02") + "</table>",
    f"{S}/enforcement/directives/cpl-01": LONG * 2,
    f"{S}/enforcement/directives/cpl-03": f'<title>Third</title><article>Only as PDF <a href="{FILES}/enforcement/directives/CPL_03.pdf">x</a></article>',
    f"{S}/enforcement/directives/cpl-02.pdf": PDF,
    f"{S}/enforcement/directives/std-9.pdf": b"<html>not a document",
    f"{S}{FILES}/enforcement/directives/CPL_03.pdf": PDF,
    f"{S}/publications/all?page=0": f'<h3><h5>Ladders</h5></h3>{publishers.collect.ROW}<b lang="english">English:</b><span class="views-field-field-publication-id"><span class="field-content">(OSHA 1)</span><a href="{FILES}/lad.pdf">PDF</a><a href="{FILES}/gone.pdf">PDF</a>',
    f"{S}{FILES}/lad.pdf": PDF,
    f"{A}/sitemap.xml": _loc(f"{A}/sitemap.xml?page=1", f"{A}/sitemap.xml?page=2"),
    f"{A}/sitemap.xml?page=1": _loc(f"{A}/lead/one", f"{A}/lead/two", f"{A}/newsroom/x"),
    f"{A}/sitemap.xml?page=2": _loc(f"{A}/mold/three", f"{A}/enforcement/some-settlement", f"{A}/pfas/none"),
    f"{A}/lead/one": '<a href="/files/Lead.pdf?v=1">Lead in <b>water</b></a><a href="https://nepis.epa.gov/x.pdf">no</a>',
    f"{A}/lead/two": '<a href="/files/Lead.pdf">Again</a><a href="/other/lead.pdf">Lead in water</a>',
    f"{A}/mold/three": '<a href="https://elsewhere.org/a.pdf">no</a><a href="/files/table.csv">Table</a>',
    f"{A}/files/Lead.pdf?v=1": PDF,
    f"{A}/other/lead.pdf": PDF,
    f"{A}/files/table.csv": b"a,b\n",
    f"{N}/sitemap.xml": _loc(f"{N}/downloadable-resources/safety-tips/candles", f"{N}/downloadable-resources/social-media/x", f"{N}/education-and-research/research/reports/y"),
    f"{N}/downloadable-resources/safety-tips/candles": '<title>Candle safety. Download the free NFPA PDF | NFPA</title><a href="/-/media/Files/candles.pdf?rev=1">x</a><img src="/-/media/Images/i.pdf">',
    f"{N}/es/downloadable-resources/safety-tips/candles": '<a href="/-/media/Files/candles.pdf?rev=2">x</a><a href="/-/media/Files/velas.pdf">y</a>',
    f"{N}/education-and-research/research/reports/y": "<title>No documents</title>",
    f"{N}/-/media/Files/candles.pdf?rev=1": PDF,
    f"{N}/-/media/Files/velas.pdf": PDF,
}


def _client(log):
    site = SITE

    def ask(url, headers):
        with open(log, "a") as f:
            f.write(url + "\n")
        body = site.get(url)
        return (404, b"") if body is None else (200, body if isinstance(body, bytes) else body.encode())

    return ask


def _quiet(_):
    return None


def _run(spark, tmp_path, name, most=5000, stop=None):
    ask, rounds = _client(str(tmp_path / "asked")), []

    def fetcher(urls):
        rounds.append(1)
        if stop is not None and len(rounds) > stop:
            raise RuntimeError("stopped")
        return fetch.fetch(urls, ask, _quiet)

    root = str(tmp_path / "root")
    os.makedirs(root, exist_ok=True)
    return publishers.collected(spark, name, root, str(tmp_path / "store" / name), fetcher, lambda plan, folder: fetch.download(plan, folder, ask, _quiet), most)


def _asked(tmp_path):
    return Counter((tmp_path / "asked").read_text().split())


def _manifest(spark, tmp_path, name):
    at = publishers.PUBLISHERS[name]
    return {r.relative_path: r for r in files.manifest(spark, str(tmp_path / "root"), at.corpus, at.manifest).collect()}


def test_stopped_crawl_goes_on(spark, tmp_path):
    """Stopped after each round in turn, a crawl asks every page once, and ends as one that was never stopped."""
    for stop in (1, 2):
        with pytest.raises(RuntimeError, match="stopped"):
            _run(spark, tmp_path, "epa", most=2, stop=stop)
    done = _run(spark, tmp_path, "epa", most=2)
    asked = _asked(tmp_path)
    assert set(asked.values()) == {1} and f"{A}/newsroom/x" not in asked and f"{A}/enforcement/some-settlement" not in asked
    assert done == {"pages": {"ok": 6, "gone": 1}, "planned": 3, "files": 3}
    found = _manifest(spark, tmp_path, "epa")
    assert set(found) == {"lead/Lead-in-water__Lead.pdf", "lead/Lead-in-water__lead-1.pdf", "mold/Table__table.csv"}
    assert found["lead/Lead-in-water__Lead.pdf"].source_url == f"{A}/files/Lead.pdf?v=1" and found["mold/Table__table.csv"].section == "mold" and found["mold/Table__table.csv"].bytes == "4"
    again = _run(spark, tmp_path, "epa", most=2)
    assert again == done and set(_asked(tmp_path).values()) == {1}


def test_letters_and_directives(spark, tmp_path):
    """Listing and sitemap together, with what the listing knows; stubs bring their PDF; what is on disk is not asked again, even by a new crawl."""
    assert _run(spark, tmp_path, "osha-interp")["files"] == 2
    found = _manifest(spark, tmp_path, "osha-interp")
    first = found["Letters/Guards-rails__2001-02-03.txt"]
    assert (first.title, first.date, first.standards_cited, first.identifier) == ("Guards & rails", "2001-02-03", "1910.23", "2001-02-03") and first.publisher == publishers.SAFETY_NAME
    assert found["Letters/Second__2002-01-01-1.txt"].date == "2002-01-01"
    os.rename(tmp_path / "store" / "osha-interp", tmp_path / "old")
    assert _run(spark, tmp_path, "osha-interp")["files"] == 2
    assert _asked(tmp_path)[f"{S}/laws-regs/standardinterpretations/2001-02-03"] == 1 and _asked(tmp_path)[f"{S}/sitemap.xml"] == 2

    assert _run(spark, tmp_path, "osha-dir")["files"] == 4
    found = _manifest(spark, tmp_path, "osha-dir")
    assert {(p, r.format) for p, r in found.items()} == {("Text/First-directive__cpl-01.txt", "TEXT"), ("Text/Third__cpl-03.txt", "TEXT"), ("PDF/Second-one__cpl-02.pdf", "PDF"), ("PDF/Third__cpl-03.pdf", "PDF")}
    assert found["Text/First-directive__cpl-01.txt"].date == "2007-05-06" and found["PDF/Second-one__cpl-02.pdf"].title == "Second one"


def test_catalogue_and_resources(spark, tmp_path):
    assert _run(spark, tmp_path, "osha-pubs") == {"pages": {"ok": 1, "gone": 25}, "planned": 2, "files": 1}
    (row,) = _manifest(spark, tmp_path, "osha-pubs").values()
    assert (row.relative_path, row.language, row.format, row.title, row.publication_id) == ("English/Ladders__lad.pdf", "English", "PDF", "Ladders", "OSHA 1")
    _run(spark, tmp_path, "nfpa-public")
    found = _manifest(spark, tmp_path, "nfpa-public")
    assert set(found) == {"Public-Education/English/Candle-safety__candles.pdf", "Public-Education/Espanol/Candle-safety__velas.pdf"}
    spanish = found["Public-Education/Espanol/Candle-safety__velas.pdf"]
    assert (spanish.category, spanish.language, spanish.source_page) == ("safety-tips", "Spanish", f"{N}/es/downloadable-resources/safety-tips/candles")
    assert f"{N}/downloadable-resources/social-media/x" not in _asked(tmp_path) and f"{N}/es/education-and-research/research/reports/y" not in _asked(tmp_path)


def test_crawl_of_cycles_and_failures(spark, tmp_path):
    """Cycles end, nulls are left out, kinds are the first by name; failures are asked again by the next call only; a round without its links is followed again."""
    links, down = {"a": ["b", "c", None], "b": ["a", "d"], "c": ["c"], "d": ["e"]}, {"d"}
    asked = []

    def fetcher(urls):
        got = [r.url for r in urls.collect()]
        asked.append(sorted(got))
        rows = [(u, "failed", None) if u in down else ("e", "gone", None) if u == "e" else (u, "ok", " ".join(x or "" for x in links[u])) for u in got]
        return spark.createDataFrame(rows, "url string, outcome string, body string")

    follow = lambda pages: pages.select(F.explode(F.split("body", " ")).alias("url")).select(F.nullif("url", F.lit("")).alias("url"), F.lit("page").alias("kind"))
    seeds = spark.createDataFrame([("a", "seed"), ("a", "first"), (None, "seed")], KNOWN)
    go = lambda: {r.url: (r.kind, r.outcome, r.round) for r in crawl(spark, str(tmp_path / "c"), seeds, follow, fetcher).collect()}
    assert go() == {"a": ("first", "ok", 0), "b": ("page", "ok", 1), "c": ("page", "ok", 1), "d": ("page", "failed", 2)}
    assert asked == [["a"], ["b", "c"], ["d"]]
    down.clear()
    os.rename(tmp_path / "c" / "known" / "round=2", tmp_path / "lost")
    assert go() == {"a": ("first", "ok", 0), "b": ("page", "ok", 1), "c": ("page", "ok", 1), "d": ("page", "ok", 3), "e": ("page", "gone", 4)}
    assert asked[3:] == [["d"], ["e"]]
    assert crawl(spark, str(tmp_path / "empty"), seeds.limit(0), follow, fetcher).count() == 0
