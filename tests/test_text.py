"""Scalar functions, against plain Python where that has an equivalent."""

import re

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as X


@pytest.fixture
def apply(spark):
    def run(function, *rows, n=1):
        df = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], ", ".join(f"c{i} string" for i in range(n)))
        return [r[0] for r in df.coalesce(1).select(function(*[F.col(f"c{i}") for i in range(n)])).collect()]

    return run


SPACED = ["a  b", "\ta\u00a0b\u2003c\n", "\x1cx\x1f y\x85z", "\u200bkeep\u200b", "", "  ", "Ä B"]


def test_whitespace_is_pythons(apply):
    assert apply(X.normalised, *SPACED) == [" ".join(s.split()).lower() for s in SPACED]
    assert apply(X.stripped, *SPACED) == [s.strip() for s in SPACED]


def test_clean_whitespace(apply):
    assert apply(X.clean_whitespace, " a \t b \n  c\n\n\n\nd\u00a0 e ", "") == ["a b\nc\n\nd e", ""]


def test_header_and_body(apply):
    text = "Title: A: b\nNote:\nTitle: last\n" + X.RULE + "\n\nbody"
    assert apply(X.body, text, "no header", "x" * 1950 + X.RULE, "x" * 1900 + X.RULE + "y") == ["\n\nbody", "no header", "x" * 1950 + X.RULE, "y"]
    assert apply(X.header, text, "plain") == [{"Title": "last", "Note": ""}, {}]


def test_content_key(apply):
    assert apply(X.content_key, "x" * 49, "x" * 50)[0] == "TOO_SHORT"
    assert len(apply(X.content_key, "x" * 50)[0]) == 64


def test_addresses(apply):
    urls = ["https://WWW.Example.org/a/b?q=1", "/rooted/x/", "ftp", "https://h.org"]
    assert apply(X.host, *urls) == ["www.example.org", "", "", "h.org"]
    assert apply(X.without_query, *urls)[0] == "https://WWW.Example.org/a/b"
    assert apply(X.last_segment, *urls) == ["b?q=1", "x", "ftp", "h.org"]
    assert apply(lambda u: X.absolute(u, "https://b.org"), "//c.org/x", "/y", "http://z", "mailto:a") == ["https://c.org/x", "https://b.org/y", "http://z", None]
    assert apply(lambda u: X.first_segment(u, "https://b.org"), "https://b.org/lead/x", "https://b.org/", "https://other.org/x") == ["lead", "misc", "https:"]


def test_dates_and_languages(apply):
    assert apply(X.iso_date, ("03/09/1999", ""), ("", "2001-02-03-1"), ("soon", "x"), n=2) == ["1999-03-09", "2001-02-03", ""]
    assert apply(X.language_name, ("english", "x"), ('"es"', ""), ("vi", "Tiếng Việt(Vietnamese)"), ("", "French "), ("", ""), n=2) == ["English", "Spanish", "Vietnamese", "French", "Unknown"]


def test_human_name(apply):
    slugs = ["assessing-and-managing-chemicals-under-tsca", "the-lead", "indoorairplus", "hw_test", "pcbs"]
    assert apply(X.human_name, *slugs) == ["Assessing and Managing Chemicals under TSCA", "The Lead", "Indoor airPLUS", "Hazardous waste Test", "PCBs"]


def test_natural_order(spark):
    ids = ["173.4a", "173.4", "173.10", "173.2", "171.8", "9999999999999999999.1"]
    df = spark.createDataFrame([(i,) for i in ids], "s string").orderBy(X.natural_key(F.col("s")))
    assert [r.s for r in df.collect()] == ["171.8", "173.2", "173.4", "173.4a", "173.10", "9999999999999999999.1"]


def test_letters(apply):
    notice = X.LETTER_NOTICE + " Words. See " + X.LETTER_NOTICE_END + " . "
    letter = f"Dear Sir,\n\n\n\n{notice}Yours. {X.LETTER_ARCHIVED}"
    (first,) = apply(X.clean_letter, letter)
    assert first.body == f"Dear Sir,\n\nYours. {X.LETTER_ARCHIVED}" and first.archived
    assert apply(X.clean_letter, first.body) == [first]
    (r,) = apply(X.clean_letter, "Standard Number:\n\n1910.147(c)\n1910.95\nText here?")
    assert r.body == "Text here?" and not r.archived


def test_letters_without_the_notices_end(apply):
    (r,) = apply(X.clean_letter, "A " + X.LETTER_NOTICE + "x" * 700)
    assert r.body == "A " + "x" * (700 + len(X.LETTER_NOTICE) - 600)


def test_article_markup(apply):
    page = "<p>out</p><article><script>x</script>a<br/>b<td>c</td><b>d</b></article> tail"
    assert apply(lambda c: X.clean_whitespace(X.article_markup(c)), page, "<p>x</p>y") == ["a\nb c | d", "x\ny"]


def test_standards_and_versions(apply):
    link = '<a href="/laws-regs/regulations/standardnumber/1910/1910.147">1910.147</a>'
    assert apply(X.standards_cited, link + link + link.replace("147<", "95<")) == ["1910.147, 1910.95"]
    assert apply(X.version, "2026-08-31") == ["2026.08.31"]
    assert apply(X.mirror_path, "A/b.c/d.e.pdf", "A/b", "A/.x") == ["A/b.c/d.e.txt", "A/b.txt", "A/.x.txt"]


def test_stub(apply):
    assert apply(X.is_stub, "short", "x" * 700, "available in " + "x" * 700 + " PDF") == [True, False, True]


def test_path_lint(apply):
    lines = ["built at X:\\data\\dist", "see /mnt/x/data", "ok http://localhost:6333/collections", "C:\\path\\to\\it", "run it", "at C:\\Users\\Some One"]
    (found,) = apply(X.path_lint, "\n".join(lines))
    assert [r.line for r in found] == [1, 2, 6]
    (found,) = apply(lambda c: X.path_lint(c, ("work",)), "at /d/work/x")
    assert [r.line for r in found] == [1]


def test_titles(apply):
    assert apply(X.resource_title, "Home fires. Download the free NFPA PDF. | NFPA ", " .Plain. ") == ["Home fires", "Plain"]
    assert apply(lambda t: X.without_suffix(t, "Site"), "A | Site", "A | Other") == ["A", "A | Other"]


def test_white_space_is_pythons_at_every_code_point(spark):
    rows = [(chr(i),) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    odd = [c for (c,) in rows if c.isspace()]
    rows = rows[:0x400] + rows[0x1600:0x1900] + rows[0x1F00:0x3100] + rows[-16:] + [(c,) for c in odd]
    df = spark.createDataFrame(rows, "c string")
    edge, mid = F.concat("c", F.lit("a "), "c", "c", F.lit("b"), "c", "c"), F.concat("c", F.lit("a "), "c", "c", F.lit("\n"), "c", F.lit("b"), "c", F.lit("\n\n\n\nc"), "c")
    for c, s, k, w in df.select("c", X.stripped(edge), X.collapsed(edge), X.clean_whitespace(mid)).collect():
        e, m = f"{c}a {c}{c}b{c}{c}", f"{c}a {c}{c}\n{c}b{c}\n\n\n\nc{c}"
        assert s == e.strip() and k == re.sub(r"\s+", " ", e).strip(" "), ascii(c)
        m = re.sub(" *\n *", "\n", re.sub("[ \t]+", " ", m.replace("\xa0", " ")))
        assert w == re.sub("\n{3,}", "\n\n", m).strip(), ascii(c)
