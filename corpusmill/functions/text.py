"""Text scalars as Column -> Column, all inside the JVM.

White space is Python's: str.split() and \\s on str take Unicode separators that Java's \\s does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The white space of Python's str.split().
SPACES = r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
RUN = f"[{SPACES}]+"
#: the same characters one by one, and as what is left of all others, ASCII first: Java's patterns test a class's ranges one after another
_BLANKS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_RUN = r"[^!-\x{84}[\x00-\x08\x0E-\x1B\x{86}-\x{9F}\x{A1}-\x{167F}\x{1681}-\x{1FFF}\x{200B}-\x{2027}\x{202A}-\x{202E}\x{2030}-\x{205E}\x{2060}-\x{2FFF}\x{3001}-\x{10FFFF}]]+"
RULE = "-" * 72
SHORTEST_CONTENT = 50


def stripped(s: Column) -> Column:
    """s without white space at its ends."""
    return F.btrim(s, F.lit(_BLANKS))


def blank_to_null(s: Column) -> Column:
    """Empty and missing are the same in manifests."""
    return F.nullif(s, F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty; empty if none is."""
    return F.coalesce(*map(blank_to_null, columns), F.lit(""))


def clean_whitespace(s: Column) -> Column:
    """Runs of blanks become one, blanks around line ends go, at most one empty line stays between lines, ends are stripped."""
    put = lambda s, old, new: F.replace(s, F.lit(old), F.lit(new))
    s = F.regexp_replace(put(put(s, "\xa0", " "), "\t", " "), " {2,}", " ")
    s = put(put(s, " \n", "\n"), "\n ", "\n")  # no blank has another beside it any more
    return stripped(F.regexp_replace(s, "\n{3,}", "\n\n"))


def collapsed(s: Column) -> Column:
    """Words joined by single blanks."""
    return F.trim(F.regexp_replace(s, _RUN, " "))


def normalised(s: Column) -> Column:
    """The form that duplicates are compared in."""
    return F.lower(collapsed(s))


def header_rule_at(s: Column) -> Column:
    """1-based place of the first header rule that lies within the first 2,000 characters; 0 if there is none."""
    return F.instr(F.substring(s, 1, 2000), RULE)


def body(s: Column) -> Column:
    """What follows the header, or all of a text without one."""
    at = header_rule_at(s)
    return F.when(at > 0, F.substr(s, at + len(RULE))).otherwise(s)


def header(s: Column) -> Column:
    """Key-value map of a header: the first ten lines before a rule, each cut at its first colon; later keys win."""
    lines = F.slice(F.split(s, "\n"), 1, 10)
    # the lines before the first that begins with ---
    stop = F.array_position(F.transform(lines, lambda x: x.startswith("---")), F.lit(True))
    lines = F.filter(F.when(stop > 0, F.slice(lines, F.lit(1), stop - 1)).otherwise(lines), lambda x: x.contains(":"))
    pairs = F.transform(lines, lambda x: F.struct(stripped(F.split_part(x, F.lit(":"), F.lit(1))), stripped(F.substr(x, F.instr(x, ":") + 1))))
    return F.map_from_entries(pairs)


def content_key(normal: Column) -> Column:
    """sha256 of a normalised text, TOO_SHORT below SHORTEST_CONTENT characters."""
    return F.when(F.length(normal) < SHORTEST_CONTENT, F.lit("TOO_SHORT")).otherwise(F.sha2(normal, 256))


def sha256(s: Column) -> Column:
    return F.sha2(s, 256)


def cache_key(url: Column, suffix: str = ".html") -> Column:
    return F.concat(F.md5(url), F.lit(suffix))


# addresses


def host(url: Column) -> Column:
    """Lower-cased third part between slashes; empty without ://."""
    return F.when(url.contains("://"), F.lower(F.coalesce(F.get(F.split(url, "/"), F.lit(2)), F.lit("")))).otherwise(F.lit(""))


def without_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def first_segment(url: Column, base: Column | str) -> Column:
    """The first path segment below base, misc if there is none."""
    base = F.rtrim(base, F.lit("/")) if isinstance(base, Column) else F.lit(base.rstrip("/"))
    return F.coalesce(blank_to_null(F.get(F.split(F.replace(url, F.concat(base, F.lit("/")), F.lit("")), "/"), F.lit(0))), F.lit("misc"))


def last_segment(url: Column) -> Column:
    return F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)


def absolute(url: Column, base: str) -> Column:
    """An address made absolute; null if it is neither absolute, protocol-relative nor rooted."""
    return F.when(url.startswith("//"), F.concat(F.lit("https:"), url)).when(url.startswith("/"), F.concat(F.lit(base), url)).when(url.startswith("http"), url)


# markup that needs no entity table


def tags_to(s: Column, what: str = " ") -> Column:
    return F.regexp_replace(s, "<[^>]+>", what)


def article_markup(html: Column) -> Column:
    """An article's text before entities are resolved: the first <article> or all, scripts and styles gone, blocks as lines, cells barred."""
    start = F.instr(html, "<article")
    rest = F.substr(html, F.greatest(start, F.lit(1)))
    end = F.instr(rest, "</article>")
    s = F.when((start > 0) & (end > 1), F.substr(rest, F.lit(1), end - 1)).otherwise(html)
    s = F.regexp_replace(s, "(?s)<script.*?</script>|<style.*?</style>", " ")
    s = F.regexp_replace(s, r"<br\s*/?>|</p>|</div>|</li>|</h\d>|</tr>", "\n")
    return tags_to(F.regexp_replace(s, "</td>|</th>", " | "))


def title_markup(html: Column) -> Column:
    """The content of <title>, empty without one, before entities are resolved."""
    return F.regexp_extract(html, "<title>([^<]*)</title>", 1)


def without_suffix(title: Column, pattern: str) -> Column:
    """A page title without the site's name: a bar and pattern at the end."""
    return stripped(F.regexp_replace(stripped(title), rf"[{SPACES}]*\|[{SPACES}]*{pattern}[{SPACES}]*\z", ""))


def resource_title(title: Column) -> Column:
    """A landing page's title without the site's name, without an invitation to download, and without dots at its ends."""
    plain = without_suffix(title, "NFPA")
    plain = F.regexp_replace(plain, rf"(?i)\.?[{SPACES}]*Download the free NFPA (PDF|resource)\.?[{SPACES}]*\z", "")
    return F.regexp_replace(plain, r"\A[ .\n]+|[ .\n]+\z", "")


def locations(xml: Column) -> Column:
    """The addresses of a sitemap, in order."""
    return F.regexp_extract_all(xml, F.lit("<loc>([^<]+)</loc>"), F.lit(1))


def table_rows(html: Column) -> Column:
    """The markup of each table row's cells: array<array<string>>."""
    rows = F.regexp_extract_all(html, F.lit("(?s)<tr>(.*?)</tr>"), F.lit(1))
    return F.transform(rows, lambda r: F.regexp_extract_all(r, F.lit("(?s)<td[^>]*>(.*?)</td>"), F.lit(1)))


# identifiers, dates, names


def iso_date(us: Column, ident: Column) -> Column:
    """MM/DD/YYYY at the start as ISO; otherwise an ISO date at the start of the identifier; otherwise empty."""
    parts = r"\A(\d{2})/(\d{2})/(\d{4})"
    part = lambda i: F.regexp_extract(us, parts, i)
    return F.when(us.rlike(parts), F.concat_ws("-", part(3), part(1), part(2))).otherwise(F.regexp_extract(F.coalesce(ident, F.lit("")), r"\A\d{4}-\d{2}-\d{2}", 0))


def language_name(code: Column, label: Column) -> Column:
    """A language's name from its code and label; what stands in brackets at the label's end wins over the label."""
    code = F.lower(F.trim(stripped(code), F.lit('"')))
    inner = F.regexp_extract(label, rf"\(([^)]+)\)[{SPACES}]*\z", 1)
    other = F.coalesce(blank_to_null(stripped(F.when(inner != "", inner).otherwise(label))), F.lit("Unknown"))
    return F.when((code == "english") | (F.lower(label) == "english"), "English").when((code == "es") | (F.lower(label) == "spanish"), "Spanish").otherwise(other)


#: Names of sections that no rule gives.
SECTION_NAMES = {
    "emergencies-iaq": "Emergencies - Indoor Air Quality",
    "greenchemistry": "Green Chemistry",
    "greenercleanups": "Greener Cleanups",
    "hw-sw846": "Hazardous Waste - SW-846 Test Methods",
    "indoor-air-quality-iaq": "Indoor Air Quality",
    "indoorairplus": "Indoor airPLUS",
    "reviewing-new-chemicals-under-toxic-substances-control-act-tsca": "Reviewing New Chemicals under TSCA",
    "safepestcontrol": "Safe Pest Control",
    "toxics-release-inventory-tri-program": "Toxics Release Inventory (TRI)",
}
#: How words of a slug read where capitalising them is wrong.
NAME_WORDS = {
    "aegl": "AEGL", "cfr": "CFR", "epa": "EPA", "epcra": "EPCRA", "ghg": "GHG", "hw": "Hazardous waste", "iaq": "IAQ",
    "msgp": "MSGP", "nfpa": "NFPA", "npdes": "NPDES", "nsr": "NSR", "osha": "OSHA", "pbt": "PBT", "pcbs": "PCBs", "pfas": "PFAS",
    "rcra": "RCRA", "rmp": "RMP", "spcc": "SPCC", "sw846": "SW-846", "tri": "TRI", "tsca": "TSCA", "ust": "UST", "uv": "UV", "voc": "VOC",
    "and": "and", "for": "for", "of": "of", "the": "the", "under": "under", "in": "in", "to": "to",
}


def _mapping(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def capitalised(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substr(word, F.lit(2))))


def human_name(slug: Column) -> Column:
    """A slug as a person would write it."""
    known = _mapping(NAME_WORDS)
    parts = F.filter(F.split(F.translate(slug, "_", "-"), "-"), lambda p: p != "")

    def named(p, i):
        word = F.try_element_at(known, F.lower(p))
        return F.when(word.isNull(), capitalised(p)).when((i == 0) & (word == F.lower(word)), capitalised(word)).otherwise(word)

    return F.coalesce(F.try_element_at(_mapping(SECTION_NAMES), slug), F.array_join(F.transform(parts, named), " "))


def natural_key(ident: Column) -> Column:
    """Sort key of a section number: its segments as (leading number or -1, rest), so 4 < 4a < 10."""
    segments = F.filter(F.split(ident, r"[.\-]"), lambda s: s != "")
    number = lambda s: F.coalesce(blank_to_null(F.regexp_extract(s, r"\A\d*", 0)), F.lit("-1")).cast("decimal(38,0)")
    return F.transform(segments, lambda s: F.struct(number(s).alias("n"), F.regexp_replace(s, r"\A\d*", "").alias("rest")))


def standards_cited(html: Column) -> Column:
    """The standards that a page links to, each once, in order."""
    found = F.regexp_extract_all(html, F.lit('/laws-regs/regulations/standardnumber/[^"]*?">([^<]+)</a>'), F.lit(1))
    return F.array_join(F.array_distinct(found), ", ")


def version(date: Column) -> Column:
    return F.replace(date, F.lit("-"), F.lit("."))


def mirror_path(path: Column) -> Column:
    """A file's place in the text mirror: its last suffix becomes .txt."""
    return F.concat(F.regexp_replace(path, r"(?<=[^/])\.[^./]+\z", ""), F.lit(".txt"))


# letters


LETTER_NOTICE = "OSHA requirements are set by statute, standards and regulations."
LETTER_NOTICE_END = "https://www.osha.gov"
LETTER_ARCHIVED = "NOTICE: This is an OSHA Archive Document"


def clean_letter(s: Column) -> Column:
    """struct(body, archived): the general notice and a repeated list of standard numbers are cut. Cutting twice changes nothing."""
    start = F.instr(s, LETTER_NOTICE)
    tail = F.substr(s, F.greatest(start, F.lit(1)))
    end = F.instr(tail, LETTER_NOTICE_END)
    after = F.when(end > 0, F.substr(tail, end + len(LETTER_NOTICE_END))).otherwise(F.substr(tail, F.lit(601)))
    cut = F.when(start > 0, F.concat(F.substr(s, F.lit(1), start - 1), F.regexp_replace(after, r"\A[ .]+", ""))).otherwise(s)
    cut = F.regexp_replace(cut, rf"(?U)\A[{SPACES}]*Standard Number:[{SPACES}]*\n+(?:[{SPACES}]*[\w.,()\[\]/\- ]+\n+)*", "")
    cut = stripped(F.regexp_replace(cut, "\n{3,}", "\n\n"))
    return F.struct(cut.alias("body"), cut.contains(LETTER_ARCHIVED).alias("archived"))


def is_stub(s: Column) -> Column:
    """A directive's page that only points to its PDF."""
    return (F.length(s) < 600) | (s.contains("available in") & F.substring(s, -200, 200).contains("PDF"))


#: What a path on one machine looks like, and spellings that are placeholders.
LOCAL_PATH = r"(?<![A-Za-z0-9])(?:[A-Za-z]:[\\/]{1,2}[A-Za-z0-9_.]|/mnt/[a-z]/)"
PLACEHOLDERS = ("C:\\path\\to", "<drive>\\<parent>")


def path_lint(s: Column, folders: tuple[str, ...] = ()) -> Column:
    """array<struct(line, text)> of the lines that name a local path, numbered from 1. folders: names that a one-letter mount may hold."""
    pattern = LOCAL_PATH + "".join(f"|(?<![A-Za-z0-9])/[a-z]/{f}" for f in folders)
    lines = F.transform(F.split(s, r"\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]"), lambda x, i: F.struct((i + 1).cast("long").alias("line"), x.alias("text")))

    def names(x):
        exempt = F.lit(False)
        for p in PLACEHOLDERS:
            exempt = exempt | x["text"].contains(p)
        return x["text"].rlike(pattern) & ~exempt

    return F.filter(lines, names)
