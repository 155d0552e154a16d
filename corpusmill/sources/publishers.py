"""The publishers' sites as crawls: where each begins, what its pages lead to, and the files and manifest that come of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import schemas
from corpusmill.functions import markup
from corpusmill.functions import text as X
from corpusmill.operators import collect
from corpusmill.operators.index import suffixed
from corpusmill.operators.master import ENVIRONMENT
from corpusmill.sources import fetch, files
from corpusmill.sources.crawl import by_kind, crawl

#: Sites, publishers, catalogue pages and what their files are called.
SAFETY, AGENCY, FIRE = "https://www.osha.gov", "https://www.epa.gov", "https://www.nfpa.org"
SAFETY_NAME, FIRE_NAME = "U.S. Occupational Safety and Health Administration", "National Fire Protection Association"
CATALOGUE = (*[f"{SAFETY}/publications/all?page={n}" for n in range(25)], f"{SAFETY}/publications/all-n?pub_first_letter_filter=1")
EXTENSIONS = {"PDF": ".pdf", "EPUB": ".epub", "MOBI": ".mobi", "DOCX": ".docx", "HTML": ".html"}
FREE = r"(?i)\.?\s*Download the free NFPA (PDF|resource)\.?\s*\z"


@dataclass(frozen=True)
class Publisher:
    """corpus: its folder; manifest: its columns' name; seeds: (url, kind); rules: see by_kind; texts and plan: what becomes of the pages; rows: manifest rows of the files on disk, by pages, plan and files (relative_path, content)."""

    corpus: str
    manifest: str
    seeds: Callable[[SparkSession], DataFrame]
    rules: dict[str, Callable[[DataFrame], DataFrame]]
    texts: Callable[[DataFrame], DataFrame] | None
    plan: Callable[[DataFrame], DataFrame] | None
    rows: Callable[[DataFrame | None, DataFrame], DataFrame]


def _of(pages: DataFrame, kind: str) -> DataFrame:
    return pages.filter((F.col("kind") == kind) & (F.col("outcome") == "ok"))


def _seeds(rows: list[tuple[str, str]], listing: str | None = None) -> Callable[[SparkSession], DataFrame]:
    def made(spark: SparkSession) -> DataFrame:
        given = spark.createDataFrame(rows, "url string, kind string")
        return given if listing is None else given.unionByName(collect.listing_pages(spark, listing).withColumn("kind", F.lit("listing")))

    return made


def _addresses(kind: str, wanted: Callable[[Column], Column]) -> Callable[[DataFrame], DataFrame]:
    """A sitemap's addresses that are wanted."""
    return lambda pages: collect.sitemap(pages).filter(wanted(F.col("url"))).withColumn("kind", F.lit(kind))


def _listed(pages: DataFrame, wanted: Column) -> DataFrame:
    """(url, date, title, number) of listings' rows, one an address: the first by page and row."""
    rows = collect.listed(pages.withColumn("page", F.col("url")), SAFETY).filter(wanted)
    return rows.groupBy("url").agg(F.min_by(F.struct("date", "title", "number"), F.struct("page", "row")).alias("r")).select("url", "r.*")


def _named(title: Column, stem: Column, length: int = 80) -> Column:
    return F.concat(markup.slugged(title, length), F.lit("__"), stem)


# letters


def _letter_rows(pages: DataFrame) -> DataFrame:
    return _listed(pages, F.col("url").contains("/standardinterpretations/"))


def _letters(pages: DataFrame) -> DataFrame:
    known = _letter_rows(_of(pages, "listing")).select("url", "title", "date", F.col("number").alias("standards"))
    made = collect.letters(_of(pages, "letter").select("url", "body"), known)
    return made.select(F.concat(F.lit("Letters/"), _named(F.col("title"), F.col("identifier")), F.lit(".txt")).alias("path"), "text")


def _letter_manifest(plan: DataFrame | None, held: DataFrame) -> DataFrame:
    return collect.header_manifest(held.filter(F.col("relative_path").startswith("Letters/")), collect.LETTER_COLUMNS).withColumn("publisher", F.lit(SAFETY_NAME))


# directives


def _is_pdf(url: Column) -> Column:
    return F.lower(url).endswith(".pdf")


def _directive_rows(pages: DataFrame) -> DataFrame:
    return _listed(pages, F.lit(True))


def _directive_pages(pages: DataFrame) -> DataFrame:
    """The pages that listings name; their PDFs are downloads."""
    return _directive_rows(pages).filter(~_is_pdf(F.col("url"))).select("url", F.lit("directive").alias("kind"))


def _directives(pages: DataFrame) -> DataFrame:
    known = _directive_rows(_of(pages, "listing"))
    return collect.directives(_of(pages, "directive").select("url", "body"), known, SAFETY)


def _directive_texts(pages: DataFrame) -> DataFrame:
    return _directives(pages).select(F.concat(F.lit("Text/"), "name", F.lit(".txt")).alias("path"), "text")


def _directive_plan(pages: DataFrame) -> DataFrame:
    """PDFs of stubs, and those that listings or the sitemap name themselves."""
    stubs = _directives(pages).filter("stub and pdf is not null").select(F.col("pdf").alias("url"), "name")
    rows = _directive_rows(_of(pages, "listing")).select("url", "title")
    rows = rows.unionByName(collect.sitemap(_of(pages, "sitemap")).filter(collect.directive_page(F.col("url"))).withColumn("title", F.lit("")))
    direct = rows.filter(_is_pdf(F.col("url"))).groupBy("url").agg(F.max("title").alias("title"))
    ident = F.regexp_replace(X.last_segment(F.col("url")), r"(?i)\.pdf\z", "")
    direct = direct.select("url", _named(X.first_filled(F.col("title"), ident), ident).alias("name"))
    return stubs.unionByName(direct).groupBy("name").agg(F.min("url").alias("url")).select("url", F.concat(F.lit("PDF/"), "name", F.lit(".pdf")).alias("path"))


def _directive_manifest(plan: DataFrame | None, held: DataFrame) -> DataFrame:
    """Texts by their headers; of PDFs the title and the identifier are those of the file's name."""
    texts = collect.header_manifest(held.filter(F.col("relative_path").startswith("Text/")), collect.DIRECTIVE_COLUMNS).withColumn("format", F.lit("TEXT"))
    pdfs = held.filter(F.col("relative_path").startswith("PDF/"))
    name = F.regexp_extract("relative_path", r"\APDF/(.*)\.[^.]*\z", 1)
    ident = F.element_at(F.split(name, "__"), -1)
    title = F.replace(F.when(name.contains("__"), F.regexp_extract(name, r"\A(.*)__", 1)).otherwise(name), F.lit("-"), F.lit(" "))
    none = F.lit("")
    pdfs = pdfs.select("relative_path", F.lit("PDF").alias("format"), title.alias("title"), none.alias("date"), none.alias("directive_number"), ident.alias("identifier"), F.concat(F.lit(f"{SAFETY}/sites/default/files/enforcement/directives/"), ident, F.lit(".pdf")).alias("source_url"), F.octet_length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return texts.unionByName(pdfs).withColumn("publisher", F.lit(SAFETY_NAME))


# catalogue of publications


def _publication_plan(pages: DataFrame) -> DataFrame:
    found = collect.publications(_of(pages, "catalogue").withColumn("page", F.col("url")), SAFETY)
    base = X.last_segment(F.col("url"))
    ext = F.lower(F.regexp_extract(base, r"(?<=.)(\.[^.]+)\z", 1))
    own = F.length(ext).between(1, 6)
    known = F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for pair in EXTENSIONS.items() for v in pair]), F.col("format")), F.lit(".html"))
    stem = F.when(own, F.regexp_replace(base, r"(?<=.)\.[^.]*\z", "")).otherwise(base)
    rows = found.withColumn("file", F.concat(collect.folder(F.col("language")), F.lit("/"), _named(F.col("title"), stem, 90))).withColumn("ext", F.when(own, ext).otherwise(known))
    rows = suffixed(rows, "file", "ext", [F.col("url"), F.col("language")])
    return rows.select("url", F.regexp_replace("path", r"\AEHS/", "").alias("path"), "language", "format", "title", "publication_id")


# the agency's documents


def _agency_plan(pages: DataFrame) -> DataFrame:
    found = collect.first_pages(collect.links(_of(pages, "page").select("url", "body"), AGENCY, "epa.gov"))
    rows = collect.file_plan(found, AGENCY)
    form = F.upper(F.regexp_extract("path", r"\.([^.]*)\z", 1))
    return rows.select("url", F.regexp_replace("path", r"\AEPA/", "").alias("path"), "section", form.alias("format"), F.left("title", F.lit(300)).alias("title"), F.col("ref_page").alias("source_page"))


# resources in two languages


def _landing(pages: DataFrame) -> DataFrame:
    return collect.resource_pages(collect.sitemap(pages), FIRE)


def _spanish(url: Column) -> Column:
    return F.concat(F.lit(f"{FIRE}/es"), F.replace(url, F.lit(FIRE), F.lit("")))


def _other_language(pages: DataFrame) -> DataFrame:
    """The Spanish page of a page that has documents."""
    return pages.filter(F.size(collect.media(F.col("body"))) > 0).select(_spanish(F.col("url")).alias("url"), F.lit("spanish").alias("kind"))


def _resource_plan(pages: DataFrame) -> DataFrame:
    landing = _landing(_of(pages, "sitemap")).withColumnRenamed("kind", "collection")
    english = _of(pages, "page").select("url", "body").join(landing, "url").withColumn("here", collect.media(F.col("body")))
    spanish = _of(pages, "spanish").select(F.col("url").alias("es"), collect.media(F.col("body")).alias("there"))
    both = english.withColumn("es", _spanish(F.col("url"))).join(spanish, "es", "left")
    title = X.without_suffix(markup.html_unescape(X.title_markup(F.col("body"))), "NFPA")
    title = F.trim(F.regexp_replace(title, FREE, ""), F.lit(" .\n"))
    side = lambda language, found, page: F.struct(F.lit(language).alias("language"), found.alias("found"), page.alias("page"))
    none = F.array().cast("array<string>")
    sides = F.array(side("English", F.col("here"), F.col("url")), side("Spanish", F.coalesce(collect.only_here(F.col("there"), F.col("here")), none), F.col("es")))
    rows = both.select("collection", "category", title.alias("title"), F.explode(sides).alias("s")).select("collection", "category", "title", "s.language", "s.page", F.posexplode("s.found").alias("pos", "file"))
    rows = rows.withColumn("file", markup.html_unescape(F.col("file"))).withColumn("key", X.without_query(F.col("file")))
    first = F.min_by(F.struct("collection", "category", "title", "page", "file"), F.struct("page", "pos"))
    rows = rows.groupBy("key", "language").agg(first.alias("r")).select("key", "language", "r.*")
    base = X.last_segment(F.col("key"))
    spoken = F.when(F.col("language") == "English", "English").otherwise("Espanol")
    rows = rows.withColumn("stem", F.concat(F.col("collection"), F.lit("/"), spoken, F.lit("/"), _named(F.col("title"), F.regexp_replace(base, r"(?<=.)\.[^.]*\z", ""), 85))).withColumn("ext", F.lower(F.regexp_extract(base, r"(\.[^.]+)\z", 1)))
    rows = suffixed(rows, "stem", "ext", [F.col("page"), F.col("key"), F.col("language")])
    return rows.select(F.concat(F.lit(FIRE), "file").alias("url"), "path", "collection", "category", "language", F.upper(F.ltrim(F.col("ext"), F.lit("."))).alias("format"), "title", F.col("page").alias("source_page"))


def _planned(publisher: str | None, plan: DataFrame, held: DataFrame) -> DataFrame:
    """Manifest rows of a plan's files that are on disk."""
    rows = collect.on_disk(plan.withColumnRenamed("url", "source_url").withColumnRenamed("path", "relative_path"), held)
    return rows if publisher is None else rows.withColumn("publisher", F.lit(publisher))


SITEMAP = "sitemap"
PUBLISHERS = {
    "osha-pubs": Publisher("EHS", "publications", _seeds([(u, "catalogue") for u in CATALOGUE]), {}, None, _publication_plan, partial(_planned, None)),
    "osha-interp": Publisher(
        "OSHA-Interpretations", "interpretations", _seeds([(f"{SAFETY}/sitemap.xml", SITEMAP)], "osha-interp"),
        {"listing": lambda p: _letter_rows(p).select("url", F.lit("letter").alias("kind")), SITEMAP: _addresses("letter", collect.dated_letter)}, _letters, None, _letter_manifest,
    ),
    "osha-dir": Publisher(
        "OSHA-Directives", "directives", _seeds([(f"{SAFETY}/sitemap.xml", SITEMAP)], "osha-dir"),
        {"listing": _directive_pages, SITEMAP: _addresses("directive", lambda u: collect.directive_page(u) & ~_is_pdf(u))}, _directive_texts, _directive_plan, _directive_manifest,
    ),
    "epa": Publisher(
        "EPA", "epa", _seeds([(f"{AGENCY}/sitemap.xml", "index")]),
        {"index": _addresses(SITEMAP, lambda u: F.lit(True)), SITEMAP: _addresses("page", lambda u: collect.in_scope(u, AGENCY))}, None, _agency_plan, partial(_planned, ENVIRONMENT),
    ),
    "nfpa-public": Publisher(
        "NFPA-Public", "nfpa_public", _seeds([(f"{FIRE}/sitemap.xml", SITEMAP)]),
        {SITEMAP: lambda p: _landing(p).select("url", F.lit("page").alias("kind")), "page": _other_language}, None, _resource_plan, partial(_planned, FIRE_NAME),
    ),
}


def collected(spark: SparkSession, name: str, root: str, store: str, fetcher: Callable = fetch.fetch, download: Callable = fetch.download, most: int = 5000) -> dict:
    """Crawls a publisher's site into store, writes its texts, downloads its files below root, and lists what is there in the corpus's manifest.

    Letters and directives that are on disk are not asked again. A file that can't be had is missing, not an error.
    """
    at = PUBLISHERS[name]
    folder = f"{root.rstrip('/')}/{at.corpus}"
    had = collect.identifiers(_held(spark, root, at.corpus))

    def follow(pages: DataFrame) -> DataFrame:
        found = by_kind(pages, at.rules)
        if at.texts is None:
            return found
        return found.withColumn("identifier", F.regexp_replace(X.last_segment(F.col("url")), r"(?i)\.pdf\z", "")).join(had, "identifier", "left_anti")

    pages = crawl(spark, store, at.seeds(spark), follow, fetcher, most)
    if at.texts is not None:
        files.write_texts(at.texts(pages), folder)
    plan = None
    if at.plan is not None:
        at.plan(pages).write.mode("overwrite").parquet(f"{store}/plan")
        plan = spark.read.parquet(f"{store}/plan")
        download(plan.select("url", "path"), folder).write.mode("overwrite").parquet(f"{store}/downloads")
    rows = at.rows(plan, _held(spark, root, at.corpus))
    files.write_one_csv(rows.select(*schemas.MANIFESTS[at.manifest].split()).orderBy("relative_path"), f"{folder}/manifest.csv")
    outcomes = {r.outcome: r["count"] for r in pages.groupBy("outcome").count().collect()}
    return {"pages": outcomes, "planned": 0 if plan is None else plan.count(), "files": files.manifest(spark, root, at.corpus, at.manifest).count()}


def _held(spark: SparkSession, root: str, corpus: str) -> DataFrame:
    """(relative_path, content) of a corpus's files, their paths below its folder."""
    rows = files.documents(spark, root).filter(F.col("corpus") == corpus)
    return rows.select(F.substr("relative_path", F.lit(len(corpus) + 2)).alias("relative_path"), "content")
