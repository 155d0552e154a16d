"""The master index: every manifest in one shape, with provenance and rights, checked against the disk."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.text import first_filled

COLUMNS = ("corpus", "relative_path", "language", "format", "title", "identifier", "source_url", "source_page", "publisher", "rights", "bytes", "sha256")


def projection(manifest: DataFrame, corpus: str, folder: str, **given: Column | str) -> DataFrame:
    """A manifest in the master index's shape; given holds columns, or literals as strings, for what its own columns don't have."""
    have = set(manifest.columns)

    def column(name: str) -> Column:
        if name in given:
            return given[name] if isinstance(given[name], Column) else F.lit(given[name])
        return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in have else F.lit("")

    fields = {"corpus": F.lit(corpus), "relative_path": F.concat(F.lit(folder + "/"), F.col("relative_path")), "bytes": F.col("bytes").cast("long")}
    return manifest.select(*[fields.get(c, column(c)).alias(c) for c in COLUMNS])


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


#: Publishers and rights of the corpora.
LABOR = "U.S. Occupational Safety and Health Administration"
PRINTING = "U.S. Government Publishing Office / eCFR"
ENVIRONMENT = "U.S. Environmental Protection Agency"
PUBLIC = "Public domain (17 U.S.C. 105) - U.S. federal government work"
FREE = "Copyright NFPA; offered free by NFPA for public education/research - see NFPA-Public/README.md"
BY_REFERENCE = "Copyright NFPA; posted by Public.Resource.Org as incorporated by reference into law - not distributed as a pack; see NFPA/README.md"


def from_manifests(manifests: dict[str, DataFrame], rights: dict[str, str] | None = None) -> DataFrame:
    """The master index of the manifests of the known corpora, by folder name; a missing one adds nothing."""
    said = {"public": PUBLIC, "free": FREE, "reference": BY_REFERENCE} | (rights or {})
    col, url = F.col, F.col("source_url")
    plans = {
        "EHS": ("OSHA-Publications", {"identifier": col("publication_id"), "source_page": "https://www.osha.gov/publications", "publisher": LABOR, "rights": said["public"]}),
        "OSHA-Interpretations": ("OSHA-Interpretations", {"language": "English", "format": "TEXT", "identifier": F.left(first_filled(col("standards_cited"), col("identifier")), F.lit(150)), "source_page": url, "publisher": LABOR, "rights": said["public"]}),
        "OSHA-Directives": ("OSHA-Directives", {"language": "English", "identifier": first_filled(col("directive_number"), col("identifier")), "source_page": url, "publisher": LABOR, "rights": said["public"]}),
        **{c: (c, {"language": "English", "format": "TEXT", "title": col("subject"), "identifier": col("citation"), "source_page": url, "publisher": PRINTING, "rights": said["public"]}) for c in ("CFR-29", "CFR-49")},
        "EPA": ("EPA", {"language": "English", "identifier": col("section"), "publisher": ENVIRONMENT, "rights": said["public"]}),
        "NFPA": ("NFPA-IBR", {"language": "English", "format": col("kind"), "identifier": F.trim(F.format_string("%s (%s)", "standard", "edition_year")), "source_page": col("source_details_page"), "rights": said["reference"]}),
        "NFPA-Public": ("NFPA-Public", {"identifier": F.trim(F.concat_ws("/", "collection", "category"), F.lit("/")), "rights": said["free"]}),
    }
    return union([projection(manifests[folder], corpus, folder, **given) for folder, (corpus, given) in plans.items() if folder in manifests])


def reconcile(listed: DataFrame, disk: DataFrame, key: str = "relative_path") -> DataFrame:
    """One row: how many distinct paths, ignoring case, are listed, on disk, missing from disk, and not listed."""
    a = listed.select(F.lower(key).alias("k")).distinct().withColumn("listed", F.lit(True))
    b = disk.select(F.lower(key).alias("k")).distinct().withColumn("on_disk", F.lit(True))
    both = a.join(b, "k", "full_outer")
    return both.agg(F.count("listed").alias("listed"), F.count("on_disk").alias("disk"), F.count_if(F.col("on_disk").isNull()).alias("missing"), F.count_if(F.col("listed").isNull()).alias("unlisted"))


def totals(index: DataFrame) -> DataFrame:
    """One row: rows, bytes, and whether all have an address and a digest (true of none)."""
    every = lambda c: F.coalesce(F.bool_and(F.coalesce(c, F.lit(False))), F.lit(True))
    return index.agg(F.count("*").alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), every(F.col("source_url").startswith("http")).alias("all_have_url"), every(F.length("sha256") == 64).alias("all_have_sha"))


def latest_wins(manifest: DataFrame, order: str) -> DataFrame:
    """Of rows with one relative_path, the last by order, which is not kept."""
    return manifest.groupBy("relative_path").agg(F.max_by(F.struct(*[c for c in manifest.columns if c not in ("relative_path", order)]), order).alias("_r")).select("relative_path", "_r.*")


def by_corpus(index: DataFrame) -> DataFrame:
    """rows of each corpus."""
    return index.groupBy("corpus").agg(F.count("*").alias("rows"))
