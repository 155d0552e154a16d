"""Is a pack still what its publisher shows? Every check compares a current listing, passed in, with what is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.functions.text import blank_to_null, without_query


def known_urls(manifest: DataFrame, column: str = "source_url") -> DataFrame:
    """(key): the manifest's addresses without queries, blanks left out."""
    return manifest.filter(blank_to_null(F.col(column)).isNotNull()).select(without_query(F.col(column)).alias("key")).distinct()


def date_stale(current: Column, captured: Column) -> Column:
    """Whether the publisher's date is later; false where either is missing."""
    return F.coalesce(blank_to_null(current) > blank_to_null(captured), F.lit(False))


def difference(current: DataFrame, known: DataFrame, sample: int = 10, only_added: bool = False) -> DataFrame:
    """One row of two tables (key): stale, added, removed, and the first `sample` of each, sorted.

    Both sides are compared in one join; samples come from ranked rows, never from a gathered set.
    With only_added, what has gone does not make a pack stale.
    """
    a = current.select("key").distinct().withColumn("here", F.lit(True))
    b = known.select("key").distinct().withColumn("there", F.lit(True))
    apart = a.join(b, "key", "full_outer").filter(F.col("here").isNull() | F.col("there").isNull()).select("key", F.col("there").isNull().alias("added"))
    counts = apart.groupBy("added").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("added").orderBy("key"))
    first = apart.withColumn("place", place).filter(F.col("place") <= sample).groupBy("added").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    of = lambda side, c: F.max(F.when(F.col("added") == side, F.col(c)))
    n = lambda side: F.coalesce(of(side, "n"), F.lit(0).cast("long"))
    keys = lambda side: F.coalesce(of(side, "keys"), F.array().cast("array<string>"))
    found = counts.join(first, "added").agg(n(True).alias("added"), n(False).alias("removed"), keys(True).alias("added_sample"), keys(False).alias("removed_sample"))
    stale = (F.col("added") > 0) if only_added else (F.col("added") + F.col("removed") > 0)
    return found.select(stale.alias("stale"), "added", "removed", "added_sample", "removed_sample")


def harvest(current: DataFrame | None, known: DataFrame) -> DataFrame:
    """difference(), or an unchecked row (stale null) without a current listing."""
    if current is not None:
        return difference(current, known)
    none = F.array().cast("array<string>")
    return known.sparkSession.range(1).select(F.lit(None).cast("boolean").alias("stale"), F.lit(0).cast("long").alias("added"), F.lit(0).cast("long").alias("removed"), none.alias("added_sample"), none.alias("removed_sample"))


def folded(identifiers: DataFrame, column: str) -> DataFrame:
    """(key): identifiers in lower case, as publishers write one in several ways."""
    return identifiers.filter(F.col(column).isNotNull()).select(F.lower(column).alias("key"))


def new_identifiers(current: DataFrame, known: DataFrame, sample: int = 20) -> DataFrame:
    """difference() of identifiers (key) without regard to case; only new ones make a pack stale."""
    return difference(folded(current, "key"), folded(known, "key"), sample, only_added=True)


#: The corpus whose manifest a pack's addresses are compared with.
COMPARED = {"osha-publications": "EHS", "osha-interpretations": "OSHA-Interpretations", "osha-directives": "OSHA-Directives", "nfpa-public": "NFPA-Public", "epa": "EPA", "cfr-29": "CFR-29", "dot-hazmat": "CFR-49"}


def compared(pack_id: str) -> str | None:
    return COMPARED.get("epa" if pack_id.startswith("epa-") else pack_id)


def checked(pack_id: str, how: str | None, detail: str, current: DataFrame | None, manifest: DataFrame | None, captured: str = "", date: str | None = None, now: Column | None = None) -> DataFrame:
    """The report row of one pack, by its method: how and detail as plan() gives them.

    current holds what the publisher lists (key: addresses, or identifiers for new_identifier), date the
    publisher's date for api_date.  Where what a method needs is missing, the row says unchecked: stale is null.
    """
    spark = (manifest if manifest is not None else current).sparkSession
    none = F.array().cast("array<string>")
    row = lambda stale, said: spark.range(1).select(F.lit(stale).cast("boolean").alias("stale"), F.lit(0).cast("long").alias("added"), F.lit(0).cast("long").alias("removed"), none.alias("added_sample"), none.alias("removed_sample"), F.lit(said).alias("detail"))
    if how is None:
        found = row(None, detail)
    elif how == "api_date":
        found = row(None, "no date given") if date is None else row(None, f"{captured or 'never'} -> {date}").withColumn("stale", date_stale(F.lit(date), F.lit(captured)))
    elif current is None:
        found = row(None, "needs the publisher's current listing")
    elif how == "new_identifier":
        found = new_identifiers(current, manifest.select(F.col("identifier").alias("key"))).withColumn("detail", F.lit(""))
    else:
        found = difference(current.select(without_query(F.col("key")).alias("key")), known_urls(manifest)).withColumn("detail", F.lit(""))
    return report(pack_id, how, found, now)


def owners(specs: DataFrame) -> DataFrame:
    """(pack_id, owner): every spec by its own id, members by the first meta spec that lists them."""
    own = specs.select("pack_id", F.col("pack_id").alias("owner"), F.lit(0).alias("rank"))
    members = specs.select(F.explode("members").alias("pack_id"), F.col("pack_id").alias("owner")).withColumn("rank", F.lit(1))
    return own.unionByName(members).groupBy("pack_id").agg(F.min_by("owner", F.struct("rank", "owner")).alias("owner"))


def due(specs: DataFrame, checks: DataFrame, now: Column) -> DataFrame:
    """(pack_id) of packs whose cadence has passed: specs (pack_id, kind, members, cadence_days), checks (pack_id, checked_at). Metas stand for their members; a pack never checked is due."""
    members = F.when((F.col("kind") == "meta") & F.col("members").isNotNull(), F.col("members")).otherwise(F.array("pack_id"))
    ids = specs.filter(F.coalesce("cadence_days", F.lit(0)) != 0).select(F.explode(members).alias("pack_id"), "cadence_days")
    last = checks.groupBy("pack_id").agg(F.max("checked_at").alias("checked_at"))
    age = F.floor((F.unix_timestamp(now) - F.unix_timestamp("checked_at")) / 86400)
    return ids.join(last, "pack_id", "left").filter(F.col("checked_at").isNull() | (age >= F.col("cadence_days"))).select("pack_id")


def record(captures: DataFrame, corpus: str, date: str) -> DataFrame:
    """captures (corpus, captured_at) with corpus set to date."""
    new = captures.sparkSession.range(1).select(F.lit(corpus).alias("corpus"), F.lit(date).alias("captured_at"))
    return captures.filter(F.col("corpus") != corpus).unionByName(new)


#: How a pack is checked; packs of sections are checked as the whole they are part of.
METHODS = {
    "cfr-29": "api_date",
    "dot-hazmat": "api_date",
    "osha-publications": "manifest_hash",
    "osha-interpretations": "manifest_hash",
    "osha-directives": "new_identifier",
    "nfpa-public": "manifest_hash",
    "epa": "harvest",
}


def method(pack_id: Column) -> Column:
    """The way a pack is checked; null for one that has none."""
    known = F.create_map(*[F.lit(x) for pair in METHODS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, pack_id), F.when(pack_id.startswith("epa-"), "harvest"))


def plan(packs: DataFrame, specs: DataFrame) -> DataFrame:
    """(pack_id, owner, method, detail) of packs (pack_id): what to check and how, or why not."""
    rows = packs.join(owners(specs), "pack_id", "left").withColumn("method", F.when(F.col("owner").isNotNull() | F.col("pack_id").startswith("epa-"), method(F.col("pack_id"))))
    detail = F.when(F.col("method").isNotNull(), "").when(F.col("owner").isNull(), "unknown pack").otherwise("no checker for this pack")
    return rows.select("pack_id", "owner", "method", detail.alias("detail"))


def report(pack_id: str, how: str | None, found: DataFrame, now: Column | None = None) -> DataFrame:
    """A report row of a check's row."""
    at = F.date_format(now if now is not None else F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    return found.select(F.lit(pack_id).alias("pack"), at.alias("checked_at"), F.lit(how).cast("string").alias("method"), *found.columns)
