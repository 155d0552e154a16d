"""Source divergence audit: how the words of each source differ from those of the other sources in its language.

Plain relational, DataFrame functions only.  Matches are exploded and counted by group (lang, source) and
term, with the number of texts that hold each; groups are crossed with their language's kept vocabulary, so
that terms a group lacks count zero; a self-join on language and term gives the summed differences of every
two sources, a window the ranks.

Hot languages: counts are combined before they are shuffled, and vocabulary and groups are joined on language
and a share of the terms, so that no task holds a whole language.  Only the ranks' windows hold a group's rows,
which are its language's sources or, cut to the report's length before the shuffle, its first terms.

All arithmetic is on whole numbers; products that 64 bits may not hold are decimals.  A group's shares sum to
SCALE and one a kept term at most, so squares of their differences, and the sums of these, fit 64 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.store import partitions, written

#: what a share of 1 is scaled to
SCALE = 1_000_000_000
#: what stands between two terms of a lowered text
_BETWEEN = r"[\x00-\x60\x7B-\x7F]+"


def scaled(count: str, of: str) -> Column:
    """1 + floor(SCALE * (count + 1) / of): in 64 bits where the product fits them, otherwise as a decimal."""
    short = f"({SCALE} * ({count} + 1)) div ({of})"
    long = f"cast(cast({SCALE} AS decimal(10,0)) * cast({count} + 1 AS decimal(20,0)) AS decimal(38,0)) div cast({of} AS decimal(20,0))"
    return F.expr(f"1 + if({count} < {(1 << 63) // SCALE - 1}, {short}, {long})")


def term_counts(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, count, texts): occurrences, and texts that hold the term. Each group has a row at least, if only for the empty term, which is no term."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    # lowering other letters than A-Z would change terms: those of texts beyond ASCII are lowered one by one
    low = F.when(F.octet_length(empty(text)) == F.char_length(empty(text)), F.lower(empty(text))).otherwise(F.translate(empty(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    rows = df.select(empty(lang).alias("lang"), empty(source).alias("source"), F.split(low, _BETWEEN).alias("terms"))
    both = F.array(F.struct(F.lit(0).alias("once"), F.col("terms")), F.struct(F.lit(1).alias("once"), F.array_distinct("terms").alias("terms")))
    terms = rows.select("lang", "source", F.explode(both).alias("x")).select("lang", "source", "x.once", F.explode("x.terms").alias("term"))
    return terms.groupBy("lang", "source", "term").agg(F.count_if(F.col("once") == 0).alias("count"), F.sum("once").alias("texts"))


def divergence(df: DataFrame, at_least: int = 3, top: int = 200, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """Rows (lang, source, part, item, value, rank).

    Part `pair`: item is another source of the language, value the sum over the language's kept terms (those in
    at_least of its texts) of the squared difference of the two scaled shares over the other's.  Part `term`: item
    is a term whose share in the source exceeds its share in the language, value the same measure against the
    language; the first top ones.  Ranks run from 1, values descending, then items ascending by bytes.

    Null texts, languages and sources are empty ones.  A source without terms is a group all the same; where a
    language keeps no term its pairs have value 0.  Repeated rows count as texts of their own.  An empty table, or
    languages of one source and no kept term, give no row.  Other columns of df are not read.
    """
    shares = partitions(df.sparkSession)
    counts = written(term_counts(df, text, lang, source), "terms")
    groups = counts.groupBy("lang", "source").agg(F.lit(0).alias("n")).select("lang", "source", F.monotonically_increasing_id().alias("at"))
    groups = written(groups, "groups")
    kept = counts.filter(F.col("term") != "").groupBy("lang", "term").agg(F.sum("count").alias("in_lang"), F.sum("texts").alias("texts"))
    kept = kept.filter(F.col("texts") >= at_least).select("lang", "term", "in_lang", F.monotonically_increasing_id().alias("term_at"))
    kept = written(kept, "vocabulary")

    # from here on a group and a term of a language are known by the numbers they were written with
    found = counts.join(kept, ["lang", "term"]).join(groups, ["lang", "source"]).select("at", "term_at", "count")
    found = written(found, "found")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("in_lang").alias("n_lang"))
    totals = found.groupBy("at").agg(F.sum("count").alias("n"))
    sized = groups.join(sizes, "lang").join(totals, "at", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    dealt = sized.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    crossed = kept.withColumn("share", (F.col("term_at") % shares).cast("int")).join(dealt, ["lang", "share"])
    dense = crossed.select("at", "term_at", "in_lang", "v", "n", "n_lang").join(found, ["at", "term_at"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    dense = written(dense.select("at", "term_at", (F.col("count") > 0).alias("has"), scaled("count", "n + v").alias("p"), scaled("in_lang", "n_lang + v").alias("q")), "dense")

    differ = F.expr("((p - q) * (p - q)) div q")
    other = dense.select("term_at", F.col("at").alias("other"), F.col("p").alias("q"))
    met = dense.select("term_at", "at", "p").join(other, "term_at").filter("at <> other")
    sums = met.groupBy("at", "other").agg(F.sum(differ).alias("value"))
    others = groups.select("lang", F.col("source").alias("item"), F.col("at").alias("other"))
    pairs = groups.join(others, "lang").filter("at <> other").join(sums, ["at", "other"], "left")
    pairs = pairs.select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))
    terms = dense.filter("has AND p > q").select("at", "term_at", differ.alias("value"))
    terms = terms.join(kept.select("term_at", F.col("term").alias("item")), "term_at").join(groups, "at").select("lang", "source", "item", "value")

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs, "pair").unionByName(ranked(terms, "term").filter(F.col("rank") <= top))
