"""Crawls in rounds: what is known and not yet asked is fetched, what the pages lead to is known in the next round.

A round is two tables in a folder, its pages and what they lead to, each written whole by Spark.  A run that was
stopped goes on after the last whole round; nothing that is written is asked for again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.sources.fetch import fetch
from corpusmill.sources.files import exists
from corpusmill.sources.scratch import stored

PAGE = "url string, kind string, outcome string, body string"
KNOWN = "url string, kind string"


def crawl(spark: SparkSession, folder: str, seeds: DataFrame, follow: Callable[[DataFrame], DataFrame], fetcher: Callable[[DataFrame], DataFrame] = fetch, most: int = 5000) -> DataFrame:
    """(url, kind, outcome, body, round) of all that seeds (url, kind) lead to, one row an address.

    follow gives (url, kind) for pages (url, kind, body) that were had; fetcher gives (url, outcome, body) for (url).
    A round asks at most `most` addresses, in order; the others wait for the next one, so a stopped run loses no more
    than that.  Addresses that failed are asked again by the next call, not by this one.  An address known as several
    kinds is of the first by name; null addresses are left out.  Rounds are the longest way from a seed, or the
    addresses by `most` where that is more.
    """
    pages, known = f"{folder.rstrip('/')}/pages", f"{folder.rstrip('/')}/known"
    n = 0
    while _whole(spark, pages, n):
        n += 1
    if n and not _whole(spark, known, n - 1):
        _follow(spark, pages, known, n - 1, follow)
    begun = n
    while True:
        asked = _rounds(spark, pages, PAGE, n).filter((F.col("outcome") != "failed") | (F.col("round") >= begun)).select("url")
        found = seeds.select("url", "kind").unionByName(_rounds(spark, known, KNOWN, n).select("url", "kind")).filter("url is not null")
        todo = found.groupBy("url").agg(F.min("kind").alias("kind")).join(asked, "url", "left_anti").orderBy("url").limit(most)
        todo, _ = stored(todo, "frontier")
        if todo.isEmpty():
            break
        got = todo.join(fetcher(todo.select("url")), "url", "left")
        got.select("url", "kind", F.coalesce("outcome", F.lit("failed")).alias("outcome"), "body").write.mode("overwrite").parquet(_place(pages, n))
        _follow(spark, pages, known, n, follow)
        n += 1
    last = F.max_by(F.struct("kind", "outcome", "body", "round"), F.struct((F.col("outcome") == "ok").alias("ok"), "round"))
    return _rounds(spark, pages, PAGE, n).groupBy("url").agg(last.alias("r")).select("url", "r.*")


def _place(table: str, n: int) -> str:
    return f"{table}/round={n}"


def _whole(spark: SparkSession, table: str, n: int) -> bool:
    return exists(spark, f"{_place(table, n)}/_SUCCESS")


def _rounds(spark: SparkSession, table: str, ddl: str, n: int) -> DataFrame:
    """The first n rounds of a table, with the round's number."""
    if not n:
        return spark.createDataFrame([], f"{ddl}, round int")
    return spark.read.schema(f"{ddl}, round int").option("basePath", table).parquet(*[_place(table, i) for i in range(n)])


def _follow(spark: SparkSession, pages: str, known: str, n: int, follow: Callable) -> None:
    had = spark.read.schema(PAGE).parquet(_place(pages, n)).filter("outcome = 'ok'").select("url", "kind", "body")
    follow(had).select("url", "kind").distinct().write.mode("overwrite").parquet(_place(known, n))


def by_kind(pages: DataFrame, rules: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """What pages lead to by the rule of their kind: kind -> (pages -> (url, kind)); kinds without a rule lead nowhere."""
    found = [rule(pages.filter(F.col("kind") == kind)).select("url", "kind") for kind, rule in rules.items()]
    return reduce(DataFrame.unionByName, found) if found else pages.select("url", "kind").filter("false")
