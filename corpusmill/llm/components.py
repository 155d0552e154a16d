"""Connected components of a table of links, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corpusmill.sources.scratch import removed, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id with a link; component is the smallest id reachable.

    Alternating large-star and small-star steps: each is one grouped minimum and one join, every
    round is written to the shared folder, and the rounds grow with the logarithm of a component's size.
    Minima are combined before the shuffle and the join's hot side can be split, so one huge component
    does no harm.  Null ends and links of an id with itself are ignored.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    spark = links.sparkSession
    edges, at, mark = _kept(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.filter("u <> v").distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges, place, now = _kept(small.filter("u <> v").distinct())
        removed(spark, at)  # nothing reads the round before any more
        at = place
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _kept(edges: DataFrame) -> tuple[DataFrame, str, tuple]:
    """Edges written, where they lie, and a mark by which equal sets of edges are known: their number and 128 bits of sums of hashes, taken as they are written."""
    seen = Observation()
    total = lambda seed: F.coalesce(F.sum(F.xxhash64(F.lit(seed), "u", "v").cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))
    rows, at = stored(edges.observe(seen, F.count(F.lit(1)).alias("n"), total(1).alias("x"), total(2).alias("y")), "links", compression="zstd")
    found = seen.get
    return rows, at, (found["n"], found["x"], found["y"])
