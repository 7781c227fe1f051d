"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _pairs(df: DataFrame, a, b) -> DataFrame:
    return df.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").union(e.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _pairs(both.where("b > a").join(least, "a"), F.col("b"), F.col("m"))


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _pairs(moved.union(least), F.col("a"), F.col("b"))


def connected(edges: DataFrame) -> DataFrame:
    """Components of the undirected ``edges`` (a, b: long; loops, repeats and nulls are ignored).

    Returns (node, root): every node but the roots, root being the smallest node
    of the component.  Each step is written to the shared folder; the loop ends
    when a step changes nothing, after O(log^2 n) steps at most.
    """
    e = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a is not null and b is not null")
    e = cut_lineage(_pairs(e, F.col("a"), F.col("b")))
    mark = lambda d: tuple(d.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
    seen = mark(e)
    while True:
        e = cut_lineage(_small_star(_large_star(e)))
        now = mark(e)
        if now == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
