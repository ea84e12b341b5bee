"""Connected components of a graph given as edges, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it sees."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of longs -> ``(u, root)`` for every node but the roots.

    Each round is two joins on node ids with partial minima before the shuffle, so a
    hub's neighbours are never gathered in one row and a skewed join can be split.
    A round's edges are checkpointed reliably. The edge set shrinks towards stars, and
    the number of rounds grows with the logarithm of the longest path. An edge table
    without rows gives a table without rows; loops are ignored.
    """
    now = cut_lineage(edges.where("u <> v")
                      .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select("u", F.col("v").alias("root"))
        seen = mark
        now = cut_lineage(_small_star(_large_star(now).distinct()).distinct())
