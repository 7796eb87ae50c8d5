"""Connected components of a table of edges, by alternating large-star and small-star steps.

Every step hangs nodes on the least neighbour known so far. Only minima are kept for each node, so a node that a third
of all edges meet is folded before the shuffle; the joins back to it are ordinary ones whose large keys Spark splits.
Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from estate_hygiene.llm.workspace import stored


def components(edges: DataFrame) -> DataFrame:
    """From edges (a long, b long) the nodes that have one, each with the least node it can reach: node, component."""
    now = stored(_hung(edges.where(F.col("a") != F.col("b"))).distinct(), "stars")
    before = None
    while (after := _sum(now)) != before:
        before = after
        now = stored(_small_star(_large_star(now)), "stars")
    children = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return children.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _hung(edges: DataFrame) -> DataFrame:
    """The larger end first."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _sum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node hang on its least neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    larger = both.where(F.col("b") > F.col("a"))
    return larger.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours hang on the least of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
