"""Connected components of an edge table, by alternating large and small stars.

Each round is two aggregates with partial sums and two joins on a node, all of
which Spark can spread, however many edges one node has; the number of rounds
grows with the logarithm of the longest chain.  No edge reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: ties neighbours to the smallest node around a centre."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # In a small step the larger end of each edge is its centre.
    # Written first: a join of two plain shuffles is one whose hot centres Spark can split.
    least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "component-least")
    tied = both.join(least, "u")
    if large:
        out = tied.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = (tied.select(F.col("v").alias("a"), F.col("m").alias("b"))
               .unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
    return (out.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``edges`` (a, b)."""
    edges = (edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    edges = written(edges, "component-edges")
    mark = _mark(edges)
    while mark[0]:
        edges = written(_star(_star(edges, True), False), "component-edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).groupBy(
        "node").agg(F.min("component").alias("component"))
