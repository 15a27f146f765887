"""Connected components of a distributed edge table, by alternating star contractions.

Each round hangs the neighbours of every node on its smallest neighbour (first the larger, then the smaller ones), so
chains halve and hubs stay where they are. Only minima are aggregated and joined back; no neighbour list is built, and
a node with most of the edges is combined on the map side and split by the skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladegrid.session import cut_lineage


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One contraction of edges (a > b)."""
    ends = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if larger:
        ends = ends.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = ends.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    hung = ends.join(least, "u")
    if larger:
        moved = hung.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = hung.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a > b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars already: every node hangs on one other at most, and none that hangs has nodes of its own."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b); root is the smallest node of its component.

    Edges with a null end are ignored; loops and repeated edges do nothing beyond naming their node.
    """
    ends = edges.where("a is not null and b is not null").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = cut_lineage(ends.distinct())
    loops = edges.where("a = b").select(F.col("a").alias("node"), F.col("b").alias("root"))
    edges = edges.where("a <> b")
    while not _settled(edges):
        edges = cut_lineage(_star(_star(edges, larger=True), larger=False))
    named = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    named = named.unionByName(named.select(F.col("root").alias("node"), "root")).unionByName(loops)
    return named.groupBy("node").agg(F.min("root").alias("root"))
