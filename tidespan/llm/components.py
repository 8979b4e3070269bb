"""Connected components of a graph of links, as joins and aggregates over the link table.

Alternating large-star and small-star steps: each node's neighbours are linked to the smallest of them, until nothing
changes. Links stay distributed; a node with very many links is one key of joins that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.llm.tables import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """(a, b), b < a. Large: every larger neighbour of a node goes to the least of it and its neighbours;
    small: a node and its smaller neighbours go to the least of them."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return out.where("a <> b")
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    out = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Every node has one smaller neighbour, which has none itself: a star for each component."""
    up = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    down = edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    ends = up.union(down).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 OR up = 1 AND down = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for all nodes of ``links`` (a, b); the component is its least node."""
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _settled(edges):
        edges = written(_star(_star(edges, True), False), "stars")
    centres = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centres)
