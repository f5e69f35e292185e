"""Connected components of a graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import snapshot


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge; component is its smallest reachable node.

    ``edges`` has two integer columns a and b in any order; loops and repeats do no harm, edges
    with a null end are no edges. An empty frame gives an empty frame.

    Each round hangs every neighbour of a node that is larger than it on the smallest
    neighbour (large star), then every smaller one too (small star). The number of rounds
    grows with the logarithm of the longest path. Neighbourhoods are reduced to their minimum
    before they meet the edges again, never gathered, and the minima are written first, so that
    Spark can split the join at a node with very many edges. Each round is written to the
    shared folder, which cuts the lineage.
    """
    now = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    )
    now = snapshot(now.distinct(), "edges")
    before = None
    while (mark := _mark(now)) != before:
        before = mark
        now = _small_star(_large_star(now, mark[0]), mark[0])
    stars = now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return stars.union(now.select("lo", "lo").distinct())


def _mark(edges: DataFrame) -> tuple:
    """The number of edges, and a value equal for equal sets of edges."""
    hashed = F.xxhash64("hi", "lo").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed)).first())


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hung = both.join(snapshot(least, "least", 2 * rows), "u").where("v > u")
    return snapshot(hung.select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "stars", rows)


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    hung = edges.join(snapshot(least, "least", rows), "hi")
    to_root = hung.select("hi", F.col("m").alias("lo"))
    moved = hung.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return snapshot(to_root.union(moved).distinct(), "edges", 2 * rows)
