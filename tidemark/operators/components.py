"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage


def _least(edges: DataFrame) -> DataFrame:
    """For each node the smallest of its neighbours and itself."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest one."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_least(both), "u")
    larger = joined.where("v > u and v != m")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of a node, and itself, to the smallest one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = down.join(_least(down), "u")
    others = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = joined.select("u", F.col("m").alias("v"))
    return others.union(own).where("u != v").distinct()


def connected(edges: DataFrame, one: str, other: str) -> DataFrame:
    """``node, root`` for all nodes of the edges; the root is a component's smallest node.

    The nodes may be of any type that has an order. Edges with a null end and loops are left
    out. It runs until nothing changes, in rounds that grow with the logarithm of the longest
    path; each round is checkpointed. A node with very many neighbours is aggregated before
    the shuffle and its edges are joined as rows, never gathered.
    """
    current = cut_lineage(
        edges.select(F.col(one).alias("u"), F.col(other).alias("v")).where("u != v").distinct()
    )
    before = None
    while True:
        # Equal counts and hash sums of the edges: nothing moved.
        mark = F.xxhash64("u", "v").cast("decimal(38,0)")
        state = current.agg(F.count(F.lit(1)).alias("n"), F.sum(mark).alias("h")).first()
        if (state["n"], state["h"]) == before or state["n"] == 0:
            break
        before = (state["n"], state["h"])
        current = cut_lineage(_small_star(_large_star(current)))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
