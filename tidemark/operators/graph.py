"""Edges, centralities, communities and lineage as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import centrality
from tidemark.operators.components import connected
from tidemark.session import cut_lineage, shared_folder


def user_merchant_edges(
    transactions: DataFrame, order=("timestamp", "transaction_id")
) -> DataFrame:
    """src, dst, weight: one edge per user and merchant, the last amount as weight."""
    return (
        transactions.groupBy("user_id", "merchant_id")
        .agg(F.max_by("amount", F.struct(*order)).alias("weight"))
        .select(
            F.concat(F.lit("user_"), F.col("user_id")).alias("src"),
            F.concat(F.lit("merchant_"), F.col("merchant_id")).alias("dst"),
            "weight",
        )
    )


def both_ways(edges: DataFrame) -> DataFrame:
    """Every edge in both directions, from one reading of the edges."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    there = F.struct(F.col("src"), F.col("dst"), *rest)
    back = F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), *rest)
    return edges.select(F.inline(F.array(there, back)))


def nodes_of(edges: DataFrame) -> DataFrame:
    return both_ways(edges.select("src", "dst")).select(F.col("src").alias("node")).distinct()


def degree_centrality(edges: DataFrame) -> DataFrame:
    """Distinct neighbours / (nodes - 1)."""
    pairs = both_ways(edges.select("src", "dst")).distinct()
    degrees = pairs.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree"))
    others = degrees.agg(F.count(F.lit(1)) - 1).scalar()
    return degrees.select(
        "node",
        F.when(others == 0, 1.0)
        .otherwise(F.try_divide(F.col("degree").cast("double"), others.cast("double")))
        .alias("degree_centrality"),
    )


def edge_summary(edges: DataFrame) -> DataFrame:
    distinct = edges.select(
        F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")
    ).distinct()
    return nodes_of(edges).agg(F.count(F.lit(1)).alias("nodes")).withColumn(
        "edges", distinct.agg(F.count(F.lit(1))).scalar()
    )


def communities(edges: DataFrame) -> DataFrame:
    """node, community: connected components named by their smallest node."""
    found = connected(edges, "src", "dst")
    return nodes_of(edges).join(found, "node", "left").select(
        "node", F.coalesce("root", "node").alias("community")
    )


def pivots(nodes: DataFrame, k=100, seed=7) -> DataFrame:
    """min(k, n) of the rows of ``nodes``, chosen by a seeded hash."""
    return nodes.orderBy(F.xxhash64(F.lit(seed), "node"), "node").limit(k)


def betweenness(edges: DataFrame, k=100, seed=7) -> DataFrame:
    """Betweenness estimated from min(k, n) pivots with edge weights as distances.

    Distances by relaxing edges until none improves, path counts forward along the
    shortest-path edges, and dependencies back along them, all pivots at once
    (``centrality``); each goes on until nothing changes. A negative weight is an error.
    Nodes behind a cycle of edges without weight have no path counts. Scores are scaled as
    for an undirected graph and by n / k for the sampled pivots.
    """
    spark = edges.sparkSession
    folder = shared_folder(spark, "pairs")
    pairs = edges.select(F.least("src", "dst").alias("one"), F.greatest("src", "dst").alias("other"), "weight")
    pairs.groupBy("one", "other").agg(F.min("weight").alias("weight")).write.parquet(folder)
    pairs = spark.read.parquet(folder)
    if not pairs.where("weight < 0").isEmpty():
        raise ValueError("edge weights must not be negative")
    ends = pairs.select(F.col("one").alias("src"), F.col("other").alias("dst"))
    folder = shared_folder(spark, "nodes")
    degrees = cut_lineage(both_ways(ends).groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree")))
    degrees.withColumn("id", F.monotonically_increasing_id()).write.parquet(folder)
    nodes = spark.read.parquet(folder)
    chosen = [row["id"] for row in pivots(nodes, k, seed).collect()]
    rank = F.struct("degree", "id").alias("rank")
    one = nodes.select(F.col("node").alias("one"), rank).withColumnRenamed("rank", "here")
    other = nodes.select(F.col("node").alias("other"), rank).withColumnRenamed("rank", "there")
    ranked = pairs.where("one != other and weight is not null").join(one, "one").join(other, "other")
    parts = centrality.Parts(
        ranked.select(
            F.least("here", "there")["id"].alias("low"), F.greatest("here", "there")["id"].alias("high"),
            F.col("weight").cast("double").alias("weight"),
        ),
        chosen,
    )
    for kind in centrality.KINDS:
        parts.settle(kind)
    n, used = float(nodes.count()), float(len(chosen))
    scale = F.try_divide(F.lit(n), F.lit((n - 1) * (n - 2) * used))
    return nodes.join(parts.sums(), "id", "left").select(
        "node", F.coalesce(F.col("total") * scale, F.lit(0.0)).alias("betweenness_centrality")
    )


def ancestors(edges: DataFrame, dataset: str) -> DataFrame:
    """All nodes from which ``dataset`` can be reached in an edge table (src, dst).

    One join per level; a node is followed once, so shared parents and cycles are safe.
    """
    found = fresh = cut_lineage(
        edges.where(F.col("dst") == dataset).select(F.col("src").alias("node")).distinct()
    )
    while True:
        up = edges.join(fresh, F.col("dst") == F.col("node"), "left_semi")
        fresh = cut_lineage(
            up.select(F.col("src").alias("node")).distinct().join(found, "node", "left_anti")
        )
        if fresh.isEmpty():
            return found
        found = cut_lineage(found.unionByName(fresh))


def lineage_report(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Per node type the number of nodes and their sorted names, with the edge total."""
    # Lists are the report itself; a lineage table holds one row per dataset or job.
    return (
        nodes.groupBy("node_type")
        .agg(
            F.count(F.lit(1)).alias("nodes"),
            F.array_sort(F.collect_set("node")).alias("names"),
        )
        .withColumn("total_edges", edges.agg(F.count(F.lit(1))).scalar())
    )
