"""Queries over the user-merchant graph and over lineage edges."""

from pyspark.sql import functions as F

from tidemark.model import fraud_transactions, table
from tidemark.operators import graph
from tidemark.queries.registry import FRAUD_SQL, query

EDGES_SQL = f"""(SELECT 'user_' || user_id AS src, 'merchant_' || merchant_id AS dst,
    arg_max(amount, (timestamp, transaction_id)) AS weight FROM {FRAUD_SQL} GROUP BY user_id, merchant_id)"""


def edges(spark, folder):
    return graph.user_merchant_edges(fraud_transactions(spark, folder))


@query("graph_edges", "src dst weight:2", f"SELECT * FROM {EDGES_SQL}")
def _(spark, folder):
    return edges(spark, folder)


@query("degree_centrality", "node degree_centrality:8",
       f"""WITH p AS (SELECT src AS node, dst AS other FROM {EDGES_SQL} UNION ALL SELECT dst, src FROM {EDGES_SQL})
           SELECT node, count(DISTINCT other) / ((SELECT count(DISTINCT node) FROM p) - 1) AS degree_centrality
           FROM p GROUP BY node""")
def _(spark, folder):
    return graph.degree_centrality(edges(spark, folder))


@query("edge_summary", "nodes edges",
       f"""SELECT (SELECT count(DISTINCT src) + count(DISTINCT dst) FROM {EDGES_SQL}) AS nodes,
               (SELECT count(*) FROM {EDGES_SQL}) AS edges""")
def _(spark, folder):
    return graph.edge_summary(edges(spark, folder))


@query("betweenness", "node betweenness_centrality:8")
def _(spark, folder):
    return graph.betweenness(edges(spark, folder))


@query("communities", "node community",
       f"""WITH RECURSIVE e AS MATERIALIZED (SELECT src AS a, dst AS b FROM {EDGES_SQL}
               UNION SELECT dst, src FROM {EDGES_SQL}),
           reach(node, other) AS (SELECT a, a FROM e UNION
               SELECT reach.node, e.b FROM reach JOIN e ON reach.other = e.a)
           SELECT node, min(other) AS community FROM reach GROUP BY node""")
def _(spark, folder):
    return graph.communities(edges(spark, folder))


def lineage_edges(spark, folder):
    """Sources to transformations to datasets: region to nation to customer."""
    nation = table(spark, folder, "nation")
    customer = table(spark, folder, "customer")
    return nation.select(
        F.concat(F.lit("region_"), "n_regionkey").alias("src"),
        F.concat(F.lit("nation_"), "n_nationkey").alias("dst"),
    ).unionByName(
        customer.select(
            F.concat(F.lit("nation_"), "c_nationkey").alias("src"),
            F.concat(F.lit("customer_"), "c_custkey").alias("dst"),
        )
    )


@query("lineage_ancestors", "node",
       """SELECT 'nation_' || c_nationkey AS node FROM customer WHERE c_custkey = 1
          UNION ALL SELECT 'region_' || n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey
          WHERE c_custkey = 1""")
def _(spark, folder):
    return graph.ancestors(lineage_edges(spark, folder), "customer_1")


@query("lineage_report", "node_type nodes names:l total_edges",
       """SELECT 'source' AS node_type, count(*) AS nodes,
              list_sort(list('region_' || r_regionkey)) AS names,
              (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer) AS total_edges FROM region
          UNION ALL SELECT 'transformation', count(*), list_sort(list('nation_' || n_nationkey)),
              (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer) FROM nation
          UNION ALL SELECT 'dataset', count(*), list_sort(list('customer_' || c_custkey)),
              (SELECT count(*) FROM nation) + (SELECT count(*) FROM customer) FROM customer""")
def _(spark, folder):
    regions = table(spark, folder, "region").select(
        F.concat(F.lit("region_"), "r_regionkey").alias("node"), F.lit("source").alias("node_type")
    )
    nations = table(spark, folder, "nation").select(
        F.concat(F.lit("nation_"), "n_nationkey").alias("node"),
        F.lit("transformation").alias("node_type"),
    )
    customers = table(spark, folder, "customer").select(
        F.concat(F.lit("customer_"), F.col("c_custkey")).alias("node"), F.lit("dataset").alias("node_type")
    )
    nodes = regions.unionByName(nations).unionByName(customers)
    return graph.lineage_report(nodes, lineage_edges(spark, folder))
