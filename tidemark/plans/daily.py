"""The daily feature run, as one function of table steps in the documented order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import aggregates as agg
from tidemark.operators import graph
from tidemark.operators.quality import QualityError, quality_gate, run_suite
from tidemark.session import shared_folder
from tidemark.sources import lake


def daily_run(
    spark: SparkSession,
    staged_paths: list[str],
    checks,
    warehouse_path: str,
    feature_path: str,
    day,
) -> dict[str, DataFrame]:
    """Combine staged sources, validate, build features, load the day, export features.

    ``checks(df)`` gives the expectations; a failed one stops the run before anything is
    loaded. The combined input is written once to the shared folder, so that the later
    steps do not read the sources again.
    """
    staging = shared_folder(spark, "daily")
    lake.combine_staged(spark, staged_paths).write.parquet(staging)
    transactions = spark.read.parquet(staging)

    failed = run_suite(transactions, checks(transactions)).where(~F.col("success")).collect()
    if failed:
        raise QualityError(f"failed checks: {[(r['check_name'], r['column_name']) for r in failed]}")
    quality_gate(transactions)

    as_of = (F.lit(day).cast("timestamp") + F.expr("INTERVAL 1 DAY"))
    features = {
        "user_features": agg.user_features(transactions, as_of),
        "merchant_features": agg.merchant_features(transactions),
        "graph_features": graph.degree_centrality(graph.user_merchant_edges(transactions)),
    }
    lake.load_day(transactions, warehouse_path, day)
    paths = lake.export_features(features, feature_path, day)
    return {name: spark.read.parquet(path) for name, path in zip(features, paths)}
