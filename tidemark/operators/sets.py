"""Unions, duplicates and key checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sequences import newest_per_key


def combine(frames: list[DataFrame]) -> DataFrame:
    """All rows by column name; a column a frame lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: rows, distinct rows and whole-row duplicates."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
            F.count(F.lit(1)).alias("distinct_rows"),
        )
        .withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))
    )


def has_columns_exactly(df: DataFrame, names) -> bool:
    return set(df.columns) == set(names)


def keep_last(df: DataFrame, keys: list[str], ingest_order: list[str]) -> DataFrame:
    """Remove duplicates of a key, keeping the row ingested last."""
    return newest_per_key(df, keys, ingest_order)


def keep_any(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropDuplicates(keys)


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows whose key no parent has."""
    return children.join(parents.select(key).distinct(), key, "left_anti")


def unprocessed(batch: DataFrame, processed: DataFrame, key: str) -> DataFrame:
    """Rows whose id was not handled before."""
    return batch.join(processed.select(key).distinct(), key, "left_anti")
