"""Fraud decisions for whole tables: model probability, rule fallback, explanations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.functions.times import monday_day_of_week
from tidemark.operators.filters import first_reason
from tidemark.operators.joins import merge_features


def feature_rows(transactions, user_features, merchant_features, time="timestamp"):
    """Transaction, user and merchant columns with hour and weekday of the transaction."""
    return merge_features(transactions, user_features, merchant_features).withColumns(
        {"hour_of_day": F.hour(time), "day_of_week": monday_day_of_week(time)}
    )


def decide(
    rows: DataFrame,
    probability=None,
    threshold=rules.MODEL_THRESHOLD,
    categories=rules.HIGH_RISK_CATEGORIES,
    explained=rules.EXPLAINED_CATEGORIES,
) -> DataFrame:
    """Decision rows. Without a model probability (or where it is null) the rules decide."""
    by_rules = rules.fallback_score("amount", "hour_of_day", "merchant_category", categories)
    score = by_rules if probability is None else F.coalesce(F.col(probability), by_rules)
    return rows.withColumn("fraud_probability", score).select(
        "transaction_id",
        rules.is_fraud("fraud_probability", threshold).alias("is_fraud"),
        "fraud_probability",
        rules.service_factors("amount", "hour_of_day", "merchant_category", explained).alias(
            "risk_factors"
        ),
        F.col("timestamp"),
    )


def decide_each(rows: DataFrame, **options) -> DataFrame:
    """``decide`` for rows that may be incomplete: a bad row gets an error, not an exception."""
    reason = first_reason(
        {
            "missing user_id": F.col("user_id").isNotNull(),
            "missing merchant_id": F.col("merchant_id").isNotNull(),
            "missing amount": F.col("amount").isNotNull(),
        }
    )
    marked = rows.withColumn("error", reason)
    good = decide(marked.where(F.col("error").isNull()), **options).withColumn(
        "error", F.lit(None).cast("string")
    )
    bad = marked.where(F.col("error").isNotNull()).select(
        "transaction_id",
        F.lit(False).alias("is_fraud"),
        F.lit(0.0).alias("fraud_probability"),
        F.array().cast("array<string>").alias("risk_factors"),
        "timestamp",
        "error",
    )
    return good.unionByName(bad)


def simple_decisions(rows: DataFrame, categories=rules.EXPLAINED_CATEGORIES) -> DataFrame:
    """Decisions of the simpler rule model, marked as such in the factors."""
    score = rules.simple_score("amount", "hour_of_day", "merchant_category", categories)
    return rows.withColumn("fraud_probability", score).select(
        "transaction_id",
        rules.simple_is_fraud("fraud_probability").alias("is_fraud"),
        "fraud_probability",
        rules.fallback_factors().alias("risk_factors"),
    )
