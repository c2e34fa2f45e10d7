"""Three-layer risk model: cleaned transactions, user patterns, scored latest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.functions.times import is_night
from tidemark.operators.aggregates import recent_activity, user_daily_stats, user_patterns
from tidemark.operators.filters import clean_transactions, valid_transactions
from tidemark.operators.sequences import newest_per_key

TIME = "transaction_timestamp"


def staged_transactions(transactions: DataFrame, as_of: Column | None = None) -> DataFrame:
    return valid_transactions(clean_transactions(transactions), as_of)


def patterns(staged: DataFrame, as_of: Column, lookback_days=90) -> DataFrame:
    """User patterns over the lookback with their risk category."""
    recent = staged.where(
        F.col(TIME) >= F.date_trunc("DAY", as_of) - F.expr(f"INTERVAL {lookback_days} DAYS")
    )
    return user_patterns(user_daily_stats(recent)).withColumn(
        "risk_category", rules.risk_category("fraud_rate")
    )


def latest_day(staged: DataFrame, as_of: Column) -> DataFrame:
    """Rows since 24 hours before the start of the day of ``as_of``."""
    return staged.where(
        F.col(TIME) >= F.date_trunc("DAY", as_of) - F.expr("INTERVAL 24 HOURS")
    )


def risk_scoring(
    staged: DataFrame,
    as_of: Column,
    high_risk=rules.HIGH_RISK_CATEGORIES,
    fraud_threshold=rules.MODEL_THRESHOLD,
    lookback_days=90,
) -> DataFrame:
    """Score, factors, level and recommendation of each user's newest transaction."""
    recent = latest_day(staged, as_of)
    last = newest_per_key(recent, ["user_id"], [TIME, "transaction_id"])
    activity = recent_activity(recent)
    history = patterns(staged, as_of, lookback_days).select(
        "user_id",
        "avg_daily_amount",
        "avg_daily_categories",
        F.col("fraud_rate").alias("historical_fraud_rate"),
        F.col("risk_category").alias("historical_risk_category"),
    )
    joined = last.join(activity, "user_id", "left").join(history, "user_id", "left")
    flags = joined.withColumns(
        {
            "high_velocity_risk": rules.flag(F.col("transactions_24h") > 50),
            "unusual_amount_risk": rules.flag(
                F.col("amount") > F.col("avg_daily_amount") * 3
            ),
            "high_risk_category": rules.flag(F.col("merchant_category").isin(*high_risk)),
            "category_diversity_risk": rules.flag(
                F.col("unique_categories_24h") > F.col("avg_daily_categories") * 2
            ),
            "unusual_time_risk": rules.flag(is_night(TIME)),
        }
    )
    return flags.withColumns(
        {"risk_score": rules.mart_score(), "risk_factors_list": rules.mart_explanation()}
    ).select(
        "transaction_id",
        "user_id",
        TIME,
        "amount",
        "merchant_category",
        "is_fraud",
        "risk_score",
        "risk_factors_list",
        rules.risk_level("risk_score", fraud_threshold).alias("risk_level"),
        rules.recommendation("risk_score", fraud_threshold).alias("recommendation"),
    )
