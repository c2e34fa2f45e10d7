"""Feature builders for model training, stacked as column additions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.functions.numbers import amount_category, is_round_amount, zscore_clipped
from tidemark.operators.aggregates import behaviour_stats
from tidemark.operators.hotkeys import hot_keys, join_unique
from tidemark.operators.sequences import acceleration


def transaction_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "amount_log": F.log1p("amount"),
            "amount_category": amount_category("amount"),
            "is_round_amount": is_round_amount("amount"),
        }
    )


def temporal_features(df: DataFrame, time="timestamp") -> DataFrame:
    return df.withColumns(
        {
            "hour": F.hour(time),
            "day_of_week": times.monday_day_of_week(time),
            "day_of_month": F.dayofmonth(time),
            "is_weekend": times.is_weekend(time).cast("int"),
            "is_night": times.is_night(time).cast("int"),
            "is_business_hours": times.is_business_hours(time).cast("int"),
        }
    )


def velocity_features(df: DataFrame, hot=None) -> DataFrame:
    """hours_since_last_transaction and transaction_acceleration."""
    return acceleration(df, hot=hot)


def behaviour_features(df: DataFrame, hot=None) -> DataFrame:
    """User statistics on every row and the z-score of the amount among them."""
    return join_unique(df, behaviour_stats(df), ["user_id"], hot=hot).withColumn(
        "amount_zscore", zscore_clipped("amount", "user_amount_mean", "user_amount_std")
    )


def all_features(transactions: DataFrame) -> DataFrame:
    hot = hot_keys(transactions, ["user_id"])
    return behaviour_features(
        velocity_features(temporal_features(transaction_features(transactions)), hot), hot
    )
