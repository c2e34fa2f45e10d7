"""Joins of transactions with dimensions, features, labels and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.hotkeys import hot_keys, join_unique


def with_users(transactions: DataFrame, users: DataFrame) -> DataFrame:
    """Transactions of known users with the user columns."""
    return join_unique(transactions, users, ["user_id"], "inner")


def merge_features(
    transactions: DataFrame, user_features: DataFrame, merchant_features: DataFrame
) -> DataFrame:
    """Transaction, user and merchant columns; on equal names merchant wins over user
    over transaction."""
    keys = {"user_id", "merchant_id"}

    def tagged(features, key, tag):
        names = [c for c in features.columns if c != key]
        return features.select(key, *[F.col(c).alias(f"_{tag}_{c}") for c in names]), names

    by_user, user_names = tagged(user_features, "user_id", "u")
    by_merchant, merchant_names = tagged(merchant_features, "merchant_id", "m")
    # Hot keys are looked for in the transactions, not in the joined rows.
    hot_users, hot_merchants = (hot_keys(transactions, [k]) for k in ("user_id", "merchant_id"))
    joined = join_unique(
        join_unique(transactions, by_user, ["user_id"], hot=hot_users),
        by_merchant, ["merchant_id"], hot=hot_merchants,
    )
    names = list(dict.fromkeys([*transactions.columns, *user_names, *merchant_names]))

    def pick(name):
        found = []
        if name in merchant_names:
            found.append(F.col(f"_m_{name}"))
        if name in user_names:
            found.append(F.col(f"_u_{name}"))
        if name in transactions.columns:
            found.append(F.col(name))
        return F.coalesce(*found).alias(name) if name not in keys else F.col(name)

    return joined.select(*[pick(n) for n in names])


def enrich_logs(logs: DataFrame, transactions: DataFrame, columns) -> DataFrame:
    """Log rows with the columns of the transaction they name; unknown ids give null."""
    return logs.join(transactions.select("transaction_id", *columns), "transaction_id", "left")


def with_labels(predictions: DataFrame, labels: DataFrame, key="transaction_id") -> DataFrame:
    """Predictions that have an actual label, with it."""
    return predictions.join(labels, key)
