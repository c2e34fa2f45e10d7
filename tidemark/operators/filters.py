"""Staging projections, validity filters, rejects and search."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import texts
from tidemark.model import MONEY


def stage_events(events: DataFrame) -> DataFrame:
    """event_id, user_id, value, event_ts, event_date of the events that have a time."""
    return events.where(F.col("ts").isNotNull()).select(
        F.col("id").cast("long").alias("event_id"),
        F.col("user_id").cast("long").alias("user_id"),
        F.col("value").alias("event_type"),
        F.col("ts").alias("event_ts"),
        F.to_date("ts").alias("event_date"),
    )


def clean_transactions(transactions: DataFrame) -> DataFrame:
    """Defaults, trimmed lower-case codes and the fields of the JSON location."""
    location = F.col("location")
    return transactions.select(
        "transaction_id",
        "user_id",
        "merchant_id",
        F.col("timestamp").cast("timestamp").alias("transaction_timestamp"),
        F.col("created_at").alias("ingestion_timestamp"),
        F.coalesce("amount", F.lit(0).cast(MONEY)).alias("amount"),
        F.coalesce("currency", F.lit("USD")).alias("currency"),
        texts.clean("merchant_category").alias("merchant_category"),
        texts.clean("channel").alias("channel"),
        F.when(location.isNotNull(), texts.json_text(location, "$.country"))
        .otherwise("unknown")
        .alias("country"),
        texts.json_number(location, "$.lat").alias("latitude"),
        texts.json_number(location, "$.lon").alias("longitude"),
        F.coalesce("is_fraud", F.lit(False)).alias("is_fraud"),
        F.coalesce("fraud_score", F.lit(0).cast("decimal(5,4)")).alias("fraud_score"),
        F.coalesce("model_version", F.lit("unknown")).alias("model_version"),
    )


def is_valid_transaction(as_of: Column, time="transaction_timestamp", amount="amount") -> Column:
    """0 < amount < 1 000 000 and 2020-01-01 <= time <= as_of + 1 day."""
    return (
        (F.col(amount) > 0)
        & (F.col(amount) < 1_000_000)
        & (F.col(time) >= F.lit("2020-01-01").cast("timestamp"))
        & (F.col(time) <= as_of + F.expr("INTERVAL 1 DAY"))
    )


def valid_transactions(transactions: DataFrame, as_of: Column | None = None) -> DataFrame:
    return transactions.where(
        is_valid_transaction(F.current_timestamp() if as_of is None else as_of)
    )


def first_reason(reasons: dict[str, Column]) -> Column:
    """Name of the first check that fails (or cannot be decided); null when all pass."""
    out = None
    for name, passed in reasons.items():
        failed = ~F.coalesce(passed, F.lit(False))
        out = F.when(failed, name) if out is None else out.when(failed, name)
    return out


def record_reason(required=("transaction_id", "user_id", "amount", "timestamp")) -> Column:
    """Reject reason of a raw record: a missing field, then a non-positive amount."""
    checks = {f"missing_{name}": F.col(name).isNotNull() for name in required}
    checks["amount_not_positive"] = F.col("amount") > 0
    return first_reason(checks)


def check_requests(requests: DataFrame) -> DataFrame:
    """Apply the request contract: rounded amount, default channel and an error column."""
    inside = {
        "amount must be positive": F.col("amount") > 0,
        "amount too large": F.col("amount") <= 1_000_000,
        "latitude out of range": F.coalesce(
            F.col("location_lat").between(-90, 90), F.col("location_lat").isNull()
        ),
        "longitude out of range": F.coalesce(
            F.col("location_lon").between(-180, 180), F.col("location_lon").isNull()
        ),
    }
    return requests.withColumns(
        {
            "error": first_reason(inside),
            "amount": F.round("amount", 2),
            "channel": F.coalesce("channel", F.lit("online")),
        }
    )


def split_rejects(df: DataFrame, reason: Column, at: Column | None = None):
    """(good rows, rejected rows with error text and failure time)."""
    marked = df.withColumn("error", reason)
    good = marked.where(F.col("error").isNull()).drop("error")
    bad = marked.where(F.col("error").isNotNull()).withColumn(
        "failed_at", F.current_timestamp() if at is None else at
    )
    return good, bad


def violations(df: DataFrame, amount="amount") -> DataFrame:
    """Rows that break the assertion that no amount is negative."""
    return df.where(F.col(amount) < 0)


def slower_than(df: DataFrame, duration: str, limit=1.0) -> DataFrame:
    return df.where(F.col(duration) > limit)


def search(
    transactions: DataFrame,
    user_id=None,
    merchant_id=None,
    min_amount=None,
    max_amount=None,
    start=None,
    end=None,
    is_fraud=None,
) -> DataFrame:
    """Transactions that meet every given condition; both ends of a range count."""
    tests = []
    if user_id is not None:
        tests.append(F.col("user_id") == user_id)
    if merchant_id is not None:
        tests.append(F.col("merchant_id") == merchant_id)
    if min_amount is not None:
        tests.append(F.col("amount") >= min_amount)
    if max_amount is not None:
        tests.append(F.col("amount") <= max_amount)
    if start is not None:
        tests.append(F.col("timestamp") >= F.lit(start).cast("timestamp"))
    if end is not None:
        tests.append(F.col("timestamp") <= F.lit(end).cast("timestamp"))
    if is_fraud is not None:
        tests.append(F.col("is_fraud") == is_fraud)
    return transactions.where(reduce(lambda a, b: a & b, tests)) if tests else transactions


SORTS = {"amount": "amount", "timestamp": "timestamp", "risk": "risk_score"}


def page(
    df: DataFrame, sort="timestamp", limit=20, offset=0, key="transaction_id", ascending=False
):
    """One page in the given order with the total count and the page flags on each row."""
    total = df.agg(F.count(F.lit(1))).scalar()
    direction = F.asc if ascending else F.desc
    rows = df.orderBy(direction(SORTS.get(sort, sort)), F.asc(key)).offset(offset).limit(limit)
    return rows.withColumns(
        {
            "total_count": total,
            "has_next_page": total > offset + limit,
            "has_previous_page": F.lit(offset > 0),
        }
    )


def by_id(df: DataFrame, value, key="transaction_id") -> DataFrame:
    return df.where(F.col(key) == value)


def last_predictions(predictions: DataFrame, user_id, n=10) -> DataFrame:
    return (
        predictions.where(F.col("user_id") == user_id)
        .orderBy(F.desc("timestamp"), F.desc("transaction_id"))
        .limit(n)
    )
