"""The five reports over partitioned transactions and the user dimension.

Reports that need users aggregate the transactions per user first and join the small
result to the dimension, so the fact table is shuffled once on its own key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import percent, safe_ratio
from tidemark.functions.times import all_not_null, date_parts
from tidemark.model import MONEY
from tidemark.operators.aggregates import count_rows, count_when, sum_when

PARTS = ["year", "month", "day"]


def _completed():
    return F.col("status") == "completed"


def _type(name):
    return F.col("transaction_type") == name


def with_partitions(transactions: DataFrame, time="timestamp") -> DataFrame:
    """Add the year, month and day partition columns."""
    return transactions.withColumns(date_parts(time))


def partitioned(transactions: DataFrame) -> DataFrame:
    """Rows whose partition columns are set, filtered on the raw columns so it prunes."""
    return transactions.where(all_not_null(PARTS))


def daily_summary(transactions: DataFrame) -> DataFrame:
    """Twelve measures per day, newest day first."""
    return (
        partitioned(transactions)
        .groupBy(*PARTS)
        .agg(
            count_rows().alias("total_transactions"),
            F.countDistinct("user_id").alias("unique_users"),
            F.sum("amount").alias("total_revenue"),
            F.avg("amount").alias("avg_transaction_amount"),
            F.avg("processing_time_ms").alias("avg_processing_time"),
            count_when(_type("purchase")).alias("purchases"),
            count_when(_type("refund")).alias("refunds"),
            count_when(_type("subscription")).alias("subscriptions"),
            count_when(_completed()).alias("completed_txns"),
            count_when(F.col("status") == "failed").alias("failed_txns"),
            sum_when(_completed(), F.col("amount")).alias("completed_revenue"),
        )
        .withColumn("transaction_date", F.concat_ws("-", *PARTS))
        .drop(*PARTS)
        .orderBy(F.desc("transaction_date"))
    )


def user_analytics(transactions: DataFrame, users: DataFrame, at_least=5) -> DataFrame:
    """Lifetime value and activity of users with at least ``at_least`` transactions."""
    per_user = (
        partitioned(transactions)
        .groupBy("user_id")
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            sum_when(_completed(), F.col("amount")).alias("lifetime_value"),
            F.avg("amount").alias("avg_transaction_amount"),
            F.max("timestamp").alias("last_transaction_date"),
            F.min("timestamp").alias("first_transaction_date"),
            F.countDistinct(F.to_date("timestamp")).alias("active_days"),
            F.avg("processing_time_ms").alias("avg_processing_time"),
            count_when(_type("purchase")).alias("purchases"),
            count_when(_type("subscription")).alias("subscriptions"),
            count_when(_completed()).alias("_completed"),
        )
        .where(F.col("total_transactions") >= at_least)
        .withColumn("success_rate_pct", percent("_completed", "total_transactions"))
        .drop("_completed")
    )
    return per_user.join(
        users.select("user_id", "country", "user_type", "age_group", "signup_date"), "user_id"
    )


def geographic(transactions: DataFrame, users: DataFrame) -> DataFrame:
    """Per country, largest revenue first; the country is the transaction's, or its user's
    where transactions have none.

    Transactions are summed per user before the users are joined, once. premium_users and enterprise_users count transactions of such users, not users.
    Revenue is summed as a decimal, so the rounded revenue per user is exact.
    """
    own = [c for c in ("country",) if c in transactions.columns]
    per_user = (
        partitioned(transactions)
        .groupBy(*own, "user_id")
        .agg(
            F.count("transaction_id").alias("n"),
            F.sum(F.when(_completed(), F.col("amount").cast(MONEY))).alias("revenue"),
            F.sum("amount").alias("amount"),
            F.sum("processing_time_ms").alias("time"),
            F.count("amount").alias("n_amount"),
            F.count("processing_time_ms").alias("n_time"),
            count_when(_completed()).alias("completed"),
        )
    )
    wanted = ["user_id", "user_type"] + ([] if own else ["country"])
    typed = per_user.join(users.select(*wanted), "user_id")
    premium = F.when(F.col("user_type") == "premium", F.col("n")).otherwise(0)
    enterprise = F.when(F.col("user_type") == "enterprise", F.col("n")).otherwise(0)
    return (
        typed.groupBy("country")
        .agg(
            count_rows().alias("unique_users"),
            F.sum("n").alias("total_transactions"),
            F.coalesce(F.sum("revenue"), F.lit(0).cast(MONEY)).alias("total_revenue"),
            safe_ratio(F.sum("amount"), F.sum("n_amount")).alias("avg_transaction_amount"),
            safe_ratio(F.sum("time"), F.sum("n_time")).alias("avg_processing_time"),
            F.sum(premium).alias("premium_users"),
            F.sum(enterprise).alias("enterprise_users"),
            F.sum("completed").alias("_completed"),
        )
        .withColumns(
            {
                "success_rate_pct": percent("_completed", "total_transactions"),
                "revenue_per_user": F.round(
                    F.try_divide(F.col("total_revenue"), F.col("unique_users")), 2
                ).cast("double"),
                "total_revenue": F.col("total_revenue").cast("double"),
            }
        )
        .drop("_completed")
        .orderBy(F.desc("total_revenue"), "country")
    )


def hourly_trends(transactions: DataFrame) -> DataFrame:
    """Per day and hour."""
    return (
        partitioned(transactions)
        .groupBy(*PARTS, F.hour("timestamp").alias("hour_of_day"))
        .agg(
            count_rows().alias("transaction_count"),
            F.countDistinct("user_id").alias("unique_users"),
            sum_when(_completed(), F.col("amount")).alias("hourly_revenue"),
            F.avg("processing_time_ms").alias("avg_processing_time"),
            count_when(_completed()).alias("_completed"),
        )
        .withColumns(
            {
                "transaction_date": F.concat_ws("-", *PARTS),
                "success_rate_pct": percent("_completed", "transaction_count"),
            }
        )
        .drop("_completed", *PARTS)
        .orderBy("transaction_date", "hour_of_day")
    )


def business_kpis(transactions: DataFrame, users: DataFrame) -> DataFrame:
    """One row of overall figures, with distinct users per segment."""
    per_user = (
        partitioned(transactions)
        .groupBy("user_id")
        .agg(
            F.count("transaction_id").alias("n"),
            sum_when(_completed(), F.col("amount")).alias("revenue"),
            F.sum("amount").alias("amount"),
            F.count("amount").alias("n_amount"),
            count_when(_completed()).alias("completed"),
        )
    )
    typed = per_user.join(users.select("user_id", "user_type"), "user_id")
    return (
        typed.agg(
            count_rows().alias("total_users"),
            F.sum("n").alias("total_transactions"),
            F.sum("revenue").alias("total_revenue"),
            safe_ratio(F.sum("amount"), F.sum("n_amount")).alias("avg_transaction_value"),
            count_when(F.col("user_type") == "premium").alias("premium_users"),
            count_when(F.col("user_type") == "enterprise").alias("enterprise_users"),
            F.sum("completed").alias("_completed"),
        )
        .withColumns(
            {
                "metric_scope": F.lit("overall"),
                "overall_success_rate": percent("_completed", "total_transactions"),
            }
        )
        .drop("_completed")
    )


def build_reports(spark, transactions: DataFrame, users: DataFrame, prefix="") -> list[str]:
    """Drop and rebuild the report tables and the KPI view."""
    from tidemark.sources.lake import replace_table, replace_view

    tables = {
        "daily_transaction_summary": daily_summary(transactions),
        "user_analytics": user_analytics(transactions, users),
        "geographic_analysis": geographic(transactions, users),
        "hourly_transaction_trends": hourly_trends(transactions),
    }
    for name, df in tables.items():
        replace_table(df, prefix + name)
    replace_view(
        business_kpis(transactions, users).withColumn("calculated_at", F.current_timestamp()),
        prefix + "business_kpis",
    )
    return [prefix + name for name in [*tables, "business_kpis"]]


def sample_results(spark, tables: list[str], rows=5) -> dict[str, DataFrame]:
    return {name: spark.table(name).limit(rows) for name in tables}
