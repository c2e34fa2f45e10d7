"""Grouped measures over events and transactions.

Distinct counts over a large group are taken in two steps, per (group, member) and then
per group, so that one big group never gathers its members in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import fraud_rate_category, percent, safe_ratio
from tidemark.functions.texts import parse_log_lines
from tidemark.functions.times import period_start, whole_days_between
from tidemark.model import MONEY
from tidemark.operators.percentiles import percentiles



def count_rows() -> Column:
    return F.count(F.lit(1))


def count_when(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def sum_when(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0.0)))


def rate_of(flag: str) -> Column:
    """Mean of a boolean."""
    return F.avg(F.col(flag).cast("int"))


def event_counts(events: DataFrame, time="ts", length="1 minute") -> DataFrame:
    """Tumbling counts: window_start, window_end, event_count. Also works on streams."""
    return (
        events.groupBy(F.window(time, length))
        .agg(count_rows().alias("event_count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "event_count",
        )
    )


def sliding_metrics(events: DataFrame, time="ts", length="1 minute", slide="10 seconds"):
    """Sliding count and mean user id over all events. Also works on streams."""
    return (
        events.groupBy(F.window(time, length, slide))
        .agg(count_rows().alias("event_count"), F.avg(F.col("user_id").cast("double")).alias("m"))
        .select(
            F.lit("sliding_window").alias("metric_type"),
            "event_count",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            F.col("m").alias("avg_processing_time"),
        )
    )


def category_windows(scored: DataFrame, time="timestamp", length="5 minutes") -> DataFrame:
    """Count, amount and mean risk per window and category. Also works on streams."""
    return (
        scored.groupBy(F.window(time, length), "merchant_category")
        .agg(
            count_rows().alias("transaction_count"),
            F.sum("amount").alias("total_amount"),
            F.avg("risk_score").alias("avg_risk_score"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "merchant_category",
            "transaction_count",
            "total_amount",
            "avg_risk_score",
        )
    )


def daily_event_metrics(staged: DataFrame) -> DataFrame:
    """Counts by date and type, newest date and largest count first."""
    return (
        staged.groupBy("event_date", "event_type")
        .agg(count_rows().alias("event_count"))
        .orderBy(F.desc("event_date"), F.desc("event_count"), "event_type")
    )


def log_counts(lines: DataFrame, levels=("ERROR", "WARN"), known_levels=None) -> DataFrame:
    """Lines per hour, level and component for the wanted levels."""
    parsed = parse_log_lines(lines, known_levels) if known_levels else parse_log_lines(lines)
    return (
        parsed.where(F.col("level").isin(*levels))
        .groupBy("hour", "level", "component")
        .agg(count_rows().alias("lines"))
        .select(F.concat_ws(":", "hour", "level", "component").alias("key"), "lines")
    )


def transaction_rollup(transactions: DataFrame, users: DataFrame) -> DataFrame:
    """Totals, success rate and mean amount per date, country of the user and type.

    The users are joined first: a user has about one transaction per day and type, so sums
    per user would shuffle nearly as many rows again. Catalyst chooses the join from the sizes.
    """
    completed = F.col("status") == "completed"
    located = transactions.join(users.select("user_id", "country"), "user_id")
    exact = F.sum(F.col("amount").cast(MONEY))
    return (
        located.groupBy(
            F.to_date("timestamp").alias("transaction_date"), "country", "transaction_type"
        )
        .agg(
            count_rows().alias("total_transactions"),
            count_when(completed).alias("completed_transactions"),
            count_when(F.col("status") == "failed").alias("failed_transactions"),
            # Rounded from decimals: the mean of two amounts often ends in half a cent.
            F.round(F.sum("amount"), 2).alias("total_revenue"),
            F.round(sum_when(completed, F.col("amount")), 2).alias("completed_revenue"),
            F.round(F.try_divide(exact, F.count("amount")), 2)
            .cast("double")
            .alias("avg_transaction_amount"),
        )
        .withColumn(
            "success_rate", percent("completed_transactions", "total_transactions")
        )
    )


def user_daily_stats(cleaned: DataFrame) -> DataFrame:
    """Per user and date: count, amount, mean, deviation, categories, frauds."""
    return cleaned.groupBy(
        "user_id", F.to_date("transaction_timestamp").alias("transaction_date")
    ).agg(
        count_rows().alias("daily_transaction_count"),
        F.sum("amount").alias("daily_amount"),
        F.avg("amount").alias("daily_avg_amount"),
        F.stddev("amount").alias("daily_std_amount"),
        F.countDistinct("merchant_category").alias("unique_categories"),
        F.sum(F.col("is_fraud").cast("long")).alias("fraud_count"),
    )


def user_patterns(daily: DataFrame) -> DataFrame:
    """Second aggregation level over ``user_daily_stats``."""
    total = F.sum("daily_transaction_count")
    return daily.groupBy("user_id").agg(
        count_rows().alias("active_days"),
        total.alias("total_transactions"),
        F.sum("daily_amount").alias("total_amount"),
        F.avg("daily_amount").alias("avg_daily_amount"),
        F.stddev("daily_amount").alias("std_daily_amount"),
        F.max("daily_transaction_count").alias("max_daily_transactions"),
        F.avg("daily_transaction_count").alias("avg_daily_transactions"),
        F.avg("unique_categories").alias("avg_daily_categories"),
        F.sum("fraud_count").alias("total_fraud_count"),
        safe_ratio(F.sum("fraud_count"), total).alias("fraud_rate"),
        F.min("transaction_date").alias("first_transaction_date"),
        F.max("transaction_date").alias("last_transaction_date"),
        F.datediff(F.max("transaction_date"), F.min("transaction_date")).alias("days_active"),
    )


def recent_activity(recent: DataFrame) -> DataFrame:
    """Per user over the recent rows: count, amounts, distinct merchants and categories."""
    return recent.groupBy("user_id").agg(
        count_rows().alias("transactions_24h"),
        F.sum("amount").alias("amount_24h"),
        F.avg("amount").alias("avg_amount_24h"),
        F.max("amount").alias("max_amount_24h"),
        F.countDistinct("merchant_id").alias("unique_merchants_24h"),
        F.countDistinct("merchant_category").alias("unique_categories_24h"),
    )


def modal_value(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Most frequent value per key, the lowest one on a tie; counted before it is compared."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(
        count_rows().alias("_n")
    )
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))
    return counts.groupBy(key).agg(best.getField("v").alias(name))


def user_features(transactions: DataFrame, as_of: Column) -> DataFrame:
    """Per-user amounts, distinct merchants, modal category, first and last time, ages."""
    base = transactions.groupBy("user_id").agg(
        count_rows().alias("amount_count"),
        F.avg("amount").alias("amount_mean"),
        F.stddev("amount").alias("amount_std"),
        F.min("amount").alias("amount_min"),
        F.max("amount").alias("amount_max"),
        F.sum("amount").alias("amount_sum"),
        F.countDistinct("merchant_id").alias("merchant_id_nunique"),
        F.min("timestamp").alias("timestamp_min"),
        F.max("timestamp").alias("timestamp_max"),
    )
    mode = modal_value(
        transactions, "user_id", "merchant_category", "merchant_category_mode"
    )
    # The divisor is the number of rows, not of gaps, as the feature is defined.
    span = whole_days_between("timestamp_max", "timestamp_min")
    return base.join(mode, "user_id", "left").withColumns(
        {
            "days_since_first_transaction": whole_days_between(as_of, "timestamp_min"),
            "avg_days_between_transactions": safe_ratio(span, "amount_count"),
        }
    )


def behaviour_stats(transactions: DataFrame) -> DataFrame:
    """Per-user behaviour columns with the ``user_`` prefix."""
    base = transactions.groupBy("user_id").agg(
        F.avg("amount").alias("user_amount_mean"),
        F.stddev("amount").alias("user_amount_std"),
        F.min("amount").alias("user_amount_min"),
        F.max("amount").alias("user_amount_max"),
        F.countDistinct("merchant_id").alias("user_merchant_id_nunique"),
    )
    mode = modal_value(transactions, "user_id", "merchant_category", "user_merchant_category_mode")
    return base.join(mode, "user_id", "left")


def merchant_features(transactions: DataFrame) -> DataFrame:
    """Per-merchant frauds, amounts, distinct users and the bin of the fraud rate."""
    return (
        transactions.groupBy("merchant_id")
        .agg(
            F.sum(F.col("is_fraud").cast("long")).alias("is_fraud_sum"),
            rate_of("is_fraud").alias("is_fraud_mean"),
            F.count("amount").alias("amount_count"),
            F.avg("amount").alias("amount_mean"),
            F.stddev("amount").alias("amount_std"),
            F.countDistinct("user_id").alias("user_id_nunique"),
        )
        .withColumn("fraud_rate", F.col("is_fraud_mean"))
        .withColumn("risk_category", fraud_rate_category("fraud_rate"))
    )


def user_risk_profile(transactions: DataFrame, as_of: Column, days=90) -> DataFrame:
    """Per user over the last ``days``: count, mean, deviation, exact p95, frauds."""
    recent = transactions.where(F.col("timestamp") > as_of - F.expr(f"INTERVAL {days} DAYS"))
    base = recent.groupBy("user_id").agg(
        count_rows().alias("transaction_count"),
        F.avg("amount").alias("avg_amount"),
        F.stddev("amount").alias("stddev_amount"),
        count_when(F.col("is_fraud")).alias("fraud_count"),
    )
    p95 = percentiles(recent, ["user_id"], "amount", {"p95_amount": 0.95})
    return base.join(p95, "user_id", "left")


def fraud_by_category(transactions: DataFrame) -> DataFrame:
    """Count, amount and mean amount of the frauds per category, largest amount first."""
    return (
        transactions.where("is_fraud")
        .groupBy("merchant_category")
        .agg(
            count_rows().alias("fraud_count"),
            F.sum("amount").alias("total_amount"),
            F.avg("amount").alias("avg_amount"),
        )
        .orderBy(F.desc("total_amount"), "merchant_category")
    )


def frauds_per_user(transactions: DataFrame) -> DataFrame:
    return transactions.where("is_fraud").groupBy("user_id").agg(
        count_rows().alias("fraud_count")
    )


def fraud_statistics(transactions: DataFrame, by=None) -> DataFrame:
    """Totals, frauds, rate and amounts; over all rows or per the given columns."""
    grouped = transactions.groupBy(*(by or []))
    fraud = F.col("is_fraud")
    return grouped.agg(
        count_rows().alias("total_transactions"),
        count_when(fraud).alias("fraud_transactions"),
        F.sum("amount").alias("total_amount"),
        sum_when(fraud, F.col("amount")).alias("fraud_amount"),
        F.avg("amount").alias("avg_amount"),
    ).withColumn("fraud_rate", safe_ratio("fraud_transactions", "total_transactions", 0.0))


def fraud_over_time(transactions: DataFrame, period: str) -> DataFrame:
    return fraud_statistics(
        transactions.withColumn("period_start", period_start(period, "timestamp")),
        ["period_start"],
    )


def event_funnel(events: DataFrame) -> DataFrame:
    """Events and distinct users per type, most frequent first."""
    return (
        events.groupBy("event_type")
        .agg(
            count_rows().alias("event_count"),
            F.countDistinct("user_id").alias("unique_users"),
        )
        .orderBy(F.desc("event_count"), "event_type")
    )


def conversion_rate(events: DataFrame, goal="purchase") -> DataFrame:
    """Share of goal events per day, null-safe."""
    hits = count_when(F.col("event_type") == goal)
    return events.groupBy("event_date").agg(
        hits.alias("purchases"),
        count_rows().alias("total_events"),
        safe_ratio(hits, count_rows()).alias("conversion_rate"),
    )


def minute_totals(events: DataFrame, last=30, time="ts") -> DataFrame:
    """Events of the newest ``last`` minutes that have any."""
    return (
        events.groupBy(F.date_trunc("MINUTE", time).alias("minute"))
        .agg(count_rows().alias("event_count"))
        .orderBy(F.desc("minute"))
        .limit(last)
    )


def day_totals(events: DataFrame, time="ts") -> DataFrame:
    return events.groupBy(F.to_date(time).alias("event_date")).agg(
        count_rows().alias("event_count")
    )


def grand_total(events: DataFrame) -> DataFrame:
    return events.agg(count_rows().alias("event_count"))


def user_activity(events: DataFrame, time="timestamp") -> DataFrame:
    """Events, sessions and mean processing time per user and day."""
    return events.groupBy("user_id", F.to_date(time).alias("activity_date")).agg(
        count_rows().alias("event_count"),
        F.countDistinct("session_id").alias("session_count"),
        F.avg("processing_time_ms").alias("avg_processing_time"),
    )


def daily_users(events: DataFrame, time="ts", error=0.02) -> DataFrame:
    """Estimated distinct users per day from mergeable sketches."""
    return events.groupBy(F.to_date(time).alias("event_date")).agg(
        F.approx_count_distinct("user_id", error).alias("unique_users")
    )


SKETCH_BITS = 12
# Three standard errors of a sketch of 2^12 counters.
SKETCH_BOUND = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)


def user_sketches(events: DataFrame, time="ts", user="user_id") -> DataFrame:
    """One sketch of the distinct users per day, to be stored and merged later."""
    return events.groupBy(F.to_date(time).alias("event_date")).agg(
        F.hll_sketch_agg(user, SKETCH_BITS).alias("sketch")
    )


def merged_users(sketches: DataFrame, *periods) -> DataFrame:
    """Estimated distinct users per period of days, from the stored sketches alone."""
    merged = sketches.groupBy(*periods).agg(
        F.hll_union_agg("sketch").alias("_sketch"), count_rows().alias("days")
    )
    return merged.withColumn("users", F.hll_sketch_estimate("_sketch")).drop("_sketch")


def daily_users_exact(events: DataFrame, time="ts") -> DataFrame:
    return events.groupBy(F.to_date(time).alias("event_date")).agg(
        F.countDistinct("user_id").alias("unique_users")
    )


def fraud_summary(transactions: DataFrame) -> DataFrame:
    return transactions.agg(
        count_rows().alias("transactions"),
        count_when(F.col("is_fraud")).alias("frauds"),
        F.round(rate_of("is_fraud") * 100, 2).alias("fraud_percent"),
    )


def class_weight(labelled: DataFrame, label="is_fraud") -> DataFrame:
    """Negatives per positive."""
    positive = count_when(F.col(label).cast("int") == 1)
    negative = count_when(F.col(label).cast("int") == 0)
    return labelled.agg(
        negative.alias("negatives"),
        positive.alias("positives"),
        safe_ratio(negative, positive).alias("scale_pos_weight"),
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, row_count of every table, sorted by name."""
    parts = [
        df.agg(count_rows().alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.orderBy("table_name")


def volume_report(spark, names) -> DataFrame:
    """Row counts of catalog tables; a missing table is reported, not an error."""
    found, missing = {}, []
    for name in names:
        if spark.catalog.tableExists(name):
            found[name] = spark.table(name)
        else:
            missing.append((name,))
    absent = spark.createDataFrame(missing, "table_name string").select(
        "table_name", F.lit(None).cast("long").alias("row_count"), F.lit("missing").alias("state")
    )
    if not found:
        return absent
    return row_counts(found).withColumn("state", F.lit("ok")).unionByName(absent)
