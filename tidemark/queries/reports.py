"""Queries of the lake reports and the risk model."""

from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.model import MONEY, batch_transactions, fraud_transactions, latest, table, users
from tidemark.operators import aggregates as agg
from tidemark.operators import filters, joins, sets
from tidemark.operators.percentiles import flag_above_percentile
from tidemark.plans import detector, features, lake, risk
from tidemark.queries.registry import FRAUD_SQL, ORDERS_SQL, USERS_SQL, query

DONE = "status = 'completed'"
DAY = "strftime(timestamp, '%Y-%m-%d')"
SUCCESS = f"round(sum(CASE WHEN {DONE} THEN 1 ELSE 0 END) * 100.0 / count(*), 2)"
REVENUE = f"sum(CASE WHEN {DONE} THEN amount ELSE 0 END)"
LOCATED_SQL = f"(SELECT t.*, u.country FROM {ORDERS_SQL} t JOIN {USERS_SQL} u USING (user_id))"


def orders(spark, folder):
    return lake.with_partitions(batch_transactions(spark, folder))


def located(spark, folder):
    """Transactions with the country of their user."""
    return joins.with_users(
        orders(spark, folder), users(spark, folder).select("user_id", "country")
    )


@query("transaction_rollup",
       "transaction_date:d country transaction_type total_transactions completed_transactions "
       "failed_transactions total_revenue:2 completed_revenue:2 success_rate:2 avg_transaction_amount:2",
       f"""SELECT CAST(timestamp AS DATE) AS transaction_date, country, transaction_type,
              count(*) AS total_transactions, count(*) FILTER (WHERE {DONE}) AS completed_transactions,
              count(*) FILTER (WHERE status = 'failed') AS failed_transactions,
              round(sum(amount), 2) AS total_revenue, round({REVENUE}, 2) AS completed_revenue,
              {SUCCESS} AS success_rate, ((2 * CAST(round(sum(amount) * 100) AS BIGINT) + count(*)) // (2 * count(*))) / 100.0
                  AS avg_transaction_amount
           FROM {LOCATED_SQL} GROUP BY 1, 2, 3""")
def _(spark, folder):
    return agg.transaction_rollup(orders(spark, folder), users(spark, folder))


@query("daily_summary",
       "transaction_date total_transactions unique_users total_revenue:2 avg_transaction_amount:6 "
       "avg_processing_time:6 purchases refunds subscriptions completed_txns failed_txns completed_revenue:2",
       f"""SELECT {DAY} AS transaction_date, count(*) AS total_transactions,
              count(DISTINCT user_id) AS unique_users, sum(amount) AS total_revenue,
              avg(amount) AS avg_transaction_amount, avg(processing_time_ms) AS avg_processing_time,
              count(*) FILTER (WHERE transaction_type = 'purchase') AS purchases,
              count(*) FILTER (WHERE transaction_type = 'refund') AS refunds,
              count(*) FILTER (WHERE transaction_type = 'subscription') AS subscriptions,
              count(*) FILTER (WHERE {DONE}) AS completed_txns,
              count(*) FILTER (WHERE status = 'failed') AS failed_txns, {REVENUE} AS completed_revenue
           FROM {ORDERS_SQL} GROUP BY 1""")
def _(spark, folder):
    return lake.daily_summary(orders(spark, folder))


@query("user_analytics",
       "user_id country user_type age_group signup_date:d total_transactions lifetime_value:2 "
       "avg_transaction_amount:6 last_transaction_date:t first_transaction_date:t active_days "
       "avg_processing_time:6 purchases subscriptions success_rate_pct:2",
       f"""SELECT user_id, country, user_type, age_group, signup_date, count(*) AS total_transactions,
              {REVENUE} AS lifetime_value, avg(amount) AS avg_transaction_amount,
              max(timestamp) AS last_transaction_date, min(timestamp) AS first_transaction_date,
              count(DISTINCT {DAY}) AS active_days, avg(processing_time_ms) AS avg_processing_time,
              count(*) FILTER (WHERE transaction_type = 'purchase') AS purchases,
              count(*) FILTER (WHERE transaction_type = 'subscription') AS subscriptions,
              {SUCCESS} AS success_rate_pct
           FROM {ORDERS_SQL} JOIN {USERS_SQL} USING (user_id)
           GROUP BY 1, 2, 3, 4, 5 HAVING count(*) >= 5""")
def _(spark, folder):
    return lake.user_analytics(orders(spark, folder), users(spark, folder))


@query("geographic",
       "country unique_users total_transactions total_revenue:2 avg_transaction_amount:6 "
       "avg_processing_time:6 premium_users:i enterprise_users:i success_rate_pct:2 revenue_per_user:2",
       f"""SELECT country, count(DISTINCT t.user_id) AS unique_users, count(*) AS total_transactions,
              {REVENUE} AS total_revenue, avg(amount) AS avg_transaction_amount,
              avg(processing_time_ms) AS avg_processing_time,
              sum(CASE WHEN user_type = 'premium' THEN 1 ELSE 0 END) AS premium_users,
              sum(CASE WHEN user_type = 'enterprise' THEN 1 ELSE 0 END) AS enterprise_users,
              {SUCCESS} AS success_rate_pct,
              ((2 * CAST(round({REVENUE} * 100) AS BIGINT) + count(DISTINCT t.user_id))
                  // (2 * count(DISTINCT t.user_id))) / 100.0 AS revenue_per_user
           FROM {LOCATED_SQL} t JOIN (SELECT user_id, user_type FROM {USERS_SQL}) u USING (user_id)
           GROUP BY country""")
def _(spark, folder):
    return lake.geographic(orders(spark, folder), users(spark, folder))


def event_transactions(spark, folder):
    """Batch transactions with a time of day, made of the events."""
    rows = fraud_transactions(spark, folder).select(
        "transaction_id",
        "user_id",
        "timestamp",
        "amount",
        F.when(F.col("is_fraud"), "failed").otherwise("completed").alias("status"),
        F.col("merchant_id").cast("double").alias("processing_time_ms"),
    )
    return lake.with_partitions(rows)


@query("hourly_trends",
       "transaction_date hour_of_day:i transaction_count unique_users hourly_revenue:2 "
       "avg_processing_time:6 success_rate_pct:2",
       f"""SELECT {DAY} AS transaction_date, hour(timestamp) AS hour_of_day,
              count(*) AS transaction_count, count(DISTINCT user_id) AS unique_users,
              {REVENUE} AS hourly_revenue, avg(merchant_id) AS avg_processing_time,
              {SUCCESS} AS success_rate_pct
           FROM (SELECT *, CASE WHEN is_fraud THEN 'failed' ELSE 'completed' END AS status FROM {FRAUD_SQL})
           GROUP BY 1, 2""")
def _(spark, folder):
    return lake.hourly_trends(event_transactions(spark, folder))


@query("business_kpis",
       "metric_scope total_users total_transactions total_revenue:2 avg_transaction_value:6 "
       "premium_users enterprise_users overall_success_rate:2",
       f"""SELECT 'overall' AS metric_scope, count(DISTINCT user_id) AS total_users,
              count(*) AS total_transactions, {REVENUE} AS total_revenue,
              avg(amount) AS avg_transaction_value,
              count(DISTINCT CASE WHEN user_type = 'premium' THEN user_id END) AS premium_users,
              count(DISTINCT CASE WHEN user_type = 'enterprise' THEN user_id END) AS enterprise_users,
              {SUCCESS} AS overall_success_rate
           FROM {ORDERS_SQL} JOIN {USERS_SQL} USING (user_id)""")
def _(spark, folder):
    return lake.business_kpis(orders(spark, folder), users(spark, folder))


# The warehouse form of the transactions has a JSON location and unclean codes.
WAREHOUSE_SQL = f"""(SELECT *, CASE WHEN merchant_id % 7 = 0 THEN NULL ELSE 'EUR' END AS currency,
    '  ' || upper(merchant_category) || ' ' AS raw_category,
    CASE WHEN merchant_id % 5 = 0 THEN NULL ELSE merchant_id / 2 END AS lat FROM {FRAUD_SQL})"""


def warehouse_transactions(spark, folder):
    merchant = F.col("merchant_id")
    location = F.to_json(
        F.struct(
            (merchant / 2).alias("lat"),
            F.lit("n/a").alias("lon"),
            F.concat(F.lit("C"), merchant).alias("country"),
        )
    )
    return fraud_transactions(spark, folder).select(
        "transaction_id",
        "user_id",
        "merchant_id",
        "timestamp",
        F.col("amount").cast(MONEY).alias("amount"),
        F.when(merchant % 7 != 0, "EUR").alias("currency"),
        F.concat(F.lit("  "), F.upper("merchant_category"), F.lit(" ")).alias("merchant_category"),
        F.lit("Online ").alias("channel"),
        F.when(merchant % 5 != 0, location).alias("location"),
        "is_fraud",
        F.lit(None).cast("decimal(5,4)").alias("fraud_score"),
        F.lit(None).cast("string").alias("model_version"),
        F.col("timestamp").alias("created_at"),
    )


@query("clean_transactions",
       "transaction_id user_id merchant_id transaction_timestamp:t amount:2 currency merchant_category "
       "channel country latitude:2 longitude:2 is_fraud fraud_score:4 model_version",
       f"""SELECT transaction_id, user_id, merchant_id, timestamp AS transaction_timestamp, amount,
              coalesce(currency, 'USD') AS currency, merchant_category, 'online' AS channel,
              CASE WHEN lat IS NULL THEN 'unknown' ELSE 'C' || merchant_id END AS country,
              lat AS latitude, CAST(NULL AS DOUBLE) AS longitude, is_fraud, 0 AS fraud_score,
              'unknown' AS model_version FROM {WAREHOUSE_SQL}""")
def _(spark, folder):
    return filters.clean_transactions(warehouse_transactions(spark, folder))


def unchecked(spark, folder):
    """Orders as raw records, with amounts shifted so that some break the rules."""
    return batch_transactions(spark, folder).select(
        F.when(F.col("transaction_type") != "refund", F.col("transaction_id")).alias(
            "transaction_id"
        ),
        "user_id",
        (F.col("amount") * 4 - 50_000).alias("amount"),
        (F.col("timestamp") + F.expr("INTERVAL 22 YEARS")).alias("timestamp"),
        F.col("transaction_id").alias("row_id"),
    )


UNCHECKED_SQL = f"""(SELECT CASE WHEN transaction_type <> 'refund' THEN transaction_id END AS transaction_id,
    user_id, amount * 4 - 50000 AS amount, timestamp + INTERVAL 22 YEARS AS timestamp,
    transaction_id AS row_id FROM {ORDERS_SQL})"""


@query("validity_filter", "row_id user_id amount:2 timestamp:t",
       f"""SELECT * FROM {UNCHECKED_SQL} WHERE amount > 0 AND amount < 1000000
           AND timestamp >= TIMESTAMP '2020-01-01' AND timestamp <= TIMESTAMP '2023-06-01' + INTERVAL 1 DAY""")
def _(spark, folder):
    as_of = F.lit("2023-06-01").cast("timestamp")
    return unchecked(spark, folder).where(filters.is_valid_transaction(as_of, "timestamp"))


@query("reject_reasons", "row_id error",
       f"""SELECT row_id, CASE WHEN transaction_id IS NULL THEN 'missing_transaction_id'
               ELSE 'amount_not_positive' END AS error
           FROM {UNCHECKED_SQL} WHERE transaction_id IS NULL OR amount <= 0""")
def _(spark, folder):
    return filters.split_rejects(unchecked(spark, folder), filters.record_reason())[1]


@query("accepted_records", "row_id transaction_id amount:2",
       f"SELECT * FROM {UNCHECKED_SQL} WHERE transaction_id IS NOT NULL AND amount > 0")
def _(spark, folder):
    return filters.split_rejects(unchecked(spark, folder), filters.record_reason())[0]


@query("request_contract", "row_id amount:2 channel error",
       f"""SELECT row_id, round(amount, 2) AS amount, 'online' AS channel,
               CASE WHEN amount <= 0 THEN 'amount must be positive'
                    WHEN amount > 1000000 THEN 'amount too large'
                    WHEN user_id % 200 > 90 THEN 'latitude out of range' END AS error
           FROM {UNCHECKED_SQL}""")
def _(spark, folder):
    requests = unchecked(spark, folder).withColumns(
        {
            "location_lat": (F.col("user_id") % 200).cast("double"),
            "location_lon": F.lit(None).cast("double"),
            "channel": F.lit(None).cast("string"),
        }
    )
    return filters.check_requests(requests)


@query("negative_amounts", "row_id amount:2",
       f"SELECT row_id, amount FROM {UNCHECKED_SQL} WHERE amount < 0")
def _(spark, folder):
    return filters.violations(unchecked(spark, folder))


def staged(spark, folder):
    return risk.staged_transactions(
        warehouse_transactions(spark, folder), latest(fraud_transactions(spark, folder), "timestamp")
    )


AS_OF = "(SELECT max(ts) FROM events)"
RISKY = "('error', 'signup')"
DAILY_SQL = f"""(SELECT user_id, CAST(timestamp AS DATE) AS transaction_date,
    count(*) AS daily_transaction_count, sum(amount) AS daily_amount, avg(amount) AS daily_avg_amount,
    stddev_samp(amount) AS daily_std_amount, count(DISTINCT merchant_category) AS unique_categories,
    sum(CASE WHEN is_fraud THEN 1 ELSE 0 END) AS fraud_count
    FROM {FRAUD_SQL} GROUP BY 1, 2)"""
PATTERNS_SQL = f"""(SELECT *, CASE WHEN fraud_rate > 0.1 THEN 'very_high_risk'
        WHEN fraud_rate > 0.05 THEN 'high_risk' WHEN fraud_rate > 0.02 THEN 'medium_risk'
        ELSE 'low_risk' END AS risk_category
    FROM (SELECT user_id, count(*) AS active_days, sum(daily_transaction_count) AS total_transactions,
        sum(daily_amount) AS total_amount, avg(daily_amount) AS avg_daily_amount,
        stddev_samp(daily_amount) AS std_daily_amount,
        max(daily_transaction_count) AS max_daily_transactions,
        avg(daily_transaction_count) AS avg_daily_transactions,
        avg(unique_categories) AS avg_daily_categories, sum(fraud_count) AS total_fraud_count,
        sum(fraud_count) / nullif(sum(daily_transaction_count), 0) AS fraud_rate,
        min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date,
        date_diff('day', min(transaction_date), max(transaction_date)) AS days_active
    FROM {DAILY_SQL} GROUP BY 1))"""


@query("user_daily_stats",
       "user_id transaction_date:d daily_transaction_count daily_amount:2 daily_avg_amount:6 "
       "daily_std_amount:5 unique_categories fraud_count:i",
       f"SELECT * FROM {DAILY_SQL}")
def _(spark, folder):
    return agg.user_daily_stats(staged(spark, folder))


@query("user_patterns",
       "user_id active_days total_transactions:i total_amount:2 avg_daily_amount:6 std_daily_amount:5 "
       "max_daily_transactions avg_daily_transactions:6 avg_daily_categories:6 total_fraud_count:i "
       "fraud_rate:6 first_transaction_date:d last_transaction_date:d days_active:i risk_category",
       f"SELECT * FROM {PATTERNS_SQL}")
def _(spark, folder):
    return risk.patterns(staged(spark, folder), latest(fraud_transactions(spark, folder), "timestamp"))


@query("risk_scoring",
       "transaction_id user_id transaction_timestamp:t amount:2 merchant_category is_fraud risk_score:6 "
       "risk_factors_list:l risk_level recommendation",
       f"""WITH recent AS (SELECT *, row_number() OVER (PARTITION BY user_id
                   ORDER BY timestamp DESC, transaction_id DESC) AS rn FROM {FRAUD_SQL}
               WHERE timestamp >= date_trunc('day', {AS_OF}) - INTERVAL 24 HOURS),
           activity AS (SELECT user_id, count(*) AS n, count(DISTINCT merchant_category) AS c
               FROM recent GROUP BY 1),
           flags AS (SELECT r.*, h.fraud_rate,
               CASE WHEN a.n > 50 THEN 1 ELSE 0 END AS f1,
               CASE WHEN r.amount > h.avg_daily_amount * 3 THEN 1 ELSE 0 END AS f2,
               CASE WHEN r.merchant_category IN {RISKY} THEN 1 ELSE 0 END AS f3,
               CASE WHEN a.c > h.avg_daily_categories * 2 THEN 1 ELSE 0 END AS f4,
               CASE WHEN hour(r.timestamp) BETWEEN 0 AND 6 THEN 1 ELSE 0 END AS f5
               FROM recent r LEFT JOIN activity a USING (user_id)
               LEFT JOIN {PATTERNS_SQL} h USING (user_id) WHERE r.rn = 1),
           scored AS (SELECT *, f1 * 0.2 + f2 * 0.25 + f3 * 0.15 + f4 * 0.1 + f5 * 0.1
               + coalesce(fraud_rate, 0) * 0.2 AS risk_score FROM flags)
           SELECT transaction_id, user_id, timestamp AS transaction_timestamp, amount,
               merchant_category, is_fraud, risk_score,
               list_filter([CASE WHEN f1 = 1 THEN 'high_velocity' END,
                   CASE WHEN f2 = 1 THEN 'unusual_amount' END, CASE WHEN f3 = 1 THEN 'risky_category' END,
                   CASE WHEN f4 = 1 THEN 'unusual_diversity' END, CASE WHEN f5 = 1 THEN 'unusual_time' END,
                   CASE WHEN fraud_rate > 0.05 THEN 'fraud_history' END], lambda x: x IS NOT NULL)
                   AS risk_factors_list,
               CASE WHEN risk_score >= 0.7 THEN 'high' WHEN risk_score >= 0.5 THEN 'medium'
                   ELSE 'low' END AS risk_level,
               CASE WHEN risk_score >= 0.7 THEN 'block' WHEN risk_score >= 0.5 THEN 'review'
                   ELSE 'approve' END AS recommendation FROM scored""")
def _(spark, folder):
    return risk.risk_scoring(
        staged(spark, folder),
        latest(fraud_transactions(spark, folder), "timestamp"),
        high_risk=("error", "signup"),
    )


@query("risk_profile_p95",
       "user_id transaction_count avg_amount:8 stddev_amount:5 fraud_count p95_amount:4",
       f"""SELECT user_id, count(*) AS transaction_count, avg(amount) AS avg_amount,
               stddev_samp(amount) AS stddev_amount, count(*) FILTER (WHERE is_fraud) AS fraud_count,
               quantile_cont(amount, 0.95) AS p95_amount
           FROM {FRAUD_SQL} WHERE timestamp > {AS_OF} - INTERVAL 20 DAYS GROUP BY 1""")
def _(spark, folder):
    rows = fraud_transactions(spark, folder)
    return agg.user_risk_profile(rows, latest(rows, "timestamp"), days=20)


STAT_SQL = """count(*) AS total_transactions, count(*) FILTER (WHERE is_fraud) AS fraud_transactions,
    sum(amount) AS total_amount, sum(CASE WHEN is_fraud THEN amount ELSE 0 END) AS fraud_amount,
    avg(amount) AS avg_amount, count(*) FILTER (WHERE is_fraud) / count(*) AS fraud_rate"""
STAT_SPEC = (
    "total_transactions fraud_transactions total_amount:2 fraud_amount:2 avg_amount:8 fraud_rate:6"
)


@query("fraud_statistics", STAT_SPEC,
       f"""SELECT {STAT_SQL} FROM {FRAUD_SQL} WHERE timestamp >= TIMESTAMP '2024-01-05'
           AND timestamp <= TIMESTAMP '2024-01-20'""")
def _(spark, folder):
    rows = fraud_transactions(spark, folder)
    return agg.fraud_statistics(filters.search(rows, start="2024-01-05", end="2024-01-20"))


@query("fraud_by_group", "merchant_category " + STAT_SPEC,
       f"SELECT merchant_category, {STAT_SQL} FROM {FRAUD_SQL} GROUP BY 1")
def _(spark, folder):
    return agg.fraud_statistics(fraud_transactions(spark, folder), ["merchant_category"])


for _period in ("hour", "day", "week", "month"):
    @query(f"fraud_by_{_period}", "period_start:t " + STAT_SPEC,
           f"SELECT CAST(date_trunc('{_period}', timestamp) AS TIMESTAMP) AS period_start, {STAT_SQL} "
           f"FROM {FRAUD_SQL} GROUP BY 1")
    def _(spark, folder, period=_period):
        return agg.fraud_over_time(fraud_transactions(spark, folder), period)


@query("fraud_by_category", "merchant_category fraud_count total_amount:2 avg_amount:8",
       f"""SELECT merchant_category, count(*) AS fraud_count, sum(amount) AS total_amount,
               avg(amount) AS avg_amount FROM {FRAUD_SQL} WHERE is_fraud GROUP BY 1""")
def _(spark, folder):
    return agg.fraud_by_category(fraud_transactions(spark, folder))


@query("frauds_per_user", "user_id fraud_count",
       f"SELECT user_id, count(*) AS fraud_count FROM {FRAUD_SQL} WHERE is_fraud GROUP BY 1")
def _(spark, folder):
    return agg.frauds_per_user(fraud_transactions(spark, folder))


@query("fraud_summary", "transactions frauds fraud_percent:2",
       f"""SELECT count(*) AS transactions, count(*) FILTER (WHERE is_fraud) AS frauds,
               round(avg(CAST(is_fraud AS INT)) * 100, 2) AS fraud_percent FROM {FRAUD_SQL}""")
def _(spark, folder):
    return agg.fraud_summary(fraud_transactions(spark, folder))


@query("class_weight", "negatives positives scale_pos_weight:6",
       f"""SELECT count(*) FILTER (WHERE NOT is_fraud) AS negatives,
               count(*) FILTER (WHERE is_fraud) AS positives,
               count(*) FILTER (WHERE NOT is_fraud) / count(*) FILTER (WHERE is_fraud) AS scale_pos_weight
           FROM {FRAUD_SQL}""")
def _(spark, folder):
    return agg.class_weight(fraud_transactions(spark, folder))


MODE_SQL = f"""(SELECT user_id, merchant_category AS mode FROM (SELECT user_id, merchant_category,
    row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, merchant_category) AS rn
    FROM {FRAUD_SQL} GROUP BY 1, 2) WHERE rn = 1)"""


@query("user_features",
       "user_id amount_count amount_mean:8 amount_std:5 amount_min:2 amount_max:2 amount_sum:2 "
       "merchant_id_nunique timestamp_min:t timestamp_max:t merchant_category_mode "
       "days_since_first_transaction:i avg_days_between_transactions:6",
       f"""SELECT user_id, count(*) AS amount_count, avg(amount) AS amount_mean,
               stddev_samp(amount) AS amount_std, min(amount) AS amount_min, max(amount) AS amount_max,
               sum(amount) AS amount_sum, count(DISTINCT merchant_id) AS merchant_id_nunique,
               min(timestamp) AS timestamp_min, max(timestamp) AS timestamp_max,
               any_value(mode) AS merchant_category_mode,
               floor((epoch_us({AS_OF}) - epoch_us(min(timestamp))) / 86400000000)
                   AS days_since_first_transaction,
               floor((epoch_us(max(timestamp)) - epoch_us(min(timestamp))) / 86400000000) / count(*)
                   AS avg_days_between_transactions
           FROM {FRAUD_SQL} JOIN {MODE_SQL} USING (user_id) GROUP BY 1""")
def _(spark, folder):
    rows = fraud_transactions(spark, folder)
    return agg.user_features(rows, latest(rows, "timestamp"))


@query("merchant_features",
       "merchant_id is_fraud_sum:i is_fraud_mean:6 amount_count amount_mean:8 amount_std:5 "
       "user_id_nunique fraud_rate:6 risk_category",
       f"""SELECT *, is_fraud_mean AS fraud_rate, CASE WHEN is_fraud_mean <= 0 THEN NULL
               WHEN is_fraud_mean <= 0.01 THEN 'low' WHEN is_fraud_mean <= 0.05 THEN 'medium'
               WHEN is_fraud_mean <= 0.1 THEN 'high' ELSE 'very_high' END AS risk_category
           FROM (SELECT merchant_id, sum(CAST(is_fraud AS INT)) AS is_fraud_sum,
               avg(CAST(is_fraud AS INT)) AS is_fraud_mean, count(amount) AS amount_count,
               avg(amount) AS amount_mean, stddev_samp(amount) AS amount_std,
               count(DISTINCT user_id) AS user_id_nunique FROM {FRAUD_SQL} GROUP BY 1)""")
def _(spark, folder):
    return agg.merchant_features(fraud_transactions(spark, folder))


ALL_FEATURES_SPEC = (
    "transaction_id amount_log:6 amount_category is_round_amount:i hour:i day_of_week:i day_of_month:i "
    "is_weekend:i is_night:i is_business_hours:i hours_since_last_transaction:4 "
    "transaction_acceleration:4 user_amount_mean:8 user_amount_std:5 user_amount_min:2 "
    "user_amount_max:2 user_merchant_id_nunique user_merchant_category_mode amount_zscore:5"
)


@query("model_features", ALL_FEATURES_SPEC,
       f"""WITH h AS (SELECT *, coalesce((epoch_us(timestamp) - epoch_us(lag(timestamp) OVER w))
                   / 3600000000.0, 24.0) AS hours_since_last_transaction FROM {FRAUD_SQL}
               WINDOW w AS (PARTITION BY user_id ORDER BY timestamp, transaction_id)),
           s AS (SELECT user_id, avg(amount) AS user_amount_mean, stddev_samp(amount) AS user_amount_std,
               min(amount) AS user_amount_min, max(amount) AS user_amount_max,
               count(DISTINCT merchant_id) AS user_merchant_id_nunique FROM {FRAUD_SQL} GROUP BY 1)
           SELECT h.*, s.*, mode AS user_merchant_category_mode, ln(1 + amount) AS amount_log,
               CASE WHEN amount <= 0 THEN NULL WHEN amount <= 50 THEN 'very_low' WHEN amount <= 200 THEN 'low'
                   WHEN amount <= 1000 THEN 'medium' WHEN amount <= 5000 THEN 'high'
                   ELSE 'very_high' END AS amount_category,
               CASE WHEN CAST(amount AS DECIMAL(12, 2)) % 10 = 0 THEN 1 ELSE 0 END AS is_round_amount,
               hour(timestamp) AS hour, isodow(timestamp) - 1 AS day_of_week,
               day(timestamp) AS day_of_month,
               CASE WHEN isodow(timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend,
               CASE WHEN hour(timestamp) <= 6 THEN 1 ELSE 0 END AS is_night,
               CASE WHEN hour(timestamp) BETWEEN 9 AND 17 AND isodow(timestamp) < 6 THEN 1 ELSE 0 END
                   AS is_business_hours,
               coalesce(hours_since_last_transaction - lag(hours_since_last_transaction) OVER (
                   PARTITION BY h.user_id ORDER BY timestamp, transaction_id), 0) AS transaction_acceleration,
               (amount - user_amount_mean) / greatest(user_amount_std, 1) AS amount_zscore
           FROM h JOIN s USING (user_id) JOIN {MODE_SQL} USING (user_id)""")
def _(spark, folder):
    return features.all_features(fraud_transactions(spark, folder))


@query("high_amount_flag", "transaction_id is_high_amount",
       f"""SELECT transaction_id, amount > (SELECT quantile_cont(amount, 0.95) FROM {FRAUD_SQL})
               AS is_high_amount FROM {FRAUD_SQL}""")
def _(spark, folder):
    return flag_above_percentile(fraud_transactions(spark, folder))


USER_VIEW_SQL = f"(SELECT user_id, avg(amount) AS avg_amount, max(amount) AS top FROM {FRAUD_SQL} GROUP BY 1)"
SHOP_VIEW_SQL = f"""(SELECT merchant_id, avg(CAST(is_fraud AS INT)) AS merchant_risk_score,
    min(amount) AS top FROM {FRAUD_SQL} GROUP BY 1 HAVING max(amount) > 220)"""


def merged(spark, folder):
    rows = fraud_transactions(spark, folder)
    by_user = rows.groupBy("user_id").agg(
        F.avg("amount").alias("avg_amount"), F.max("amount").alias("top")
    )
    by_shop = (
        rows.groupBy("merchant_id")
        .agg(
            agg.rate_of("is_fraud").alias("merchant_risk_score"),
            F.min("amount").alias("top"),
            F.max("amount").alias("_highest"),
        )
        .where("_highest > 220")
        .drop("_highest")
    )
    return detector.feature_rows(rows, by_user, by_shop)


@query("feature_merge",
       "transaction_id user_id merchant_id avg_amount:8 top:2 merchant_risk_score:6 hour_of_day:i day_of_week:i",
       f"""SELECT t.*, u.avg_amount, coalesce(m.top, u.top) AS top, m.merchant_risk_score,
               hour(timestamp) AS hour_of_day, isodow(timestamp) - 1 AS day_of_week
           FROM {FRAUD_SQL} t LEFT JOIN {USER_VIEW_SQL} u USING (user_id)
           LEFT JOIN {SHOP_VIEW_SQL} m USING (merchant_id)""")
def _(spark, folder):
    return merged(spark, folder)


SCORE_SQL = """least((CASE WHEN amount > 5000 THEN 0.3 ELSE 0 END)
    + (CASE WHEN hour(timestamp) < 6 THEN 0.2 ELSE 0 END)
    + (CASE WHEN merchant_category IN ('error', 'signup') THEN 0.3 ELSE 0 END), 1.0)"""


@query("rule_decisions", "transaction_id is_fraud fraud_probability:6 risk_factors:l",
       f"""SELECT transaction_id, {SCORE_SQL} > 0.4 AS is_fraud, {SCORE_SQL} AS fraud_probability,
               list_filter([CASE WHEN amount > 5000 THEN 'high_amount' END,
                   CASE WHEN hour(timestamp) < 6 THEN 'unusual_time' END,
                   CASE WHEN merchant_category = 'error' THEN 'high_risk_merchant' END],
                   lambda x: x IS NOT NULL) AS risk_factors
           FROM (SELECT * REPLACE (amount * 30 AS amount) FROM {FRAUD_SQL})""")
def _(spark, folder):
    rows = merged(spark, folder).withColumn("amount", F.col("amount") * 30)
    return detector.decide(
        rows, threshold=0.4, categories=("error", "signup"), explained=("error",)
    )


@query("isolated_decisions", "transaction_id is_fraud fraud_probability:6 error",
       f"""SELECT transaction_id, CASE WHEN merchant_id < 20 THEN false ELSE {SCORE_SQL} > 0.7 END AS is_fraud,
               CASE WHEN merchant_id < 20 THEN 0 ELSE {SCORE_SQL} END AS fraud_probability,
               CASE WHEN merchant_id < 20 THEN 'missing merchant_id' END AS error
           FROM {FRAUD_SQL}""")
def _(spark, folder):
    rows = merged(spark, folder).withColumn(
        "merchant_id", F.when(F.col("merchant_id") >= 20, F.col("merchant_id"))
    )
    return detector.decide_each(rows, categories=("error", "signup"))


@query("simple_decisions", "transaction_id is_fraud fraud_probability:6 risk_factors:l",
       f"""SELECT transaction_id, s >= 0.5 AS is_fraud, s AS fraud_probability,
               ['fallback_model_used'] AS risk_factors
           FROM (SELECT transaction_id, least((CASE WHEN amount * 100 > 10000 THEN 0.5 ELSE 0 END)
               + (CASE WHEN merchant_category = 'error' THEN 0.3 ELSE 0 END)
               + (CASE WHEN hour(timestamp) < 6 THEN 0.2 ELSE 0 END), 1.0) AS s FROM {FRAUD_SQL})""")
def _(spark, folder):
    rows = fraud_transactions(spark, folder).withColumns(
        {"amount": F.col("amount") * 100, "hour_of_day": F.hour("timestamp")}
    )
    return detector.simple_decisions(rows, ("error",))


@query("factor_variants", "transaction_id documented:l extended:l",
       f"""SELECT transaction_id,
               list_filter([CASE WHEN a > 5000 THEN 'high_amount' END,
                   CASE WHEN hour(timestamp) <= 6 THEN 'unusual_time' END,
                   CASE WHEN p > 0.8 THEN 'high_ml_score' END], lambda x: x IS NOT NULL) AS documented,
               list_filter([CASE WHEN a > 5000 THEN 'high_amount' END,
                   CASE WHEN z > 3 THEN 'unusual_amount_for_user' END,
                   CASE WHEN merchant_id > 10 THEN 'high_velocity' END,
                   CASE WHEN merchant_category = 'error' THEN 'high_risk_merchant_category' END,
                   CASE WHEN hour(timestamp) < 6 THEN 'unusual_time' END,
                   CASE WHEN p > 0.9 THEN 'very_high_ml_confidence' WHEN p > 0.7 THEN 'high_ml_confidence' END],
                   lambda x: x IS NOT NULL) AS extended
           FROM (SELECT *, amount * 100 AS a, merchant_id / 100 AS p,
                 (amount - avg(amount) OVER (PARTITION BY user_id))
                 / greatest(stddev_samp(amount) OVER (PARTITION BY user_id), 1) AS z FROM {FRAUD_SQL})""")
def _(spark, folder):
    from tidemark.operators.sequences import amount_zscores

    rows = amount_zscores(fraud_transactions(spark, folder)).withColumns(
        {
            "a": F.col("amount") * 100,
            "p": F.col("merchant_id") / 100,
            "hour": F.hour("timestamp"),
            "night": F.hour("timestamp").between(0, 6),
        }
    )
    return rows.select(
        "transaction_id",
        rules.documented_factors("a", "night", "p").alias("documented"),
        rules.extended_factors(
            "a", "amount_zscore", "merchant_id", "merchant_category", "hour", "p", ("error",)
        ).alias("extended"),
    )


@query("stream_rules",
       "transaction_id transaction_count_1h amount_zscore:3 rule_high_amount rule_unusual_time "
       "rule_rapid_transactions rule_high_zscore risk_score:6",
       f"""SELECT transaction_id, n AS transaction_count_1h, z AS amount_zscore, a > 10000 AS rule_high_amount,
               hour(timestamp) <= 6 AND a > 1000 AS rule_unusual_time, n > 10 AS rule_rapid_transactions,
               z > 3 AS rule_high_zscore,
               (CASE WHEN a > 10000 THEN 0.3 ELSE 0 END)
               + (CASE WHEN hour(timestamp) <= 6 AND a > 1000 THEN 0.2 ELSE 0 END)
               + (CASE WHEN n > 10 THEN 0.3 ELSE 0 END) + (CASE WHEN z > 3 THEN 0.2 ELSE 0 END) AS risk_score
           FROM (SELECT *, CASE WHEN s > 0 THEN (a - m) / s ELSE 0 END AS z
                 FROM (SELECT *, amount * 100 AS a, count(*) OVER w AS n, avg(amount * 100) OVER w AS m,
                           stddev_samp(amount * 100) OVER w AS s FROM {FRAUD_SQL}
                       WINDOW w AS (PARTITION BY user_id ORDER BY timestamp
                           RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW)))""")
def _(spark, folder):
    from tidemark.functions.numbers import zscore_or_zero
    from tidemark.operators.sequences import velocity

    rows = fraud_transactions(spark, folder).withColumn("amount", F.col("amount") * 100)
    enriched = velocity(rules.stream_flags(rows), {"1h": 86400})
    scored = enriched.withColumn(
        "amount_zscore", zscore_or_zero("amount", "avg_amount_1h", "std_amount_1h")
    )
    return rules.stream_rules(scored)


@query("search_page",
       "transaction_id amount:2 total_count has_next_page has_previous_page",
       f"""SELECT transaction_id, amount, (SELECT count(*) FROM {FRAUD_SQL} WHERE amount BETWEEN 20 AND 300
               AND timestamp >= TIMESTAMP '2024-01-03' AND NOT is_fraud) AS total_count,
               true AS has_next_page, true AS has_previous_page
           FROM {FRAUD_SQL} WHERE amount BETWEEN 20 AND 300 AND timestamp >= TIMESTAMP '2024-01-03'
               AND NOT is_fraud ORDER BY amount DESC, transaction_id LIMIT 20 OFFSET 40""")
def _(spark, folder):
    found = filters.search(
        fraud_transactions(spark, folder),
        min_amount=20,
        max_amount=300,
        start="2024-01-03",
        is_fraud=False,
    )
    return filters.page(found, "amount", 20, 40)


@query("search_page_ascending",
       "transaction_id timestamp:t total_count has_next_page has_previous_page",
       f"""SELECT transaction_id, timestamp, (SELECT count(*) FROM {FRAUD_SQL} WHERE user_id = 7) AS total_count,
               (SELECT count(*) FROM {FRAUD_SQL} WHERE user_id = 7) > 5 AS has_next_page, false AS has_previous_page
           FROM {FRAUD_SQL} WHERE user_id = 7 ORDER BY timestamp, transaction_id LIMIT 5""")
def _(spark, folder):
    found = filters.search(fraud_transactions(spark, folder), user_id=7)
    return filters.page(found, "timestamp", 5, ascending=True)


@query("last_predictions", "transaction_id timestamp:t",
       f"""SELECT transaction_id, timestamp FROM {FRAUD_SQL} WHERE user_id = 7
           ORDER BY timestamp DESC, transaction_id DESC LIMIT 10""")
def _(spark, folder):
    return filters.last_predictions(fraud_transactions(spark, folder), 7)


@query("slow_operations", "transaction_id amount:2",
       f"SELECT transaction_id, amount FROM {FRAUD_SQL} WHERE amount > 100")
def _(spark, folder):
    return filters.slower_than(fraud_transactions(spark, folder), "amount", 100)


@query("orphans", "l_suppkey n",
       """SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_suppkey NOT IN
          (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY 1""")
def _(spark, folder):
    parents = table(spark, folder, "supplier").where("s_acctbal > 0").select(
        F.col("s_suppkey").alias("l_suppkey")
    )
    children = table(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("n")
    )
    return sets.orphans(children, parents, "l_suppkey")


@query("skip_processed", "transaction_id",
       f"""SELECT transaction_id FROM {FRAUD_SQL} WHERE transaction_id NOT IN
           (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def _(spark, folder):
    done = table(spark, folder, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("transaction_id")
    )
    return sets.unprocessed(fraud_transactions(spark, folder), done, "transaction_id")


@query("enriched_logs", "log_id transaction_id user_id merchant_id",
       f"""SELECT o_orderkey AS log_id, o_custkey AS transaction_id, user_id, merchant_id
           FROM orders LEFT JOIN (SELECT transaction_id AS t, user_id, merchant_id FROM {FRAUD_SQL}
               WHERE amount > 30) ON t = o_custkey""")
def _(spark, folder):
    logs = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("log_id"), F.col("o_custkey").alias("transaction_id")
    )
    known = fraud_transactions(spark, folder).where("amount > 30")
    return joins.enrich_logs(logs, known, ["user_id", "merchant_id"])


@query("users_joined", "transaction_id user_id country user_type",
       f"SELECT transaction_id, user_id, country, user_type FROM {ORDERS_SQL} JOIN {USERS_SQL} USING (user_id)")
def _(spark, folder):
    return joins.with_users(batch_transactions(spark, folder), users(spark, folder))


@query("dedup_last", "o_custkey o_orderkey o_totalprice:2",
       """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
              ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""")
def _(spark, folder):
    return sets.keep_last(
        table(spark, folder, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]
    )


@query("dedup_any", "o_custkey", "SELECT DISTINCT o_custkey FROM orders")
def _(spark, folder):
    return sets.keep_any(table(spark, folder, "orders"), ["o_custkey"])


@query("duplicate_keys", "l_orderkey copies",
       "SELECT l_orderkey, count(*) AS copies FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def _(spark, folder):
    return sets.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey"])


@query("duplicate_rows", "total_rows:i distinct_rows duplicate_rows:i",
       """SELECT sum(n) AS total_rows, count(*) AS distinct_rows, sum(n) - count(*) AS duplicate_rows
          FROM (SELECT *, count(*) AS n FROM conversations GROUP BY ALL)""")
def _(spark, folder):
    return sets.duplicate_rows(table(spark, folder, "conversations"))


@query("union_staged", "id user_id amount:2 note",
       """SELECT event_id AS id, user_id, value AS amount, NULL AS note FROM events
          UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders""")
def _(spark, folder):
    events = fraud_transactions(spark, folder).select(
        F.col("transaction_id").alias("id"), "user_id", "amount"
    )
    orders_ = table(spark, folder, "orders").select(
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("note"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("id"),
    )
    return sets.combine([events, orders_])


@query("top_risk", "user_id risk_score:2",
       f"""SELECT user_id, max(amount) AS risk_score FROM {FRAUD_SQL}
           WHERE CAST(timestamp AS DATE) = CAST({AS_OF} AS DATE)
           GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(spark, folder):
    from tidemark.operators.monitoring import top_risk

    rows = fraud_transactions(spark, folder)
    return top_risk(rows.withColumnRenamed("amount", "risk_score"), latest(rows, "timestamp"))
