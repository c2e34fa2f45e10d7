"""Queries over the event stream's table form."""

from pyspark.sql import functions as F

from tidemark.model import fraud_transactions, raw_events, table
from tidemark.functions import rules
from tidemark.operators import aggregates as agg
from tidemark.operators.filters import stage_events
from tidemark.plans import warehouse
from tidemark.session import shared_folder
from tidemark.queries.registry import EVENTS_SQL, FRAUD_SQL, query

STAGED_SQL = f"""(SELECT id AS event_id, user_id, value AS event_type, ts AS event_ts,
    CAST(ts AS DATE) AS event_date FROM {EVENTS_SQL} WHERE ts IS NOT NULL)"""


def staged(spark, folder):
    return stage_events(raw_events(spark, folder))


@query("stg_events", "event_id user_id event_type event_ts:t event_date:d",
       f"SELECT * FROM {STAGED_SQL}")
def _(spark, folder):
    return staged(spark, folder)


@query("daily_event_metrics", "event_date:d event_type event_count",
       f"""SELECT event_date, event_type, count(*) AS event_count FROM {STAGED_SQL}
           GROUP BY ALL ORDER BY event_date DESC, event_count DESC""")
def daily_event_metrics(spark, folder):
    return agg.daily_event_metrics(staged(spark, folder))


@query("tumbling_counts", "window_start:t window_end:t event_count",
       """SELECT date_trunc('minute', ts) AS window_start,
              date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, count(*) AS event_count
          FROM events GROUP BY ALL""")
def _(spark, folder):
    return agg.event_counts(raw_events(spark, folder))


SLIDING_SQL = """SELECT 'sliding_window' AS metric_type, count(*) AS event_count, window_start,
    window_start + INTERVAL 1 MINUTE AS window_end, avg(user_id) AS avg_processing_time
    FROM (SELECT user_id, ts, unnest(generate_series(
              time_bucket(INTERVAL 10 SECONDS, ts) - INTERVAL 50 SECONDS,
              time_bucket(INTERVAL 10 SECONDS, ts), INTERVAL 10 SECONDS)) AS window_start
          FROM events)
    GROUP BY window_start"""


@query("sliding_metrics",
       "metric_type event_count window_start:t window_end:t avg_processing_time:6", SLIDING_SQL)
def _(spark, folder):
    return agg.sliding_metrics(raw_events(spark, folder))


@query("five_minute_category",
       "window_start:t window_end:t merchant_category transaction_count total_amount:2 avg_risk_score:6",
       f"""SELECT time_bucket(INTERVAL 5 MINUTES, timestamp) AS window_start,
              time_bucket(INTERVAL 5 MINUTES, timestamp) + INTERVAL 5 MINUTES AS window_end,
              merchant_category, count(*) AS transaction_count, sum(amount) AS total_amount,
              avg(CASE WHEN amount > 200 THEN 0.3 ELSE 0 END
                  + CASE WHEN hour(timestamp) < 6 THEN 0.2 ELSE 0 END) AS avg_risk_score
          FROM {FRAUD_SQL} GROUP BY ALL""")
def _(spark, folder):
    scored = fraud_transactions(spark, folder).withColumn(
        "risk_score",
        rules.points(F.col("amount") > 200, 0.3) + rules.points(F.hour("timestamp") < 6, 0.2),
    )
    return agg.category_windows(scored)


@query("event_funnel", "event_type event_count unique_users",
       f"""SELECT event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users
           FROM {STAGED_SQL} GROUP BY event_type""")
def _(spark, folder):
    return agg.event_funnel(staged(spark, folder))


@query("conversion_rate", "event_date:d purchases total_events conversion_rate:6",
       f"""SELECT event_date, count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
              count(*) AS total_events,
              count(*) FILTER (WHERE event_type = 'purchase') / count(*) AS conversion_rate
           FROM {STAGED_SQL} GROUP BY event_date""")
def _(spark, folder):
    return agg.conversion_rate(staged(spark, folder))


@query("minute_totals", "minute:t event_count",
       """SELECT date_trunc('minute', ts) AS minute, count(*) AS event_count FROM events
          GROUP BY 1 ORDER BY 1 DESC LIMIT 30""")
def _(spark, folder):
    return agg.minute_totals(raw_events(spark, folder))


@query("day_totals", "event_date:d event_count",
       "SELECT CAST(ts AS DATE) AS event_date, count(*) AS event_count FROM events GROUP BY 1")
def _(spark, folder):
    return agg.day_totals(raw_events(spark, folder))


@query("grand_total", "event_count", "SELECT count(*) AS event_count FROM events")
def _(spark, folder):
    return agg.grand_total(raw_events(spark, folder))


VOLUME_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query("volume_stats", "table_name row_count",
       " UNION ALL ".join(
           f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in VOLUME_TABLES))
def _(spark, folder):
    return agg.row_counts({t: table(spark, folder, t) for t in VOLUME_TABLES})


@query("staging_tests", "check_name column_name observed:0 success",
       f"""SELECT check_name, column_name, CAST(observed AS DOUBLE) AS observed, observed = 0 AS success
           FROM (
             SELECT 'unique' AS check_name, 'event_id' AS column_name,
                    count(*) - count(DISTINCT event_id) AS observed FROM {STAGED_SQL}
             {' '.join(f"UNION ALL SELECT 'not_null', '{c}', count(*) - count({c}) FROM {STAGED_SQL}"
                       for c in ('event_id', 'user_id', 'event_type', 'event_ts', 'event_date'))})""")
def _(spark, folder):
    return warehouse.staging_tests(staged(spark, folder))


@query("daily_users", "event_date:d unique_users",
       """SELECT CAST(ts AS DATE) AS event_date, count(DISTINCT user_id) AS unique_users
          FROM events GROUP BY 1""")
def _(spark, folder):
    return agg.daily_users_exact(raw_events(spark, folder))


@query("approx_daily_users", "event_date:d unique_users")
def _(spark, folder):
    return agg.daily_users(raw_events(spark, folder))


@query("weekly_users", "week:d days exact_users within_bound",
       """SELECT CAST(date_trunc('week', ts) AS DATE) AS week, count(DISTINCT CAST(ts AS DATE)) AS days,
              count(DISTINCT user_id) AS exact_users, true AS within_bound FROM events GROUP BY 1""")
def _(spark, folder):
    """Stored sketches of days merged to weeks, held against the exact counts."""
    events, path = raw_events(spark, folder), shared_folder(spark, "sketches")
    agg.user_sketches(events).write.parquet(path)
    week = F.trunc("event_date", "week").alias("week")
    merged = agg.merged_users(spark.read.parquet(path), week)
    exact = events.groupBy(F.trunc(F.to_date("ts"), "week").alias("week")).agg(
        F.countDistinct("user_id").alias("exact_users")
    )
    off = F.abs(F.col("users") - F.col("exact_users"))
    return exact.join(merged, "week").withColumn(
        "within_bound", off <= F.greatest(F.lit(1.0), F.col("exact_users") * agg.SKETCH_BOUND)
    )


@query("user_activity", "user_id activity_date:d event_count session_count avg_processing_time:6",
       """SELECT user_id, CAST(ts AS DATE) AS activity_date, count(*) AS event_count,
              count(DISTINCT event_type) AS session_count, avg(value) AS avg_processing_time
          FROM events GROUP BY 1, 2""")
def _(spark, folder):
    named = fraud_transactions(spark, folder).select(
        "user_id",
        "timestamp",
        F.col("merchant_category").alias("session_id"),
        F.col("amount").alias("processing_time_ms"),
    )
    return agg.user_activity(named)
