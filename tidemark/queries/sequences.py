"""Queries over rows in time order."""

from pyspark.sql import functions as F

from tidemark.model import fraud_transactions, latest, raw_events
from tidemark.operators import asof
from tidemark.operators import sequences as seq
from tidemark.queries.registry import EVENTS_SQL, FRAUD_SQL, query

ORDERED = "PARTITION BY user_id ORDER BY timestamp, transaction_id"
HOURS_SQL = f"""(SELECT *, coalesce((epoch_us(timestamp) - epoch_us(lag(timestamp) OVER ({ORDERED})))
    / 3600000000.0, 24.0) AS hours_since_last_transaction FROM {FRAUD_SQL})"""


@query("hours_since_last", "transaction_id user_id hours_since_last_transaction:4",
       f"SELECT * FROM {HOURS_SQL}")
def _(spark, folder):
    return seq.hours_since_previous(fraud_transactions(spark, folder))


@query("acceleration", "transaction_id user_id hours_since_last_transaction:4 transaction_acceleration:4",
       f"""SELECT *, coalesce(hours_since_last_transaction
               - lag(hours_since_last_transaction) OVER ({ORDERED}), 0) AS transaction_acceleration
           FROM {HOURS_SQL}""")
def _(spark, folder):
    return seq.acceleration(fraud_transactions(spark, folder))


@query("days_since_last", "transaction_id days_since_last_transaction",
       f"""SELECT transaction_id, date_diff('day', lag(timestamp) OVER ({ORDERED}), timestamp)
               AS days_since_last_transaction FROM {FRAUD_SQL}""")
def _(spark, folder):
    return seq.days_since_previous(fraud_transactions(spark, folder))


def velocity_sql(source=FRAUD_SQL):
    spans = {"1h": "1 HOUR", "24h": "24 HOURS", "7d": "7 DAYS"}
    parts = []
    for suffix, length in spans.items():
        w = (f"(PARTITION BY user_id ORDER BY timestamp "
             f"RANGE BETWEEN INTERVAL {length} PRECEDING AND CURRENT ROW)")
        parts += [
            f"count(*) OVER {w} AS transaction_count_{suffix}",
            f"sum(amount) OVER {w} AS total_amount_{suffix}",
            f"avg(amount) OVER {w} AS avg_amount_{suffix}",
            f"stddev_samp(amount) OVER {w} AS std_amount_{suffix}",
            f"count(DISTINCT merchant_id) OVER {w} AS unique_merchants_{suffix}",
        ]
    return f"SELECT transaction_id, {', '.join(parts)} FROM {source}"


VELOCITY_SPEC = "transaction_id " + " ".join(
    f"transaction_count_{s} total_amount_{s}:2 avg_amount_{s}:8 std_amount_{s}:3 unique_merchants_{s}"
    for s in seq.SPANS
)


@query("velocity", VELOCITY_SPEC, velocity_sql())
def _(spark, folder):
    return seq.velocity(fraud_transactions(spark, folder), seq.SPANS)


# Every fifth amount is missing, the others have four places.
SPARSE_SQL = f"""(SELECT * REPLACE (CASE WHEN transaction_id % 5 <> 0
    THEN CAST(floor(amount * 100) + transaction_id % 97 AS DOUBLE) / 10000 END AS amount) FROM {FRAUD_SQL})"""


@query("velocity_sparse", VELOCITY_SPEC.replace(":2", ":4"), velocity_sql(SPARSE_SQL))
def _(spark, folder):
    rows = fraud_transactions(spark, folder)
    fine = (F.floor(F.col("amount") * 100) + F.col("transaction_id") % 97).cast("double") / 10000
    sparse = rows.withColumn("amount", F.when(F.col("transaction_id") % 5 != 0, fine))
    return seq.velocity(sparse, seq.SPANS)


@query("zscore",
       "transaction_id amount_zscore:5 amount_zscore_or_zero:5 amount_zscore_relative:2",
       f"""SELECT transaction_id, (amount - m) / greatest(s, 1) AS amount_zscore,
               CASE WHEN s > 0 THEN (amount - m) / s ELSE 0 END AS amount_zscore_or_zero,
               round((amount - m) / (m * 0.3), 2) AS amount_zscore_relative
           FROM (SELECT *, avg(amount) OVER (PARTITION BY user_id) AS m,
                        stddev_samp(amount) OVER (PARTITION BY user_id) AS s FROM {FRAUD_SQL})""")
def _(spark, folder):
    return seq.amount_zscores(fraud_transactions(spark, folder))


def ticks(spark, folder):
    """Market ticks made of the events: one symbol per event type, whole-number volume."""
    return fraud_transactions(spark, folder).select(
        F.col("transaction_id").alias("tick_id"),
        F.col("merchant_category").alias("symbol"),
        "timestamp",
        F.col("amount").alias("price"),
        F.col("merchant_id").alias("volume"),
    )


TICKS_SQL = f"""(SELECT transaction_id AS tick_id, merchant_category AS symbol, timestamp,
    amount AS price, merchant_id AS volume FROM {FRAUD_SQL})"""


@query("running_high_low", "tick_id symbol high:2 low:2 total_volume:i",
       f"""SELECT tick_id, symbol, max(price) OVER w AS high, min(price) OVER w AS low,
               sum(volume) OVER w AS total_volume FROM {TICKS_SQL}
           WINDOW w AS (PARTITION BY symbol, CAST(timestamp AS DATE) ORDER BY timestamp, tick_id
                        ROWS UNBOUNDED PRECEDING)""")
def _(spark, folder):
    return seq.running_market(ticks(spark, folder))


@query("price_change", "tick_id symbol change:2 change_percent:4",
       f"""SELECT tick_id, symbol, round(price - p, 2) AS change,
               round((price - p) * 100 / nullif(p, 0), 4) AS change_percent
           FROM (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY timestamp, tick_id) AS p
                 FROM {TICKS_SQL})""")
def _(spark, folder):
    return seq.price_changes(ticks(spark, folder))


@query("latest_per_user", "user_id transaction_id timestamp:t amount:2",
       f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
               ORDER BY timestamp DESC, transaction_id DESC) AS rn FROM {FRAUD_SQL}) WHERE rn = 1""")
def _(spark, folder):
    return seq.newest_per_key(
        fraud_transactions(spark, folder), ["user_id"], ["timestamp", "transaction_id"]
    )


@query("recent_per_user", "user_id transaction_id",
       f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
               ORDER BY timestamp DESC, transaction_id DESC) AS rn FROM {FRAUD_SQL}) WHERE rn <= 60""")
def _(spark, folder):
    return seq.newest(
        fraud_transactions(spark, folder), ["user_id"], ["timestamp", "transaction_id"], 60
    )


SESSION_SQL = f"""SELECT user_id, 'session' AS metric_type, count(*) AS event_count,
        min(ts) AS window_start, max(ts) AS window_end
    FROM (SELECT *, sum(CASE WHEN p IS NULL OR epoch_us(ts) - epoch_us(p) > 3600000000
                        THEN 1 ELSE 0 END)
                 OVER (PARTITION BY user_id ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS s
          FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, id) AS p FROM {EVENTS_SQL}))
    GROUP BY user_id, s"""


@query("sessions_gap", "user_id metric_type event_count window_start:t window_end:t", SESSION_SQL)
def _(spark, folder):
    return seq.gap_sessions(raw_events(spark, folder), 3600)


NTH_SQL = f"""SELECT user_id, 'user_event_count' AS metric_type, event_count, ts AS window_start
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, id) AS event_count
          FROM {EVENTS_SQL}) WHERE event_count % 10 = 0"""


@query("every_nth_event", "user_id metric_type event_count window_start:t", NTH_SQL)
def _(spark, folder):
    return seq.every_nth(raw_events(spark, folder), 10)


PATTERN_SQL = f"""SELECT user_id, 'rapid_fire_pattern' AS metric_type, 2 AS event_count,
        ts AS window_start, nxt AS window_end,
        (epoch_us(nxt) - epoch_us(ts)) / 1000.0 AS avg_processing_time
    FROM (SELECT *, min(CASE WHEN value = 'purchase' THEN ts END) OVER (
              PARTITION BY user_id ORDER BY ts, id
              ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM {EVENTS_SQL})
    WHERE value = 'click' AND epoch_us(nxt) - epoch_us(ts) < 43200000000"""


@query("rapid_fire", "user_id metric_type event_count:i window_start:t window_end:t avg_processing_time:3",
       PATTERN_SQL)
def _(spark, folder):
    return seq.followed_by(
        raw_events(spark, folder),
        F.col("value") == "click",
        F.col("value") == "purchase",
        12 * 3600,
    )


@query("amount_then_category", "user_id window_start:t window_end:t",
       f"""SELECT user_id, timestamp AS window_start, nxt AS window_end
           FROM (SELECT *, min(CASE WHEN merchant_category = 'purchase' THEN timestamp END) OVER (
                     {ORDERED} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
                 FROM {FRAUD_SQL})
           WHERE amount > 100 AND epoch_us(nxt) - epoch_us(timestamp) < 86400000000""")
def _(spark, folder):
    return seq.followed_by(
        fraud_transactions(spark, folder),
        F.col("amount") > 100,
        F.col("merchant_category") == "purchase",
        86400,
        time="timestamp",
        tie="transaction_id",
    )


@query("sustained_alert", "user_id started_at:t last_seen_at:t samples",
       f"""SELECT user_id, min(timestamp) AS started_at, max(timestamp) AS last_seen_at, count(*) AS samples
           FROM (SELECT *, count(CASE WHEN amount > 20 THEN NULL ELSE 1 END) OVER (
                     {ORDERED} ROWS UNBOUNDED PRECEDING) AS breaks FROM {FRAUD_SQL})
           WHERE amount > 20 GROUP BY user_id, breaks
           HAVING epoch_us(max(timestamp)) - epoch_us(min(timestamp)) >= 86400000000""")
def _(spark, folder):
    return seq.held_for(
        fraud_transactions(spark, folder),
        F.col("amount") > 20,
        86400,
        ["user_id"],
        time="timestamp",
        tie="transaction_id",
    )


def feature_view(spark, folder):
    """Daily user features stamped at the end of their day."""
    return (
        fraud_transactions(spark, folder)
        .groupBy("user_id", F.to_date("timestamp").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            F.max("amount").alias("max_transaction_amount"),
        )
        .select(
            "user_id",
            F.date_add("day", 1).cast("timestamp").alias("event_timestamp"),
            "transaction_count",
            "max_transaction_amount",
        )
    )


VIEW_SQL = f"""(SELECT user_id, CAST(CAST(timestamp AS DATE) + 1 AS TIMESTAMP) AS event_timestamp,
    count(*) AS transaction_count, max(amount) AS max_transaction_amount
    FROM {FRAUD_SQL} GROUP BY 1, 2)"""


@query("asof_features", "transaction_id user_id transaction_count max_transaction_amount:2",
       f"""SELECT e.transaction_id, e.user_id,
               CASE WHEN f.event_timestamp > e.timestamp - INTERVAL 1 DAY
                    THEN f.transaction_count END AS transaction_count,
               CASE WHEN f.event_timestamp > e.timestamp - INTERVAL 1 DAY
                    THEN f.max_transaction_amount END AS max_transaction_amount
           FROM {FRAUD_SQL} e ASOF LEFT JOIN {VIEW_SQL} f
             ON e.user_id = f.user_id AND f.event_timestamp <= e.timestamp""")
def _(spark, folder):
    entities = fraud_transactions(spark, folder).select(
        "transaction_id", "user_id", F.col("timestamp").alias("event_timestamp")
    )
    return asof.as_of_join(
        entities,
        feature_view(spark, folder),
        "user_id",
        ["transaction_count", "max_transaction_amount"],
        "1 DAY",
        id_column="transaction_id",
    )


@query("online_lookup", "c_custkey transaction_count max_transaction_amount:2",
       f"""SELECT c_custkey, f.transaction_count, f.max_transaction_amount
           FROM customer LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY user_id
               ORDER BY event_timestamp DESC) AS rn FROM {VIEW_SQL}) f
             ON c_custkey = f.user_id AND f.rn = 1""")
def _(spark, folder):
    entities = spark.read.parquet(f"{folder}/customer.parquet").select(
        F.col("c_custkey").alias("user_id")
    )
    out = asof.online_lookup(entities, feature_view(spark, folder), "user_id")
    return out.withColumnRenamed("user_id", "c_custkey")


@query("materialized_view", "user_id event_timestamp:t transaction_count",
       f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
               ORDER BY event_timestamp DESC) AS rn FROM {VIEW_SQL}
               WHERE event_timestamp BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20')
           WHERE rn = 1""")
def _(spark, folder):
    return asof.materialize_latest(
        feature_view(spark, folder), "user_id", "2024-01-05", "2024-01-20"
    )
