"""Queries of the quality checks, profiles and operational metrics."""

from pyspark.sql import functions as F

from tidemark.functions import protect
from tidemark.model import fraud_transactions, latest, raw_events, table
from tidemark.operators import monitoring as mon
from tidemark.operators import quality as q
from tidemark.queries.registry import CANARY, FRAUD_SQL, query

AS_OF = "(SELECT max(ts) FROM events)"
CHECKS_SPEC = "check_name column_name observed:6 low:6 high:6 success"


def checked(name, column, observed, low, high):
    column = "NULL" if column is None else f"'{column}'"
    return (
        f"SELECT '{name}' AS check_name, {column} AS column_name, CAST({observed} AS DOUBLE) AS observed, "
        f"{low}::DOUBLE AS low, {high}::DOUBLE AS high, ({observed}) BETWEEN {low} AND {high} AS success "
        f"FROM {FRAUD_SQL}"
    )


@query("quality_suite", CHECKS_SPEC, " UNION ALL ".join([
    checked("row_count_between", None, "count(*)", 10000, 10000000),
    "SELECT 'columns_are', NULL, 0, 1, 1, false",
    "SELECT 'column_exists', 'amount', 1, 1, 1, true",
    checked("unique", "transaction_id", "count(*) - count(DISTINCT transaction_id)", 0, 0),
    checked("unique", "user_id", "count(*) - count(DISTINCT user_id)", 0, 0),
    checked("not_null", "user_id", "count(*) - count(user_id)", 0, 0),
    checked("values_between", "amount", "avg(CAST(amount BETWEEN 0.01 AND 150 AS INT))", 0.99, 1),
    checked("values_match", "transaction_id",
            "avg(CAST(regexp_full_match(CAST(transaction_id AS VARCHAR), '[0-9]{3}') AS INT))", 1, 1),
    checked("values_in", "merchant_category",
            "avg(CAST(merchant_category IN ('error', 'click', 'view') AS INT))", 0.5, 1),
    checked("mean_between", "amount", "avg(amount)", 50, 500),
    checked("stdev_between", "amount", "stddev_samp(amount)", 10, 1000),
    checked("mean_between", "is_fraud", "avg(CAST(is_fraud AS INT))", 0.001, 0.05),
    checked("length_at_most", "merchant_category", "max(length(merchant_category))", 0, 50),
]))
def _(spark, folder):
    rows = fraud_transactions(spark, folder)
    return q.run_suite(
        rows,
        [
            q.row_count_between(10_000, 10_000_000),
            q.columns_are(rows, ["transaction_id", "timestamp", "currency"]),
            q.column_exists(rows, "amount"),
            q.unique("transaction_id"),
            q.unique("user_id"),
            q.not_null("user_id"),
            q.values_between("amount", 0.01, 150, mostly=0.99),
            q.values_match("transaction_id", r"^\d{3}$"),
            q.values_in("merchant_category", ["error", "click", "view"], mostly=0.5),
            q.mean_between("amount", 50, 500),
            q.stdev_between("amount", 10, 1000),
            q.mean_between("is_fraud", 0.001, 0.05),
            q.length_at_most("merchant_category", 50),
        ],
    )


PROFILED = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax")
UNMEASURED = ("l_returnflag", "l_linestatus", "l_shipdate")


def profile_sql():
    parts = [
        "SELECT 'rows' AS metric, NULL AS column_name, CAST(count(*) AS DOUBLE) AS value FROM lineitem",
        "SELECT 'duplicates', NULL, sum(n - 1) FROM (SELECT *, count(*) AS n FROM lineitem GROUP BY ALL)",
    ]
    for c in (*PROFILED, *UNMEASURED):
        parts.append(f"SELECT 'nulls', '{c}', count(*) - count({c}) FROM lineitem")
    for c in PROFILED:
        for metric, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
            parts.append(f"SELECT '{metric}', '{c}', {f}({c}) FROM lineitem")
        parts.append(f"""SELECT 'outliers', '{c}', count(*) FROM lineitem
            WHERE {c} > (SELECT quantile_cont({c}, 0.99) FROM lineitem)""")
    return " UNION ALL ".join(parts)


@query("data_profile", "metric column_name value:5", profile_sql())
def _(spark, folder):
    return q.profile(table(spark, folder, "lineitem"))


COARSE_SQL = f"""(SELECT date_trunc('hour', timestamp) AS timestamp, floor(amount / 10) AS amount,
    CASE WHEN merchant_id >= 30 THEN merchant_id END AS merchant_id FROM {FRAUD_SQL})"""


@query("quality_metrics",
       "total_rows duplicate_rate:6 null_rate:6 outliers min_time:t max_time:t passed",
       f"""SELECT count(*) AS total_rows,
               (SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM {COARSE_SQL} GROUP BY timestamp, amount, merchant_id))
                   / count(*) AS duplicate_rate,
               (count(*) - count(merchant_id)) / (count(*) * 3) AS null_rate,
               count(*) FILTER (WHERE amount > (SELECT quantile_cont(amount, 0.99) FROM {COARSE_SQL})) AS outliers,
               min(timestamp) AS min_time, max(timestamp) AS max_time, false AS passed
           FROM {COARSE_SQL}""")
def _(spark, folder):
    coarse = fraud_transactions(spark, folder).select(
        F.date_trunc("HOUR", "timestamp").alias("timestamp"),
        F.floor(F.col("amount") / 10).cast("double").alias("amount"),
        F.when(F.col("merchant_id") >= 30, F.col("merchant_id")).alias("merchant_id"),
    )
    return q.quality_metrics(coarse)


@query("low_volume_days", "day:d rows_of_day",
       f"""WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS rows_of_day FROM events
               WHERE ts >= {AS_OF} - INTERVAL 30 DAYS GROUP BY 1)
           SELECT * FROM d WHERE rows_of_day < (SELECT avg(rows_of_day) FROM d) * 0.98""")
def _(spark, folder):
    events = raw_events(spark, folder)
    return q.low_volume_days(events, "ts", latest(events, "ts"), ratio=0.98)


@query("freshness", "newest:t complete_user_id:6 complete_merchant_id:6 age_seconds:3",
       f"""SELECT max(timestamp) AS newest, 1.0 AS complete_user_id,
               avg(CASE WHEN merchant_id >= 25 THEN 1 ELSE 0 END) AS complete_merchant_id,
               (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(timestamp))) / 1000000.0 AS age_seconds
           FROM {FRAUD_SQL}""")
def _(spark, folder):
    rows = fraud_transactions(spark, folder).withColumn(
        "merchant_id", F.when(F.col("merchant_id") >= 25, F.col("merchant_id"))
    )
    as_of = F.lit("2024-02-01").cast("timestamp")
    return q.freshness(rows, "timestamp", ["user_id", "merchant_id"], as_of)


def halves(spark, folder):
    rows = fraud_transactions(spark, folder)
    middle = F.lit("2024-01-16").cast("timestamp")
    return rows.where(F.col("timestamp") < middle), rows.where(F.col("timestamp") >= middle)


KS_SQL = " UNION ALL ".join(
           f"""SELECT '{c}' AS feature, max(abs(r / nr - c / nc)) AS ks_statistic, any_value(nr) AS n_reference,
                   any_value(nc) AS n_current
               FROM (SELECT v, sum(sum(ref)) OVER (ORDER BY v) AS r, sum(sum(1 - ref)) OVER (ORDER BY v) AS c,
                         sum(sum(ref)) OVER () AS nr, sum(sum(1 - ref)) OVER () AS nc
                     FROM (SELECT {c} AS v, CASE WHEN timestamp < TIMESTAMP '2024-01-16' THEN 1 ELSE 0 END AS ref
                           FROM {FRAUD_SQL}) GROUP BY v)"""
           for c in ("amount", "merchant_id"))


@query("ks_drift", "feature ks_statistic:8 n_reference:i n_current:i", KS_SQL)
def _(spark, folder):
    return q.ks_drift(*halves(spark, folder), ["amount", "merchant_id"])


# The alternating series of the asymptotic distribution; with enough terms it also holds
# for small arguments.
@query("ks_drift_p_value", "feature p_value:6 drift_detected",
       f"""SELECT feature, p AS p_value, p < 0.05 AS drift_detected FROM (
               SELECT feature, list_sum(list_transform(range(1, 2001), lambda k:
                   CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END * exp(-2.0 * k * k * x * x))) AS p
               FROM (SELECT feature, ks_statistic * sqrt(CAST(n_reference AS DOUBLE) * n_current
                   / (n_reference + n_current)) AS x FROM ({KS_SQL})))""")
def _(spark, folder):
    return q.ks_drift(*halves(spark, folder), ["amount", "merchant_id"])


@query("cleaned_records", "o_orderkey o_custkey:i o_orderpriority amount:4",
       """WITH r AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_totalprice END AS amount,
              CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS o_orderpriority,
              CASE WHEN o_custkey % 2 = 0 THEN o_custkey END AS o_custkey FROM orders)
          SELECT o_orderkey, o_custkey, coalesce(o_orderpriority, (SELECT o_orderpriority FROM r
                  WHERE o_orderpriority IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS o_orderpriority,
              coalesce(amount, (SELECT avg(amount) FROM r)) AS amount FROM r""")
def _(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "2-HIGH", F.col("o_totalprice")).alias("amount"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("o_orderpriority"),
        F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey").cast("string"))
        .otherwise("unknown")
        .alias("o_custkey"),
    )
    return q.fill_and_cast(
        rows.union(rows),
        "o_orderkey",
        {"amount": "mean", "o_orderpriority": "mode"},
        {"o_custkey": "bigint"},
    )


CONFUSION = """count(*) FILTER (WHERE a AND p) AS true_positives, count(*) FILTER (WHERE NOT a AND p) AS false_positives,
    count(*) FILTER (WHERE a AND NOT p) AS false_negatives, count(*) FILTER (WHERE NOT a AND NOT p) AS true_negatives"""
RATES = """true_positives / nullif(true_positives + false_negatives, 0) AS detection_rate,
    false_positives / nullif(false_positives + true_negatives, 0) AS false_positive_rate,
    true_positives / nullif(true_positives + false_positives, 0) AS precision,
    (true_positives + true_negatives) / nullif(true_positives + true_negatives + false_positives + false_negatives, 0) AS accuracy,
    2 * true_positives / nullif(2 * true_positives + false_positives + false_negatives, 0) AS f1"""
RATE_SPEC = (
    "true_positives false_positives false_negatives true_negatives detection_rate:6 "
    "false_positive_rate:6 precision:6 accuracy:6 f1:6"
)


@query("confusion_metrics", RATE_SPEC,
       f"""SELECT *, {RATES} FROM (SELECT {CONFUSION}
           FROM (SELECT quality = 1 AS a, toxic = 1 AS p FROM labels))""")
def _(spark, folder):
    return mon.confusion(table(spark, folder, "labels"), "quality", "toxic")


def decided(spark, folder):
    return fraud_transactions(spark, folder).withColumns(
        {"actual": F.col("is_fraud"), "predicted": F.col("amount") > 40}
    )


@query("prevented_fraud", "merchant_id prevented_amount:2 " + RATE_SPEC,
       f"""SELECT *, {RATES} FROM (SELECT merchant_id, {CONFUSION},
               sum(CASE WHEN a AND p THEN amount END) AS prevented_amount
           FROM (SELECT *, is_fraud AS a, amount > 40 AS p FROM {FRAUD_SQL}) GROUP BY 1)""")
def _(spark, folder):
    return mon.confusion(decided(spark, folder), amount="amount", keys=["merchant_id"])


@query("variant_metrics", "variant " + RATE_SPEC,
       f"""SELECT *, {RATES} FROM (SELECT variant, {CONFUSION} FROM (SELECT is_fraud AS a, amount > 40 AS p,
               CASE WHEN {CANARY} THEN 'canary' ELSE 'primary' END AS variant FROM {FRAUD_SQL}) GROUP BY 1)""")
def _(spark, folder):
    scored = decided(spark, folder).withColumn("variant", protect.variant("transaction_id", 0.1))
    return mon.confusion(scored, keys=["variant"])


@query("retrain_decision", RATE_SPEC + " retrain",
       f"""SELECT *, {RATES}, true_positives / (true_positives + false_negatives) < 0.9 AS retrain
           FROM (SELECT {CONFUSION} FROM (SELECT is_fraud AS a, amount > 40 AS p FROM {FRAUD_SQL}
               WHERE timestamp >= {AS_OF} - INTERVAL 7 DAYS))""")
def _(spark, folder):
    scored = decided(spark, folder)
    return mon.retrain_decision(
        scored, latest(scored, "timestamp"), {"detection_rate": 0.9}, "timestamp"
    )


@query("metric_drift", "metric current:6 baseline:6 drift:6 degradation:6 drifted degraded",
       f"""SELECT metric, c AS current, b AS baseline, abs(c - b) / b AS drift, (b - c) / b AS degradation,
               abs(c - b) / b > lim AS drifted, (b - c) / b > lim AS degraded
           FROM (SELECT merchant_category AS metric,
                     avg(CASE WHEN timestamp >= TIMESTAMP '2024-01-16' THEN amount END) AS c,
                     avg(CASE WHEN timestamp < TIMESTAMP '2024-01-16' THEN amount END) AS b,
                     CASE WHEN merchant_category = 'error' THEN 0.001 ELSE 0.02 END AS lim
                 FROM {FRAUD_SQL} GROUP BY 1)""")
def _(spark, folder):
    before, after = (
        part.groupBy(F.col("merchant_category").alias("metric")).agg(F.avg("amount").alias("value"))
        for part in halves(spark, folder)
    )
    return mon.compare_metrics(after, before, 0.02, {"error": 0.001})


@query("response_times", "operation samples avg:8 max:2 p50:4 p95:4 p99:4",
       f"""SELECT operation, count(*) AS samples, avg(duration) AS avg, max(duration) AS max,
               quantile_cont(duration, 0.5) AS p50, quantile_cont(duration, 0.95) AS p95,
               quantile_cont(duration, 0.99) AS p99
           FROM (SELECT merchant_category AS operation, amount AS duration, row_number() OVER (
                     PARTITION BY merchant_category ORDER BY timestamp DESC, transaction_id DESC) AS rn
                 FROM {FRAUD_SQL}) WHERE rn <= 1000 GROUP BY 1""")
def _(spark, folder):
    calls = fraud_transactions(spark, folder).select(
        F.col("merchant_category").alias("operation"),
        F.col("amount").alias("duration"),
        F.col("timestamp").alias("ts"),
        F.col("transaction_id").alias("id"),
    )
    return mon.response_times(calls)


BOUNDS = [5.0, 10.0, 25.0, 50.0, 100.0, 250.0]
HISTOGRAM_SQL = "(" + " UNION ALL ".join(
    f"SELECT merchant_category, {b} AS le, count(*) FILTER (WHERE amount <= {b}) AS bucket_count "
    f"FROM {FRAUD_SQL} GROUP BY 1" for b in BOUNDS
) + f" UNION ALL SELECT merchant_category, 1e9, count(*) FROM {FRAUD_SQL} GROUP BY 1)"


def histogram(spark, folder):
    return mon.latency_histogram(
        fraud_transactions(spark, folder), "amount", BOUNDS, ["merchant_category"]
    )


@query("latency_histogram", "merchant_category le:1 bucket_count", f"SELECT * FROM {HISTOGRAM_SQL}")
def _(spark, folder):
    return histogram(spark, folder).withColumn("le", F.least("le", F.lit(1e9)))


@query("histogram_quantile", "merchant_category quantile:6",
       f"""SELECT merchant_category, min(low + (le - low) * (0.95 * n - lown) / (bucket_count - lown)) AS quantile
           FROM (SELECT *, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(bucket_count) OVER w, 0) AS lown,
                     max(bucket_count) OVER (PARTITION BY merchant_category) AS n FROM {HISTOGRAM_SQL}
                 WINDOW w AS (PARTITION BY merchant_category ORDER BY le))
           WHERE bucket_count >= 0.95 * n AND lown < 0.95 * n GROUP BY 1""")
def _(spark, folder):
    return mon.histogram_quantile(histogram(spark, folder), 0.95, ["merchant_category"])


@query("event_rates", "merchant_category window_start:t events rate:6",
       f"""SELECT merchant_category, time_bucket(INTERVAL 5 MINUTES, timestamp) AS window_start,
               count(*) AS events, count(*) / 300.0 AS rate FROM {FRAUD_SQL} GROUP BY 1, 2""")
def _(spark, folder):
    return mon.event_rates(
        fraud_transactions(spark, folder), "timestamp", "5 minutes", 300, ["merchant_category"]
    )


@query("counter_increase", "merchant_category window_start:t increase:2",
       f"""SELECT merchant_category, date_trunc('hour', timestamp) AS window_start, sum(
               CASE WHEN p IS NULL THEN 0 WHEN merchant_id < p THEN merchant_id ELSE merchant_id - p END) AS increase
           FROM (SELECT *, lag(merchant_id) OVER (PARTITION BY merchant_category
                     ORDER BY timestamp, transaction_id) AS p FROM {FRAUD_SQL}) GROUP BY 1, 2""")
def _(spark, folder):
    samples = fraud_transactions(spark, folder).withColumnsRenamed(
        {"timestamp": "ts", "transaction_id": "id"}
    ).withColumn("value", F.col("merchant_id").cast("double"))
    return mon.counter_increase(samples, ["merchant_category"])


@query("rate_limited", "client window_start:t requests",
       """SELECT event_type AS client, date_trunc('minute', ts) AS window_start, count(*) AS requests
          FROM events GROUP BY 1, 2 HAVING count(*) > 1""")
def _(spark, folder):
    return mon.over_limit(raw_events(spark, folder).withColumnRenamed("value", "client"), 1)


def alerts(spark, folder):
    """Alerts made of the events: type as name, user and merchant as cluster and service."""
    return fraud_transactions(spark, folder).select(
        F.col("transaction_id").alias("id"),
        F.col("timestamp").alias("ts"),
        F.concat(F.lit("alert"), F.col("merchant_id") % 10).alias("alertname"),
        F.concat(F.lit("c"), F.col("user_id") % 7).alias("cluster"),
        F.when(F.col("user_id") % 3 == 0, "fraud-detection").otherwise("api").alias("service"),
        F.when(F.col("merchant_id") % 4 == 0, "ml-team").otherwise("core").alias("team"),
        F.when(F.col("amount") > 250, "critical")
        .when(F.col("amount") > 50, "warning")
        .otherwise("info")
        .alias("severity"),
    )


ALERTS_SQL = f"""(SELECT transaction_id AS id, timestamp AS ts, 'alert' || merchant_id % 10 AS alertname,
    'c' || user_id % 7 AS cluster, CASE WHEN user_id % 3 = 0 THEN 'fraud-detection' ELSE 'api' END AS service,
    CASE WHEN merchant_id % 4 = 0 THEN 'ml-team' ELSE 'core' END AS team,
    CASE WHEN amount > 250 THEN 'critical' WHEN amount > 50 THEN 'warning' ELSE 'info' END AS severity
    FROM {FRAUD_SQL})"""


@query("alert_groups", "alertname cluster service window_start:t alerts first_at:t",
       f"""SELECT alertname, cluster, service, time_bucket(INTERVAL 12 HOURS, ts) AS window_start,
               count(*) AS alerts, min(ts) AS first_at FROM {ALERTS_SQL} GROUP BY 1, 2, 3, 4""")
def _(spark, folder):
    return mon.group_alerts(alerts(spark, folder))


@query("alert_inhibition", "id severity",
       f"""SELECT id, severity FROM {ALERTS_SQL} a WHERE severity <> 'warning' OR NOT EXISTS (
               SELECT 1 FROM {ALERTS_SQL} c WHERE c.severity = 'critical' AND c.alertname = a.alertname
               AND c.cluster = a.cluster AND c.service = a.service)""")
def _(spark, folder):
    return mon.inhibit(alerts(spark, folder))


@query("alert_routes", "id receiver",
       f"""SELECT id, 'pagerduty' AS receiver FROM {ALERTS_SQL} WHERE severity = 'critical'
           UNION ALL SELECT id, CASE WHEN team = 'ml-team' THEN 'ml-slack' ELSE 'fraud-team' END FROM {ALERTS_SQL}
               WHERE team = 'ml-team' OR service = 'fraud-detection'
           UNION ALL SELECT id, 'default' FROM {ALERTS_SQL}
               WHERE severity <> 'critical' AND team <> 'ml-team' AND service <> 'fraud-detection'""")
def _(spark, folder):
    return mon.route_alerts(alerts(spark, folder))


@query("consumer_lag", "topic partition lag:i alert",
       """SELECT event_type AS topic, user_id % 4 AS partition, max(event_id) - min(event_id) AS lag,
              max(event_id) - min(event_id) > 9980 AS alert FROM events GROUP BY 1, 2""")
def _(spark, folder):
    offsets = table(spark, folder, "events").groupBy(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).alias("partition")
    ).agg(F.min("event_id").alias("committed"), F.max("event_id").alias("end_offset"))
    return mon.consumer_lag(offsets, 9980)
