"""Queries of text, time, key and device functions and of message handling."""

from pyspark.sql import functions as F


from tidemark.functions import devices, numbers, protect, texts, times
from tidemark.model import fraud_transactions, raw_events, table
from tidemark.operators import aggregates as agg
from tidemark.queries.registry import CANARY, FRAUD_SQL, query
from tidemark.sources import messages

LEVEL_SQL = """CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'WARN' WHEN 'click' THEN 'INFO'
    WHEN 'signup' THEN 'FATAL' ELSE 'DEBUG' END"""


def log_lines(spark, folder):
    """The events rendered as application log lines."""
    level = (
        F.when(F.col("value") == "error", "ERROR")
        .when(F.col("value") == "view", "WARN")
        .when(F.col("value") == "click", "INFO")
        .when(F.col("value") == "signup", "FATAL")
        .otherwise("DEBUG")
    )
    return raw_events(spark, folder).select(
        F.format_string(
            "%s [%s] %s: event %s - RequestID:%d",
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
            level,
            F.concat(F.lit("Component"), F.col("user_id") % 10),
            "value",
            "id",
        ).alias("value")
    )


def log_sql(levels):
    return f"""SELECT strftime(ts, '%Y-%m-%d %H') || ':' || l || ':Component' || user_id % 10 AS key,
        count(*) AS lines FROM (SELECT *, {LEVEL_SQL} AS l FROM events) WHERE l IN {levels} GROUP BY 1"""


@query("log_counts", "key lines", log_sql("('ERROR', 'WARN')"))
def _(spark, folder):
    return agg.log_counts(log_lines(spark, folder))


@query("log_counts_fatal", "key lines", log_sql("('ERROR', 'FATAL')"))
def _(spark, folder):
    return agg.log_counts(
        log_lines(spark, folder), ("ERROR", "FATAL"), (*texts.LOG_LEVELS, "FATAL")
    )


@query("access_log", "ip ts:t method path status:i bytes:i agent duration_ms:i",
       """SELECT '10.0.0.' || user_id % 250 AS ip, date_trunc('second', ts) AS ts,
              CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
              '/api/' || event_type AS path, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
              event_id * 3 AS bytes, 'agent/' || user_id % 5 AS agent, CAST(floor(value) AS BIGINT) AS duration_ms
          FROM events""")
def _(spark, folder):
    event = table(spark, folder, "events")
    zone = F.when(F.col("event_id") % 2 == 0, "+0000").otherwise("")
    lines = event.select(
        F.format_string(
            '10.0.0.%d - - [%s %s] "%s /api/%s HTTP/1.1" %d %d "-" "agent/%d" %dms',
            F.col("user_id") % 250,
            F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"),
            zone,
            F.when(F.col("event_type") == "purchase", "POST").otherwise("GET"),
            "event_type",
            F.when(F.col("event_type") == "error", 500).otherwise(200),
            F.col("event_id") * 3,
            F.col("user_id") % 5,
            F.floor("value"),
        ).alias("value")
    )
    return texts.parse_access_lines(lines)


@query("error_blocks", "component error_type depth top_frame blocks",
       """SELECT 'Component' || user_id % 10 AS component, 'SQLException' AS error_type,
              1 + event_id % 5 AS depth, 'com.company.a.A' || event_id % 5 || '.run' AS top_frame, count(*) AS blocks
          FROM events WHERE event_type = 'error' GROUP BY ALL""")
def _(spark, folder):
    last = F.col("id") % 5
    frame = F.format_string(
        "\tat com.company.a.A%d.run(A.java:%d)", last, F.col("user_id")
    )
    other = F.lit("\n\tat com.company.b.B.call(B.java:7)")
    blocks = raw_events(spark, folder).where("value = 'error'").select(
        F.concat(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
            F.lit(" [ERROR] Component"),
            F.col("user_id") % 10,
            F.lit(": SQLException: it broke\n"),
            frame,
            F.repeat(other, last.cast("int")),
        ).alias("value")
    )
    return (
        texts.parse_error_blocks(blocks)
        .groupBy("component", "error_type", "depth", "top_frame")
        .agg(agg.count_rows().alias("blocks"))
        .withColumn("depth", F.col("depth").cast("long"))
    )


@query("log_scan", "word documents",
       """SELECT 'with_digit' AS word, count(*) AS documents FROM documents WHERE regexp_matches(text, '[0-9]')
          UNION ALL SELECT 'with_license', count(*) FROM documents WHERE contains(lower(text), 'license')
          UNION ALL SELECT 'all', count(*) FROM documents""")
def _(spark, folder):
    documents = table(spark, folder, "documents")
    found = documents.agg(
        agg.count_when(texts.matches("text", "[0-9]")).alias("with_digit"),
        agg.count_when(texts.contains(F.lower("text"), "license")).alias("with_license"),
        agg.count_rows().alias("all"),
    )
    return found.unpivot([], ["with_digit", "with_license", "all"], "word", "documents")


@query("decoded_events", "id ts:t value user_id",
       """SELECT event_id AS id, date_trunc('milliseconds', ts) AS ts, event_type AS value, user_id FROM events
          WHERE event_id % 4 < 3""")
def _(spark, folder):
    kind = F.col("id") % 4
    time = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'+00:00'"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
        .when(kind == 2, F.unix_millis("ts").cast("string"))
        .otherwise("not a time")
    )
    sent = raw_events(spark, folder).select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(F.struct("id", time.alias("ts"), "value", "user_id"))
        .cast("binary")
        .alias("value"),
    )
    return messages.decode_events(sent)


@query("decoded_transactions", "transaction_id timestamp:t amount:2 country kafka_key",
       f"""SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, date_trunc('second', timestamp) AS timestamp,
               amount, 'C' || merchant_id AS country, CAST(user_id AS VARCHAR) AS kafka_key FROM {FRAUD_SQL}""")
def _(spark, folder):
    body = F.struct(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        "amount",
        F.struct(F.concat(F.lit("C"), "merchant_id").alias("country")).alias("location"),
    )
    sent = fraud_transactions(spark, folder).select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.to_json(body).cast("binary").alias("value"),
        "timestamp",
    )
    return messages.decode_transactions(sent).withColumn("country", F.col("location.country"))


@query("routed_topics", "topic messages",
       """SELECT CASE WHEN event_type = 'purchase' THEN 'user_activity' ELSE 'events' END AS topic,
              count(*) AS messages FROM events GROUP BY 1""")
def _(spark, folder):
    rows = raw_events(spark, folder)
    sent = messages.as_messages(rows, "user_id", messages.topic_for("value"))
    return sent.groupBy("topic").agg(agg.count_rows().alias("messages"))


@query("alert_messages", "key transaction_id merchant_id:i",
       f"""SELECT CAST(user_id AS VARCHAR) AS key, CAST(transaction_id AS VARCHAR) AS transaction_id, merchant_id
           FROM {FRAUD_SQL} WHERE amount > 50""")
def _(spark, folder):
    risky = fraud_transactions(spark, folder).where("amount > 50")
    sent = messages.as_messages(risky, "user_id")
    return sent.select(
        "key",
        texts.json_text("value", "$.transaction_id").alias("transaction_id"),
        texts.json_number("value", "$.merchant_id").alias("merchant_id"),
    )


@query("topic_volume", "topic partitions messages:i size_mb:6",
       """SELECT topic, count(*) AS partitions, sum(n) AS messages, sum(n) * 500 / 1048576.0 AS size_mb
          FROM (SELECT event_type AS topic, user_id % 4 AS p, max(event_id) - min(event_id) + 1 AS n
                FROM events GROUP BY 1, 2) GROUP BY 1""")
def _(spark, folder):
    return messages.topic_volume(
        table(spark, folder, "events").select(
            F.col("event_type").alias("topic"),
            (F.col("user_id") % 4).alias("partition"),
            F.col("event_id").alias("offset"),
        )
    )


@query("temporal_flags",
       "id event_date:d hour:i spark_dow:i monday_dow:i day_of_month:i is_weekend is_night is_unusual "
       "is_business season band month_label week_start:d millis iso",
       """SELECT event_id AS id, CAST(ts AS DATE) AS event_date, hour(ts) AS hour, dayofweek(ts) + 1 AS spark_dow,
              isodow(ts) - 1 AS monday_dow, day(ts) AS day_of_month, isodow(ts) >= 6 AS is_weekend,
              hour(ts) <= 6 AS is_night, hour(ts) < 6 AS is_unusual,
              hour(ts) BETWEEN 9 AND 17 AND isodow(ts) < 6 AS is_business,
              CASE WHEN month(ts) IN (12, 1, 2) THEN 'winter' ELSE 'other' END AS season,
              CASE WHEN hour(ts) BETWEEN 6 AND 18 THEN 'high' ELSE 'low' END AS band,
              strftime(ts, '%Y-%m') AS month_label, date_trunc('week', ts) AS week_start,
              epoch_us(ts) // 1000 AS millis, strftime(ts, '%Y-%m-%d %H:%M:%S') AS iso FROM events""")
def _(spark, folder):
    return raw_events(spark, folder).select(
        "id",
        F.to_date("ts").alias("event_date"),
        F.hour("ts").alias("hour"),
        times.spark_day_of_week("ts").alias("spark_dow"),
        times.monday_day_of_week("ts").alias("monday_dow"),
        F.dayofmonth("ts").alias("day_of_month"),
        times.is_weekend("ts").alias("is_weekend"),
        times.is_night("ts").alias("is_night"),
        times.is_unusual_hour("ts").alias("is_unusual"),
        times.is_business_hours("ts").alias("is_business"),
        times.season("ts").alias("season"),
        times.activity_band("ts").alias("band"),
        times.month_label("ts").alias("month_label"),
        times.period_start("WEEK", "ts").alias("week_start"),
        times.epoch_millis("ts").alias("millis"),
        texts.iso_to_plain(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("iso"),
    )


@query("lookback_filters", "id",
       """SELECT event_id AS id FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 24 HOURS
          AND ts >= TIMESTAMP '2024-01-19' AND ts < TIMESTAMP '2024-01-20'""")
def _(spark, folder):
    as_of = F.lit("2024-01-20 12:00:00").cast("timestamp")
    return raw_events(spark, folder).where(
        times.since("ts", as_of, "24 HOURS") & times.on_previous_day("ts", as_of)
    )


@query("amount_bins", "transaction_id amount_log:6 amount_category is_round_amount:i clipped:2 ratio:6",
       f"""SELECT transaction_id, ln(1 + amount) AS amount_log,
               CASE WHEN amount <= 50 THEN 'very_low' WHEN amount <= 200 THEN 'low' ELSE 'medium' END AS amount_category,
               CASE WHEN CAST(round(amount * 100) AS BIGINT) % 1000 = 0 THEN 1 ELSE 0 END AS is_round_amount,
               least(greatest(amount, 10), 100) AS clipped, amount / nullif(merchant_id, 0) AS ratio
           FROM {FRAUD_SQL}""")
def _(spark, folder):
    return fraud_transactions(spark, folder).select(
        "transaction_id",
        F.log1p("amount").alias("amount_log"),
        numbers.amount_category("amount").alias("amount_category"),
        numbers.is_round_amount("amount").alias("is_round_amount"),
        numbers.clip("amount", 10.0, 100.0).alias("clipped"),
        numbers.safe_ratio("amount", "merchant_id").alias("ratio"),
    )


@query("surrogate_keys", "event_id key composite first_part amount_text",
       """SELECT event_id, md5(coalesce(CAST(event_id AS VARCHAR), '_null_') || '-' || event_type || '-_null_') AS key,
              event_type || ':' || user_id AS composite, strftime(ts, '%Y-%m-%d') AS first_part,
              printf('%.2f', value) AS amount_text FROM events""")
def _(spark, folder):
    rows = table(spark, folder, "events")
    missing = F.lit(None).cast("string")
    return rows.select(
        "event_id",
        protect.surrogate_key("event_id", "event_type", missing).alias("key"),
        texts.composite_key("event_type", "user_id").alias("composite"),
        texts.part_of(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), " ", 1).alias("first_part"),
        texts.two_places("value").alias("amount_text"),
    )


CARD_SQL = "lpad(CAST(4000000000000000 + c_custkey * 7919 AS VARCHAR), 16, '0')"


def cards(spark, folder):
    number = F.lit(4_000_000_000_000_000) + F.col("c_custkey") * 7919
    return table(spark, folder, "customer").select("c_custkey", number.cast("string").alias("card"))


@query("masked_cards", "c_custkey masked",
       f"SELECT c_custkey, left({CARD_SQL}, 4) || '********' || right({CARD_SQL}, 4) AS masked FROM customer")
def _(spark, folder):
    return cards(spark, folder).select("c_custkey", protect.mask_card("card").alias("masked"))


DIGIT = "CAST(substr({n}, {i}, 1) AS INT)"


def luhn_sql():
    terms = []
    for i in range(1, 17):
        d = DIGIT.format(n="card", i=i)
        terms.append(f"(({d} * 2) // 10 + ({d} * 2) % 10)" if i % 2 == 1 else d)
    check = []
    for i in range(1, 17):
        d = DIGIT.format(n="card", i=i)
        check.append(f"(({d} * 2) // 10 + ({d} * 2) % 10)" if i % 2 == 0 else d)
    return (f"SELECT c_custkey, ({' + '.join(terms)}) % 10 = 0 AS valid, "
            f"(10 - ({' + '.join(check)}) % 10) % 10 AS digit "
            f"FROM (SELECT c_custkey, {CARD_SQL} AS card FROM customer)")


@query("luhn_checks", "c_custkey valid digit:i", luhn_sql())
def _(spark, folder):
    return cards(spark, folder).select(
        "c_custkey",
        protect.luhn_valid("card").alias("valid"),
        protect.luhn_digit("card").alias("digit"),
    )


@query("encrypted_round_trip", "c_custkey c_name hidden",
       "SELECT c_custkey, c_name, true AS hidden FROM customer")
def _(spark, folder):
    key = "0123456789abcdef"
    people = table(spark, folder, "customer").select("c_custkey", "c_name")
    sealed = protect.encrypt_columns(people.withColumn("plain", F.col("c_name")), ["c_name"], key)
    hidden = sealed.withColumn("hidden", F.col("c_name") != F.col("plain"))
    return protect.decrypt_columns(hidden, ["c_name"], key)


@query("variant_split", "variant transactions",
       f"""SELECT CASE WHEN {CANARY} THEN 'canary' ELSE 'primary' END AS variant, count(*) AS transactions
           FROM {FRAUD_SQL} GROUP BY 1""")
def _(spark, folder):
    rows = fraud_transactions(spark, folder)
    return rows.groupBy(protect.variant("transaction_id", 0.1).alias("variant")).agg(
        agg.count_rows().alias("transactions")
    )


@query("device_health", "s_suppkey health_score:1 status",
       """SELECT s_suppkey, round(h, 1) AS health_score, CASE WHEN s_nationkey <> 3 AND round(h, 1) > 20
              THEN 'active' ELSE 'inactive' END AS status
          FROM (SELECT *, (abs(s_acctbal) / 100 / 100.0 * 0.4 + (s_nationkey * 2 - 90 + 100) / 70.0 * 0.3
              + (1 - least(s_suppkey / 180.0, 1.0)) * 0.3) * 100 AS h FROM supplier)""")
def _(spark, folder):
    known = table(spark, folder, "supplier").select(
        "s_suppkey",
        (F.abs("s_acctbal") / 100).alias("battery_level"),
        (F.col("s_nationkey") * 2 - 90).alias("signal_strength"),
        F.col("s_suppkey").alias("days_since_maintenance"),
        (F.col("s_nationkey") != 3).alias("is_active"),
    )
    return devices.device_health(known)


@query("sensor_range", "transaction_id is_normal",
       f"""SELECT transaction_id, CASE s WHEN 'temperature' THEN amount BETWEEN 18 AND 25
               WHEN 'humidity' THEN amount BETWEEN 30 AND 70 WHEN 'sound' THEN amount BETWEEN 30 AND 60
               WHEN 'air_quality' THEN amount BETWEEN 0 AND 50 END AS is_normal
           FROM (SELECT *, CASE merchant_category WHEN 'click' THEN 'temperature' WHEN 'view' THEN 'humidity'
               WHEN 'error' THEN 'sound' WHEN 'signup' THEN 'air_quality' ELSE 'unknown' END AS s FROM {FRAUD_SQL})""")
def _(spark, folder):
    from tidemark.model import recode

    kinds = {"click": "temperature", "view": "humidity", "error": "sound", "signup": "air_quality"}
    return fraud_transactions(spark, folder).select(
        "transaction_id",
        devices.in_normal_range(
            recode("merchant_category", kinds, "unknown"), "amount"
        ).alias("is_normal"),
    )


@query("hashtag_counts", "tag mentions",
       """SELECT tag, count(*) AS mentions FROM (SELECT unnest([event_type, 'u' || user_id % 10]) AS tag FROM events)
          GROUP BY 1""")
def _(spark, folder):
    posts = raw_events(spark, folder).select(
        F.array("value", F.concat(F.lit("u"), F.col("user_id") % 10)).alias("hashtags")
    )
    return texts.hashtag_counts(posts)
