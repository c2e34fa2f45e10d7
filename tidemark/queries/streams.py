"""Streaming jobs run over the whole event table, compared with their batch meaning."""

from pyspark.sql import functions as F


from tidemark.model import fraud_columns, table
from tidemark.operators.sequences import fixed_life_sessions
from tidemark.queries.registry import EVENTS_SQL, FRAUD_SQL, query

from tidemark.session import shared_folder
from tidemark.streaming import jobs, progress, rule_versions, slices, stateful


class Closing:
    """A second source beside the event files that ends the stream.

    Results in append mode wait for the watermark. After the event files are read, one row
    of a user of its own arrives here, a month after the newest event, so that every window,
    session and waiting row of the table is passed; its own results are never emitted.
    """

    def __init__(self, spark, folder):
        self.events = table(spark, folder, "events")
        self.path = jobs.shared_folder(spark, "closing")
        self.events.limit(0).write.parquet(self.path)

    def beside(self, stream):
        return stream.unionByName(jobs.file_stream(stream.sparkSession, self.path, stream.schema))

    def close(self):
        newest = self.events.agg(F.max("ts").alias("ts")).select(
            *[
                (F.col("ts") + F.expr("INTERVAL 30 DAYS") if f.name == "ts" else F.lit(
                    -1 if f.name in ("event_id", "user_id") else None)).cast(f.dataType).alias(f.name)
                for f in self.events.schema
            ]
        )
        newest.write.mode("append").parquet(self.path)


def event_stream(spark, folder, closing=None):
    source = table(spark, folder, "events").schema
    stream = jobs.file_stream(spark, f"{folder}/events*.parquet", source)
    if closing:
        stream = closing.beside(stream)
    return event_columns(stream)


def event_columns(events):
    return events.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("value"),
        "user_id",
    )


def event_rows(spark, folder):
    return event_columns(table(spark, folder, "events"))


def transaction_stream(spark, folder, closing=None):
    source = table(spark, folder, "events").schema
    stream = jobs.file_stream(spark, f"{folder}/events*.parquet", source)
    return fraud_columns(closing.beside(stream) if closing else stream)


def whole(spark, folder, purpose, build, source=event_stream):
    """The append-mode result of ``build`` over the whole table."""
    closing = Closing(spark, folder)
    stream = build(source(spark, folder, closing))
    return jobs.run_to_table(stream, purpose, then=closing.close)


@query("stream_tumbling", "window_start:t window_end:t event_count",
       """SELECT date_trunc('minute', ts) AS window_start,
              date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, count(*) AS event_count
          FROM events GROUP BY ALL""")
def _(spark, folder):
    return whole(spark, folder, "tumbling", jobs.window_counts)


@query("stream_tumbling_updates", "window_start:t window_end:t event_count",
       """SELECT date_trunc('minute', ts) AS window_start,
              date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, count(*) AS event_count
          FROM events GROUP BY ALL""")
def _(spark, folder):
    spark_path = jobs.shared_folder(spark, "updates")
    counts = jobs.window_counts(event_stream(spark, folder))
    jobs.finish(
        jobs.batches(
            counts,
            jobs.append_batches(spark_path),
            jobs.shared_folder(spark, "updates-state"),
            "update",
        )
    )
    return jobs.newest_by_batch(spark, spark_path, ["window_start", "window_end"])


@query("stream_sliding", "metric_type event_count window_start:t avg_processing_time:6",
       """SELECT 'sliding_window' AS metric_type, count(*) AS event_count, window_start,
               avg(user_id) AS avg_processing_time FROM (SELECT user_id, unnest(generate_series(
                   time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 5 HOURS, time_bucket(INTERVAL 1 HOUR, ts),
                   INTERVAL 1 HOUR)) AS window_start FROM events) GROUP BY window_start""")
def _(spark, folder):
    return whole(
        spark, folder, "sliding",
        lambda events: jobs.sliding_metrics(events, "5 seconds", "6 hours", "1 hour"),
    )


@query("stream_user_windows",
       "user_id window_start:t transaction_count_1h total_amount_1h:2 std_amount_1h:4 merchants:i",
       f"""SELECT user_id, window_start, count(*) AS transaction_count_1h,
               sum(amount) AS total_amount_1h, stddev_samp(amount) AS std_amount_1h,
               count(DISTINCT merchant_id) AS merchants
               FROM (SELECT *, unnest([time_bucket(INTERVAL 12 HOURS, timestamp),
                   time_bucket(INTERVAL 12 HOURS, timestamp) - INTERVAL 12 HOURS]) AS window_start FROM {FRAUD_SQL})
               GROUP BY 1, 2""")
def _(spark, folder):
    windows = whole(
        spark, folder, "user-windows",
        lambda rows: jobs.user_windows(rows, "5 seconds", "24 hours", "12 hours"), transaction_stream,
    )
    return windows.withColumnRenamed("unique_merchants_1h", "merchants")


@query("stream_sessions", "user_id metric_type event_count window_start:t window_end:t",
       f"""SELECT user_id, 'session' AS metric_type, count(*) AS event_count, min(ts) AS window_start,
               max(ts) AS window_end
           FROM (SELECT *, sum(CASE WHEN p IS NULL OR epoch_us(ts) - epoch_us(p) > 3600000000 THEN 1 ELSE 0 END)
                     OVER (PARTITION BY user_id ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS s
                 FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, id) AS p FROM {EVENTS_SQL}))
           GROUP BY user_id, s""")
def _(spark, folder):
    return whole(spark, folder, "sessions", lambda events: jobs.gap_sessions(events, "1 hour"))


@query("stream_deduplicated", "id", "SELECT event_id AS id FROM events")
def _(spark, folder):
    once = event_stream(spark, folder)
    twice = once.unionByName(event_stream(spark, folder))
    return jobs.run_to_table(jobs.deduplicated(twice), "dedup")


@query("stream_archive", "date:d rows",
       "SELECT CAST(ts AS DATE) AS date, count(*) AS rows FROM events GROUP BY 1")
def _(spark, folder):
    path = jobs.shared_folder(spark, "archive")
    stream = event_stream(spark, folder)
    jobs.finish(jobs.archive(stream, path, jobs.shared_folder(spark, "archive-state")))
    return spark.read.parquet(path).groupBy("date").agg(F.count(F.lit(1)).alias("rows"))


@query("stream_every_nth", "user_id metric_type event_count window_start:t",
       f"""SELECT user_id, 'user_event_count' AS metric_type, event_count, ts AS window_start
           FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, id) AS event_count
                 FROM {EVENTS_SQL}) WHERE event_count % 10 = 0""")
def _(spark, folder):
    return whole(spark, folder, "nth", lambda events: slices.every_nth(events, 10, slice="1 hour"))


@query("stream_pattern", "user_id metric_type event_count:i window_start:t window_end:t avg_processing_time:3",
       f"""SELECT user_id, 'rapid_fire_pattern' AS metric_type, 2 AS event_count, ts AS window_start,
               nxt AS window_end, (epoch_us(nxt) - epoch_us(ts)) / 1000.0 AS avg_processing_time
           FROM (SELECT *, min(CASE WHEN value = 'purchase' THEN ts END) OVER (PARTITION BY user_id
                     ORDER BY ts, id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM {EVENTS_SQL})
           WHERE value = 'click' AND epoch_us(nxt) - epoch_us(ts) < 43200000000""")
def _(spark, folder):
    click, purchase = F.col("value") == "click", F.col("value") == "purchase"
    return whole(
        spark, folder, "pattern", lambda events: slices.followed_by(events, click, purchase, 43200, slice="1 hour")
    )


MAX_LIFE_SQL = """WITH RECURSIVE s AS (SELECT user_id, min(ts) AS session_start FROM events GROUP BY 1
               UNION ALL SELECT s.user_id, min(e.ts) FROM s JOIN events e
                   ON e.user_id = s.user_id AND e.ts > s.session_start + INTERVAL 2 HOURS
               GROUP BY s.user_id, s.session_start)
           SELECT e.user_id, e.event_id AS id, e.ts, s.session_start FROM events e ASOF JOIN s
               ON e.user_id = s.user_id AND s.session_start <= e.ts"""


@query("sessions_max_life", "user_id id ts:t session_start:t", MAX_LIFE_SQL)
def _(spark, folder):
    return whole(
        spark, folder, "max-life", lambda events: slices.max_life_sessions(events, slice="1 hour")
    )


@query("sessions_max_life_batch", "user_id id ts:t session_start:t", MAX_LIFE_SQL)
def _(spark, folder):
    return fixed_life_sessions(event_rows(spark, folder))


@query("stream_scored",
       "transaction_id transaction_count_1h total_amount_1h:2 rule_high_amount rule_unusual_time risk_score:6",
       f"""SELECT transaction_id, n AS transaction_count_1h, t AS total_amount_1h, amount > 200 AS rule_high_amount,
               hour(timestamp) <= 6 AND amount > 50 AS rule_unusual_time,
               (CASE WHEN amount > 200 THEN 0.3 ELSE 0 END)
               + (CASE WHEN hour(timestamp) <= 6 AND amount > 50 THEN 0.2 ELSE 0 END)
               + (CASE WHEN n > 4 THEN 0.3 ELSE 0 END)
               + (CASE WHEN s > 0 AND (amount - m) / s > 1.5 THEN 0.2 ELSE 0 END) AS risk_score
           FROM (SELECT *, count(*) OVER w AS n, sum(amount) OVER w AS t, avg(amount) OVER w AS m,
                     stddev_samp(amount) OVER w AS s FROM {FRAUD_SQL}
                 WINDOW w AS (PARTITION BY user_id ORDER BY timestamp
                     RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW))""")
def _(spark, folder):
    scored = stateful.scored_stream(
        transaction_stream(spark, folder),
        86400.0,
        high_amount=200.0,
        night_amount=50.0,
        rapid=4,
        z=1.5,
    )
    return stateful.newest_revisions(jobs.run_to_table(scored, "scored"))


@query("stream_logs", "date:d event_type alert_required rows known",
       f"""SELECT CAST(timestamp AS DATE) AS date, merchant_category AS event_type,
               merchant_category = 'error' AS alert_required, count(*) AS rows, count(o_custkey) AS known
           FROM {FRAUD_SQL} LEFT JOIN orders ON o_orderkey = transaction_id GROUP BY 1, 2, 3""")
def _(spark, folder):
    logs = transaction_stream(spark, folder).select(
        "transaction_id", "timestamp", F.col("merchant_category").alias("event_type")
    )
    known = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("merchant_id"),
    )
    enriched = jobs.enrich_logs(
        logs.where("event_type = 'error'"), logs.where("event_type <> 'error'"), known
    )
    return (
        jobs.run_to_table(enriched, "logs")
        .groupBy("date", "event_type", "alert_required")
        .agg(F.count(F.lit(1)).alias("rows"), F.count("enriched_user_id").alias("known"))
    )


@query("collected_logs", "kind date:d event_type rows known unread",
       f"""WITH logs AS (
               SELECT *, transaction_id % 50 = 7 AS cut, timestamp + INTERVAL 2 HOURS AS utc FROM {FRAUD_SQL}
           ), read AS (
               SELECT CASE WHEN NOT cut THEN CAST(utc AS DATE) END AS date, CASE WHEN NOT cut THEN merchant_category END AS event_type,
                   CASE WHEN NOT cut THEN o_custkey END AS known, cut
               FROM logs LEFT JOIN orders ON o_orderkey = transaction_id)
           SELECT 'logs' AS kind, date, event_type, count(*) AS rows, count(known) AS known, count(*) FILTER (cut) AS unread
           FROM read GROUP BY ALL
           UNION ALL SELECT 'alerts', date, event_type, count(*), count(known), 0 FROM read WHERE event_type = 'error' GROUP BY ALL""")
def _(spark, folder):
    """JSON lines of files and of a topic, with times two hours behind UTC; some are cut off."""
    source = fraud_columns(table(spark, folder, "events"))
    line = F.to_json(F.struct(
        F.concat(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("-02:00")).alias("timestamp"),
        F.col("merchant_category").alias("event_type"), "transaction_id"))
    lines = source.select(
        F.when(F.col("transaction_id") % 50 == 7, F.substring(line, 1, 25)).otherwise(line).alias("value"),
        (F.col("transaction_id") % 2).alias("from_topic"),
    )
    paths = [shared_folder(spark, "log-files"), shared_folder(spark, "log-topic")]
    lines.where("from_topic = 0").select("value").write.text(paths[0])
    lines.where("from_topic = 1").select(F.col("value").cast("binary")).write.parquet(paths[1])
    known = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("merchant_id"),
    )
    out = shared_folder(spark, "collected")
    jobs.finish(jobs.collect_logs(
        spark.readStream.text(paths[0]), jobs.file_stream(spark, paths[1], "value binary"), known,
        out, shared_folder(spark, "collected-state"),
    ))
    kinds = [spark.read.parquet(f"{out}/{k}").withColumn("kind", F.lit(k)) for k in ("logs", "alerts")]
    return kinds[0].unionByName(kinds[1]).groupBy("kind", "date", "event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count("enriched_user_id").alias("known"), F.count("raw").alias("unread")
    )


@query("stream_dead_letters", "error rows",
       f"""SELECT error, count(*) AS rows FROM (SELECT CASE WHEN merchant_id < 10 THEN 'missing_merchant_id'
               WHEN amount <= 1 THEN 'amount_not_positive' END AS error FROM {FRAUD_SQL}) GROUP BY 1""")
def _(spark, folder):
    from tidemark.operators.filters import record_reason

    rows = transaction_stream(spark, folder).withColumns(
        {
            "merchant_id": F.when(F.col("merchant_id") >= 10, F.col("merchant_id")),
            "amount": F.round(F.col("amount") - 1, 2),
        }
    )
    good, bad = jobs.shared_folder(spark, "good"), jobs.shared_folder(spark, "bad")
    reason = record_reason(("transaction_id", "user_id", "merchant_id", "amount"))
    write = jobs.split_dead_letters(good, bad, reason)
    jobs.finish(jobs.batches(rows, write, jobs.shared_folder(spark, "split-state")))
    kept = spark.read.parquet(good).select(F.lit(None).cast("string").alias("error"))
    lost = spark.read.parquet(bad).select("error")
    return kept.unionByName(lost).groupBy("error").agg(F.count(F.lit(1)).alias("rows"))


@query("stream_rule_versions", "transaction_id version over_limit",
       f"""SELECT transaction_id,
               CASE WHEN timestamp >= TIMESTAMP '2024-01-16' THEN 2 WHEN timestamp >= TIMESTAMP '2024-01-03' THEN 1 END AS version,
               amount > CASE WHEN timestamp >= TIMESTAMP '2024-01-16' THEN length(merchant_category) * 20
                   WHEN timestamp >= TIMESTAMP '2024-01-03' THEN length(merchant_category) * 10 END AS over_limit
           FROM {FRAUD_SQL}""")
def _(spark, folder):
    """Two versions of each category's limit; before the first an event has no rule."""
    kinds = table(spark, folder, "events").select(F.col("event_type").alias("merchant_category")).distinct()
    path = jobs.shared_folder(spark, "versions")
    for version, day in ((2, "2024-01-16"), (1, "2024-01-03")):
        kinds.select(
            "merchant_category", F.lit(day).cast("timestamp").alias("valid_from"), F.lit(version).alias("version"),
            (F.length("merchant_category") * (10 * version)).alias("amount_limit"),
        ).write.mode("append").parquet(path)
    versions = jobs.file_stream(spark, path, spark.read.parquet(path).schema)
    judged = whole(
        spark, folder, "judged",
        lambda rows: rule_versions.with_rule_versions(rows, versions, "merchant_category", "timestamp"),
        transaction_stream,
    )
    return judged.withColumn("over_limit", F.col("amount") > F.col("amount_limit"))


@query("running_lag", "rows_in rows_read lag",
       """SELECT count(*) AS rows_in, count(*) FILTER (event_id % 8 < 5) AS rows_read,
              count(*) FILTER (event_id % 8 >= 5) AS lag FROM events""")
def _(spark, folder):
    """A query has read five of eight parts of the events when the others arrive."""
    events, path = table(spark, folder, "events"), jobs.shared_folder(spark, "parts")
    log = progress.ProgressTable(spark, jobs.shared_folder(spark, "progress"))
    spark.streams.addListener(log)
    try:
        events.where("event_id % 8 < 5").write.parquet(path)
        counts = jobs.window_counts(event_columns(jobs.file_stream(spark, path, events.schema)))
        sink, state = jobs.shared_folder(spark, "lag"), jobs.shared_folder(spark, "lag-state")
        running = jobs.start(jobs.batches(counts, jobs.append_batches(sink), state, "update"))
        running.awaitTermination()
        log.wait(running)
    finally:
        spark.streams.removeListener(log)
    events.where("event_id % 8 >= 5").write.mode("append").parquet(path)
    read = progress.rows_read(log.read()).where(F.col("query_id") == str(running.id))
    none = F.lit(0).cast("long")
    arrived = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_in")).withColumn("rows_read", none)
    done = read.agg(F.sum("rows_read").alias("rows_read")).withColumn("rows_in", none)
    both = arrived.unionByName(done).agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_read").alias("rows_read"))
    return both.withColumn("lag", F.col("rows_in") - F.col("rows_read"))
