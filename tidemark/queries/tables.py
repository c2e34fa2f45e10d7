"""Queries over written tables, views and files, stream sinks, gates and labelled results."""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.ml import models
from tidemark.model import fraud_transactions, table, users
from tidemark.operators import filters, joins
from tidemark.operators import quality as q
from tidemark.operators.sequences import newest_per_key
from tidemark.plans import lake as reports
from tidemark.queries.models import interactions
from tidemark.queries.registry import FRAUD_SQL, USERS_SQL, query
from tidemark.queries.streams import event_stream, transaction_stream, whole
from tidemark.session import shared_folder
from tidemark.sources import files, lake
from tidemark.streaming import jobs, slices, stateful


def named(name):
    """A table name of its own: the catalog is shared by all queries of a session."""
    return f"{name}_{uuid.uuid4().hex}"


def sums(df, *keys):
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount"))


@query("stream_hourly_archive", "date:d hour_of_day rows",
       f"""SELECT CAST(timestamp AS DATE) AS date, hour(timestamp) AS hour_of_day, count(*) AS rows
           FROM {FRAUD_SQL} GROUP BY 1, 2""")
def _(spark, folder):
    path, state = shared_folder(spark, "hourly"), shared_folder(spark, "hourly-state")
    stream = transaction_stream(spark, folder)
    jobs.finish(jobs.archive(stream, path, state, "timestamp", hourly=True))
    return spark.read.parquet(path).groupBy("date", "hour_of_day").agg(F.count(F.lit(1)).alias("rows"))


@query("column_partitions", "form date:d rows amount:2",
       " UNION ALL ".join(
           f"""SELECT '{form}' AS form, CAST(timestamp AS DATE) AS date, count(*) AS rows, sum(amount) AS amount
               FROM {FRAUD_SQL} GROUP BY 2""" for form in ("parquet", "json", "csv"))
       + f""" UNION ALL SELECT 'unpartitioned', NULL, count(*), sum(amount) FROM {FRAUD_SQL}""")
def _(spark, folder):
    rows = fraud_transactions(spark, folder).select("transaction_id", "timestamp", "amount")
    dated, plain = shared_folder(spark, "dated"), shared_folder(spark, "undated")
    lake.write_by_column(rows.withColumn("date", F.to_date("timestamp")), dated)
    lake.write_by_column(rows, plain, formats=("parquet",))
    readers = {
        "parquet": spark.read.parquet(f"{dated}/parquet"),
        "json": spark.read.json(f"{dated}/json"),
        "csv": spark.read.option("header", True).csv(f"{dated}/csv"),
    }
    out = None
    for form, df in readers.items():
        part = sums(
            df.select(F.col("date").cast("date").alias("date"), F.col("amount").cast("double").alias("amount")),
            "date",
        ).select(F.lit(form).alias("form"), "date", "rows", "amount")
        out = part if out is None else out.unionByName(part)
    undated = sums(spark.read.parquet(f"{plain}/parquet")).select(
        F.lit("unpartitioned").alias("form"), F.lit(None).cast("date").alias("date"), "rows", "amount"
    )
    return out.unionByName(undated)


@query("external_partitions", "date:d rows amount:2",
       f"""SELECT CAST(timestamp AS DATE) AS date, count(*) AS rows, sum(amount) AS amount
           FROM {FRAUD_SQL} GROUP BY 1""")
def _(spark, folder):
    path = shared_folder(spark, "external")
    rows = fraud_transactions(spark, folder).withColumn("date", F.to_date("timestamp"))
    lake.overwrite_partitions(rows.select("transaction_id", "amount", "date"), path, ["date"])
    schema = "transaction_id bigint, amount double, date date"
    return sums(lake.external_table(spark, named("external"), schema, "date", path), "date")


@query("dimension_table", "country users:i", f"SELECT country, count(*) AS users FROM {USERS_SQL} GROUP BY 1")
def _(spark, folder):
    path = shared_folder(spark, "dimension")
    for _ in range(2):
        lake.write_dimension(users(spark, folder), path)
    found = lake.read_parquet_only(spark, path)
    return found.groupBy("country").agg(F.count(F.lit(1)).alias("users"))


@query("replaced_table", "merchant_category rows amount:2",
       f"SELECT merchant_category, count(*) AS rows, sum(amount) AS amount FROM {FRAUD_SQL} GROUP BY 1")
def _(spark, folder):
    """A table that is dropped and made again, seen through a view that is replaced."""
    name, view = named("replaced"), named("view")
    rows = fraud_transactions(spark, folder)
    for part in (rows.where("amount < 10"), rows):
        lake.replace_table(part, name)
        seen = lake.replace_view(sums(spark.table(name), "merchant_category"), view)
    return seen


@query("sample_rows", "name rows",
       """SELECT 'customer' AS name, least(5, count(*)) AS rows FROM customer
          UNION ALL SELECT 'nation', least(5, count(*)) FROM nation""")
def _(spark, folder):
    tables = {n: named(n) for n in ("customer", "nation")}
    for name, stored in tables.items():
        lake.replace_view(table(spark, folder, name), stored)
    found = reports.sample_results(spark, list(tables.values()))
    parts = [
        found[stored].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name, stored in tables.items()
    ]
    return parts[0].unionByName(parts[1])


@query("scanned_logs", "lines out_of_order", "SELECT count(*) AS lines, 0 AS out_of_order FROM events")
def _(spark, folder):
    """Log lines written in time order and read back; each line starts with its time."""
    path = shared_folder(spark, "log")
    lines = table(spark, folder, "events").select(
        "ts", F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), "event_type").alias("value")
    )
    files.write_log(lines.repartition(4), path)
    read = files.read_lines(spark, path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )
    time = F.substring("value", 1, 26)  # lines of one time are in any order
    before = F.lag(time).over(Window.partitionBy("file", "block").orderBy("place"))
    return read.withColumn("before", before).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(F.col("before") > time, 1)).alias("out_of_order"),
    )


@query("file_formats", "form rows amount:2",
       " UNION ALL ".join(f"SELECT '{f}' AS form, count(*) AS rows, sum(amount) AS amount FROM {FRAUD_SQL}"
                          for f in ("orc", "orc-zlib", "parquet-gzip", "parquet-lz4")))
def _(spark, folder):
    rows = fraud_transactions(spark, folder).select("transaction_id", "amount")
    parts = []
    for form, compression in (("orc", None), ("orc", "zlib"), ("parquet", "gzip"), ("parquet", "lz4")):
        path = shared_folder(spark, form)
        lake.write_as(rows, path, form, compression)
        label = f"{form}-{compression}" if compression else form
        parts.append(sums(spark.read.format(form).load(path)).withColumn("form", F.lit(label)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("bucketed_join", "n_name orders",
       """SELECT n_name, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
          JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def _(spark, folder):
    facts, dimension = named("facts"), named("dimension")
    lake.bucketed_table(table(spark, folder, "orders").withColumnRenamed("o_custkey", "key"), facts, "key", 8)
    lake.bucketed_table(table(spark, folder, "customer").withColumnRenamed("c_custkey", "key"), dimension, "key", 8)
    joined = spark.table(facts).join(spark.table(dimension), "key")
    nations = table(spark, folder, "nation").select("n_name", F.col("n_nationkey").alias("c_nationkey"))
    return joined.join(nations, "c_nationkey").groupBy("n_name").agg(F.count(F.lit(1)).alias("orders"))


@query("recorded_feedback", "transaction_id is_fraud",
       f"SELECT transaction_id, CASE WHEN amount > 100 THEN NOT is_fraud ELSE is_fraud END AS is_fraud FROM {FRAUD_SQL}")
def _(spark, folder):
    rows = fraud_transactions(spark, folder).select("transaction_id", "is_fraud", F.col("timestamp").alias("updated_at"), "amount")
    later = rows.where("amount > 100").withColumns(
        {"is_fraud": ~F.col("is_fraud"), "updated_at": F.col("updated_at") + F.expr("INTERVAL 1 HOUR")}
    )
    # The same feedback twice, and an older one that comes late.
    found = lake.record_feedback(rows, later.unionByName(later))
    older = rows.withColumns(
        {"is_fraud": F.lit(True), "updated_at": F.col("updated_at") - F.expr("INTERVAL 1 DAY")}
    )
    return lake.record_feedback(found, older)


@query("transaction_by_id", "transaction_id amount:2",
       f"SELECT transaction_id, amount FROM {FRAUD_SQL} WHERE transaction_id = 77")
def _(spark, folder):
    return filters.by_id(fraud_transactions(spark, folder), 77)


@query("suspicious_transactions", "transaction_id risk_score:4",
       f"SELECT transaction_id, amount / 200 AS risk_score FROM {FRAUD_SQL} WHERE amount / 200 > 0.5")
def _(spark, folder):
    scored = fraud_transactions(spark, folder).withColumn("risk_score", F.col("amount") / 200)
    return jobs.suspicious(scored)


@query("labelled_predictions", "predicted toxic rows",
       """SELECT n_chars > 2000 AS predicted, toxic, count(*) AS rows
          FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2""")
def _(spark, folder):
    predictions = table(spark, folder, "documents").select("doc_id", (F.col("n_chars") > 2000).alias("predicted"))
    found = joins.with_labels(predictions, table(spark, folder, "labels"), "doc_id")
    return found.groupBy("predicted", "toxic").agg(F.count(F.lit(1)).alias("rows"))


@query("quality_gates", "gate passed",
       f"""SELECT 'clean' AS gate, true AS passed UNION ALL
           SELECT 'doubled', false UNION ALL
           SELECT 'holes', (SELECT count(*) FILTER (WHERE merchant_id < 30) / (count(*) * 3.0) <= 0.05 FROM {FRAUD_SQL})""")
def _(spark, folder):
    """Whether the gate lets a table pass: as it is, with every row twice, with nulls."""
    rows = fraud_transactions(spark, folder).select("timestamp", "amount", "merchant_id", "transaction_id")
    holes = rows.select(
        "timestamp", "amount", F.when(F.col("merchant_id") >= 30, F.col("merchant_id")).alias("merchant_id")
    ).dropDuplicates()

    def passes(df):
        try:
            q.quality_gate(df)
            return True
        except q.QualityError:
            return False

    found = [("clean", passes(rows)), ("doubled", passes(rows.union(rows))), ("holes", passes(holes))]
    return spark.createDataFrame(found, "gate string, passed boolean")


@query("required_columns", "columns passed",
       f"""SELECT 'transaction_id,amount' AS columns, count(*) FILTER (WHERE transaction_id IS NULL OR amount IS NULL) = 0
               AS passed FROM {FRAUD_SQL}
           UNION ALL SELECT 'nothing', false
           UNION ALL SELECT 'holes', count(*) FILTER (WHERE amount > 50) = 0 FROM {FRAUD_SQL}""")
def _(spark, folder):
    rows = fraud_transactions(spark, folder).withColumn(
        "holes", F.when(F.col("amount") <= 50, F.col("amount"))
    )

    def passes(*names):
        try:
            q.require_columns(rows, list(names))
            return ",".join(names), True
        except q.QualityError:
            return ",".join(names), False

    found = [passes("transaction_id", "amount"), passes("nothing"), passes("holes")]
    return spark.createDataFrame(found, "columns string, passed boolean")


@query("stream_user_statistics", "user_id last_seen:t event_count avg_amount:6 session_count:i",
       f"""SELECT user_id, max(timestamp) AS last_seen, count(*) AS event_count, avg(amount) AS avg_amount,
               sum(CASE WHEN p IS NULL OR epoch_us(timestamp) - epoch_us(p) > 1800000000 THEN 1 ELSE 0 END) AS session_count
           FROM (SELECT *, lag(timestamp) OVER (PARTITION BY user_id ORDER BY timestamp, transaction_id) AS p FROM {FRAUD_SQL})
           GROUP BY 1""")
def _(spark, folder):
    def build(rows):
        events = rows.select(
            "user_id", F.col("timestamp").alias("ts"), F.col("transaction_id").alias("id"), "amount"
        )
        return slices.user_statistics(events, 1800.0, F.col("amount"), slice="1 hour")

    states = whole(spark, folder, "statistics", build, transaction_stream)
    return newest_per_key(states, ["user_id"], ["event_count"])


@query("late_rows", "part rows",
       """SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'late' ELSE 'on time' END AS part, count(*) AS rows
          FROM events GROUP BY 1""")
def _(spark, folder):
    path = shared_folder(spark, "late")

    def write(batch, batch_id):
        on_time, late = jobs.split_late(batch, "ts", F.lit("2024-01-16").cast("timestamp"))
        both = on_time.withColumn("part", F.lit("on time")).unionByName(late.withColumn("part", F.lit("late")))
        jobs.append_batches(path)(both, batch_id)

    jobs.finish(jobs.batches(event_stream(spark, folder), write, shared_folder(spark, "late-state")))
    return spark.read.parquet(path).groupBy("part").agg(F.count(F.lit(1)).alias("rows"))


@query("stream_with_rules", "value limit_per_hour rows",
       """SELECT event_type AS value, length(event_type) * 10 AS limit_per_hour, count(*) AS rows FROM events
          WHERE event_type <> 'view' GROUP BY 1, 2
          UNION ALL SELECT 'view', NULL, count(*) FROM events WHERE event_type = 'view' HAVING count(*) > 0""")
def _(spark, folder):
    kinds = table(spark, folder, "events").select(F.col("event_type").alias("value")).distinct()
    limits = kinds.where("value <> 'view'").withColumn("limit_per_hour", F.length("value") * 10)
    stream = jobs.with_rules(event_stream(spark, folder), limits, "value")
    return jobs.run_to_table(stream, "rules").groupBy("value", "limit_per_hour").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query("stream_model_scores", "rows same:i",
       "SELECT count(*) AS rows, count(*) AS same FROM lineitem")
def _(spark, folder):
    """A saved model scores a stream as it scores the table."""
    rows, path = interactions(spark, folder), shared_folder(spark, "interactions")
    rows.write.parquet(path)
    model_path = shared_folder(spark, "stream-model")
    models.save(models.fit_logistic(rows), model_path)
    model = models.load(model_path)
    streamed = jobs.run_to_table(
        models.score(jobs.file_stream(spark, path, rows.schema), model).select("id", "probability"), "scores"
    )
    scored = models.score(spark.read.parquet(path), model).select("id", "probability")

    # Ids repeat, so the rows are compared as counts of equal (id, probability).
    def counted(df, name):
        return df.groupBy("id", "probability").agg(F.count(F.lit(1)).alias(name))

    both = counted(streamed, "streamed").join(counted(scored, "scored"), ["id", "probability"], "left")
    return both.agg(
        F.sum("streamed").alias("rows"), F.sum(F.least("streamed", F.coalesce("scored", F.lit(0)))).alias("same")
    )
