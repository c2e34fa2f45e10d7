"""Queries that write to the shared folder and read back what was written."""

import uuid

from pyspark.sql import functions as F

from tidemark.model import batch_transactions, fraud_transactions, latest, table
from tidemark.queries.registry import FRAUD_SQL, ORDERS_SQL, query
from tidemark.session import shared_folder
from tidemark.sources import databases, files, lake, switched


@query("monthly_partitions", "month rows amount:2",
       f"""SELECT strftime(timestamp, '%Y-%m') AS month, count(*) AS rows, sum(amount) AS amount
           FROM {ORDERS_SQL} GROUP BY 1""")
def _(spark, folder):
    path = shared_folder(spark, "monthly")
    lake.write_by_month(batch_transactions(spark, folder), path)
    return (
        lake.read_parquet_only(spark, path)
        .groupBy("month")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount"))
    )


@query("daily_formats", "form day:d rows",
       " UNION ALL ".join(f"""SELECT '{form}' AS form, CAST(timestamp AS DATE) AS day, count(*) AS rows
           FROM {FRAUD_SQL} GROUP BY 2""" for form in lake.FORMATS))
def _(spark, folder):
    path = shared_folder(spark, "formats")
    lake.write_by_day(fraud_transactions(spark, folder), path)
    parts = [
        spark.read.format(form)
        .schema("transaction_id long, year string, month string, day string")
        .load(f"{path}/{form}")
        .select(
            F.lit(form).alias("form"),
            F.concat_ws("-", "year", "month", "day").cast("date").alias("day"),
        )
        for form in ("json", "parquet")
    ]
    parts.append(
        spark.read.option("header", True)
        .option("inferSchema", False)
        .csv(f"{path}/csv")
        .select(
            F.lit("csv").alias("form"),
            F.make_date(
                F.col("year").cast("int"), F.col("month").cast("int"), F.col("day").cast("int")
            ).alias("day"),
        )
    )
    from tidemark.operators.sets import combine

    return combine(parts).groupBy("form", "day").agg(F.count(F.lit(1)).alias("rows"))


@query("replaced_day", "date:d rows amount:2",
       f"""SELECT CAST(timestamp AS DATE) AS date, count(*) AS rows,
               sum(CASE WHEN CAST(timestamp AS DATE) = DATE '2024-01-10' THEN amount * 2 ELSE amount END) AS amount
           FROM {FRAUD_SQL} GROUP BY 1""")
def _(spark, folder):
    path = shared_folder(spark, "by-date")
    rows = fraud_transactions(spark, folder)
    lake.backfill(lambda df: df, rows, path, "2024-01-01", "2024-01-31")
    lake.load_day(rows.withColumn("amount", F.col("amount") * 2), path, "2024-01-10")
    return (
        spark.read.parquet(path)
        .groupBy("date")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount"))
    )


@query("high_water_increment", "transaction_id",
       f"""SELECT transaction_id FROM {FRAUD_SQL}
           WHERE timestamp > (SELECT max(timestamp) FROM {FRAUD_SQL} WHERE timestamp < TIMESTAMP '2024-01-20')""")
def _(spark, folder):
    rows = fraud_transactions(spark, folder)
    target = rows.where(F.col("timestamp") < F.lit("2024-01-20").cast("timestamp"))
    return lake.newer_than_target(rows, target, "timestamp")


@query("upserted", "transaction_id amount:2",
       f"""SELECT transaction_id, CASE WHEN is_fraud THEN amount + 1 ELSE amount END AS amount FROM {FRAUD_SQL}""")
def _(spark, folder):
    rows = fraud_transactions(spark, folder)
    changes = rows.where("is_fraud").withColumn("amount", F.col("amount") + 1)
    return lake.upsert(rows, changes, "transaction_id", "timestamp")


@query("upserted_partitions", "date:d rows amount:2",
       f"""SELECT CAST(timestamp AS DATE) AS date, count(*) AS rows,
               sum(CASE WHEN is_fraud AND timestamp >= TIMESTAMP '2024-01-25' THEN amount + 1 ELSE amount END)
                   AS amount FROM {FRAUD_SQL} GROUP BY 1""")
def _(spark, folder):
    path = shared_folder(spark, "upserts")
    rows = fraud_transactions(spark, folder).withColumn("date", F.to_date("timestamp"))
    lake.overwrite_partitions(rows, path, ["date"])
    changes = rows.where(
        F.col("is_fraud") & (F.col("timestamp") >= F.lit("2024-01-25").cast("timestamp"))
    ).withColumn("amount", F.col("amount") + 1)
    lake.upsert_partitions(spark, path, changes, "transaction_id", "timestamp", "date")
    return (
        spark.read.parquet(path)
        .groupBy("date")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount"))
    )


@query("moved_partitions", "transaction_id date:d amount:2",
       f"""SELECT transaction_id, CASE WHEN CAST(timestamp AS DATE) = DATE '2024-01-10'
               THEN DATE '2024-01-11' ELSE CAST(timestamp AS DATE) END AS date,
               CASE WHEN CAST(timestamp AS DATE) = DATE '2024-01-10' THEN amount + 1 ELSE amount END AS amount
           FROM {FRAUD_SQL}""")
def _(spark, folder):
    """All rows of a day move to the next one; the same changes are applied twice."""
    path = shared_folder(spark, "moves")
    rows = fraud_transactions(spark, folder).withColumn("date", F.to_date("timestamp"))
    lake.overwrite_partitions(rows, path, ["date"])
    day = F.lit("2024-01-10").cast("date")
    changes = rows.where(F.col("date") == day).withColumns(
        {"date": F.date_add("date", 1), "amount": F.col("amount") + 1}
    )
    for _ in range(2):
        lake.upsert_partitions(spark, path, changes, "transaction_id", "timestamp", "date")
    return spark.read.parquet(path)


@query("switched_partitions", "transaction_id date:d amount:2",
       f"""SELECT transaction_id, CASE WHEN CAST(timestamp AS DATE) = DATE '2024-01-10'
               THEN DATE '2024-01-11' ELSE CAST(timestamp AS DATE) END AS date,
               CASE WHEN CAST(timestamp AS DATE) = DATE '2024-01-10' THEN amount + 1 ELSE amount END AS amount
           FROM {FRAUD_SQL}""")
def _(spark, folder):
    """All rows of a day move to the next one in one commit, twice."""
    root, name = shared_folder(spark, "switched"), f"parts_{uuid.uuid4().hex}"
    rows = fraud_transactions(spark, folder).withColumn("date", F.to_date("timestamp"))
    switched.create_partitioned(rows, root, name, "date")
    changes = rows.where(F.col("date") == "2024-01-10").withColumns(
        {"date": F.date_add("date", 1), "amount": F.col("amount") + 1}
    )
    for _ in range(2):
        switched.upsert_partitioned(root, name, changes, "transaction_id", "timestamp", "date")
    return switched.read_partitioned(spark, root, name, "date", rows.schema)


@query("archived_in_place", "part day:d rows",
       f"""SELECT CASE WHEN timestamp < (SELECT max(ts) FROM events) - INTERVAL 10 DAYS THEN 'archived'
               ELSE 'kept' END AS part, CAST(timestamp AS DATE) AS day, count(*) AS rows FROM {FRAUD_SQL} GROUP BY ALL""")
def _(spark, folder):
    """A catalog table loses its old rows to the archive in two runs, the first with fewer days."""
    place, archive = shared_folder(spark, "stored"), shared_folder(spark, "archive")
    name = f"stored_{uuid.uuid4().hex}"
    rows = fraud_transactions(spark, folder).withColumn("day", F.to_date("timestamp"))
    switched.create_table(rows, name, place, ["day"])
    newest = latest(rows, "timestamp")
    for days in (20, 10):
        switched.archive_in_place(spark, name, archive, newest, days)
    old = spark.read.parquet(archive).select("day", F.lit("archived").alias("part"))
    both = spark.table(name).select("day", F.lit("kept").alias("part")).unionByName(old)
    return both.groupBy("part", "day").agg(F.count(F.lit(1)).alias("rows"))


@query("repeated_batches", "batch_id:i rows amount:2",
       f"""SELECT transaction_id % 3 AS batch_id, count(*) AS rows, sum(amount) AS amount
           FROM {FRAUD_SQL} GROUP BY 1""")
def _(spark, folder):
    """Batches that are written, fail and are written again leave one copy."""
    path = shared_folder(spark, "batches")
    rows = fraud_transactions(spark, folder)
    write = databases.per_batch(*databases.folder_table(spark, path))
    for attempt in range(2):
        for batch_id in range(3):
            part = rows.where(F.col("transaction_id") % 3 == batch_id)
            write(part if attempt else part.where("is_fraud"), batch_id)
    return spark.read.parquet(path).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount")
    )


@query("retention_split", "part rows",
       f"""SELECT CASE WHEN timestamp < (SELECT max(ts) FROM events) - INTERVAL 10 DAYS THEN 'archived'
               ELSE 'kept' END AS part, count(*) AS rows FROM {FRAUD_SQL} GROUP BY 1""")
def _(spark, folder):
    rows = fraud_transactions(spark, folder)
    kept, old = lake.split_by_retention(rows, latest(rows, "timestamp"), 10)
    both = kept.select(F.lit("kept").alias("part")).unionByName(
        old.select(F.lit("archived").alias("part"))
    )
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))


def json_lines(spark, folder):
    """The transactions as JSON lines, with the refunds' lines cut off in the middle."""
    path = shared_folder(spark, "lines")
    rows = batch_transactions(spark, folder)
    text = F.to_json(F.struct("*"))
    broken = F.col("transaction_type") == "refund"
    rows.select(F.when(broken, F.substring(text, 1, 20)).otherwise(text).alias("value")).write.text(path)
    return files.read_json_lines(spark, path)


@query("malformed_records", "records malformed_records",
       f"""SELECT count(*) AS records, count(*) FILTER (WHERE transaction_type = 'refund') AS malformed_records
           FROM {ORDERS_SQL}""")
def _(spark, folder):
    """Counted while the readable records are written."""
    counts = files.write_readable(json_lines(spark, folder), shared_folder(spark, "readable"))
    return spark.createDataFrame([counts], "records long, malformed_records long")


@query("json_transactions", "transaction_id user_id timestamp:t amount:2 status",
       f"SELECT * FROM {ORDERS_SQL} WHERE transaction_type <> 'refund'")
def _(spark, folder):
    return files.readable_transactions(json_lines(spark, folder))


@query("text_pairs", "key lines:i",
       "SELECT event_type AS key, count(*) AS lines FROM events GROUP BY 1")
def _(spark, folder):
    path = shared_folder(spark, "pairs")
    counts = table(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)))
    lake.write_text_pairs(counts, path)
    return spark.read.option("sep", "\t").csv(path).toDF("key", "lines")


@query("feature_exports", "name rows",
       f"""SELECT 'merchants' AS name, count(DISTINCT merchant_id) AS rows FROM {FRAUD_SQL}
           UNION ALL SELECT 'users', count(DISTINCT user_id) FROM {FRAUD_SQL}""")
def _(spark, folder):
    rows = fraud_transactions(spark, folder)
    tables = {
        "users": rows.groupBy("user_id").agg(F.avg("amount").alias("mean")),
        "merchants": rows.groupBy("merchant_id").agg(F.avg("amount").alias("mean")),
    }
    paths = lake.export_features(tables, shared_folder(spark, "features"), "2024-01-31")
    parts = [
        spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(p.rsplit("/", 1)[1]).alias("name"), "rows"
        )
        for p in paths
    ]
    return parts[0].unionByName(parts[1])


@query("prediction_audit", "model_version rows total:4",
       f"""SELECT 'v1' AS model_version, count(*) * 2 AS rows, sum(least(amount / 1000, 1)) * 2 AS total
           FROM {FRAUD_SQL}""")
def _(spark, folder):
    path = shared_folder(spark, "audit")
    probability = F.least(F.col("amount") / 1000, F.lit(1.0))
    scored = fraud_transactions(spark, folder).withColumn("fraud_probability", probability)
    for _ in range(2):
        lake.append_predictions(scored, path, "v1")
    return spark.read.parquet(path).groupBy("model_version").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("prediction").alias("total")
    )


@query("storage_volume", "name files bytes",
       """SELECT 'p' || pmod AS name, 1 AS files, sum(n) AS bytes FROM (
              SELECT o_orderkey % 3 AS pmod, octet_length(encode(o_orderpriority)) + 1 AS n FROM orders)
          GROUP BY 1""")
def _(spark, folder):
    """Volume of text folders with known content: a line per order in one file each."""
    lines = table(spark, folder, "orders").select(
        F.concat(F.lit("p"), F.col("o_orderkey") % 3).alias("part"), "o_orderpriority"
    )
    path = shared_folder(spark, "volume")
    for n in range(3):  # a writer of one folder streams its lines, of several it sorts them
        own = lines.where(F.col("part") == f"p{n}").select("o_orderpriority")
        own.repartition(1).write.text(f"{path}/part=p{n}")
    volume = lake.storage_volume(spark, [f"{path}/part=p{n}" for n in range(3)])
    return volume.withColumn("name", F.element_at(F.split("path", "="), -1))
