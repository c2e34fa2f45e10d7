"""Streaming jobs made of built-in operators: archive, windows, sessions, deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.functions.times import parse_time
from tidemark.operators import aggregates as agg
from tidemark.session import shared_folder


BATCH_BYTES = 1 << 30


def file_stream(
    spark: SparkSession, path: str, schema, files_per_trigger=None, bytes_per_trigger=BATCH_BYTES
) -> DataFrame:
    """Parquet files of a folder or glob as a stream.

    Every micro-batch is limited, by default in bytes: that also bounds the rows a
    stateful operator can receive for one key at a time.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    else:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(path)


def with_watermark(stream: DataFrame, time="ts", delay="5 seconds") -> DataFrame:
    return stream.withWatermark(time, delay)


def window_counts(stream: DataFrame, delay="5 seconds", length="1 minute") -> DataFrame:
    return agg.event_counts(with_watermark(stream, "ts", delay), "ts", length)


def sliding_metrics(
    stream: DataFrame, delay="5 seconds", length="1 minute", slide="10 seconds"
) -> DataFrame:
    """Sliding metrics in event time, so a replay gives the same windows."""
    return agg.sliding_metrics(with_watermark(stream, "ts", delay), "ts", length, slide)


def category_windows(scored: DataFrame, delay="1 hour", length="5 minutes") -> DataFrame:
    return agg.category_windows(with_watermark(scored, "timestamp", delay), length=length)


def user_window_merchants(
    transactions: DataFrame, delay="1 hour", length="1 hour", slide="10 minutes"
) -> DataFrame:
    """Per user, sliding window and merchant: rows, known amounts, their sum and spread."""
    known = F.count("amount")
    return (
        with_watermark(transactions, "timestamp", delay)
        .groupBy("user_id", F.window("timestamp", length, slide).alias("window"), "merchant_id")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            known.alias("known"),
            F.sum("amount").alias("total"),
            (F.var_pop("amount") * known).alias("spread"),
        )
    )


def user_windows(
    transactions: DataFrame, delay="1 hour", length="1 hour", slide="10 minutes"
) -> DataFrame:
    """Per user and sliding window: count, amounts, deviation, number of distinct merchants.

    Merchants are grouped first and counted in a second aggregation, so a state row holds a few
    numbers however many merchants a user has; ``user_window_merchants`` lists them.
    """
    rows, known, total = F.sum("rows"), F.sum("known"), F.sum("total")
    between = F.sum(F.try_divide(F.col("total") * F.col("total"), F.col("known")))
    spread = F.sum("spread") + between - F.try_divide(total * total, known)
    return (
        user_window_merchants(transactions, delay, length, slide)
        .groupBy("user_id", "window")
        .agg(
            rows.alias("transaction_count_1h"),
            total.alias("total_amount_1h"),
            F.try_divide(total, known).alias("avg_amount_1h"),
            F.sqrt(F.try_divide(F.greatest(spread, F.lit(0.0)), known - 1)).alias("std_amount_1h"),
            F.count("merchant_id").alias("unique_merchants_1h"),
        )
        .select(
            "user_id",
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "transaction_count_1h",
            "total_amount_1h",
            "avg_amount_1h",
            "std_amount_1h",
            "unique_merchants_1h",
        )
    )


def gap_sessions(stream: DataFrame, gap="30 seconds", delay="5 seconds") -> DataFrame:
    """Sessions per user with the times of their first and last event."""
    return (
        with_watermark(stream, "ts", delay)
        .groupBy("user_id", F.session_window("ts", gap))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.min("ts").alias("window_start"),
            F.max("ts").alias("window_end"),
        )
        .select(
            "user_id",
            F.lit("session").alias("metric_type"),
            "event_count",
            "window_start",
            "window_end",
        )
    )


def deduplicated(stream: DataFrame, key="id", time="ts", memory="24 hours") -> DataFrame:
    """Each id once within the memory span."""
    return with_watermark(stream, time, memory).dropDuplicatesWithinWatermark([key])


def with_rules(stream: DataFrame, rule_table: DataFrame, key: str) -> DataFrame:
    """Stream rows with the columns of a shared rule table; its size decides the join."""
    return stream.join(rule_table, key, "left")


def enrich_logs(
    file_logs: DataFrame, topic_logs: DataFrame, transactions: DataFrame, time="timestamp"
) -> DataFrame:
    """Both log streams with the transaction's user and merchant, day and alert mark."""
    looked_up = transactions.select(
        "transaction_id",
        F.col("user_id").alias("enriched_user_id"),
        F.col("merchant_id").alias("enriched_merchant_id"),
    )
    logs = file_logs.unionByName(topic_logs, allowMissingColumns=True)
    return logs.join(looked_up, "transaction_id", "left").withColumns(
        {
            "date": F.to_date(time),
            "alert_required": F.coalesce(F.col("event_type") == "error", F.lit(False)),
        }
    )


LOG_SCHEMA = (
    "timestamp string, level string, component string, message string, event_type string, "
    "transaction_id bigint"
)


def parse_logs(lines: DataFrame, schema=LOG_SCHEMA, column="value") -> DataFrame:
    """JSON log lines with their ISO time parsed; a line that is no JSON stays as ``raw``."""
    wanted = F.from_json(F.col(column).cast("string"), schema + ", raw string", {"columnNameOfCorruptRecord": "raw"})
    parsed = lines.select(F.inline(F.array(wanted)))
    return parsed.withColumn("timestamp", parse_time("timestamp"))


def collect_logs(files: DataFrame, messages: DataFrame, transactions: DataFrame, folder: str, checkpoint: str):
    """Writer of all logs of files and a topic to daily folders, and of alerts to others.

    Logs of a transaction get its user and merchant. Every batch owns its folders below
    ``logs`` and ``alerts``, so a batch that is run again replaces them; it is computed once for
    both. Lines without a readable time are kept under no date.
    """
    enriched = enrich_logs(parse_logs(files), parse_logs(messages), transactions)

    def daily(path: str):
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").partitionBy("date").parquet(f"{path}/batch_id={batch_id}")

        return write

    def alerts(batch: DataFrame, batch_id: int) -> None:
        daily(f"{folder}/alerts")(batch.where("alert_required"), batch_id)

    return batches(enriched, fan_out(daily(f"{folder}/logs"), alerts), checkpoint)


def archive(stream: DataFrame, path: str, checkpoint: str, time="ts", hourly=False):
    """Writer of the stream to Parquet by date (and hour), to be started by the caller."""
    dated = stream.withColumn("date", F.to_date(time))
    parts = ["date"]
    if hourly:
        dated = dated.withColumn("hour_of_day", F.hour(time))
        parts.append("hour_of_day")
    return (
        dated.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*parts)
        .outputMode("append")
    )


def start(writer, every: str | None = None):
    """Start a writer on a processing-time trigger, or on what is there now."""
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()


def finish(writer) -> None:
    """Process everything that is there and stop."""
    start(writer).awaitTermination()


def batches(stream: DataFrame, write, checkpoint: str, mode="append"):
    """Writer that hands every micro-batch to ``write(batch, batch_id)``."""
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
    )


def fan_out(*writes):
    """One batch function that gives the same, once computed batch to several sinks."""

    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for write in writes:
                write(kept, batch_id)
        finally:
            kept.unpersist()

    return run


def append_batches(path: str):
    """Sink that owns one folder per batch: repeating a batch replaces its folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def archive_batches(path: str, time="timestamp"):
    """The same by date and hour within a batch's folder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        dated = batch.withColumns({"date": F.to_date(time), "hour_of_day": F.hour(time)})
        dated.write.mode("overwrite").partitionBy("date", "hour_of_day").parquet(f"{path}/batch_id={batch_id}")

    return write


def newest_by_batch(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Rows written by ``append_batches`` in update mode: the last batch wins per key."""
    from tidemark.operators.sequences import newest_per_key

    return newest_per_key(spark.read.parquet(path), keys, ["batch_id"]).drop("batch_id")


def split_dead_letters(path_good: str, path_bad: str, reason):
    """Batch function writing accepted rows and rejected rows to their folders."""
    from tidemark.operators.filters import split_rejects

    def write(batch: DataFrame, batch_id: int) -> None:
        good, bad = split_rejects(batch, reason)
        append_batches(path_good)(good, batch_id)
        append_batches(path_bad)(bad, batch_id)

    return fan_out(write)  # the batch is read once for both


def split_late(batch: DataFrame, time: str, watermark) -> tuple[DataFrame, DataFrame]:
    """(on time, late) rows of a batch against a known watermark."""
    late = F.col(time) < watermark
    return batch.where(~late), batch.where(late)


def run_to_table(stream: DataFrame, purpose: str, mode="append", then=None) -> DataFrame:
    """Run a stream over all its present input and read the result back as a table.

    ``then`` is called when that input is read, and may bring more for a second run.
    """
    spark = stream.sparkSession
    path, checkpoint = shared_folder(spark, purpose), shared_folder(spark, purpose + "-state")

    def run():
        if mode == "append":
            finish(
                stream.writeStream.format("parquet")
                .option("path", path)
                .option("checkpointLocation", checkpoint)
                .outputMode("append")
            )
        else:
            finish(batches(stream, append_batches(path), checkpoint, mode))

    run()
    if then:
        then()
        run()
    return spark.read.schema(stream.schema).parquet(path) if mode == "append" else spark.read.parquet(path)


def suspicious(scored: DataFrame, limit=0.5) -> DataFrame:
    return scored.where(F.col("risk_score") > limit)


def alert_messages(scored: DataFrame, limit=0.5) -> DataFrame:
    """Suspicious rows as key and JSON value."""
    return suspicious(scored, limit).select(
        F.col("user_id").cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def flagged(transactions: DataFrame, high_risk=rules.HIGH_RISK_CATEGORIES) -> DataFrame:
    """Stateless enrichment of a transaction stream."""
    return rules.stream_flags(transactions, high_risk)
