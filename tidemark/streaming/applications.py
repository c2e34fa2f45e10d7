"""The three stream applications: event archive and counts, event metrics, fraud alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.model import METRICS_SCHEMA
from tidemark.sources.messages import decode_events, decode_transactions, undecodable
from tidemark.streaming import jobs, slices, stateful


def event_application(messages: DataFrame, archive_path: str, write_counts, checkpoint: str):
    """Writers of the dated event archive and of the one-minute counts.

    Counts are aggregated in the stream and emitted in update mode, so a minute that
    spans two micro-batches gives one growing row instead of two partial ones;
    ``write_counts(batch, batch_id)`` must upsert by window.
    """
    events = decode_events(messages)
    return {
        "archive": jobs.archive(events, archive_path, f"{checkpoint}/archive"),
        "counts": jobs.batches(
            jobs.window_counts(events), write_counts, f"{checkpoint}/counts", "update"
        ),
    }


def as_metrics(df: DataFrame) -> DataFrame:
    """The common metrics record; fields an operator does not give are null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in METRICS_SCHEMA.fields
        ]
    )


def metrics_application(events: DataFrame, write, checkpoint: str, first=None, second=None):
    """Writers of the four event metrics, each to ``write(name)``."""
    first = F.col("value").contains("rapid") if first is None else first
    second = F.col("value").contains("fire") if second is None else second
    metrics = {
        "user_metrics": slices.every_nth(events, 100),
        "window_metrics": jobs.sliding_metrics(events),
        "pattern_metrics": slices.followed_by(events, first, second, 30.0),
        "session_metrics": jobs.gap_sessions(events),
    }
    return {
        name: jobs.batches(as_metrics(df), write(name), f"{checkpoint}/{name}")
        for name, df in metrics.items()
    }


def fraud_application(
    messages: DataFrame, write_all, write_alerts, write_aggregates, checkpoint: str, bad=None
):
    """One writer for all scored transactions, their alerts and the category aggregates.

    Transactions are scored in the batch that brings them, and again when an earlier one comes
    late: ``write_all`` and ``write_alerts`` get the corrections with a higher ``revision``. The
    batch is computed once, from one state store and one reading of the topic, and handed to
    the three batch functions; with ``bad``, messages that cannot be decoded go there by a writer of their own.
    """
    scored = stateful.scored_stream(decode_transactions(messages))

    def alerts(batch: DataFrame, batch_id: int) -> None:
        write_alerts(jobs.alert_messages(batch), batch_id)

    writes = jobs.fan_out(write_all, alerts, aggregated(write_aggregates))
    writers = {"transactions": jobs.batches(scored, writes, f"{checkpoint}/transactions")}
    if bad:
        writers["undecodable"] = jobs.batches(undecodable(messages), bad, f"{checkpoint}/bad")
    return writers


def topic_batches(servers: str, topic: str):
    """Batch function that sends key and value to a topic."""

    def write(batch: DataFrame, batch_id: int) -> None:
        options = {"kafka.bootstrap.servers": servers, "topic": topic}
        batch.write.format("kafka").options(**options).save()

    return write


def aggregated(write):
    """Batch function that writes the five-minute category sums of a batch.

    A window can span batches, so rows carry sums and counts that add up by window; a correction
    changes the risk by the difference only. The batch id keeps a repeated batch from being
    counted twice.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        new, change = F.lit(True), F.col("risk_score")
        if "revision" in batch.columns:
            new = F.col("revision") == 0
            change = change - F.coalesce("before_risk_score", F.lit(0.0))
        sums = (
            batch.groupBy(F.window("timestamp", "5 minutes"), "merchant_category")
            .agg(
                F.count_if(new).alias("transaction_count"),
                F.sum(F.when(new, F.col("amount"))).alias("total_amount"),
                F.sum(change).alias("total_risk_score"),
            )
            .select(
                F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"),
                "merchant_category",
                "transaction_count",
                "total_amount",
                "total_risk_score",
            )
        )
        write(sums, batch_id)

    return run


def category_totals(parts: DataFrame) -> DataFrame:
    """The category windows added up over the batches written by ``aggregated``."""
    return (
        parts.groupBy("window_start", "window_end", "merchant_category")
        .agg(
            F.sum("transaction_count").alias("transaction_count"),
            F.sum("total_amount").alias("total_amount"),
            F.sum("total_risk_score").alias("_risk"),
        )
        .withColumn("avg_risk_score", F.col("_risk") / F.col("transaction_count"))
        .drop("_risk")
    )
