"""Operational metrics: latencies, rates, classification quality, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import degradation, relative_change, safe_ratio
from tidemark.operators.percentiles import percentiles
from tidemark.operators.running import previous
from tidemark.operators.sequences import newest

# Bounds of the latency histogram in seconds.
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]


def response_times(
    calls: DataFrame, key="operation", value="duration", order=("ts", "id"), last=1000
) -> DataFrame:
    """avg, p50, p95, p99 and max over the newest ``last`` calls of each operation."""
    recent = newest(calls, [key], list(order), last)
    base = recent.groupBy(key).agg(
        F.count(F.lit(1)).alias("samples"), F.avg(value).alias("avg"), F.max(value).alias("max")
    )
    spread = percentiles(recent, [key], value, {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return base.join(spread, key)


def latency_histogram(values: DataFrame, value: str, bounds=LATENCY_BOUNDS, keys=()) -> DataFrame:
    """Cumulative counts per bound: keys, le (infinity last), bucket_count."""
    edges = [*bounds, float("inf")]
    wide = values.groupBy(*keys).agg(
        *[F.count(F.when(F.col(value) <= F.lit(e), 1)).alias(f"b{i}") for i, e in enumerate(edges)]
    )
    pairs = F.array(
        *[
            F.struct(F.lit(e).alias("le"), F.col(f"b{i}").alias("bucket_count"))
            for i, e in enumerate(edges)
        ]
    )
    return wide.select(*keys, F.explode(pairs).alias("b")).select(*keys, "b.*")


def histogram_quantile(histogram: DataFrame, q: float, keys=()) -> DataFrame:
    """Quantile estimated by linear interpolation inside the bucket that holds the rank.

    A rank in the last (infinite) bucket gives the highest finite bound.
    """
    buckets = F.array_sort(F.collect_list(F.struct("le", "bucket_count")))
    grouped = histogram.groupBy(*keys).agg(buckets.alias("b"))  # one entry per bound
    rank = F.lit(float(q)) * F.element_at("b", -1)["bucket_count"]
    at = F.array_position(F.transform("b", lambda x: x["bucket_count"] >= rank), True).cast("int")
    ranked = grouped.withColumn("_at", at)
    this = F.element_at("b", F.col("_at"))
    before = F.try_element_at("b", F.greatest(F.col("_at") - 1, F.lit(1)))
    first = F.col("_at") == 1
    low = F.when(first, 0.0).otherwise(before["le"])
    count_low = F.when(first, 0).otherwise(before["bucket_count"])
    share = F.try_divide(
        (rank - count_low).cast("double"), (this["bucket_count"] - count_low).cast("double")
    )
    inside = low + (this["le"] - low) * share
    last = this["le"] == float("inf")
    return ranked.select(
        *keys, F.when(last, F.element_at("b", -2)["le"]).otherwise(inside).alias("quantile")
    )


def event_rates(events: DataFrame, time: str, length: str, seconds: float, keys=()) -> DataFrame:
    """Events per second and label over fixed windows."""
    return (
        events.groupBy(*keys, F.window(time, length))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(
            *keys,
            F.col("window.start").alias("window_start"),
            "events",
            (F.col("events") / F.lit(float(seconds))).alias("rate"),
        )
    )


def counter_increase(
    samples: DataFrame, keys: list[str], time="ts", value="value", length="1 hour", tie="id"
) -> DataFrame:
    """Increase of a counter per window; a fall of the value is a reset to zero."""
    rows = previous(samples, keys, [time, tie], {"_before": value})
    step = F.when(F.col("_before").isNull(), 0.0).when(
        F.col(value) < F.col("_before"), F.col(value)
    ).otherwise(F.col(value) - F.col("_before"))
    return (
        rows.withColumn("_step", step)
        .groupBy(*keys, F.window(time, length))
        .agg(F.sum("_step").alias("increase"))
        .select(*keys, F.col("window.start").alias("window_start"), "increase")
    )


def confusion(
    scored: DataFrame, actual="actual", predicted="predicted", amount=None, keys=()
) -> DataFrame:
    """Confusion counts and the rates made of them, null where a rate is undefined."""
    a, p = F.col(actual).cast("int") == 1, F.col(predicted).cast("int") == 1
    cells = {
        "true_positives": a & p,
        "false_positives": ~a & p,
        "false_negatives": a & ~p,
        "true_negatives": ~a & ~p,
    }
    measures = [F.count(F.when(test, 1)).alias(name) for name, test in cells.items()]
    if amount:
        measures.append(F.sum(F.when(a & p, F.col(amount))).alias("prevented_amount"))
    tp, fp, fn, tn = (F.col(name) for name in cells)
    return (
        scored.groupBy(*keys)
        .agg(*measures)
        .withColumns(
            {
                "detection_rate": safe_ratio(tp, tp + fn),
                "false_positive_rate": safe_ratio(fp, fp + tn),
                "precision": safe_ratio(tp, tp + fp),
                "accuracy": safe_ratio(tp + tn, tp + fp + fn + tn),
                "f1": safe_ratio(tp * 2, tp * 2 + fp + fn),
            }
        )
    )


def compare_metrics(current: DataFrame, baseline: DataFrame, limit=0.1, limits=None) -> DataFrame:
    """metric, value frames side by side: relative drift, degradation and their flags."""
    joined = current.select("metric", F.col("value").alias("current")).join(
        baseline.select("metric", F.col("value").alias("baseline")), "metric"
    )
    own = F.lit(float(limit))
    for metric, value in (limits or {}).items():
        own = F.when(F.col("metric") == metric, F.lit(float(value))).otherwise(own)
    return joined.withColumns(
        {
            "drift": relative_change("current", "baseline"),
            "degradation": degradation("current", "baseline"),
        }
    ).withColumns(
        {
            "drifted": F.col("drift") > own,
            "degraded": F.col("degradation") > own,
        }
    )


def retrain_decision(scored: DataFrame, as_of: Column, limits: dict, time="ts", days=7):
    """One row: the recent metrics and whether any falls below its limit."""
    recent = confusion(scored.where(F.col(time) >= as_of - F.expr(f"INTERVAL {days} DAYS")))
    low = F.lit(False)
    for metric, limit in limits.items():
        low = low | F.coalesce(F.col(metric) < F.lit(float(limit)), F.lit(False))
    return recent.withColumn("retrain", low)


def over_limit(requests: DataFrame, limit: int, client="client", time="ts") -> DataFrame:
    """Clients with more than ``limit`` requests in a minute."""
    return (
        requests.groupBy(client, F.window(time, "1 minute"))
        .agg(F.count(F.lit(1)).alias("requests"))
        .where(F.col("requests") > limit)
        .select(client, F.col("window.start").alias("window_start"), "requests")
    )


ALERT_KEYS = ["alertname", "cluster", "service"]


def group_alerts(alerts: DataFrame, keys=tuple(ALERT_KEYS), repeat="12 hours", time="ts"):
    """One notification per group and repeat interval."""
    return (
        alerts.groupBy(*keys, F.window(time, repeat))
        .agg(F.count(F.lit(1)).alias("alerts"), F.min(time).alias("first_at"))
        .select(*keys, F.col("window.start").alias("window_start"), "alerts", "first_at")
    )


def inhibit(alerts: DataFrame, keys=tuple(ALERT_KEYS)) -> DataFrame:
    """Drop warnings for which a critical alert with the same keys exists."""
    critical = alerts.where(F.col("severity") == "critical").select(*keys).distinct()
    warnings = alerts.where(F.col("severity") == "warning")
    others = alerts.where(~F.col("severity").eqNullSafe("warning"))
    return others.unionByName(warnings.join(critical, list(keys), "left_anti"))


def route_alerts(alerts: DataFrame) -> DataFrame:
    """Each alert with its receivers: critical ones go on to the later routes."""
    critical = F.col("severity") == "critical"
    team = F.when(F.col("team") == "ml-team", "ml-slack").when(
        F.col("service") == "fraud-detection", "fraud-team"
    )
    receivers = F.array_compact(F.array(F.when(critical, "pagerduty"), team))
    return alerts.withColumn(
        "receiver",
        F.explode(F.when(F.size(receivers) > 0, receivers).otherwise(F.array(F.lit("default")))),
    )


def consumer_lag(offsets: DataFrame, limit=10_000) -> DataFrame:
    """topic, partition, lag and whether it exceeds the limit."""
    lag = F.col("end_offset") - F.coalesce(F.col("committed"), F.lit(0))
    return offsets.select("topic", "partition", lag.alias("lag"), (lag > limit).alias("alert"))


def top_risk(scores: DataFrame, as_of: Column, n=10, time="timestamp", score="risk_score"):
    """Users with the highest score of the day of ``as_of``."""
    return (
        scores.where(F.to_date(time) == F.to_date(as_of))
        .groupBy("user_id")
        .agg(F.max(score).alias(score))
        .orderBy(F.desc(score), "user_id")
        .limit(n)
    )
