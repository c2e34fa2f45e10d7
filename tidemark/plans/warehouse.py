"""Event warehouse: staging view, daily mart, volume snapshot and their tests."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.aggregates import daily_event_metrics, row_counts
from tidemark.operators.filters import stage_events
from tidemark.operators.quality import not_null, run_suite, unique
from tidemark.sources.lake import replace_table, replace_view


def build(spark, raw_events: DataFrame, prefix="") -> dict[str, DataFrame]:
    """Create the staging view, the daily mart and the volume table, in that order."""
    staged = replace_view(stage_events(raw_events), f"{prefix}stg_events")
    replace_table(daily_event_metrics(staged), f"{prefix}daily_event_metrics")
    daily = spark.table(f"{prefix}daily_event_metrics")
    volume = row_counts(
        {"raw_events": raw_events, "stg_events": staged, "daily_event_metrics": daily}
    )
    replace_table(volume, f"{prefix}volume_stats")
    return {
        "stg_events": staged,
        "daily_event_metrics": daily,
        "volume_stats": spark.table(f"{prefix}volume_stats"),
    }


def staging_tests(staged: DataFrame) -> DataFrame:
    columns = ("user_id", "event_type", "event_ts", "event_date")
    return run_suite(
        staged, [unique("event_id"), not_null("event_id"), *[not_null(c) for c in columns]]
    )


def mart_tests(daily: DataFrame) -> DataFrame:
    return run_suite(daily, [not_null(c) for c in ("event_date", "event_type", "event_count")])
