"""Scoring on arrival: every transaction at once, and again when an earlier one comes late."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.session import use_rocksdb
from tidemark.streaming.slices import window_measures

MEASURES = ("transaction_count_1h", "total_amount_1h", "avg_amount_1h", "std_amount_1h")


class ArrivalVelocity(StatefulProcessor):
    """Trailing measures of the rows of one user and one slice of event time.

    A slice is ``spans`` spans long, as every group of rows costs some calls of the state; rows
    of the last span of the slice before come along as contributors (not ``own``), since the
    windows of the slice reach no further back. A row is given out in the micro-batch that
    brings it, with revision 0; a row that arrives later and lies in its window makes it come
    out again with the next revision and what it said before. Rows that lie more than a span
    behind the watermark are dropped with the next rows of the group. When the watermark has passed
    the end of a slice nothing can change there, and a timer clears its state: a user who never
    returns leaves nothing behind.
    """

    held = "times array<bigint>, numbers array<double>, ids array<{id}>, texts array<string>, own array<boolean>, revisions array<int>"
    template = (
        "user_id {user}, transaction_id {id}, timestamp timestamp, merchant_category string, "
        "amount double, transaction_count_1h bigint, total_amount_1h double, "
        "avg_amount_1h double, std_amount_1h double, revision int, "
        "before_transaction_count_1h bigint, before_total_amount_1h double, "
        "before_avg_amount_1h double, before_std_amount_1h double"
    )

    def __init__(self, span_seconds: float, spans: int):
        self.span = int(span_seconds * 1_000_000)
        self.slice = self.span * spans

    def typed(self, user: str, id: str) -> ArrivalVelocity:
        self.schema = self.template.format(user=user, id=id)
        self.state_schema = self.held.format(id=id)
        self.names = [f.split()[0] for f in self.state_schema.split(", ")]
        return self

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("rows", self.state_schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        part = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        new = {
            "times": part["ts"].to_numpy("datetime64[us]").astype("int64"),
            "numbers": part["number"].to_numpy("float64"),
            "ids": part["id"].to_numpy(),
            "texts": part["text"].to_numpy(object),
            "own": part["own"].to_numpy(bool),
            "revisions": np.full(len(part), -1),
        }
        # What is behind the watermark may belong to a slice that has been cleared.
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        in_time = new["times"] >= passed
        if not in_time.any():
            return
        old = [*self.state.get()] if self.state.exists() else [[] for _ in self.names]
        both = {
            name: np.concatenate([np.asarray(before, dtype=new[name].dtype), new[name][in_time]])
            for name, before in zip(self.names, old, strict=True)
        }
        fresh = np.arange(len(both["times"])) >= len(old[0])
        # No row to come reaches further back than a span behind the watermark.
        needed = both["times"] >= passed - self.span
        both, fresh = {n: v[needed] for n, v in both.items()}, fresh[needed]
        order = np.argsort(both["times"], kind="stable")
        both, fresh = {n: v[order] for n, v in both.items()}, fresh[order]
        times, numbers, own = both["times"], both["numbers"], both["own"]
        touched = window_measures(times, np.zeros(len(times)), times, self.span, fresh)
        changed = own & (touched["transaction_count_1h"] > 0)
        again = changed & ~fresh
        both["revisions"] = both["revisions"] + changed
        if key[1] is not None:  # a row without a time waits for nothing
            self.handle.registerTimer((int(key[1]) + 1) * self.slice // 1000 + 1)
        self.state.update(tuple(both[n].tolist() for n in self.names))
        if not changed.any():
            return
        at = times[changed]
        now = window_measures(times, numbers, at, self.span)
        before = window_measures(times, numbers, at, self.span, ~fresh)
        first = ~again[changed]
        frame = {
            "user_id": [key[0]] * len(at),
            "transaction_id": both["ids"][changed],
            "timestamp": at.astype("datetime64[us]"),
            "merchant_category": both["texts"][changed],
            "amount": numbers[changed],  # NaN becomes null, as in all numbers here
            **now,
            "revision": both["revisions"][changed],
            **{f"before_{n}": np.where(first, np.nan, before[n]) for n in MEASURES},
        }
        yield pd.DataFrame(frame)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


def velocity_on_arrival(
    transactions: DataFrame, span_seconds=3600.0, delay="1 hour", spans=16
) -> DataFrame:
    """Trailing velocity of every row in the micro-batch it arrives in, and its corrections.

    A row has revision 0 first. Rows may come ``delay`` behind the newest one in any order and
    number per micro-batch: the last revision of each row is the same (``newest_revisions``).
    The rows of a user are grouped by slices of ``spans`` spans.
    """
    use_rocksdb(transactions.sparkSession)
    span = int(span_seconds * 1_000_000)
    length = F.lit(span * spans)
    into = F.pmod(F.unix_micros("ts"), length)
    slice = ((F.unix_micros("ts") - into) / length).cast("long")
    next_too = F.array(F.lit(True), F.lit(False))
    rows = (
        transactions.select(
            "user_id",
            F.col("timestamp").alias("ts"),
            F.col("transaction_id").alias("id"),
            F.col("merchant_category").cast("string").alias("text"),
            F.col("amount").cast("double").alias("number"),
        )
        .withWatermark("ts", delay)
        .where(F.col("ts").isNotNull())
        .select("*", F.explode(F.when(into >= length - span, next_too).otherwise(F.array(F.lit(True)))).alias("own"))
        .withColumn("slice", F.when(F.col("own"), slice).otherwise(slice + 1))
    )
    types = dict(rows.dtypes)
    processor = ArrivalVelocity(span_seconds, spans).typed(types["user_id"], types["id"])
    return rows.groupBy("user_id", "slice").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=processor.schema,
        outputMode="append",
        timeMode="eventTime",
    )


def scored_stream(transactions: DataFrame, span_seconds=3600.0, delay="1 hour", **rule_options):
    """Velocity, flags, z-score, rules and risk score for every transaction on arrival.

    A correction has a ``revision`` above 0 and ``before_risk_score``, the score it replaces.
    """
    from tidemark.functions import rules
    from tidemark.functions.numbers import zscore_or_zero

    def scored(df: DataFrame) -> DataFrame:
        z = zscore_or_zero("amount", "avg_amount_1h", "std_amount_1h")
        return rules.stream_rules(df.withColumn("amount_zscore", z), **rule_options)

    flagged = rules.stream_flags(velocity_on_arrival(transactions, span_seconds, delay))
    own = [c for c in flagged.columns if not c.startswith("before_")]
    replaced = [F.col(f"before_{m}").alias(m) for m in MEASURES]
    others = [c for c in own if c not in MEASURES]
    earlier = scored(flagged.select(*others, *replaced, F.struct(*MEASURES).alias("_now")))
    was = F.when(F.col("revision") > 0, F.col("risk_score"))
    now = earlier.select(*others, "_now.*", was.alias("before_risk_score"))
    return scored(now.select(*own, "before_risk_score"))


def newest_revisions(scored: DataFrame, key="transaction_id") -> DataFrame:
    """The last revision of every transaction of a stored result."""
    from tidemark.operators.sequences import newest_per_key

    return newest_per_key(scored, [key], ["revision"])
