"""Rules that change while a stream runs: every event is judged by the version of its time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.session import use_rocksdb

EXACT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
OUTPUT = "event string, rule string"


class VersionLookup(StatefulProcessor):
    """Holds the versions of one rule, and the events until the watermark has passed them.

    Events wait as arrays of at most one Arrow batch and are taken up again array by array, so
    memory does not grow with the events of a key. Versions that ended before the watermark go.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getValueState("versions", "valid array<bigint>, rules array<string>")
        self.waiting = handle.getListState("waiting", "times array<bigint>, events array<string>")

    def _known(self) -> tuple[np.ndarray, np.ndarray]:
        valid, rules = self.versions.get() if self.versions.exists() else ([], [])
        return np.asarray(valid, np.int64), np.asarray(rules, object)

    def _wait(self, times: np.ndarray, events: np.ndarray) -> None:
        self.waiting.appendValue((times.tolist(), events.tolist()))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            is_rule = part["rule"].notna()
            if is_rule.any():
                valid, rules = self._known()
                valid = np.concatenate([valid, part.loc[is_rule, "at"].to_numpy(np.int64)])
                rules = np.concatenate([rules, part.loc[is_rule, "rule"].to_numpy(object)])
                # Of versions valid from one moment the one greatest as text counts, always the same.
                order = np.lexsort((rules.astype(str), valid))
                self.versions.update((valid[order].tolist(), rules[order].tolist()))
            events = part[~is_rule]
            if len(events):
                times = events["at"].to_numpy(np.int64)
                self._wait(times, events["event"].to_numpy(object))
                first = int(times.min()) if first is None else min(first, int(times.min()))
        if first is not None:
            self.handle.registerTimer(first // 1000)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = timerValues.getCurrentWatermarkInMs() * 1000
        if not self.waiting.exists():
            return
        valid, rules = self._known()
        later = []
        for times, events in self.waiting.get():
            times, events = np.asarray(times, np.int64), np.asarray(events, object)
            ready = times // 1000 <= limit // 1000
            if ready.any():
                place = np.searchsorted(valid, times[ready], "right") - 1
                chosen = [rules[p] if p >= 0 else None for p in place]
                yield pd.DataFrame({"event": events[ready], "rule": chosen})
            if not ready.all():
                later.append((times[~ready], events[~ready]))
        self.waiting.clear()
        for times, events in later:  # what the delay of the watermark holds back
            self._wait(times, events)
        if later:
            self.handle.registerTimer(min(int(times.min()) for times, _ in later) // 1000)
        ended = int(np.searchsorted(valid, limit, "right")) - 1
        if ended > 0:
            self.versions.update((valid[ended:].tolist(), rules[ended:].tolist()))

    def close(self) -> None:
        pass


def with_rule_versions(
    events: DataFrame,
    versions: DataFrame,
    key: str,
    time="ts",
    valid_from="valid_from",
    delay="5 seconds",
    salts: int = 16,
) -> DataFrame:
    """Stream rows with the columns of the rule version that was valid at their time.

    ``versions`` is a stream of ``key``, ``valid_from`` and rule columns. An event is given out
    when the watermark of the events has passed it, with the newest version whose
    ``valid_from`` is not after it; the rule columns are null where there is none. So a version
    may arrive up to ``delay`` after it becomes valid, or long before. The events of a key are
    spread over ``salts`` groups; each gets all versions of the key, which are few. Events
    without a time are left out, a null key is a key like others.
    """
    use_rocksdb(events.sparkSession)
    own = [c for c in versions.columns if c not in (key, valid_from)]
    body = F.to_json(F.struct(*events.columns), EXACT_TIMES)
    left = (
        events.where(F.col(time).isNotNull())
        .withWatermark(time, delay)
        .select(
            F.col(time).alias("ts"),
            F.unix_micros(time).alias("at"),
            F.col(key).alias("key"),
            body.alias("event"),
            F.lit(None).cast("string").alias("rule"),
        )
        .withColumn("salt", F.pmod(F.xxhash64("event"), F.lit(salts)).cast("int"))
    )
    # A version has no event time: one that is announced early must not move the watermark.
    right = versions.where(F.col(valid_from).isNotNull()).select(
        F.lit(None).cast("timestamp").alias("ts"),
        F.unix_micros(valid_from).alias("at"),
        F.col(key).alias("key"),
        F.lit(None).cast("string").alias("event"),
        F.to_json(F.struct(*own), EXACT_TIMES).alias("rule"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
    )
    found = (
        left.unionByName(right)
        .groupBy("key", "salt")
        .transformWithStateInPandas(
            statefulProcessor=VersionLookup(),
            outputStructType=OUTPUT,
            outputMode="append",
            timeMode="eventTime",
        )
    )
    return found.select(
        F.from_json("event", events.schema, EXACT_TIMES).alias("event"),
        F.from_json("rule", versions.select(*own).schema, EXACT_TIMES).alias("rule"),
    ).select("event.*", *[F.col(f"rule.{c}").alias(c) for c in own])
