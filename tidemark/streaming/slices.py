"""Operators over a user's rows in time order, in two stages that split large users.

First a built-in aggregation groups the rows by user and time slice, so a user with half of
the stream is spread over as many groups as there are slices; what it emits when the watermark
passes the end of a slice is one row: sorted arrays, or a few numbers. Then a processor per
user takes the slices in their order and carries its state over them. Slices arrive complete
and later ones never before earlier ones, so nothing waits there, and whole arrays are handled
at a time. Results come when a slice is over: shorter slices answer sooner, longer ones make
fewer states. They depend neither on the order rows arrive in nor on micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.session import use_rocksdb

SLICE = "1 minute"
EXACT = "decimal(38,10)"


def _time(micros) -> pd.Series:
    return pd.to_datetime(pd.Series(micros, dtype="int64"), unit="us")


def _joined(arrays, kind=np.int64) -> np.ndarray:
    return np.concatenate([np.asarray(a, kind) for a in arrays]) if len(arrays) else np.array([], kind)


class InSlices(StatefulProcessor):
    """Base: ``follow`` gets a user's slices in order and returns the rows to emit."""

    template: str  # output columns; {user} and {id} stand for the types of the keys
    state_schema: str

    def typed(self, user: str, id: str) -> InSlices:
        self.schema = self.template.format(user=user, id=id)
        self.names = [f.split()[0] for f in self.schema.split(", ")]
        return self

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", self.state_schema)

    def follow(self, slices: pd.DataFrame) -> dict:
        """Output columns, all but ``user_id``."""
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        slices = pd.concat(list(rows), ignore_index=True).sort_values("slice_start")
        out = self.follow(slices)
        frame = pd.DataFrame({n: out[n] for n in self.names if n != "user_id"})
        frame.insert(0, "user_id", [key[0]] * len(frame))
        if len(frame):
            yield frame

    def close(self) -> None:
        pass


class CountEveryNth(InSlices):
    """Running count per user, reported at every n-th row."""

    template = "user_id {user}, metric_type string, event_count bigint, window_start timestamp"
    state_schema = "n bigint"

    def __init__(self, n: int):
        self.n = n

    def follow(self, slices):
        count = self.state.get()[0] if self.state.exists() else 0
        times = _joined(slices["times"].tolist())
        self.state.update((count + len(times),))
        reported = np.arange((count // self.n + 1) * self.n, count + len(times) + 1, self.n)
        return {
            "metric_type": ["user_event_count"] * len(reported),
            "event_count": reported,
            "window_start": _time(times[reported - count - 1]),
        }


class FollowedBy(InSlices):
    """Pairs every row marked 1 with the next row marked 2 in time; 3 means both.

    The state holds the open first rows of the last ``within_seconds``.
    """

    template = (
        "user_id {user}, metric_type string, event_count bigint, window_start timestamp, "
        "window_end timestamp, avg_processing_time double"
    )
    state_schema = "times array<bigint>"

    def __init__(self, within_seconds: float):
        self.span = int(within_seconds * 1_000_000)

    def follow(self, slices):
        open_ = np.asarray(self.state.get()[0] if self.state.exists() else [], np.int64)
        times = np.concatenate([open_, _joined(slices["times"].tolist())])
        marks = np.concatenate([np.ones(len(open_), np.int64), _joined(slices["marks"].tolist())])
        firsts, seconds = np.flatnonzero(marks & 1), np.flatnonzero(marks & 2)
        place = np.searchsorted(seconds, firsts, "right")  # the second row has to come after
        met = place < len(seconds)
        begin = times[firsts[met]]
        end = times[seconds[place[met]]]
        near = end - begin < self.span
        waiting = times[firsts[~met]]
        waiting = waiting[int(slices["slice_end"].iloc[-1]) - waiting < self.span]
        if len(waiting):
            self.state.update((waiting.tolist(),))
        elif len(open_):
            self.state.clear()
        begin, end = begin[near], end[near]
        return {
            "metric_type": ["rapid_fire_pattern"] * len(begin),
            "event_count": np.full(len(begin), 2),
            "window_start": _time(begin),
            "window_end": _time(end),
            "avg_processing_time": (end - begin) / 1000,
        }


class MaxLifeSessions(InSlices):
    """Gives every row the start of its session; a session ends a fixed time after its start.

    One step per session, which finds its last row by binary search.
    """

    template = "user_id {user}, id {id}, ts timestamp, session_start timestamp"
    state_schema = "time_us bigint"

    def __init__(self, life_seconds: float):
        self.life = int(life_seconds * 1_000_000)

    def follow(self, slices):
        start = self.state.get()[0] if self.state.exists() else None
        times = _joined(slices["times"].tolist())
        starts, lengths, place = [], [], 0
        while place < len(times):
            if start is None or times[place] - start > self.life:
                start = int(times[place])
            end = int(np.searchsorted(times, start + self.life, "right"))
            starts.append(start)
            lengths.append(end - place)
            place = end
        self.state.update((start,))
        return {
            "id": [i for ids in slices["ids"] for i in ids],
            "ts": _time(times),
            "session_start": _time(np.repeat(np.array(starts, np.int64), lengths)),
        }


def window_measures(times, numbers, at, span, counted=None) -> dict:
    """Count, sum, mean and deviation of the rows within ``span`` before each time of ``at``.

    ``times`` are sorted, both ends count. A NaN number counts as a row but has no part in sum,
    mean and deviation. ``counted`` says which rows take part, all by default.
    """
    counted = np.ones(len(times), bool) if counted is None else counted
    known = counted & ~np.isnan(numbers)
    # Moved by a whole number, so sums of whole numbers stay whole.
    middle = np.round(numbers[known].mean()) if known.any() else 0.0
    moved = np.where(known, numbers - middle, 0.0)
    low, high = np.searchsorted(times, at - span, "left"), np.searchsorted(times, at, "right")

    def within(values):
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[high] - sums[low]

    count, priced, total, squares = map(within, (counted, known, moved, moved * moved))
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = np.where(priced > 0, total / priced, np.nan)
        spread = np.maximum(squares - priced * mean * mean, 0.0)
        std = np.where(priced > 1, np.sqrt(spread / (priced - 1)), np.nan)
    return {
        "transaction_count_1h": count,
        "total_amount_1h": np.where(priced > 0, total + priced * middle, np.nan),
        "avg_amount_1h": mean + middle,
        "std_amount_1h": std,
    }


def with_nulls(values) -> pd.Series:
    """NaN as null."""
    return pd.Series(values).astype(object).where(~np.isnan(values), None)


class TrailingVelocity(InSlices):
    """Count, sum, mean and deviation of the user's amounts over the trailing span.

    The state holds times and amounts of the last span.
    """

    template = (
        "user_id {user}, transaction_id {id}, timestamp timestamp, merchant_category string, "
        "amount double, transaction_count_1h bigint, total_amount_1h double, "
        "avg_amount_1h double, std_amount_1h double"
    )
    state_schema = "times array<bigint>, numbers array<double>"

    def __init__(self, span_seconds: float):
        self.span = int(span_seconds * 1_000_000)

    def follow(self, slices):
        old = self.state.get() if self.state.exists() else ([], [])
        at = _joined(slices["times"].tolist())
        new = _joined(slices["numbers"].tolist(), np.float64)
        times = np.concatenate([np.asarray(old[0], np.int64), at])
        numbers = np.concatenate([np.asarray(old[1], np.float64), new])
        stays = times >= int(slices["slice_end"].iloc[-1]) - self.span
        self.state.update((times[stays].tolist(), numbers[stays].tolist()))
        found = window_measures(times, numbers, at, self.span)
        return {
            "transaction_id": [i for ids in slices["ids"] for i in ids],
            "timestamp": _time(at),
            "merchant_category": [t for texts in slices["texts"] for t in texts],
            "amount": with_nulls(new),
            "transaction_count_1h": found.pop("transaction_count_1h"),
            **{name: with_nulls(values) for name, values in found.items()},
        }


class UserStatistics(InSlices):
    """Running count, mean amount and session number of a user, one row per batch of slices.

    A slice brings its counts, sums and ends only.
    """

    template = (
        "user_id {user}, last_seen timestamp, event_count bigint, avg_amount double, "
        "session_count bigint"
    )
    state_schema = "n bigint, total decimal(38,10), last_us bigint, sessions bigint"

    def __init__(self, gap_seconds: float):
        self.gap = int(gap_seconds * 1_000_000)

    def follow(self, slices):
        n, total, last, sessions = self.state.get() if self.state.exists() else (0, Decimal(0), None, 0)
        first, end = slices["first"].to_numpy(), slices["last"].to_numpy()
        before = first[1:] - end[:-1] > self.gap
        opens = last is None or first[0] - last > self.gap
        sessions += int(slices["breaks"].sum() + before.sum() + opens)
        n, total = n + int(slices["n"].sum()), sum(slices["total"], total)
        self.state.update((n, total, int(end[-1]), sessions))
        return {
            "last_seen": _time([end[-1]]),
            "event_count": [n],
            "avg_amount": [float(total) / n],
            "session_count": [sessions],
        }


def run_in_slices(
    stream: DataFrame, processor: InSlices, measures, delay="5 seconds", slice=SLICE, time="ts", id="id"
) -> DataFrame:
    """Apply a processor per user to ``measures(rows)`` of every slice.

    ``rows`` is the sorted array of ``at`` (microseconds), ``id``, and ``mark``, ``number`` and
    ``text`` of a slice's rows, as far as the stream has such columns.
    """
    use_rocksdb(stream.sparkSession)
    fields = [F.unix_micros(time).alias("at"), F.col(id).alias("id")]
    fields += [F.col(c) for c in ("mark", "number", "text") if c in stream.columns]
    row = F.struct(*fields)
    if "mark" in stream.columns:
        # Rows without a mark keep the watermark moving but are not collected.
        row = F.when(F.col("mark") > 0, row)
    window = F.window(time, slice)
    sliced = (
        stream.withWatermark(time, delay)
        .groupBy("user_id", window.alias("slice"))
        .agg(F.array_sort(F.collect_list(row)).alias("rows"))
    )
    types = dict(stream.dtypes)
    processor = processor.typed(types["user_id"], types[id])
    summed = sliced.where(F.size("rows") > 0).select(
        "user_id",
        F.unix_micros("slice.start").alias("slice_start"),
        F.unix_micros("slice.end").alias("slice_end"),
        *[c.alias(n) for n, c in measures(F.col("rows")).items()],
    )
    return summed.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=processor.schema,
        outputMode="append",
        timeMode="none",
    )


def every_nth(stream: DataFrame, n=100, delay="5 seconds", slice=SLICE) -> DataFrame:
    return run_in_slices(stream, CountEveryNth(n), lambda rows: {"times": rows["at"]}, delay, slice)


def followed_by(
    stream: DataFrame, first: Column, second: Column, within_seconds=30.0, delay="5 seconds", slice=SLICE
) -> DataFrame:
    """Pattern of two conditions per user; a row that meets both closes and opens."""

    def bit(condition, value):
        return F.when(F.coalesce(condition, F.lit(False)), value).otherwise(0)

    marked = stream.withColumn("mark", bit(first, 1) + bit(second, 2))
    return run_in_slices(
        marked,
        FollowedBy(within_seconds),
        lambda rows: {"times": rows["at"], "marks": rows["mark"]},
        delay,
        slice,
    )


def max_life_sessions(stream: DataFrame, life_seconds=7200.0, delay="5 seconds", slice=SLICE):
    return run_in_slices(
        stream,
        MaxLifeSessions(life_seconds),
        lambda rows: {"times": rows["at"], "ids": rows["id"]},
        delay,
        slice,
    )


def user_statistics(
    stream: DataFrame, gap_seconds=1800.0, number=None, delay="5 seconds", slice=SLICE
) -> DataFrame:
    """Statistics per user; a gap above ``gap_seconds`` starts a session."""
    gap = int(gap_seconds * 1_000_000)
    numbered = stream.withColumn("number", (F.lit(0.0) if number is None else number).cast("double"))

    def measures(rows):
        times = rows["at"]
        gaps = F.zip_with(times, F.slice(times, 2, F.size(times)), lambda a, b: b - a)
        # Summed as decimals, so the mean does not depend on where slices begin.
        zero = F.lit(0).cast(EXACT)
        return {
            "n": F.size(times).cast("long"),
            "first": F.element_at(times, 1),
            "last": F.element_at(times, -1),
            "breaks": F.size(F.filter(gaps, lambda g: g > gap)).cast("long"),
            "total": F.aggregate(
                rows["number"],
                zero,
                lambda total, x: (total + F.coalesce(x.cast(EXACT), zero)).cast(EXACT),
            ),
        }

    return run_in_slices(numbered, UserStatistics(gap_seconds), measures, delay, slice)


def trailing_velocity(
    transactions: DataFrame, span_seconds=3600.0, delay="5 seconds", slice=SLICE
) -> DataFrame:
    """Trailing velocity of every transaction, once, when the watermark has passed it."""
    rows = transactions.select(
        "user_id",
        F.col("timestamp").alias("ts"),
        F.col("transaction_id").alias("id"),
        F.col("merchant_category").cast("string").alias("text"),
        F.col("amount").cast("double").alias("number"),
    )
    not_known = F.lit(float("nan"))
    return run_in_slices(
        rows,
        TrailingVelocity(span_seconds),
        lambda rows: {
            "times": rows["at"],
            "ids": rows["id"],
            "texts": rows["text"],
            "numbers": F.transform(rows["number"], lambda x: F.coalesce(x, not_known)),
        },
        delay,
        slice,
    )
