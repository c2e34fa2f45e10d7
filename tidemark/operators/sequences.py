"""Operators over rows in time order per key: lags, sessions, patterns, velocity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.numbers import (
    safe_ratio,
    zscore_clipped,
    zscore_or_zero,
    zscore_relative,
)
from tidemark.functions.times import hours_between, seconds_between
from tidemark.operators.hotkeys import hot_keys, join_unique
from tidemark.operators.running import previous, running
from tidemark.session import cut_lineage


UNITS = 1_000_000.0  # amounts are summed in millionths,
DIGITS = 14  # or in larger units, so that the largest amount has so many digits


def newest(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The newest ``n`` rows per key. ``order`` must be unique within a key.

    Spark limits each map task to ``n`` rows per key before the shuffle, so a hot key
    costs no more than ``n`` rows per task.
    """
    window = W.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") <= n)
        .drop("_rank")
    )


def newest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key; also removes duplicates of a key, keeping the last one."""
    return newest(df, keys, order, 1)


def hours_since_previous(
    df, key="user_id", time="timestamp", tie="transaction_id", first=24.0, hot=None
):
    """hours_since_last_transaction: hours to the key's previous row, ``first`` without one."""
    out = previous(df, [key], [time, tie], {"_before": time}, hot=hot)
    hours = F.coalesce(hours_between(time, "_before"), F.lit(float(first)))
    return out.withColumn("hours_since_last_transaction", hours).drop("_before")


def acceleration(df, key="user_id", time="timestamp", tie="transaction_id", hot=None):
    """Change of the (filled) hours since the previous row; 0 for the first row."""
    hot = hot_keys(df, [key]) if hot is None else hot
    hours = hours_since_previous(df, key, time, tie, hot=hot)
    out = previous(
        hours, [key], [time, tie], {"_hours": "hours_since_last_transaction"}, hot=hot
    )
    change = F.col("hours_since_last_transaction") - F.col("_hours")
    return out.withColumn(
        "transaction_acceleration", F.coalesce(change, F.lit(0.0))
    ).drop("_hours")


def days_since_previous(df, key="user_id", time="timestamp", tie="transaction_id", hot=None):
    """Calendar days to the key's previous row, null for the first."""
    out = previous(df, [key], [time, tie], {"_before": time}, hot=hot)
    return out.withColumn(
        "days_since_last_transaction", F.datediff(time, "_before").cast("long")
    ).drop("_before")


def velocity(
    df: DataFrame,
    spans: dict[str, int],
    key="user_id",
    time="timestamp",
    tie="transaction_id",
    amount="amount",
    member="merchant_id",
) -> DataFrame:
    """Trailing count, sum, mean, deviation and distinct members per span, ends included.

    ``spans`` maps a suffix to seconds. Every row enters a trailing window at its time
    and leaves it one span later, so each measure is a running sum over entries and
    exits: the cost grows with the rows, not with rows times window length. Sums run
    over whole millionths and are therefore exact; finer amounts are rounded to them. In a
    table with amounts above 10^8 the unit grows with the largest, which keeps 14 digits. A
    row without an amount, or with one that is no finite number, counts as a transaction, but
    not in total, mean and deviation; these are null while no amount is known. A member counts as long as its newest
    occurrence is inside the span.
    """
    number = F.col(amount).cast("double")
    finite = ~F.isnan(number) & (F.abs(number) != float("inf"))
    largest = df.agg(F.max(F.when(finite, F.abs(number)))).scalar()
    shrunk = F.pow(F.lit(10.0), DIGITS - F.ceil(F.log10(largest)))
    scale = F.when(largest > 10.0 ** DIGITS / UNITS, shrunk).otherwise(UNITS)
    units = F.when(finite, F.round(number * scale)).cast("decimal(19,0)")
    pair = [key, member]
    hot, hot_pairs = hot_keys(df, [key]), hot_keys(df, pair)
    # Rows placed by user serve the windows per user and member as well: one shuffle.
    placed = df if hot or hot_pairs else df.repartition(key)
    rows = previous(placed, pair, [time, tie], {"_before": time}, hot=hot_pairs)
    rows = previous(rows, pair, [time, tie], {"_after": time}, hot=hot_pairs, reverse=True)
    rows = rows.withColumn("_units", units)
    micros = F.unix_micros(time)
    known = F.col(member).isNotNull()

    def change(when_in, sign, suffix, seconds):
        span = F.lit(seconds * 1_000_000)
        if sign > 0:
            gap = micros - F.unix_micros("_before")
        else:
            gap = F.unix_micros("_after") - micros
        alone = known & (gap.isNull() | (gap > span))
        exact = F.col("_units")
        none = F.lit(0).cast("decimal(38,0)")
        priced = when_in & F.col("_units").isNotNull()
        return [
            F.when(when_in, sign).otherwise(0).cast("long").alias(f"_n_{suffix}"),
            F.when(priced, sign).otherwise(0).cast("long").alias(f"_m_{suffix}"),
            F.when(priced, exact * sign).otherwise(none).cast("decimal(28,0)").alias(f"_s_{suffix}"),
            F.when(priced, exact * exact * sign).otherwise(none).cast("decimal(38,0)").alias(f"_q_{suffix}"),
            F.when(when_in & alone, sign).otherwise(0).cast("long").alias(f"_d_{suffix}"),
        ]

    def moment(kind, at, own_suffix):
        """Entry (kind 0) changes every span, an exit (kind 1) only its own."""
        changes = []
        for suffix, seconds in spans.items():
            applies = F.lit(kind == 0 or suffix == own_suffix)
            changes += change(applies, 1 if kind == 0 else -1, suffix, seconds)
        row = F.struct(*df.columns) if kind == 0 else F.lit(None)
        return F.struct(at.alias("_at"), F.lit(kind).alias("_kind"), row.alias("_row"), *changes)

    moments = [moment(0, F.col(time), None)]
    for suffix, seconds in spans.items():
        leave = F.timestamp_micros(micros + F.lit(seconds * 1_000_000))
        moments.append(moment(1, leave, suffix))
    flat = rows.select(key, F.explode(F.array(*moments)).alias("m")).select(key, "m.*")
    sums = [
        (f"{letter}_{suffix}", "sum", F.col(f"_{letter}_{suffix}"))
        for suffix in spans
        for letter in "nmsqd"
    ]
    done = running(flat, [key], ["_at", "_kind"], sums, peers=True, hot=hot).where(
        F.col("_kind") == 0
    )
    measures = []
    for suffix in spans:
        n, known = F.col(f"n_{suffix}"), F.col(f"m_{suffix}")
        total = F.when(known > 0, F.col(f"s_{suffix}").cast("double"))
        # m q - s s over whole numbers, so equal amounts have exactly no spread; in doubles
        # where that has more than 38 digits.
        whole, squares = F.col(f"s_{suffix}").try_cast("decimal(19,0)"), F.col(f"q_{suffix}")
        exact = F.try_subtract(F.try_multiply(known.cast("decimal(19,0)"), squares), whole * whole)
        rough = known * squares.cast("double") - total * total
        spread = F.greatest(F.coalesce(exact.cast("double"), rough), F.lit(0.0))
        deviation = F.sqrt(F.try_divide(spread, (known * (known - 1)).cast("double")))
        measures += [
            n.alias(f"transaction_count_{suffix}"),
            (total / scale).alias(f"total_amount_{suffix}"),
            (total / scale / known).alias(f"avg_amount_{suffix}"),
            (deviation / scale).alias(f"std_amount_{suffix}"),
            F.col(f"d_{suffix}").alias(f"unique_merchants_{suffix}"),
        ]
    return done.select("_row.*", *measures)


SPANS = {"1h": 3600, "24h": 86400, "7d": 604800}


def amount_zscores(df: DataFrame, key="user_id", amount="amount", hot=None) -> DataFrame:
    """The three z-score forms of an amount within its user."""
    stats = df.groupBy(key).agg(
        F.avg(amount).alias("_mean"), F.stddev(amount).alias("_std")
    )
    return (
        join_unique(df, stats, [key], hot=hot)
        .withColumns(
            {
                "amount_zscore": zscore_clipped(amount, "_mean", "_std"),
                "amount_zscore_or_zero": zscore_or_zero(amount, "_mean", "_std"),
                "amount_zscore_relative": zscore_relative(amount, "_mean"),
            }
        )
        .drop("_mean", "_std")
    )


def running_market(ticks: DataFrame, symbol="symbol", time="timestamp", tie="tick_id"):
    """Running high, low and volume per symbol and day."""
    days = ticks.withColumn("trade_date", F.to_date(time))
    return running(
        days,
        [symbol, "trade_date"],
        [time, tie],
        [
            ("high", "max", F.col("price")),
            ("low", "min", F.col("price")),
            ("total_volume", "sum", F.col("volume")),
        ],
    )


def price_changes(ticks: DataFrame, symbol="symbol", time="timestamp", tie="tick_id"):
    """Change and percent change against the symbol's previous tick; null for its first."""
    out = previous(ticks, [symbol], [time, tie], {"_price": "price"})
    change = F.col("price") - F.col("_price")
    return out.withColumns(
        {
            "change": F.round(change, 2),
            "change_percent": F.round(safe_ratio(change * 100, "_price"), 4),
        }
    ).drop("_price")


def gap_sessions(
    df: DataFrame, gap_seconds: float, key="user_id", time="ts", tie="id"
) -> DataFrame:
    """Sessions per key that end when no row follows within the gap (equal to it still does)."""
    hot = hot_keys(df, [key])
    rows = previous(
        df.select(key, time, tie), [key], [time, tie], {"_before": time}, hot=hot
    )
    gap = seconds_between(time, "_before")
    starts = gap.isNull() | (gap > F.lit(float(gap_seconds)))
    marked = running(
        rows, [key], [time, tie], [("_start", "max", F.when(starts, F.col(time)))], hot=hot
    )
    return (
        marked.groupBy(key, F.col("_start").alias("window_start"))
        .agg(F.count(F.lit(1)).alias("event_count"), F.max(time).alias("window_end"))
        .select(
            key,
            F.lit("session").alias("metric_type"),
            "event_count",
            "window_start",
            "window_end",
        )
    )


def every_nth(df: DataFrame, n=100, key="user_id", time="ts", tie="id") -> DataFrame:
    """The key's running count at its n-th, 2n-th, ... row."""
    counted = running(
        df, [key], [time, tie], [("event_count", "count", F.lit(1))]
    )
    return counted.where(F.col("event_count") % n == 0).select(
        key,
        F.lit("user_event_count").alias("metric_type"),
        "event_count",
        F.col(time).alias("window_start"),
    )


def followed_by(
    df: DataFrame,
    first: Column,
    second: Column,
    within_seconds: float,
    key="user_id",
    time="ts",
    tie="id",
) -> DataFrame:
    """Each ``first`` row with the key's next later ``second`` row less than the bound away.

    Other rows may lie between. A row that is both cannot match itself, and several
    first rows may share one second row.
    """
    yes = F.lit(True)
    marked = df.select(
        key,
        time,
        tie,
        F.coalesce(first, F.lit(False)).alias("_first"),
        F.coalesce(second, F.lit(False)).alias("_second"),
    ).where(F.col("_first") | F.col("_second"))
    paired = running(
        marked,
        [key],
        [time, tie],
        [("_next", "last", F.when(F.col("_second") == yes, F.col(time)))],
        inclusive=False,
        reverse=True,
    )
    gap = seconds_between("_next", time)
    return paired.where(F.col("_first") & (gap < F.lit(float(within_seconds)))).select(
        key,
        F.lit("rapid_fire_pattern").alias("metric_type"),
        F.lit(2).cast("long").alias("event_count"),
        F.col(time).alias("window_start"),
        F.col("_next").alias("window_end"),
        (gap * 1000).alias("avg_processing_time"),
    )


def held_for(
    df: DataFrame, condition: Column, seconds: float, keys: list[str], time="ts", tie="id"
) -> DataFrame:
    """Unbroken stretches per key in which the condition held for at least ``seconds``."""
    marked = df.withColumn("_holds", F.coalesce(condition, F.lit(False)))
    counted = running(
        marked,
        keys,
        [time, tie],
        [("_breaks", "count", F.when(~F.col("_holds"), F.lit(1)))],
    )
    return (
        counted.where(F.col("_holds"))
        .groupBy(*keys, "_breaks")
        .agg(
            F.min(time).alias("started_at"),
            F.max(time).alias("last_seen_at"),
            F.count(F.lit(1)).alias("samples"),
        )
        .drop("_breaks")
        .where(seconds_between("last_seen_at", "started_at") >= F.lit(float(seconds)))
    )




def fixed_life_sessions(
    df: DataFrame, life_seconds=7200.0, key="user_id", time="ts", hot=None
) -> DataFrame:
    """Add ``session_start``: a session takes all rows up to a fixed time after its first row.

    Where a session starts depends on the one before it. A row after a gap longer than the
    life starts one in any case. Every time points to the first time more than a life later,
    where the next session would start; following these pointers by doubling, a chain of n
    sessions takes log n rounds, over rows spread by key and time, so a user with very many
    rows is spread too. Rows without a time have no session; a null key is a key like others.
    """
    hot = hot_keys(df, [key]) if hot is None else hot
    life = F.lit(int(life_seconds * 1_000_000))
    times = cut_lineage(
        df.where(F.col(time).isNotNull())
        .select(F.col(key).alias("_key"), F.unix_micros(time).alias("_at"))
        .distinct()
    )
    known = previous(times, ["_key"], ["_at"], {"_before": "_at"}, hot=hot)
    begins = F.coalesce(F.col("_at") - F.col("_before") > life, F.lit(True))
    known = cut_lineage(known.select("_key", "_at", begins.alias("_begins")))

    marks = known.select(
        "_key", "_at", F.lit(0).alias("_kind"), F.struct("_at", "_begins").alias("_found")
    ).unionByName(
        known.select("_key", (F.col("_at") + life).alias("_at"), F.lit(1).alias("_kind")),
        allowMissingColumns=True,
    )
    ahead = previous(marks, ["_key"], ["_at", "_kind"], {"_next": "_found"}, hot=hot, reverse=True)
    # A start that is certain needs no pointer to it.
    current = cut_lineage(
        ahead.where("_kind = 1 AND NOT _next._begins").select(
            "_key", (F.col("_at") - life).alias("_at"), F.col("_next._at").alias("_next")
        )
    )
    starts = known.where("_begins").select("_key", "_at")
    while True:
        step = current.select(F.col("_key").alias("_k"), F.col("_at").alias("_a"), F.col("_next").alias("_n"))
        same = F.col("_key").eqNullSafe(F.col("_k"))
        found = starts.join(step, same & (F.col("_at") == F.col("_a")))
        found = cut_lineage(found.select("_key", F.col("_n").alias("_at")))
        if found.isEmpty():
            break
        starts = starts.unionByName(found)
        twice = current.join(step, same & (F.col("_next") == F.col("_a")))
        current = cut_lineage(twice.select("_key", "_at", F.col("_n").alias("_next")))

    rows = df.select(
        F.col(key).alias("_key"), F.unix_micros(time).alias("_at"), F.lit(1).alias("_kind"),
        F.struct(*df.columns).alias("_row"),
    )
    heads = starts.select("_key", "_at", F.lit(0).alias("_kind"), F.col("_at").alias("_start"))
    ordered = running(
        rows.unionByName(heads, allowMissingColumns=True),
        ["_key"], ["_at", "_kind"], [("_newest", "last", F.col("_start"))], hot=hot,
    )
    start = F.when(F.col("_at").isNotNull(), F.timestamp_micros("_newest"))
    return ordered.where("_kind = 1").select("_row.*", start.alias("session_start"))
