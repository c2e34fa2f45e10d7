"""Detection and separate handling of keys that hold a large share of the rows.

A window over ``partitionBy(user_id)`` puts all rows of a user into one task. That is
fine for almost every user and fatal for one that holds a third of the table. The
operators therefore treat a key as *hot* above ``max(rows / MAX_HOT, min rows)`` and
give hot rows another plan. Because a hot key holds more than ``1 / MAX_HOT`` of the
rows there are never more than ``MAX_HOT`` of them, which bounds the list that comes
to the driver and everything broadcast because of it. Which keys count as hot never
changes a result, only the plan, so the estimate may be approximate.
"""

from __future__ import annotations

import math
import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_HOT = 500
MIN_ROWS_CONF = "spark.tidemark.hot.minRows"
MIN_ROWS = 2_000_000
BUCKETS_CONF = "spark.tidemark.hot.buckets"
BUCKET_ROWS = 2_000_000
MOST_BUCKETS = 10_000
TRACKED = 10_000
ROW_BYTES = 16


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys) if keys else F.lit(0).cast("long")


def hot_keys(df: DataFrame, keys: list[str]) -> list[int]:
    """Hashes of the hot keys, at most ``MAX_HOT``; one column-pruned pass, no shuffle.

    An input whose estimated size one task can hold anyway is not looked at.
    """
    if df.isStreaming:
        return []
    floor = int(df.sparkSession.conf.get(MIN_ROWS_CONF, str(MIN_ROWS)))
    if estimated_bytes(df) < floor * ROW_BYTES:
        return []
    row = (
        df.select(key_hash(keys).alias("h"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.expr(f"approx_top_k(h, {MAX_HOT}, {TRACKED})").alias("top"),
        )
        .first()
    )
    limit = max(row["n"] / MAX_HOT, floor)
    return [item["item"] for item in (row["top"] or []) if item["count"] > limit]


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, the one it decides broadcasts by."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except ValueError:  # joins multiply their estimates; this one has too many digits
        return sys.maxsize


def is_hot(keys: list[str], hot: list[int]) -> Column:
    return key_hash(keys).isin(hot)


def order_number(df: DataFrame, column: str) -> Column | None:
    """A column as a number that never falls where the column rises, null for other types.

    For text these are its first six bytes, by which Spark orders text first.
    """
    kind = dict(df.dtypes)[column]
    if kind.startswith("timestamp"):
        return F.unix_micros(column).cast("double")
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind == "string":
        head = F.hex(F.substring(F.encode(column, "UTF-8"), 1, 6))
        return F.conv(F.rpad(head, 12, "0"), 16, 10).cast("double")
    numeric = kind in ("tinyint", "smallint", "int", "bigint", "float", "double")
    return F.col(column).cast("double") if numeric or kind.startswith("decimal") else None


def with_buckets(df: DataFrame, keys: list[str], hot: list[int], column: str) -> DataFrame:
    """Add ``_bucket``: 0 for ordinary keys, ranges of ``column`` from 1 on for hot ones.

    A hot key gets a bucket for each ``BUCKET_ROWS`` of its rows, up to ``MOST_BUCKETS``. The
    bounds are quantiles of its own values, so its buckets are about equally large whatever
    the values are: times without time of day, shares between 0 and 1, amounts, or text. Rows
    with one value share a bucket.
    """
    number = order_number(df, column)
    if number is None:
        return df.withColumn("_bucket", F.lit(0))
    rows = df.where(is_hot(keys, hot)).select(key_hash(keys).alias("_hash"), number.alias("_number"))
    sizes = rows.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    forced = df.sparkSession.conf.get(BUCKETS_CONF, None)
    wanted = F.lit(int(forced)) if forced else F.ceil(F.col("_n") / BUCKET_ROWS)
    wanted = F.greatest(F.lit(1), F.least(F.lit(MOST_BUCKETS), wanted)).cast("int")
    most = sizes.agg(F.max(wanted)).first()[0] or 1
    sketch = F.percentile_approx(
        "_number", [i / most for i in range(1, most)] or [0.5], max(10_000, 10 * most)
    )
    stride = math.isqrt(most) + 1
    # The largest key uses all quantiles, a smaller one every so many of them.
    step = F.floor(F.lit(most) / wanted)
    bounds = (
        rows.groupBy("_hash")
        .agg(F.count(F.lit(1)).alias("_n"), sketch.alias("_all"))
        .select("_hash", F.array_distinct(F.filter("_all", lambda _, i: (i + 1) % step == 0)).alias("_bounds"))
        .withColumn("_ends", F.filter("_bounds", lambda _, i: i % stride == stride - 1))
    )
    # At most MAX_HOT rows, together about a number for each BUCKET_ROWS of the table.
    known = df.withColumn("_hash", key_hash(keys)).join(F.broadcast(bounds), "_hash", "left")
    # Blocks of bounds are counted by their ends first, so a row looks at two square roots.
    blocks = F.size(F.filter("_ends", lambda end: end < number)) * stride
    below = F.size(F.filter(F.slice("_bounds", blocks + 1, stride), lambda bound: bound < number))
    bucket = F.when(F.col("_bounds").isNull(), 0).otherwise(blocks + below + 1)
    return known.withColumn("_bucket", bucket).drop("_hash", "_bounds", "_ends")


def split_hot(df, keys, plain, hot_plan, hot=None) -> DataFrame:
    """``plain`` for ordinary keys and ``hot_plan`` for hot ones, put together again."""
    if hot is None:
        hot = hot_keys(df, keys)
    if not hot:
        return plain(df)
    if not keys:
        return hot_plan(df)  # all rows are one group
    test = is_hot(keys, hot)
    return plain(df.where(~test)).unionByName(hot_plan(df.where(test)))


def join_unique(df, lookup, keys, how="left", hot=None) -> DataFrame:
    """Join rows to a table that is unique on ``keys``.

    Ordinary rows take the join Catalyst picks from the sizes. Hot rows meet at most
    ``MAX_HOT`` lookup rows, so those are broadcast and the hot rows never shuffle.
    """
    if hot is None:
        hot = hot_keys(df, keys)

    def hot_join(part):
        return part.join(F.broadcast(lookup.where(is_hot(keys, hot))), keys, how)

    return split_hot(df, keys, lambda part: part.join(lookup, keys, how), hot_join, hot)
