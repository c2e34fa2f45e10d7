"""Point-in-time joins of feature views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.hotkeys import hot_keys, join_unique
from tidemark.operators.sequences import newest_per_key
from tidemark.operators.running import running


def as_of_join(
    entities: DataFrame,
    view: DataFrame,
    key: str,
    features: list[str],
    ttl: str,
    time="event_timestamp",
    id_column="row_id",
) -> DataFrame:
    """For every entity row the newest feature row of its key not after its time.

    A feature row older than ``ttl`` (or exactly that old) does not count: its columns
    come out null. Both sides go through one ordered pass, so the cost does not depend on
    how many feature rows precede an entity row. ``id_column`` identifies entity rows and
    ``view`` holds one row per key and time.
    """
    value = F.struct(F.col(time).alias("_at"), *features)
    left = entities.select(
        key, time, F.lit(1).alias("_kind"), F.struct(*entities.columns).alias("_row"),
        F.lit(None).cast(view.select(value.alias("v")).schema["v"].dataType).alias("_feature"),
        F.col(id_column).alias("_id"),
    )
    right = view.select(
        key, time, F.lit(0).alias("_kind"),
        F.lit(None).cast(left.schema["_row"].dataType).alias("_row"),
        value.alias("_feature"),
        F.lit(None).cast(left.schema["_id"].dataType).alias("_id"),
    )
    ordered = running(
        left.unionByName(right),
        [key],
        [time, "_kind", "_id"],
        [("_newest", "last", F.col("_feature"))],
        # A key is hot by the rows of either side, without putting them together first.
        hot=sorted({*hot_keys(entities, [key]), *hot_keys(view, [key])}),
    )
    fresh = F.col("_newest._at") > F.col(time) - F.expr(f"INTERVAL {ttl}")
    return ordered.where(F.col("_kind") == 1).select(
        "_row.*",
        *[F.when(fresh, F.col(f"_newest.{f}")).alias(f) for f in features],
    )


def online_lookup(entities: DataFrame, view: DataFrame, key: str, time="event_timestamp"):
    """Newest features of every entity row; null where the view does not know the key."""
    newest = newest_per_key(view, [key], [time]).drop(time)
    return join_unique(entities, newest, [key])


def materialize_latest(view: DataFrame, key: str, start, end, time="event_timestamp"):
    """Newest feature row per key within [start, end]: the online table."""
    inside = view.where(
        F.col(time).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    )
    return newest_per_key(inside, [key], [time])
