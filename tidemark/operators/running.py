"""Running aggregates per key in an order, safe for keys of any size.

Ordinary keys use a plain Spark window. With hot keys there is still one plan for all rows,
a window per key and bucket: ordinary keys have one bucket, a hot key is cut into ranges of
the order by quantiles of its own values. One summary row per bucket of a hot key carries the
state on and is joined back; there is never one per input row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.hotkeys import hot_keys, with_buckets
from tidemark.session import cut_lineage

_AGG = {
    "sum": F.sum,
    "count": F.count,
    "max": F.max,
    "min": F.min,
    "last": lambda c: F.last(c, ignorenulls=True),
}


def _merge(kind, carried, local):
    if kind in ("sum", "count"):
        return F.when(carried.isNull(), local).when(local.isNull(), carried).otherwise(
            carried + local
        )
    if kind == "max":
        return F.greatest(carried, local)
    if kind == "min":
        return F.least(carried, local)
    return F.coalesce(local, carried)


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    specs: list[tuple[str, str, Column]],
    inclusive: bool = True,
    peers: bool = False,
    reverse: bool = False,
    hot: list[int] | None = None,
) -> DataFrame:
    """Add one column per ``(name, kind, column)`` aggregated from the first row to here.

    ``inclusive=False`` leaves the current row out; ``peers=True`` takes all rows that
    tie on ``order`` in; ``reverse=True`` runs from the last row backwards. ``last`` skips
    nulls. With hot keys the input is checkpointed once, since bounds, summaries and rows
    are taken from it.
    """
    if hot is None:
        hot = hot_keys(df, keys)
    direction = F.desc if reverse else F.asc
    ordering = [direction(c) for c in order]

    def over(partition):
        window = W.partitionBy(*(partition or [F.lit(0)])).orderBy(*ordering)
        if peers:
            return window.rangeBetween(W.unboundedPreceding, W.currentRow)
        return window.rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)

    if not hot:
        window = over(keys)
        return df.withColumns({n: _AGG[k](c).over(window) for n, k, c in specs})

    part = with_buckets(cut_lineage(df), keys, hot, order[0])
    local = over([*keys, "_bucket"])
    rows = part.withColumns({f"_l_{n}": _AGG[k](c).over(local) for n, k, c in specs})
    newest = F.min_by if reverse else F.max_by
    position = F.struct(*order)
    totals = part.where("_bucket > 0").groupBy(*keys, "_bucket").agg(
        *[
            (
                newest(c, F.when(c.isNotNull(), position))
                if k == "last"
                else _AGG[k](c)
            ).alias(f"_t_{n}")
            for n, k, c in specs
        ]
    )
    earlier = (
        W.partitionBy(*(keys or [F.lit(0)]))
        .orderBy(direction("_bucket"))
        .rowsBetween(W.unboundedPreceding, -1)
    )
    # A running count carries on as a sum of the bucket counts.
    carry = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_bucket").alias("_k_bucket"),
        *[
            (_AGG["sum"] if k == "count" else _AGG[k])(F.col(f"_t_{n}"))
            .over(earlier)
            .alias(f"_c_{n}")
            for n, k, _ in specs
        ],
    )
    same = F.col("_bucket").eqNullSafe(F.col("_k_bucket"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    # A bounded number: hot keys times buckets.
    joined = rows.join(F.broadcast(carry), same, "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[
            _merge(k, F.col(f"_c_{n}"), F.col(f"_l_{n}")).alias(n)
            for n, k, _ in specs
        ],
    )


def previous(df, keys, order, columns, hot=None, reverse=False):
    """Add the previous (or with ``reverse`` the next) known value of each column."""
    specs = [(name, "last", F.col(column)) for name, column in columns.items()]
    return running(
        df, keys, order, specs, inclusive=False, reverse=reverse, hot=hot
    )
