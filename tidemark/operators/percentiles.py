"""Exact percentiles with linear interpolation, safe for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.hotkeys import hot_keys, split_hot
from tidemark.operators.running import running
from tidemark.session import cut_lineage


def percentiles(
    df: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]
) -> DataFrame:
    """One row per key with a column per quantile; nulls are ignored.

    The built-in ``percentile`` holds every distinct value of a group in one task, so a
    hot group is counted per distinct value first and ranked through value ranges; only the
    two values around the wanted rank are ever kept.
    """
    known = df.where(F.col(value).isNotNull()).select(*keys, value)

    def plain(part):
        return part.groupBy(*keys).agg(
            *[F.percentile(value, q).alias(name) for name, q in quantiles.items()]
        )

    hot = hot_keys(known, keys)

    def ranked(part):
        counts = cut_lineage(part.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")))
        totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
        upto = running(counts, keys, [value], [("_upto", "sum", F.col("_n"))], hot=hot)
        if keys:
            # At most one row for each of the hot keys.
            upto = upto.join(F.broadcast(totals), keys)
        else:
            upto = upto.withColumn("_total", totals.scalar())
        position = {
            name: (F.col("_total") - 1) * F.lit(float(q)) for name, q in quantiles.items()
        }
        found = upto.groupBy(*keys).agg(
            *[
                F.min(F.when(F.col("_upto") > rounding(position[name]), F.col(value))).alias(
                    f"_{side}_{name}"
                )
                for name in quantiles
                for side, rounding in (("low", F.floor), ("high", F.ceil))
            ],
            F.max("_total").alias("_total"),
        )
        return found.select(*keys, *[_between(n, position[n]) for n in quantiles])

    return split_hot(known, keys, plain, ranked, hot)


def _between(name: str, position: Column) -> Column:
    low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
    part = position - F.floor(position)
    return (low + (high - low) * part).cast("double").alias(name)


def global_percentile(df: DataFrame, value: str, q: float) -> Column:
    """A percentile over all rows as a scalar subquery."""
    return percentiles(df, [], value, {"q": q}).scalar()


def flag_above_percentile(df, value="amount", q=0.95, name="is_high_amount") -> DataFrame:
    """Add whether a row's value lies above the percentile of the whole table."""
    return df.withColumn(name, F.col(value) > global_percentile(df, value, q))
