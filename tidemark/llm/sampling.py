"""Bounded samples for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

UNITS = 2**31


def sample_each(df: DataFrame, keys: list[str], order: str, each: int, most: int) -> DataFrame:
    """At most ``each`` rows of each key, and of no more than ``most`` keys, the largest.

    Rows with the smallest places of a hash, column ``order``, are taken. The sizes of the
    keys, ``most`` rows, say how small a place must be, so only a little more than the sample
    reaches the ranking, however many rows a key has.
    """
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    largest = sizes.orderBy(F.desc("_n"), *keys).limit(most)
    place = F.pmod(F.col(order), F.lit(UNITS))
    wanted = F.least(F.lit(1.0), (F.lit(1.5 * each + 50)) / F.col("_n"))
    near = df.join(F.broadcast(largest), keys).where(place < wanted * UNITS)
    rank = Window.partitionBy(*keys).orderBy(place, order)
    return near.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= each).drop("_n")
