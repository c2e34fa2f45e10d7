"""Interleave sources by target weights with Pfair windows and earliest deadlines.

Every source is cut into blocks of equal size. Block k of a source with weight w is released
at slot floor(k / w) and due at ceil((k + 1) / w); taking the released block with the earliest
deadline for each slot keeps every source within less than one block of its target at any
time. Weights are integers over a common period, so the order of one period, which depends on
the weights alone, repeats; blocks look their slot up in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.rowwise import column

REST = "(rest)"
BUCKET_ROWS = 20_000


def shares(weights: dict[str, float], period: int) -> dict[str, int]:
    """Whole slots of a period by largest remainder, at least one each."""
    if period < len(weights) or min(weights.values(), default=1) <= 0:
        raise ValueError("weights must be above 0, and the period have a slot for each")
    total = sum(weights.values())
    exact = {k: w / total * period for k, w in weights.items()}
    slots = {k: max(1, int(x)) for k, x in exact.items()}
    by_rest = sorted(exact, key=lambda k: (slots[k] - exact[k], k))
    place = 0
    while sum(slots.values()) != period:
        short = sum(slots.values()) < period
        name = by_rest[place % len(by_rest)] if short else max(slots, key=lambda k: (slots[k] - exact[k], k))
        slots[name] += 1 if short else -1
        place += 1
    return slots


def period_order(slots: dict[str, int]) -> list[tuple[str, int, int]]:
    """(source, block, slot) of one period; ties go to the source named first."""
    period = sum(slots.values())
    taken = dict.fromkeys(slots, 0)
    out = []
    for slot in range(period):
        released = [s for s in slots if taken[s] < slots[s] and taken[s] * period // slots[s] <= slot]
        source = min(released, key=lambda s: -(-(taken[s] + 1) * period // slots[s]))
        out.append((source, taken[source], slot))
        taken[source] += 1
    return out


def mix_sources(
    df: DataFrame,
    weights: dict[str, float],
    period: int = 100,
    block_rows: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``df`` with ``mix_stream``, ``mix_block``, ``mix_slot``, ``mix_position`` and
    ``mix_balanced``; reading the rows by ``mix_position`` mixes the sources.

    Sources that ``weights`` does not name, null among them, form one stream under the key
    ``(rest)``, which gets a hundredth beside the others if it has no weight. Within a stream rows come in the order of the MD5 of
    their id (of the text if the id is null), then id, then text; rows equal in these are
    interchangeable. No row is dropped or repeated: a stream that runs out leaves its later
    slots empty, and ``mix_balanced`` is true for slots before the first empty one. An empty
    table gives an empty result; input columns of the new names are replaced.
    """
    weights = {**weights, REST: weights.get(REST, 0.01 * sum(weights.values()))}
    slots = shares(weights, period)
    spark = df.sparkSession
    named = [s for s in slots if s != REST]
    text_id = column(id_col).cast("string")
    text = column(text_col).cast("string")
    added = ("mix_stream", "mix_block", "mix_slot", "mix_position", "mix_balanced")
    kept = [c for c in df.columns if c not in added]
    rows = df.withColumn(
        "mix_stream", F.when(column(source_col).isin(named), column(source_col)).otherwise(REST)
    ).withColumn("_key", F.md5(F.coalesce(text_id, text, F.lit(""))))

    # At most one count per stream reaches the driver.
    sizes = {r[0]: r[1] for r in rows.groupBy("mix_stream").count().collect()}
    order = period_order(slots)
    slot_of = {(s, k): slot for s, k, slot in order}
    horizon = min(
        (sizes.get(s, 0) // block_rows) // slots[s] * period
        + slot_of[s, (sizes.get(s, 0) // block_rows) % slots[s]]
        for s in slots
    )
    buckets = max(1, -(-max(sizes.values(), default=1) // bucket_rows))

    # Ranges of the key cut a stream into buckets, so a large source spreads over tasks.
    head = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("_bucket", F.floor(head * F.lit(buckets) / F.lit(2**32)).cast("int"))
    counts = rows.groupBy("mix_stream", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("mix_stream").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "mix_stream", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy("mix_stream", "_bucket").orderBy("_key", column(id_col), text)
    placed = rows.join(starts, ["mix_stream", "_bucket"]).withColumn(
        "_ordinal", F.col("_start") + F.row_number().over(within) - 1
    )
    # The period's table has ``period`` rows, a parameter.
    table = spark.createDataFrame(order, "_stream string, _step long, _slot long")
    size = F.create_map(*[F.lit(x) for s in slots for x in (s, slots[s])])[F.col("mix_stream")]
    block = F.floor(F.col("_ordinal") / block_rows)
    placed = placed.withColumn("mix_block", block).withColumn("_size", size.cast("long"))
    joined = placed.join(
        F.broadcast(table),
        (F.col("mix_stream") == F.col("_stream")) & (F.pmod("mix_block", "_size") == F.col("_step")),
    )
    slot = F.floor(F.col("mix_block") / F.col("_size")) * period + F.col("_slot")
    return joined.withColumn("mix_slot", slot).select(
        *[column(c) for c in kept],
        "mix_stream", "mix_block", "mix_slot",
        (F.col("mix_slot") * block_rows + F.pmod("_ordinal", F.lit(block_rows))).alias("mix_position"),
        (F.col("mix_slot") < F.lit(horizon)).alias("mix_balanced"),
    )
