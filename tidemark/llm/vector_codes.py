"""Vectors as short codes: every part is replaced by the number of its nearest codebook entry.

The nearest entry is found by slicing and intersecting. For each dimension of a part the
entries' coordinates are sorted and carry prefix masks: bit e of mask i says that entry e is
among the first i. The distance to an entry that is close in one coordinate gives an initial
radius; in each dimension two binary searches cut the range within the radius, and the masks at
its ends give the entries in it as one 64-bit number. The AND over the dimensions holds every
entry that can be nearest, and only these are measured. All arithmetic is in integers, so the
result is exact and does not depend on how rows are spread.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rowwise import BROADCAST_ROWS, column
from tidemark.session import cut_lineage

SCALE = 256
# Components above this could overflow a sum of squares of 64 bits.
LARGEST = 1 << 27
ONE = np.uint64(1)
SALTS = 32


class Slices:
    """The entries of one part's codebook, at most 64, ready to be searched."""

    def __init__(self, entries: np.ndarray):
        if not 0 < len(entries) <= 64:
            raise ValueError("a codebook has 1 to 64 entries")
        self.entries = entries
        self.orders, self.sorted, self.masks = [], [], []
        for coordinates in entries.T:
            order = np.argsort(coordinates, kind="stable")
            bits = np.left_shift(ONE, order.astype(np.uint64))
            self.orders.append(order)
            self.sorted.append(coordinates[order])
            self.masks.append(np.concatenate([[np.uint64(0)], np.bitwise_or.accumulate(bits)]))

    def _squares(self, points: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        moved = points - self.entries[chosen]
        return np.einsum("ij,ij->i", moved, moved)

    def radius(self, points: np.ndarray) -> np.ndarray:
        """For each point a radius within which there is an entry: the distance to the best
        of those next to it in one coordinate."""
        least = None
        for order, coordinates, at in zip(self.orders, self.sorted, points.T, strict=True):
            place = np.minimum(np.searchsorted(coordinates, at), len(order) - 1)
            for near in (place, np.maximum(place - 1, 0)):
                squares = self._squares(points, order[near])
                least = squares if least is None else np.minimum(least, squares)
        # Rounded up, since a root of a large number is not exact.
        return np.sqrt(least.astype(np.float64)).astype(np.int64) + 1

    def candidates(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Bit masks of the entries within the radius in every dimension."""
        found = None
        for coordinates, masks, at in zip(self.sorted, self.masks, points.T, strict=True):
            low = masks[np.searchsorted(coordinates, at - radius, "left")]
            inside = masks[np.searchsorted(coordinates, at + radius, "right")] ^ low
            found = inside if found is None else found & inside
        return found

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each point; the lower entry of equally near ones."""
        left = self.candidates(points, self.radius(points))
        best = np.zeros(len(points), np.int64)
        least = np.full(len(points), np.iinfo(np.int64).max)
        rows = np.arange(len(points))
        while len(rows):
            lowest = left & (~left + ONE)
            entry = np.bitwise_count(lowest - ONE).astype(np.int64)
            squares = self._squares(points[rows], entry)
            better = squares < least[rows]
            best[rows[better]], least[rows[better]] = entry[better], squares[better]
            left = left ^ lowest
            more = left != 0
            rows, left = rows[more], left[more]
        return best, least


def whole_numbers(vectors: pa.Array, width: int) -> np.ndarray:
    """Lists of floats as rows of floor(256 x)."""
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(values * SCALE).reshape(-1, width)
    if np.abs(scaled).max(initial=0) > LARGEST:
        raise ValueError(f"a component lies beyond {LARGEST // SCALE}")
    return scaled.astype(np.int64)


def _assign(rows: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance), each rows by parts."""
    parts, _, width = codebooks.shape
    entries = np.zeros((len(rows), parts), np.int64)
    squares = np.zeros((len(rows), parts), np.int64)
    for part, codebook in enumerate(codebooks):
        points = rows[:, part * width : (part + 1) * width]
        entries[:, part], squares[:, part] = Slices(codebook).nearest(points)
    return entries, squares


def _moved(vectors: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks with each entry at the floored mean of the parts nearest to it.

    Every task sums its own rows; one row per entry and task is shuffled, and one per entry,
    as many as the codebooks have, reaches the driver.
    """
    parts, size, width = codebooks.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * size, width + 1), np.int64)
        for batch in batches:
            rows = whole_numbers(batch.column(0), parts * width)
            entries, _ = _assign(rows, codebooks)
            for part in range(parts):
                at = part * size + entries[:, part]
                points = rows[:, part * width : (part + 1) * width]
                np.add.at(sums, at, np.column_stack([np.ones(len(rows), np.int64), points]))
        used = np.flatnonzero(sums[:, 0])
        columns = [pa.array(used), *[pa.array(c) for c in sums[used].T]]
        yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["entry", *[f"s{i}" for i in range(width + 1)]]
    partial = vectors.select("vector").mapInArrow(work, ", ".join(f"{n} long" for n in names))
    total = partial.groupBy("entry").agg(*[F.sum(n).alias(n) for n in names[1:]])
    out = codebooks.reshape(parts * size, width).copy()
    for entry, count, *sums in total.collect():
        out[entry] = [s // count for s in sums]
    return out.reshape(codebooks.shape)


def vector_codes(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of the vectors, and the codebooks.

    The codebooks (parts, entries, position) start as the parts of the ``entries`` smallest
    ids, fewer if there are not so many vectors, and are moved ``rounds`` times. ``code`` holds
    two hex digits per part, ``error`` is the summed squared distance in units of 1/256.

    Rows whose vector is null or holds a null, NaN or infinite component are dropped. The
    others' usual length is the greatest that ``parts`` divides; a vector of another length,
    an empty one too, stays with null code and error and has no part in the codebooks. Rows
    with equal ids are taken in the order of their vectors; null ids come last; repeated rows
    all stay. An empty table gives an empty result. Other columns are not read. A component
    beyond 2^19 is an error, since squared distances could leave 64 bits.
    """
    rows = df.select(
        column(id_col).alias("vec_id"),
        column(vector_col).alias("vector"),
        column(label_col).alias("label"),
    )
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    rows = rows.where(F.col("vector").isNotNull() & finite)
    fits = F.size("vector") % parts == 0
    length = rows.agg(F.max(F.when(fits, F.size("vector")))).first()[0] or 0
    usual = rows.where(F.size("vector") == length)
    first = usual.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries if length else 0)
    start = [r[0] for r in first.select("vector").collect()]  # at most ``entries`` rows
    if not start:
        none = [F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error")]
        return rows.select("vec_id", "label", *none), np.zeros((parts, 0, 0), np.int64)
    whole = whole_numbers(pa.array(start, pa.list_(pa.float64())), length)
    books = whole.reshape(len(start), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = _moved(usual, books)
    kinds = dict(rows.dtypes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = pc.equal(pc.list_value_length(batch.column(1)), length)
            chosen, squares = _assign(
                whole_numbers(batch.column(1).filter(at), length), books
            )
            digits = iter(r.tobytes().hex() for r in chosen.astype(np.uint8))
            errors = iter(squares.sum(axis=1).tolist())
            use = at.to_pylist()
            codes = pa.array([next(digits) if u else None for u in use], pa.string())
            error = pa.array([next(errors) if u else None for u in use], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), codes, error], names=["vec_id", "label", "code", "error"]
            )

    coded = rows.mapInArrow(
        work, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    )
    return coded, books


def with_group_error(coded: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``coded`` with ``label_error``, the error summed over equal labels, nulls together.

    Sums are formed per task first. Up to ``most`` labels are broadcast, so that rows need no
    shuffle; more are joined with salted keys, so that a frequent label spreads over tasks.
    """
    coded = cut_lineage(coded)  # rows are read for the sums and again for the result
    sums = cut_lineage(
        coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    )
    same = F.col("label").eqNullSafe(F.col("_label"))
    if sums.count() <= most:
        return coded.join(F.broadcast(sums), same).drop("_label")
    salted = coded.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
    copies = sums.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = salted.join(copies, same & (F.col("_salt") == F.col("_copy")))
    return joined.drop("_label", "_salt", "_copy")


def codebooks_digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
