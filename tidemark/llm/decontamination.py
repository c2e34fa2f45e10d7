"""Benchmark passages in documents, found by the q-gram lemma and confirmed by alignment.

Items are cut into overlapping windows. A window of m characters that occurs with at most k
edits shares at least m + 1 - q - k * q of its q-grams with the text, on diagonals that lie at
most k apart. Shared q-grams are counted in overlapping bands of diagonals; regions below the
bound are discarded, the others are verified by banded alignment.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.rowwise import column, drop_rows, fresh, in_pieces, limit_batches

BASE = np.uint64(0x9E3779B97F4A7C15)
BITS = 22


@dataclass
class Settings:
    """A leak is any window of ``window`` characters of an item (the whole item if shorter)
    that occurs within ``rate`` edits per character. So a verbatim part of ``window``
    characters is always found, wherever it starts, and of a shorter item all but the budget's
    edits. Items of fewer than ``least`` characters, or shorter than a q-gram, identify nothing
    and are not searched. ``block_chars`` bounds how much of the benchmark is searched in one
    pass."""

    window: int = 100
    rate: float = 0.08
    q: int = 10
    least: int = 10
    block_chars: int = 4_000_000


CHUNK = 256  # windows of an item that are aligned together


def normalised(text: str | None) -> str:
    """Lower case, white space collapsed."""
    return " ".join(text.lower().split()) if text else ""


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def grams_of(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q characters from each place on, by doubling."""
    if q == 1:
        return codes
    if q % 2:
        return grams_of(codes, q - 1)[:-1] * BASE + codes[q - 1 :]
    half = grams_of(codes, q // 2)
    power = np.uint64(pow(int(BASE), q // 2, 2**64))
    return half[: len(half) - q // 2] * power + half[q // 2 :]


def edit_budget(m: int, settings: Settings) -> int:
    """Edits allowed in a window, few enough for the lemma to ask for a q-gram."""
    return max(0, min(int(settings.rate * m), (m - settings.q) // settings.q))


def window_starts(size: int, settings: Settings) -> range:
    return range(max(size - settings.window, 0) + 1)


class Index:
    """The q-grams of a block of items with their places."""

    def __init__(self, items: list[str], settings: Settings):
        self.settings = settings
        self.items = items
        hashes, item, place = [np.zeros(0, np.uint64)], [], []
        for number, text in enumerate(items):
            if len(text) >= max(settings.least, settings.q):
                own = grams_of(codes_of(text), settings.q)
                hashes.append(own)
                item.append(np.full(len(own), number))
                place.append(np.arange(len(own)))
        flat = np.concatenate(hashes)
        order = np.argsort(flat, kind="stable")
        self.keys, first = np.unique(flat[order], return_index=True)
        self.first = np.append(first, len(flat))
        empty = [np.zeros(0, np.int64)]
        self.item = np.concatenate(item or empty)[order].astype(np.int64)
        self.place = np.concatenate(place or empty)[order].astype(np.int64)
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[self._slot(self.keys)] = True
        sizes = {min(settings.window, len(text)) for text in items if len(text) >= max(settings.least, settings.q)}
        self.least_hits = min(map(self.bound, sizes), default=1)
        self.longest = max(sizes, default=0)
        self.slack = max(1, edit_budget(self.longest, settings))

    @staticmethod
    def _slot(hashes):
        return (hashes * BASE >> np.uint64(64 - BITS)).astype(np.int64)

    def bound(self, m: int) -> int:
        q = self.settings.q
        return max(1, m + 1 - q - edit_budget(m, self.settings) * q)

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item number, start, end, edits) of the first leaking window of each item that
        leaks into a normalised text; start and end count its characters."""
        q = self.settings.q
        if len(text) < q or not len(self.keys):
            return []
        codes = codes_of(text)
        hashes = grams_of(codes, q)
        hits = np.flatnonzero(self.seen[self._slot(hashes)])
        if len(hits) < self.least_hits:
            return []
        at = np.searchsorted(self.keys, hashes[hits])
        at[at == len(self.keys)] = 0
        real = self.keys[at] == hashes[hits]
        hits, at = hits[real], at[real]
        # Hits without enough others within the reach of a window cannot count.
        reach = self.longest + self.slack
        ahead = np.searchsorted(hits, hits + reach, side="right") - np.arange(len(hits))
        dense = np.zeros(len(hits) + 1, np.int64)
        starts = np.flatnonzero(ahead >= self.least_hits)
        np.add.at(dense, starts, 1)
        np.add.at(dense, starts + ahead[starts], -1)
        near = np.cumsum(dense)[:-1] > 0
        hits, at = hits[near], at[near]
        if not len(hits):
            return []
        sizes = self.first[at + 1] - self.first[at]
        offsets = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        entry = np.repeat(self.first[at], sizes) + offsets
        item, place = self.item[entry], self.place[entry]
        diagonal = np.repeat(hits, sizes) - place
        # Bands are two widths wide and overlap by one, so a diagonal lies in two of them.
        width = self.slack + 1
        band = diagonal // width
        shift = int(band.min()) - 1
        span = int(band.max()) - shift + 2
        key = np.concatenate([item * span + band - shift, item * span + band - 1 - shift])
        keys, owner, counts = np.unique(key, return_inverse=True, return_counts=True)
        twice = np.concatenate([place, place])
        rich = counts >= self.least_hits
        order = np.flatnonzero(rich[owner])
        order = order[np.argsort(owner[order], kind="stable")]
        found: dict[int, tuple[int, int, int, int]] = {}
        edges = np.flatnonzero(np.diff(owner[order], prepend=-1, append=-1))
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            number, low = divmod(int(keys[owner[order[a]]]), span)
            if number not in found:
                places = np.unique(twice[order[a:b]])
                match = self._verify(text, codes, number, (low + shift) * width, places)
                if match:
                    found[number] = (number, *match)
        return [found[n] for n in sorted(found)]

    def _verify(self, text, codes, number, diagonal, places):
        """(start, end, edits) of the first window of the item with enough q-grams in the
        band from ``diagonal`` on that aligns within its budget."""
        item, q = self.items[number], self.settings.q
        span = 2 * (self.slack + 1)
        m = min(self.settings.window, len(item))
        budget = edit_budget(m, self.settings)
        starts = np.array(window_starts(len(item), self.settings))
        inside = np.searchsorted(places, starts + m - q, "right") - np.searchsorted(places, starts)
        starts = starts[inside >= self.bound(m)]
        lows = np.maximum(starts + diagonal - budget, 0)
        highs = np.minimum(starts + m + diagonal + span + budget, len(text))
        whole = codes_of(item)
        for first in range(0, len(starts), CHUNK):
            part = slice(first, first + CHUNK)
            patterns = whole[starts[part, None] + np.arange(m)]
            most = fewest_edits(patterns, codes, lows[part], highs[part], span + 2 * budget)
            near = np.flatnonzero(most <= budget)
            if len(near):
                start, low, high = (int(v[part][near[0]]) for v in (starts, lows, highs))
                exact = text.find(item[start : start + m], low, high)
                if exact >= 0:
                    return exact, exact + m, 0
                pattern, region = whole[start : start + m], codes[low:high]
                edits, end = banded(pattern, region, span + 2 * budget, anchored=False)
                back = region[:end][::-1]
                _, length = banded(pattern[::-1], back, budget, anchored=True)
                return low + end - length, low + end, edits
        return None


def fewest_edits(patterns, codes, lows, highs, width):
    """For each pattern, a row, the fewest edits that turn it into a stretch of its region
    ``codes[low:high]``, in a band of ``width`` to both sides; all rows are aligned together."""
    count, m = patterns.shape
    steps = np.arange(2 * width + 1, dtype=np.int32)
    columns = steps - width
    sizes = np.maximum(highs - lows, 0)[:, None].astype(np.int32)
    place = np.arange(m + 2 * width + 1) - width
    known = (place >= 0) & (place < sizes)
    padded = np.where(known, codes[np.clip(lows[:, None] + place, 0, len(codes) - 1)], np.iinfo(np.uint64).max)
    far = np.int32(1 << 20)
    cost = np.where((columns < 0) | (columns > sizes), far, np.int32(0))
    beyond = np.full((count, 1), far)
    for row in range(m):
        ends = row + 1 + columns
        outside = ends > sizes
        taken = cost + (padded[:, row : row + len(steps)] != patterns[:, row, None])
        taken[outside | (ends < 1)] = far
        skipped = np.concatenate([cost[:, 1:], beyond], axis=1) + np.int32(1)
        cost = np.minimum.accumulate(np.minimum(taken, skipped) - steps, axis=1) + steps
        cost[outside | (ends < 0)] = far
    return cost.min(axis=1)


def banded(pattern, text, width, anchored):
    """Fewest edits that turn the pattern into a stretch of the text, and the stretch's end.

    Only cells whose column exceeds their row by ``-width`` to ``width`` are computed. The
    stretch starts anywhere, or at the text's start if ``anchored``.
    """
    steps = np.arange(2 * width + 1)
    padded = np.full(len(pattern) + 2 * width + 1, np.iinfo(np.uint64).max, np.uint64)
    known = min(len(text), len(padded) - width)
    padded[width : width + known] = text[:known]
    columns = steps - width
    far = 1 << 30
    cost = np.where(columns < 0, far, columns if anchored else 0)
    cost = np.where(columns > len(text), far, cost)
    for row, symbol in enumerate(pattern):
        taken = cost + (padded[row : row + 2 * width + 1] != symbol)
        taken[row + 1 + columns > len(text)] = far
        taken[row + 1 + columns < 1] = far
        skipped = np.append(cost[1:], far) + 1
        cost = np.minimum(taken, skipped)
        cost = np.minimum.accumulate(cost - steps) + steps
        cost[(row + 1 + columns > len(text)) | (row + 1 + columns < 0)] = far
    best = int(cost.argmin())
    return int(cost[best]), len(pattern) + int(columns[best])


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    settings: Settings | None = None,
) -> DataFrame:
    """One row for each document and item that leaks into it: the document's id, ``item``,
    ``start``, ``end`` (in the normalised text) and ``edits`` of the first leaking window.

    Whole texts are searched. Texts that are null, empty or shorter than a q-gram have no
    leaks, nor have null or short items. Repeated documents and items give repeated rows.
    An empty table on either side gives an empty result. Different texts of the benchmark are
    searched in blocks of bounded size, one pass over the documents for each; the ids of items
    are joined to what was found. Other columns are not read.
    """
    settings = settings or Settings()
    items = benchmark.select(
        column(item_id_col).alias("item"), column(item_text_col).cast("string").alias("_text")
    ).where(F.col("_text").isNotNull()).withColumn("_item", F.sha2("_text", 256))
    different = items.groupBy("_item").agg(F.min("_text").alias("_text"))
    source = docs.select(column(id_col).alias("doc_id"), column(text_col).cast("string").alias("_text"))
    size = different.agg(F.sum(F.length("_text"))).first()[0] or 0
    blocks = max(1, -(-size // settings.block_chars))
    schema = StructType(
        [
            source.schema["doc_id"],
            items.schema["_item"],
            *[StructField(n, LongType()) for n in ("start", "end", "edits")],
        ]
    )

    def search(block: int) -> DataFrame:
        part = different.where(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == block)
        found = part.toArrow().combine_chunks()
        numbers = found.column("_item").combine_chunks()
        texts = [normalised(t) for t in found.column("_text").to_pylist()]
        shared = docs.sparkSession.sparkContext.broadcast(Index(texts, settings))

        def work(batches):
            index = shared.value
            for batch in in_pieces(batches):
                rows = [
                    (row, *leak)
                    for row, text in enumerate(batch.column(1).to_pylist())
                    for leak in index.find(normalised(text))
                ]
                at, item, start, end, edits = (
                    pa.array([r[k] for r in rows], pa.int64()) for k in range(5)
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), numbers.take(item), start, end, edits],
                    names=schema.names,
                )

        return limit_batches(source).mapInArrow(work, schema)

    result = search(0)
    for block in range(1, blocks):
        result = result.unionByName(search(block))
    return result.join(items.select("_item", "item"), "_item").select("doc_id", "item", "start", "end", "edits")


def drop_leaking(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", **options):
    """The rows of ``docs`` into which no item leaks, with all their columns.

    Cases as in ``find_leaks``; a document with a null id is kept unless its own text leaks.
    """
    key = fresh(docs, "_key")
    marked = docs.withColumn(
        key, F.struct(column(id_col).alias("id"), F.xxhash64(column(text_col)).alias("mark"))
    )
    leaks = find_leaks(marked, benchmark, key, text_col, **options)
    ids = [column(id_col), F.xxhash64(column(text_col))]
    return drop_rows(docs, ids, leaks.select("doc_id.id", "doc_id.mark"))
