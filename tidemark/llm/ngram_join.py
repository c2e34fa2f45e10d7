"""Jaccard join of documents on word n-grams as a blocked sparse matrix product.

The matrix has a row per distinct n-gram set and a column per n-gram. Bounds that follow from
set sizes come first: a set with too many n-grams of its own has no partner, and two linked
sets share one of the few rarest n-grams of each. What remains is cut into blocks of bounded
size whose product accumulates overlap counts; pairs below the bound are discarded and each
block returns a spanning forest of its links, so that a group of thousands of near copies
costs no row per pair. Components of the forests are the components of all links.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from tidemark.llm.rowwise import column, drop_rows, in_pieces, limit_batches
from tidemark.llm.words import words_of
from tidemark.operators.components import connected
from tidemark.session import shared_folder

BASE = np.uint64(0x9E3779B97F4A7C15)
MEMO = 200_000


@dataclass
class Settings:
    """Sets link when 100 * intersection >= ``percent`` * union. One in ``sampled`` n-grams,
    chosen by hash, serves to find partners; ``block_docs`` and ``block_grams`` bound a block;
    ids of at most ``broadcast_rows`` candidates are broadcast, more are joined."""

    words: int = 3
    percent: int = 90
    sampled: int = 4
    block_docs: int = 1000
    block_grams: int = 1_000_000
    broadcast_rows: int = 500_000


class WordHashes(dict):
    """64-bit hashes of words, kept once computed."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


class Shingler:
    """Sorted hashes of the distinct n-grams of a text."""

    def __init__(self, words: int):
        self.words = words
        self.known = WordHashes()

    def grams(self, text: str | None) -> np.ndarray:
        if len(self.known) > MEMO:
            self.known.clear()
        words = words_of(text)
        codes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        if not len(words):
            return codes
        length = min(self.words, len(words))
        hashes = np.full(len(words) - length + 1, length, np.uint64)
        for place in range(length):
            hashes *= BASE
            hashes += codes[place : len(codes) - length + 1 + place]
        hashes ^= hashes >> np.uint64(29)
        hashes.sort()
        return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])]


def need(n, percent):
    """Fewest n-grams that a set of n shares with any partner."""
    return -(-percent * n // 100)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate([*arrays, np.zeros(0, np.uint64)]).astype(np.uint64).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def _node(grams: np.ndarray) -> int:
    digest = hashlib.blake2b(grams.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _sets(docs: DataFrame, settings: Settings, arrays: str | None) -> DataFrame:
    """``docs`` (whose last column is ``_text``) with ``node``, ``n`` and with ``grams``
    if ``arrays`` is "all", or the n-grams to find partners by if it is "sample"."""
    fields = [*docs.schema.fields[:-1], StructField("node", LongType()), StructField("n", IntegerType())]
    if arrays:
        fields.append(StructField("grams", ArrayType(LongType())))
    schema = StructType(fields)
    last = len(docs.columns) - 1

    def chosen(grams):
        if arrays == "all":
            return grams
        mark = (grams >> np.uint64(20)) % np.uint64(settings.sampled) == 0
        prefix = len(grams) - need(len(grams), settings.percent) + 1
        short = prefix - int(mark.sum())
        if short > 0:  # a prefix reaches beyond the sample only when that is used up
            mark[np.flatnonzero(~mark)[:short]] = True
        return grams[mark]

    def work(batches):
        shingler = Shingler(settings.words)
        for batch in in_pieces(batches):
            sets = [shingler.grams(t) for t in batch.column(last).to_pylist()]
            out = [
                *batch.columns[:last],
                pa.array([_node(g) for g in sets], pa.int64()),
                pa.array([len(g) for g in sets], pa.int32()),
            ]
            if arrays:
                out.append(_lists([chosen(g) for g in sets]))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return limit_batches(docs).mapInArrow(work, schema)


def links_in_block(grams: list[np.ndarray], sizes: np.ndarray, percent: int, left: np.ndarray | None):
    """(i, j) that connect the sets of a block with the first they are linked to, directly or
    over others; with ``left`` only links between a left and another set count."""
    if len(grams) < 2:
        return []
    owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    _, column_of, used = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    shared = used[column_of] > 1
    owner, column_of = owner[shared], column_of[shared]
    names, column_of = np.unique(column_of, return_inverse=True)
    order = np.argsort(column_of, kind="stable")
    owner, column_of = owner[order], column_of[order]
    overlap = np.zeros((len(grams), len(grams)), np.float32)
    slab = max(256, (1 << 22) // len(grams))
    for first in range(0, len(names), slab):
        a, b = np.searchsorted(column_of, [first, first + slab])
        part = np.zeros((len(grams), min(slab, len(names) - first)), np.float32)
        part[owner[a:b], column_of[a:b] - first] = 1.0
        overlap += part @ part.T
    linked = 100 * overlap >= percent * (sizes[:, None] + sizes[None, :] - overlap)
    np.fill_diagonal(linked, False)
    if left is not None:
        linked &= left[:, None] != left[None, :]
    out, fresh_ones = [], np.ones(len(grams), bool)
    for seed in np.flatnonzero(linked.any(axis=1)):
        if not fresh_ones[seed]:
            continue
        fresh_ones[seed] = False
        front = np.array([seed])
        while len(front):
            reached = linked[front].any(axis=0) & fresh_ones
            front = np.flatnonzero(reached)
            fresh_ones[front] = False
            out += [(int(seed), int(j)) for j in front]
    return out


def _blocks(members: DataFrame, settings: Settings) -> DataFrame:
    """``members`` (node, n, grams, root) with a row per block they take part in.

    A candidate component within bounds is one block. A larger one is cut by size class (sets
    of linked documents lie in the same or neighbouring classes) and by hash within a class;
    blocks are pairs of such cuts.
    """
    ratio = F.lit(100.0 / settings.percent)
    log_class = F.floor(F.log(F.col("n").cast("double")) / F.log(ratio)).cast("int")
    members = members.withColumn("cls", log_class)
    whole = members.groupBy("root").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("total"))
    large = whole.where(
        (F.col("docs") > settings.block_docs) | (F.col("total") > settings.block_grams)
    ).select("root")
    cuts = (
        members.join(large, "root")
        .groupBy("root", "cls")
        .agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("total"))
        .select(
            "root", "cls",
            F.greatest(
                F.ceil(F.col("docs") / settings.block_docs), F.ceil(F.col("total") / settings.block_grams)
            ).cast("int").alias("cuts"),
        )
    )
    near = cuts.select("root", F.col("cls").alias("cls"), "cuts").checkpoint()
    after = near.select("root", (F.col("cls") - 1).alias("cls"), F.col("cuts").alias("after"))
    before = near.select("root", (F.col("cls") + 1).alias("cls"), F.col("cuts").alias("before"))
    placed = (
        members.join(near, ["root", "cls"], "left")
        .join(after, ["root", "cls"], "left")
        .join(before, ["root", "cls"], "left")
        .withColumn("cut", F.pmod(F.xxhash64("node"), F.coalesce("cuts", F.lit(1))).cast("int"))
    )

    def pairs(count, make):
        some = F.transform(F.sequence(F.lit(0), count - 1), make)
        return F.when(count.isNotNull(), some).otherwise(F.array().cast("array<struct<a:int,i:int,b:int,j:int>>"))

    def block(a, i, b, j):
        parts = zip("aibj", (a, i, b, j), strict=True)
        return F.struct(*[p.cast("int").alias(name) for name, p in parts])

    cls, cut = F.col("cls"), F.col("cut")
    none = F.lit(0)
    blocks = F.when(F.col("cuts").isNull(), F.array(block(none, none, none, none))).otherwise(
        F.concat(
            pairs(F.col("cuts"), lambda j: block(cls, F.least(cut, j), cls, F.greatest(cut, j))),
            pairs(F.col("after"), lambda j: block(cls, cut, cls + 1, j)),
            pairs(F.col("before"), lambda j: block(cls - 1, j, cls, cut)),
        )
    )
    return placed.select("root", "node", "n", "grams", "cls", "cut", F.explode(blocks).alias("block"))


def _forest(blocks: DataFrame, settings: Settings) -> DataFrame:
    """Links ``u, v`` of each block's spanning forest; a task holds one block at a time."""

    def solve(rows):
        block = rows[0][-1]
        sides = None
        if (block["a"], block["i"]) != (block["b"], block["j"]):
            sides = np.array([(r[3], r[4]) == (block["a"], block["i"]) for r in rows])
        grams = [np.asarray(r[2], np.int64) for r in rows]
        sizes = np.array([r[1] for r in rows], np.float64)
        found = links_in_block(grams, sizes, settings.percent, sides)
        return [(rows[i][0], rows[j][0]) for i, j in found]

    def work(batches):
        key, rows, links = None, [], []
        for batch in batches:
            root, node, n, grams, cls, cut, block = batch.columns
            values = grams.flatten().to_numpy(zero_copy_only=False)
            offsets = grams.offsets.to_numpy() - grams.offsets[0].as_py()
            for k, (r, place) in enumerate(zip(root.to_pylist(), block.to_pylist(), strict=True)):
                now = (r, *place.values())
                if now != key:
                    links += solve(rows) if len(rows) > 1 else []
                    key, rows = now, []
                rows.append(
                    (node[k].as_py(), n[k].as_py(), values[offsets[k] : offsets[k + 1]].copy(),
                     cls[k].as_py(), cut[k].as_py(), place)
                )
        links += solve(rows) if len(rows) > 1 else []
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["u", "v"]
        )

    order = ["root", "block"]
    dealt = blocks.repartition(*order).sortWithinPartitions(*order, "node")
    return dealt.mapInArrow(work, "u long, v long")


def similar_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id``.

    Whole texts; words are what lies between ASCII white space, A-Z in lower case. A text of
    fewer words than an n-gram is one n-gram; a null, empty or blank text has none and is
    linked with nothing, so its component is its own id. ``component_id`` is the smallest id
    that links reach, null ids left out (null if there is no other). Repeated rows are
    linked like other copies. An empty table gives an empty result; other columns are not
    read. Sets and n-grams are told apart by 64-bit hashes.
    """
    return _labelled(df, id_col, text_col, settings or Settings()).drop("mark")


def _written(df: DataFrame) -> DataFrame:
    """The rows from a table in the shared folder, which takes less disk than a checkpoint."""
    folder = shared_folder(df.sparkSession, "sets")
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _labelled(df: DataFrame, id_col: str, text_col: str, settings: Settings) -> DataFrame:
    """``doc_id, mark`` (a hash of the text), ``n_shingles, component_id`` of every row."""
    text = column(text_col).cast("string")
    docs = df.select(column(id_col).alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("_text"))

    # One row per distinct set, with the document that shows it.
    reps = (
        _sets(docs, settings, "sample")
        .where("n > 0")
        .groupBy("node")
        .agg(
            F.min(F.struct("doc_id", "mark")).alias("shown"), F.min("doc_id").alias("least_id"),
            F.first("n").alias("n"), F.first("grams").alias("grams"),
        )
    )
    reps = _written(reps)
    allowed = F.col("n") - F.ceil(F.col("n") * settings.percent / 100)

    # Sets that have too many n-grams for themselves have no partner.
    alone = (
        reps.select("node", F.explode("grams").alias("gram"))
        .groupBy("gram")
        .agg(F.count(F.lit(1)).alias("uses"), F.min("node").alias("node"))
        .where("uses = 1")
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("own"))
    )
    left = (
        reps.join(alone, "node", "left")
        .where(F.coalesce("own", F.lit(0)) <= allowed)
        .select("node", "shown", "n", "grams")
        .checkpoint()
    )

    # Linked sets share one of their rarest n-grams; uses are counted among what is left.
    postings = left.select("node", "n", F.size("grams").alias("listed"), F.explode("grams").alias("gram"))
    uses = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("uses")).where("uses > 1")
    rarest = Window.partitionBy("node").orderBy("uses", "gram")
    common = Window.partitionBy("node")
    prefix = (
        postings.join(uses, "gram")
        .withColumn("own", F.col("listed") - F.count(F.lit(1)).over(common))
        .withColumn("place", F.col("own") + F.row_number().over(rarest))
        .where(F.col("place") <= allowed + 1)
        .select("gram", "node")
        .checkpoint()
    )
    meeting = prefix.groupBy("gram").agg(F.min("node").alias("hub"))
    candidates = connected(prefix.join(meeting, "gram"), "node", "hub").checkpoint()

    # The whole sets of candidates, in blocks.
    wanted = candidates.join(left.select("node", "shown"), "node").select(
        F.col("node").alias("_wanted"), "root", "shown"
    )
    if candidates.count() <= settings.broadcast_rows:
        wanted = F.broadcast(wanted)
    picked = docs.join(
        wanted,
        docs["doc_id"].eqNullSafe(wanted["shown"]["doc_id"]) & (docs["mark"] == wanted["shown"]["mark"]),
    ).select("root", "_wanted", "_text")
    members = (
        _sets(picked, settings, "all")
        .where("node = _wanted")
        .groupBy("node")
        .agg(F.first("root").alias("root"), F.first("n").alias("n"), F.first("grams").alias("grams"))
        .checkpoint()
    )
    forest = _forest(_blocks(members, settings), settings).checkpoint()
    linked = connected(forest, "u", "v")

    # Back to documents.
    ids = linked.join(reps.select("node", "least_id"), "node")
    roots = ids.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = ids.join(roots, "root").select("node", "component_id")
    named = reps.join(labels, "node", "left").select(
        F.col("node").alias("_node"), F.coalesce("component_id", "least_id").alias("_component")
    )
    rows = _sets(docs, settings, None).withColumn(
        "_key", F.when(F.col("n") == 0, F.xxhash64("doc_id")).otherwise(F.col("node"))
    )
    label = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("_component"))
    return rows.join(named, rows["_key"] == named["_node"], "left").select(
        "doc_id", "mark", F.col("n").cast("long").alias("n_shingles"), label.alias("component_id")
    )


def keep_one_of_each(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None
) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns: of each component the document
    with the smallest id, and every document without words.

    Rows with a null id go if something with an id is linked to them. Rows repeated with one
    id and one text stay or go together. Other cases as in ``similar_components``.
    """
    decided = _labelled(df, id_col, text_col, settings or Settings())
    goes = decided.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "mark")
    return drop_rows(df, [column(id_col), F.xxhash64(column(text_col).cast("string"))], goes)
