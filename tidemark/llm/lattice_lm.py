"""Subword lattice likelihood: the marginal probability of a text over all segmentations.

The pieces come from an existing vocabulary; their unigram weights start from its ranks and
are refined on the training documents by expectation maximisation over the lattice. Pieces do
not cross white space, so a text's lattice is a chain of word lattices: a word is scored once,
by forward recursion in log space, and a document adds up the scores of its words and the end.
"""

from __future__ import annotations

import math
import os
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rowwise import column, in_pieces, limit_batches
from tidemark.llm.words import words_of

START = "▁"
END = "\n"  # no word has white space
END_BYTES = END.encode()
BITS = 18
BASE = np.uint64(0x9E3779B97F4A7C15)
MATRIX_LONGEST = 48
GATHERED_WORDS, GATHERED_BYTES = 1 << 15, 1 << 21


@dataclass
class Settings:
    """``vocabulary`` is a SentencePiece model file. ``frequent`` bounds the words whose
    counts are broadcast; all other words are joined. ``flush`` bounds the distinct words
    that a task counts before it passes them on."""

    vocabulary: str = "/opt/tokenizers/piece_bpe_32k.model"
    rounds: int = 1
    frequent: int = 100_000
    flush: int = 400_000


def read_vocabulary(path: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Pieces within words with starting log weights, and log weights of the 256 bytes.

    The vocabularies at hand are made by merging pairs and score their pieces by rank, not by
    unigram probability; Zipf's law makes a rank a weight to start from.
    """
    import sentencepiece

    if not os.path.exists(path):
        raise FileNotFoundError(f"no vocabulary at {path}")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ranks = [], []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        usual = not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        if usual and START not in piece[1:]:
            pieces.append(piece)
            ranks.append(max(0.0, -model.get_score(i)))
    weights = 1.0 / (np.array(ranks) + 2.0)
    total = weights.sum() * 1.02  # the rest is for the bytes
    return pieces, np.log(weights / total), np.full(256, math.log(0.02 / 1.02 / 256))


class Lattice:
    """Word lattices over pieces, with bytes for characters that are no piece.

    Edges have numbers: pieces first, then the 256 bytes.
    """

    def __init__(self, pieces: list[str], log_pieces: np.ndarray, log_bytes: np.ndarray):
        self.number = {p: i for i, p in enumerate(pieces)}
        self.weights = np.concatenate([log_pieces, log_bytes])
        self.first_byte = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        self.sorted = np.argsort(hashes)
        self.hashes = hashes[self.sorted]
        self.filter = np.zeros(1 << BITS, bool)
        self.filter[(hashes * BASE >> np.uint64(64 - BITS)).astype(np.int64)] = True

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(BASE) + ord(c) + 1) % 2**64
        return h

    def bytes_of(self, character: str) -> list[int]:
        return [self.first_byte + b for b in character.encode("utf-8", "surrogatepass")]

    def _edges(self, codes: np.ndarray, start: int, length: int, hashes: np.ndarray):
        """Piece numbers, or -1, of the stretch of all words (rows of codes)."""
        slot = (hashes * BASE >> np.uint64(64 - BITS)).astype(np.int64)
        maybe = np.flatnonzero(self.filter[slot])
        found = np.full(len(codes), -1, np.int64)
        at = np.searchsorted(self.hashes, hashes[maybe])
        at[at == len(self.hashes)] = 0
        real = self.hashes[at] == hashes[maybe]
        found[maybe[real]] = self.sorted[at[real]]
        return found

    def _group(self, words: list[str], counts: np.ndarray | None, expected: np.ndarray | None):
        """Log probabilities of words of one length; adds their expected edge counts."""
        size = len(words[0]) + 1
        text = "".join(START + w for w in words)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = codes.reshape(len(words), size).astype(np.uint64) + np.uint64(1)
        alpha = np.full((size + 1, len(words)), -np.inf)
        alpha[0] = 0.0
        edges: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []
        for start in range(size):
            hashes = np.zeros(len(words), np.uint64)
            for length in range(1, min(self.longest, size - start) + 1):
                hashes = hashes * BASE + codes[:, start + length - 1]
                found = self._edges(codes, start, length, hashes)
                rows = np.flatnonzero(found >= 0)
                weights = self.weights[found[rows]]
                if length == 1 and len(rows) < len(words):
                    missing = np.flatnonzero(found < 0)
                    own = np.array(
                        [self.weights[self.bytes_of(text[r * size + start])].sum() for r in missing]
                    )
                    rows = np.concatenate([rows, missing])
                    weights = np.concatenate([weights, own])
                if not len(rows):
                    continue
                goal = alpha[start + length]
                goal[rows] = np.logaddexp(goal[rows], alpha[start][rows] + weights)
                if expected is not None:
                    edges.append((start, length, rows, weights, found[rows]))
        total = alpha[size]
        if expected is not None:
            beta = np.full((size + 1, len(words)), -np.inf)
            beta[size] = 0.0
            for start, length, rows, weights, found in reversed(edges):
                rest = beta[start + length][rows] + weights
                back = beta[start]
                back[rows] = np.logaddexp(back[rows], rest)
                mass = np.exp(alpha[start][rows] + rest - total[rows]) * counts[rows]
                known = found >= 0
                expected += np.bincount(found[known], mass[known], len(expected))
                for r, m in zip(rows[~known], mass[~known], strict=True):
                    for number in self.bytes_of(text[r * size + start]):
                        expected[number] += m
        return total

    def _long(self, word: str, count: float, expected: np.ndarray | None) -> float:
        """One long word, the same recursion without arrays of all stretches."""
        text = START + word
        size = len(text)
        alpha = [-math.inf] * (size + 1)
        alpha[0] = 0.0
        edges = []
        for start in range(size):
            here = alpha[start]
            for length in range(1, min(self.longest, size - start) + 1):
                number = self.number.get(text[start : start + length], -1)
                if number >= 0:
                    weight = self.weights[number]
                elif length == 1:
                    weight = self.weights[self.bytes_of(text[start])].sum()
                else:
                    continue
                a, b = alpha[start + length], here + weight
                high = max(a, b)
                alpha[start + length] = high + math.log1p(math.exp(min(a, b) - high))
                if expected is not None:
                    edges.append((start, length, weight, number))
        if expected is not None:
            beta = [-math.inf] * (size + 1)
            beta[size] = 0.0
            for start, length, weight, number in reversed(edges):
                b = beta[start + length] + weight
                a = beta[start]
                high = max(a, b)
                beta[start] = high + math.log1p(math.exp(min(a, b) - high))
                mass = math.exp(alpha[start] + b - alpha[size]) * count
                for n in [number] if number >= 0 else self.bytes_of(text[start]):
                    expected[n] += mass
        return alpha[size]

    def score(self, words: list[str], counts=None, expected: np.ndarray | None = None):
        """Natural log probabilities of words; with ``expected``, adds to it the expected
        number of uses of each edge, words weighted by ``counts``."""
        out = np.zeros(len(words))
        lengths = np.array([len(w) for w in words], np.int64)
        counts = np.ones(len(words)) if counts is None else np.asarray(counts, float)
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            if length > MATRIX_LONGEST:
                for i in at:
                    out[i] = self._long(words[i], counts[i], expected)
            else:
                out[at] = self._group([words[i] for i in at], counts[at], expected)
        return out


def count_words(docs: DataFrame, flush: int) -> DataFrame:
    """``word, trained, seen``: occurrences in training rows and in all rows, of each word
    and of the end, from a frame with ``_text`` and ``_train``."""

    def work(batches):
        trained, other = Counter(), Counter()

        def rows():
            words = list(trained.keys() | other.keys())
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(words, pa.string()),
                    pa.array([trained[w] for w in words], pa.int64()),
                    pa.array([trained[w] + other[w] for w in words], pa.int64()),
                ],
                names=["word", "trained", "seen"],
            )
            trained.clear()
            other.clear()
            return batch

        for batch in in_pieces(batches):
            for text, train in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                words.append(END_BYTES)
                (trained if train else other).update(words)
                if len(trained) + len(other) >= flush:
                    yield rows()
        yield rows()

    partial = limit_batches(docs.select("_text", "_train")).mapInArrow(work, "word string, trained long, seen long")
    return partial.groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("seen").alias("seen"))


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches put together to ``GATHERED_WORDS`` or ``GATHERED_BYTES`` of words.

    The lattice treats all words of one length at a time, so few words cost as many calls as
    many do, whatever batches the session's settings cut.
    """
    held, rows, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.column(0).nbytes
        if rows >= GATHERED_WORDS or size >= GATHERED_BYTES:
            yield pa.concat_batches(held)
            held, rows, size = [], 0, 0
    if rows:
        yield pa.concat_batches(held)


def refine(counts: DataFrame, lattice: Lattice, ends: int) -> tuple[np.ndarray, float]:
    """New log weights of all edges, and of the end, from expected counts.

    What reaches the driver is one number per edge, as many as the vocabulary has.
    """
    context = counts.sparkSession.sparkContext
    shared = context.broadcast(lattice)

    def work(batches):
        expected = np.zeros(len(shared.value.weights))
        for batch in gathered(batches):
            shared.value.score(batch.column(0).to_pylist(), batch.column(1).to_numpy(), expected)
        used = np.flatnonzero(expected)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(expected[used], pa.float64())], names=["edge", "uses"]
        )

    uses = (
        counts.where((F.col("trained") > 0) & (F.col("word") != END))
        .select("word", "trained")
        .mapInArrow(work, "edge long, uses double")
        .groupBy("edge").agg(F.sum("uses").alias("uses"))
    )
    expected = np.ones(len(lattice.weights))
    for row in uses.collect():
        expected[row["edge"]] += row["uses"]
    total = expected.sum() + ends + 1
    return np.log(expected / total), math.log((ends + 1) / total)


def _least_count(words: DataFrame, most: int) -> float:
    """A count that at most ``most`` words reach, near the smallest such count.

    Words are counted in 16 classes for each doubling of their count, so what reaches the
    driver is a few hundred rows at any size.
    """
    classes = words.groupBy(F.floor(F.log2("seen") * 16).alias("class")).count().collect()
    reached = 0
    for row in sorted(classes, reverse=True):
        reached += row["count"]
        if reached > most:
            return 2 ** ((row["class"] + 1) / 16) * (1 - 1e-9)
    return 0.0


def lattice_likelihood(
    df: DataFrame,
    train,
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Settings | None = None,
) -> DataFrame:
    """One row per input row: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``.

    ``train`` is a condition for the rows to learn from; null means no. Tokens are words and
    one end per text; ``base_score`` is the add-one unigram score of the tokens, ``score``
    the log10 of the text's marginal probability under the piece weights. A null or empty
    text is its end alone. Without training rows N is 0 and all tokens are unknown. Repeated
    rows give repeated results, an empty table an empty one; other columns are not read.
    """
    settings = settings or Settings()
    spark = df.sparkSession
    docs = df.select(
        column(id_col).alias("doc_id"),
        column(text_col).cast("string").alias("_text"),
        F.coalesce(train, F.lit(False)).alias("_train"),
    )
    counts = count_words(docs, settings.flush).checkpoint()
    totals = counts.agg(
        F.sum("trained").alias("n"),
        F.count(F.when(F.col("trained") > 0, 1)).alias("v"),
        F.sum(F.when(F.col("word") == END, F.col("trained"))).alias("ends"),
    ).first()
    tokens, kinds, ends = (int(totals[k] or 0) for k in ("n", "v", "ends"))

    lattice = Lattice(*read_vocabulary(settings.vocabulary))
    pieces, end_weight = list(lattice.number), 0.0
    for _ in range(max(1, settings.rounds)):
        weights, end_weight = refine(counts, lattice, ends)
        lattice = Lattice(pieces, weights[: len(pieces)], weights[len(pieces) :])
    shared = spark.sparkContext.broadcast(lattice)

    def score_words(batches):
        for batch in gathered(batches):
            words = batch.column(0).to_pylist()
            scores = shared.value.score([w if w != END else "" for w in words]) / math.log(10)
            scores[[w == END for w in words]] = end_weight / math.log(10)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())],
                names=["word", "trained", "seen", "log_p"],
            )

    scored = counts.mapInArrow(
        score_words, "word string, trained long, seen long, log_p double"
    ).checkpoint()

    # The most frequent words, a bounded number, are looked up inside tasks; what a document
    # has beside them is joined, and none of those words can be a hot key.
    top = scored.where(F.col("seen") >= _least_count(scored, settings.frequent))
    known = {
        w.encode(): (c, math.log10(c + 1), p)
        for w, c, p in top.select("word", "trained", "log_p").collect()
    }
    frequent = spark.sparkContext.broadcast(known)

    def look_up(batches):
        table = frequent.value
        for batch in in_pieces(batches):
            at, words, times, sums = [], [], [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                found = Counter(words_of(text))
                found[END_BYTES] += 1
                n = known = 0
                base = score = 0.0
                rare = []
                for word, time in found.items():
                    n += time
                    entry = table.get(word)
                    if entry is None:
                        rare.append((word, time))
                    else:
                        known += time if entry[0] else 0
                        base += time * entry[1]
                        score += time * entry[2]
                # The sums ride on the first row of a document; a word that cannot occur
                # stands where it has no rare ones.
                rare = rare or [(b"%b%d" % (END_BYTES, row), 0)]
                for place, (word, time) in enumerate(rare):
                    at.append(row)
                    words.append(word)
                    times.append(time)
                    sums.append((1, n, known, base, score) if place == 0 else (0, 0, 0, 0.0, 0.0))
            at = pa.array(at, pa.int64())
            columns = list(zip(*sums, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array(words, pa.string()),
                    pa.array(times, pa.int64()),
                    *[pa.array(c, pa.int64()) for c in columns[:3]],
                    *[pa.array(c, pa.float64()) for c in columns[3:]],
                ],
                names=parts_schema.names,
            )

    keyed = docs.select("doc_id", F.xxhash64("_text").alias("_mark"), "_text")
    parts_schema = keyed.select(
        "doc_id", "_mark", F.lit("").alias("word"), F.lit(0).cast("long").alias("times"),
        F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("n"),
        F.lit(0).cast("long").alias("known"), F.lit(0.0).alias("base"), F.lit(0.0).alias("score"),
    ).schema
    parts = keyed.mapInArrow(look_up, parts_schema)
    rare = scored.select("word", "trained", "log_p")
    joined = parts.join(rare, "word", "left")
    c = F.coalesce("trained", F.lit(0))
    sums = joined.groupBy("doc_id", "_mark").agg(
        F.sum("rows").alias("_rows"),
        F.sum("n").alias("_n"),
        F.sum(F.col("known") + F.when(c > 0, F.col("times")).otherwise(0)).alias("_known"),
        F.sum(F.col("base") + F.col("times") * F.log10(c + F.lit(1.0))).alias("_base"),
        F.sum(F.col("score") + F.col("times") * F.coalesce("log_p", F.lit(0.0))).alias("_score"),
    )
    # Rows repeated with id and text were added up; each gets its share back.
    per_row = sums.withColumn("_one", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))))
    n = (F.col("_n") / F.col("_rows")).cast("long")
    return per_row.select(
        "doc_id",
        n.alias("n_tokens"),
        (F.col("_known") / F.col("_rows")).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("_base") / F.col("_rows") - n * F.lit(math.log10(tokens + kinds + 1))).alias("base_score"),
        (F.col("_score") / F.col("_rows")).alias("score"),
    )
