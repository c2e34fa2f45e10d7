"""Toxicity with a classifier chain of linear models over words.

Categories are predicted one after the other; the model of a category sees the words and the
probabilities of the categories before it. In training those probabilities are out of fold:
each row's come from models that were fitted without its fold.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rowwise import add_columns, column
from tidemark.llm.sampling import sample_each

WORD = re.compile(r"\w+")
BEGINNINGS = (4, 5)


@dataclass
class Settings:
    """``sample_per_class`` bounds the labelled rows (for each combination of labels, of
    which ``classes_most`` are used) and ``vocabulary`` the words per category. The driver
    gets word counts and numbers of sampled rows within these bounds, never texts."""

    sample_per_class: int = 3000
    classes_most: int = 16
    vocabulary: int = 1500
    least_documents: int = 4
    folds: int = 5
    steps: int = 120
    penalty: float = 2.0


@dataclass
class Chain:
    categories: list[str]
    words: dict[str, int]
    models: list[np.ndarray] = field(default_factory=list)  # words, earlier categories, constant
    thresholds: list[float] = field(default_factory=list)


def words_of(text: str | None) -> set[str]:
    """The words of a text and the beginnings of longer words, which stand for inflected
    and compound forms that no sample has all of."""
    words = set(WORD.findall(text.lower())) if text else set()
    return words | {w[:n] + "~" for w in words for n in BEGINNINGS if len(w) > n}


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Rows:
    """Sparse 0/1 rows of word numbers with a few dense columns beside them."""

    def __init__(self, found: list[np.ndarray], width: int):
        self.width = width
        self.sizes = np.array([len(f) for f in found], np.int64)
        self.numbers = np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int64)
        self.owner = np.repeat(np.arange(len(found)), self.sizes)

    def times(self, w):
        return np.bincount(self.owner, w[self.numbers], len(self.sizes))

    def back(self, r):
        return np.bincount(self.numbers, r[self.owner], self.width)


def fit_linear(rows: Rows, dense, y, use, settings: Settings):
    """Weights of a logistic model with balanced classes and a squared penalty, by
    accelerated gradient steps on columns scaled by their frequency; constant if the used
    rows have one class only."""
    width, extra = rows.width, dense.shape[1]
    positive, total = float((y * use).sum()), float(use.sum())
    if positive == 0 or positive == total:
        return np.concatenate([np.zeros(width + extra), [8.0 if positive else -8.0]])
    weight = use * np.where(y == 1, 0.5 / positive, 0.5 / (total - positive)) * total

    def times(w):
        return rows.times(w[:width]) + dense @ w[width:-1] + w[-1]

    def back(r):
        return np.concatenate([rows.back(r), dense.T @ r, [r.sum()]])

    scale = 1 / np.sqrt(back(0.25 * weight) + settings.penalty)
    # The largest curvature, by power iteration, gives the step.
    probe = np.ones(width + extra + 1)
    for _ in range(20):
        probe /= np.linalg.norm(probe)
        probe = scale * (back(0.25 * weight * times(scale * probe)) + settings.penalty * scale * probe)
    rate = 1 / (1.1 * np.linalg.norm(probe))
    point = before = np.zeros(width + extra + 1)
    for step in range(settings.steps):
        wrong = weight * (sigmoid(times(scale * point)) - y)
        slope = scale * (back(wrong) + settings.penalty * scale * point)
        now = point - rate * slope
        point = now + step / (step + 3) * (now - before)
        before = now
    return scale * before


def best_threshold(probability, y, stands=None):
    """The probability above which a label is given, for the best F1; 0.5 without labels.

    Each row counts as the rows it ``stands`` for, one if not given."""
    stands = np.ones(len(y)) if stands is None else stands
    order = np.argsort(-probability, kind="stable")
    hits = np.cumsum((stands * y)[order])
    f1 = 2 * hits / (np.cumsum(stands[order]) + max(1, (stands * y).sum()))
    at = int(f1.argmax()) if len(y) else 0
    if not len(y) or not y.sum():
        return 0.5
    low = probability[order[at]]
    under = probability[order[at + 1]] if at + 1 < len(order) else 0.0
    return float((low + under) / 2)


def fit_chain(categories, words, found, labels, folds, settings: Settings, stands=None) -> Chain:
    """The chain from word numbers, 0/1 labels (rows, categories), fold numbers and, for the
    thresholds, how many labelled rows each row stands for."""
    chain = Chain(list(categories), words)
    rows = Rows(found, len(words))
    earlier = np.zeros((len(found), 0))
    for k in range(len(categories)):
        y = labels[:, k].astype(float)
        outside = np.zeros(len(found))
        for fold in range(settings.folds):
            w = fit_linear(rows, earlier, y, (folds != fold).astype(float), settings)
            own = folds == fold
            outside[own] = _probability(rows, earlier, w)[own]
        chain.models.append(fit_linear(rows, earlier, y, np.ones(len(found)), settings))
        chain.thresholds.append(best_threshold(outside, y, stands))
        earlier = np.column_stack([earlier, outside])
    return chain


def _probability(rows: Rows, earlier, w):
    return sigmoid(rows.times(w[: rows.width]) + earlier @ w[rows.width : -1] + w[-1])


def predict(chain: Chain, texts: list[str | None]) -> np.ndarray:
    """Probabilities (texts, categories), each model fed with those before it."""
    known = chain.words
    keys = known.keys()
    found = [
        np.fromiter((known[w] for w in words_of(t) & keys), np.int64) for t in texts
    ]
    rows = Rows(found, len(known))
    out = np.zeros((len(texts), 0))
    for w in chain.models:
        out = np.column_stack([out, _probability(rows, out, w)])
    return out


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    categories: dict[str, str],
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Settings | None = None,
) -> Chain:
    """Fit a chain; ``categories`` maps a category to an SQL condition over ``labels``, in
    the order of the chain. Rows with a null id or an undecided condition are not used; of
    repeated labels of an id a true one counts, and of repeated documents one."""
    settings = settings or Settings()
    names = list(categories)
    marked = (
        labels.where(column(id_col).isNotNull())
        .groupBy(column(id_col).alias("_id"))
        .agg(*[F.max(F.expr(c).cast("int")).alias(f"_y{i}") for i, c in enumerate(categories.values())])
        .dropna()
    )
    ys = [F.col(f"_y{i}") for i in range(len(names))]
    chosen = sample_each(
        marked.withColumn("_order", F.xxhash64("_id")), [f"_y{i}" for i in range(len(names))],
        "_order", settings.sample_per_class, settings.classes_most,
    )

    def make():
        return lambda texts: [pa.array([sorted(words_of(t)) for t in texts], pa.list_(pa.string()))]

    # A sampled row stands for the labelled rows of its combination, of which all have the
    # same chance, so thresholds do not depend on how many fit in the sample.
    combined = (
        marked.groupBy(*ys).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), *ys).limit(settings.classes_most).collect()
    )
    each = {tuple(r[:-1]): r["n"] / min(r["n"], settings.sample_per_class) for r in combined}

    # The chosen ids are bounded by the settings, so they may be broadcast. Of rows repeated
    # with an id one counts, the text with the smallest hash.
    texts = docs.select(column(id_col).alias("_id"), column(text_col).alias("_t")).join(
        F.broadcast(chosen.drop("_rank", "_order")), "_id"
    ).groupBy("_id", *ys).agg(F.min_by("_t", F.xxhash64("_t")).alias("_t"))
    sample = add_columns(texts, "_t", make, "_words array<string>").drop("_t").checkpoint()
    sizes = sample.agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(y).alias(f"p{i}") for i, y in enumerate(ys)]
    ).first()
    counts = (
        sample.select(*ys, F.explode("_words").alias("_word"))
        .groupBy("_word")
        .agg(F.count(F.lit(1)).alias("_df"), *[F.sum(y).alias(f"_in{i}") for i, y in enumerate(ys)])
        .where(F.col("_df") >= settings.least_documents)
    )
    vocabulary: dict[str, int] = {}
    for i in range(len(names)):
        positive, total = float(sizes[f"p{i}"] or 0), float(sizes["n"] or 0)
        expected = F.col("_df") * F.lit(positive / max(total, 1.0))
        strength = F.pow(F.col(f"_in{i}") - expected, 2) / (expected + 1)
        top = counts.orderBy(F.desc(strength), "_word").limit(settings.vocabulary)
        for row in top.select("_word").collect():
            vocabulary.setdefault(row[0], len(vocabulary))
    known = F.array(*[F.lit(w) for w in vocabulary]) if vocabulary else F.array().cast("array<string>")
    rows = sorted(
        sample.select(
            F.pmod(F.xxhash64("_id"), F.lit(settings.folds)).alias("_fold"), *ys,
            F.array_sort(F.array_intersect("_words", known)).alias("_found"),
        ).collect()
    )
    found = [np.array([vocabulary[w] for w in r["_found"]], np.int64) for r in rows]
    return fit_chain(
        names,
        vocabulary,
        found,
        np.array([[r[f"_y{i}"] for i in range(len(names))] for r in rows]).reshape(-1, len(names)),
        np.array([r["_fold"] for r in rows], np.int64),
        settings,
        np.array([each[tuple(r[f"_y{i}"] for i in range(len(names)))] for r in rows], float),
    )


def score_toxicity(df: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """``df`` with ``p_<category>`` and ``is_<category>`` for each category of the chain.

    Whole texts, one row per input row. A null or empty text has no words, so it gets what
    the models say of no words. A chain fitted without rows gives all texts a probability
    near 0 and labels nothing. Repeated rows give repeated results, an empty table an empty one;
    input columns of the new names are replaced.
    """

    def make():
        def compute(texts):
            p = predict(chain, texts)
            out = []
            for k, threshold in enumerate(chain.thresholds):
                out.append(pa.array(p[:, k], pa.float64()))
                out.append(pa.array(p[:, k] > threshold, pa.bool_()))
            return out

        return compute

    fields = ", ".join(f"p_{c} double, is_{c} boolean" for c in chain.categories)
    return add_columns(df, text_col, make, fields)
