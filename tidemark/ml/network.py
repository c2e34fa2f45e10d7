"""Feed-forward network with class weights, trained by gradients summed over Spark tasks.

Every round each task computes the weighted gradient of its rows with the current weights;
the sums of tasks are added up in a few tasks more and only then reach the driver, which takes
one Adam step. No row is copied for its weight, and what is sent grows with the network only.
Rows with equal features and label have equal gradients and are learned from as one row with the
sum of their weights, so rounds grow with the distinct rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut_lineage

SUMMED_IN = 8  # tasks that add up the gradients of all others


@dataclass
class Network:
    """Weights of the layers, and how features are brought to mean 0 and deviation 1."""

    features: tuple[str, ...]
    layers: list[tuple[np.ndarray, np.ndarray]]
    mean: np.ndarray
    deviation: np.ndarray

    def forward(self, x: np.ndarray) -> list[np.ndarray]:
        """The values of each layer; the last holds log odds."""
        values = [x]
        for i, (weights, bias) in enumerate(self.layers):
            x = x @ weights + bias
            if i + 1 < len(self.layers):
                x = np.maximum(x, 0.0)
            values.append(x)
        return values

    def probability(self, frame: pd.DataFrame) -> np.ndarray:
        """For ``models.predict_batches``."""
        x = (frame[list(self.features)].to_numpy(float) - self.mean) / self.deviation
        return 1.0 / (1.0 + np.exp(-self.forward(x)[-1][:, 0]))

    def loss_and_gradient(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray):
        """Summed weighted log loss and its gradient as one array."""
        values = self.forward(x)
        odds = values[-1][:, 0]
        loss = float((weight * (np.logaddexp(0.0, odds) - y * odds)).sum())
        delta = (weight * (1.0 / (1.0 + np.exp(-odds)) - y))[:, None]
        gradient = []
        for i in reversed(range(len(self.layers))):
            gradient += [delta.sum(axis=0), (values[i].T @ delta).ravel()]
            if i:
                delta = (delta @ self.layers[i][0].T) * (values[i] > 0)
        return loss, np.concatenate(gradient[::-1])

    def flat(self) -> np.ndarray:
        return np.concatenate([part.ravel() for layer in self.layers for part in layer])

    def with_flat(self, values: np.ndarray) -> Network:
        layers, at = [], 0
        for weights, bias in self.layers:
            w = values[at : at + weights.size].reshape(weights.shape)
            at += weights.size
            layers.append((w, values[at : at + bias.size]))
            at += bias.size
        return Network(self.features, layers, self.mean, self.deviation)


def _start(features, hidden, mean, deviation, seed) -> Network:
    chance = np.random.default_rng(seed)
    sizes = [len(features), *hidden, 1]
    layers = [
        (chance.normal(0.0, np.sqrt(2.0 / n), (n, m)), np.zeros(m))
        for n, m in zip(sizes[:-1], sizes[1:], strict=True)
    ]
    return Network(tuple(features), layers, mean, deviation)


def _summed(rows: DataFrame, network: Network) -> tuple[np.ndarray, np.ndarray]:
    """(train loss, train weight, test loss, test weight), and the gradient of the train rows."""
    names = ["sums"]

    def gradients(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = np.stack(batch.column(0).to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros((0, len(network.features)))
            y, weight = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (1, 2))
            test = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
            x = (x - network.mean) / network.deviation
            loss, gradient = network.loss_and_gradient(x[~test], y[~test], weight[~test])
            checked, _ = network.loss_and_gradient(x[test], y[test], weight[test])
            own = np.concatenate([[loss, weight[~test].sum(), checked, weight[test].sum()], gradient])
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=names)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.column(0):
                own = row.values.to_numpy()
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=names)

    parts = rows.mapInArrow(gradients, "sums array<double>").repartition(SUMMED_IN)
    collected = parts.mapInArrow(added, "sums array<double>").collect()  # at most SUMMED_IN rows
    sums = np.sum([r[0] for r in collected], axis=0)
    return sums[:4], sums[4:]


def fit_weighted(
    train: DataFrame, test: DataFrame, features, label="label", hidden=(256, 128, 64),
    positive_weight=50.0, rounds=50, patience=10, rate=0.01, seed=42,
) -> tuple[Network, list[tuple[float, float]]]:
    """(network, losses): mean weighted log losses on ``train`` and ``test`` of every round.

    A positive row weighs ``positive_weight``. After ``patience`` rounds without a lower test loss
    training ends, and the network of the best round is returned. Rows with a null or NaN
    feature or a null label are left out; an empty ``train`` is an error.
    """

    def rows(df: DataFrame, is_test: bool) -> DataFrame:
        positive = F.col(label).cast("int") == 1
        known = df.select(
            F.array(*[F.col(c).cast("double") for c in features]).alias("x"),
            positive.cast("double").alias("y"),
            F.when(positive, float(positive_weight)).otherwise(1.0).alias("weight"),
            F.lit(is_test).alias("test"),
        )
        usable = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v))
        return known.where(F.col("y").isNotNull() & usable)

    everything = rows(train, False).unionByName(rows(test, True))
    both = cut_lineage(
        everything.groupBy("x", "y", "test").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("rows"))
        .select("x", "y", "weight", "test", "rows")
    )
    learned = both.where(~F.col("test"))
    of = [F.col("x")[i] for i in range(len(features))]
    count, *sums = learned.agg(F.sum("rows"), *[F.sum(c * F.col("rows")) for c in of]).first()
    if not count:
        raise ValueError("there is no row to train on")
    mean = np.array(sums, float) / count
    apart = [F.sum((c - float(m)) * (c - float(m)) * F.col("rows")) for c, m in zip(of, mean, strict=True)]
    deviation = np.sqrt(np.array(learned.agg(*apart).first(), float) / count)
    network = _start(features, hidden, mean, np.where(deviation > 0, deviation, 1.0), seed)
    best, least, since, losses = network, np.inf, 0, []
    values = network.flat()
    first, second = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, rounds + 1):
        (loss, weight, checked, held), gradient = _summed(both, network)
        losses.append((loss / weight, checked / held if held else loss / weight))
        if losses[-1][1] < least:
            best, least, since = network, losses[-1][1], 0
        else:
            since += 1
            if since >= patience:
                break
        gradient = gradient / weight
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient * gradient
        move = (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        values = values - rate * move
        network = network.with_flat(values)
    return best, losses
