"""Language identification with a bidirectional gated recurrent network over bytes.

The network is written in numpy and trained by backpropagation through time on windows of a
bounded sample of labelled rows. It labels every byte position of every window of a text; a
document's probabilities are the mean over all its positions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rowwise import add_columns, column
from tidemark.llm.sampling import sample_each

UNKNOWN = "und"
PAD = 256  # row of the byte table for positions after the end of a text


@dataclass
class Settings:
    """``sample_per_label`` and ``labels_most`` bound what is collected to the driver:
    at most their product of rows, each of ``sample_chars`` characters."""

    hidden: int = 8
    window: int = 64
    sample_per_label: int = 400
    sample_chars: int = 512
    labels_most: int = 200
    steps: int = 250
    batch: int = 256
    rate: float = 0.02
    seed: int = 7


@dataclass
class Network:
    labels: list[str]
    window: int
    weights: dict[str, np.ndarray]


# A gate's sigmoid is written as a tanh: s(x) = (1 + tanh(x / 2)) / 2. The update and reset
# parts of the weights hold x / 2, so one tanh serves both gates. Arrays are (units, batch).


def _forward(w, codes, keep: bool):
    """Hidden states of one direction at each position, and what training needs again."""
    table, u = w["table"], w["u"]
    size = u.shape[1]
    h = np.zeros((size, codes.shape[1]), np.float32)
    states, kept = [], []
    for row in codes:
        x = np.take(table, row, axis=1)
        a = u @ h
        gates = x[: 2 * size]
        gates += a[: 2 * size]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        update, reset = gates[:size], gates[size:]
        candidate = reset * a[2 * size :]
        candidate += x[2 * size :]
        np.tanh(candidate, out=candidate)
        if keep:
            kept.append((h, a[2 * size :], update, reset, candidate))
            h = candidate + update * (h - candidate)
        else:
            h -= candidate
            h *= update
            h += candidate
            h = h.copy()
        states.append(h)
    return states, kept


def _backward(w, codes, kept, into, grads):
    """Gradients of one direction by backpropagation through time; ``into`` has the
    gradient that reaches the hidden state at each position from the output."""
    u = w["u"]
    size = u.shape[1]
    back = np.zeros_like(into[0])
    for t in range(len(codes) - 1, -1, -1):
        h, inner, update, reset, candidate = kept[t]
        dh = into[t] + back
        d_candidate = dh * (1 - update) * (1 - candidate * candidate)
        d_update = dh * (h - candidate) * 2 * update * (1 - update)
        d_reset = d_candidate * inner * 2 * reset * (1 - reset)
        d_gates = np.concatenate([d_update, d_reset])
        d_a = np.concatenate([d_gates, d_candidate * reset])
        d_x = np.concatenate([d_gates, d_candidate])
        grads["u"] += d_a @ h.T
        np.add.at(grads["table"].T, codes[t], d_x.T)
        back = dh * update + u.T @ d_a


def _softmax(logits):
    logits = logits - logits.max(axis=0)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=0)
    return logits


def _fresh(labels: int, settings: Settings):
    random = np.random.default_rng(settings.seed)
    size = settings.hidden
    weights = {}
    for side in ("left", "right"):
        table = random.normal(0, 0.5, (3 * size, 257))
        table[:size] += 0.5  # remember at first
        weights[f"{side}_table"] = table
        weights[f"{side}_u"] = random.normal(0, 0.5 / np.sqrt(size), (3 * size, size))
    weights["out"] = random.normal(0, 0.3, (labels, 2 * size))
    weights["bias"] = np.zeros((labels, 1))
    return {k: v.astype(np.float32) for k, v in weights.items()}


def _side(weights, side):
    return {"table": weights[f"{side}_table"], "u": weights[f"{side}_u"]}


def windows(data: list[bytes], window: int):
    """Codes (windows, positions) of all bytes of the texts, and each window's text."""
    counts = np.array([-(-len(d) // window) for d in data], np.int64)
    codes = np.full((int(counts.sum()), window), PAD, np.int16)
    flat, at = codes.reshape(-1), 0
    for text, count in zip(data, counts, strict=True):
        flat[at : at + len(text)] = np.frombuffer(text, np.uint8)
        at += int(count) * window
    return codes, np.repeat(np.arange(len(data)), counts)


def train(samples: list[tuple[bytes, str]], settings: Settings) -> Network:
    """Fit the network with Adam on windows of the samples; same samples, same weights."""
    labels = sorted({label for _, label in samples})
    number = {label: i for i, label in enumerate(labels)}
    weights = _fresh(max(1, len(labels)), settings)
    network = Network(labels, settings.window, weights)
    if len(labels) < 2:
        return network
    codes, owner = windows([text for text, _ in samples], settings.window)
    target = np.array([number[label] for _, label in samples])[owner]
    members = [np.flatnonzero(target == i) for i in range(len(labels))]
    random = np.random.default_rng(settings.seed)
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    size = settings.hidden
    for step in range(1, settings.steps + 1):
        kinds = random.integers(0, len(labels), settings.batch)
        picked = np.array([random.choice(members[k]) for k in kinds])
        x = np.ascontiguousarray(codes[picked].T)
        real = x != PAD
        left, kept_left = _forward(_side(weights, "left"), x, True)
        right, kept_right = _forward(_side(weights, "right"), x[::-1], True)
        grads = {k: np.zeros_like(v) for k, v in weights.items()}
        into_left, into_right = [], [None] * len(x)
        for t in range(len(x)):
            both = np.concatenate([left[t], right[len(x) - 1 - t]])
            wrong = _softmax(weights["out"] @ both + weights["bias"])
            wrong[kinds, np.arange(len(kinds))] -= 1
            wrong *= real[t] / np.float32(real.sum())
            grads["out"] += wrong @ both.T
            grads["bias"] += wrong.sum(axis=1, keepdims=True)
            d = weights["out"].T @ wrong
            into_left.append(d[:size])
            into_right[len(x) - 1 - t] = d[size:]
        for side, order, kept, into in (
            ("left", x, kept_left, into_left),
            ("right", x[::-1], kept_right, into_right),
        ):
            own = {"table": grads[f"{side}_table"], "u": grads[f"{side}_u"]}
            _backward(_side(weights, side), order, kept, into, own)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        scale = min(1.0, 1.0 / max(norm, 1e-9))
        rate = settings.rate * (1 - 0.9 * step / settings.steps)
        for k, w in weights.items():
            g = grads[k] * np.float32(scale)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            w -= (
                rate * (first[k] / (1 - 0.9**step))
                / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            ).astype(np.float32)
    return network


def position_probabilities(network: Network, codes):
    """Label probabilities (positions, labels, windows) for codes (windows, positions)."""
    x = np.ascontiguousarray(codes.T)
    w = network.weights
    left, _ = _forward(_side(w, "left"), x, False)
    right, _ = _forward(_side(w, "right"), x[::-1], False)
    for t in range(len(x)):
        yield x[t], _softmax(
            w["out"] @ np.concatenate([left[t], right[len(x) - 1 - t]]) + w["bias"]
        )


def predict(network: Network, texts: list[str | None], group: int = 2048):
    """Mean label probabilities (texts, labels) over all byte positions of each text."""
    data = [(t or "").encode("utf-8", "replace") for t in texts]
    sums = np.zeros((len(data), len(network.labels)))
    sizes = np.array([max(1, len(d)) for d in data])
    codes, owner = windows(data, network.window)
    for at in range(0, len(codes), group):
        part = codes[at : at + group]
        total = np.zeros((len(network.labels), len(part)))
        for row, probabilities in position_probabilities(network, part):
            if row.max(initial=0) == PAD:
                probabilities *= row != PAD
            total += probabilities
        np.add.at(sums, owner[at : at + group], total.T)
    return sums / sizes[:, None]


def labelled_sample(df: DataFrame, text_col: str, lang_col: str, id_col: str, settings: Settings):
    """Rows for training, bounded by ``settings``: of each label those that a hash of id and
    text picks, one stretch of characters of each at a place the hash chooses."""
    text = F.col("_text")
    room = F.greatest(F.length(text) - settings.sample_chars, F.lit(0)) + 1
    identity = [column(id_col)] if id_col in df.columns else []
    rows = (
        df.where(column(lang_col).isNotNull())
        .select(
            column(text_col).cast("string").alias("_text"),
            column(lang_col).cast("string").alias("_lang"),
            F.xxhash64(*identity, column(text_col).cast("string")).alias("_order"),
        )
        .where(text.rlike(r"\p{L}"))
    )
    chosen = sample_each(rows, ["_lang"], "_order", settings.sample_per_label, settings.labels_most)
    start = (F.pmod(F.col("_order"), room) + 1).cast("int")
    return chosen.select(
        "_lang", "_order", F.substr(text, start, F.lit(settings.sample_chars)).alias("_part")
    )


def fit_language(
    df: DataFrame, text_col="text", lang_col="lang", id_col="doc_id", settings: Settings | None = None
) -> Network:
    """A network fitted on a bounded sample of the rows with a text and a label."""
    settings = settings or Settings()
    rows = labelled_sample(df, text_col, lang_col, id_col, settings).collect()
    rows.sort(key=lambda r: (r["_lang"], r["_order"], r["_part"]))
    return train([(r["_part"].encode("utf-8", "replace"), r["_lang"]) for r in rows], settings)


def identify_language(df: DataFrame, network: Network, text_col: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, the mean probability of that label.

    Every byte of every text is labelled. A text that is null or has no letter gets ``und``
    with score 0, and so does every text if the network was fitted without labels. Of equal
    probabilities the label first in alphabetical order wins. Repeated rows give repeated
    results, an empty table an empty one; input columns of the new names are replaced.
    """

    def make():
        def compute(texts):
            names = np.array([*network.labels, UNKNOWN], dtype=object)
            letters = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], bool)
            if not network.labels:
                letters[:] = False
            shown = [t if ok else None for t, ok in zip(texts, letters, strict=True)]
            means = predict(network, shown) if letters.any() else np.zeros((len(texts), 1))
            best = np.where(letters, means.argmax(axis=1), len(network.labels))
            score = np.where(letters, means.max(axis=1), 0.0)
            return [
                pa.array(names[best], pa.string()),
                pa.array(np.clip(score, 0.0, 1.0), pa.float64()),
            ]

        return compute

    return add_columns(df, text_col, make, "lang_pred string, score double")
