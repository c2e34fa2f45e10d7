"""Language model, language identification and toxicity."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import plain
from tidemark.llm import language, lattice_lm, toxicity
from tidemark.llm.queries import QUERIES


def brute_probability(text, weights, spell):
    """Sum over all segmentations of the product of piece weights."""
    ways = [1.0] + [0.0] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(end):
            piece = text[start:end]
            weight = weights.get(piece)
            if weight is None and end - start == 1:
                weight = math.prod(spell[b] for b in piece.encode())
            if weight:
                ways[end] += ways[start] * weight
    return ways[-1]


def small_lattice():
    pieces = ["▁", "▁a", "a", "b", "ab", "ba", "aba", "▁ab", "é"]
    weights = np.array([0.1, 0.05, 0.2, 0.1, 0.05, 0.1, 0.05, 0.05, 0.01])
    return lattice_lm.Lattice(pieces, np.log(weights), np.log(np.full(256, 0.001))), dict(
        zip(pieces, weights, strict=True)
    )


@pytest.mark.parametrize("longest", [48, 0])
def test_forward_recursion_sums_all_segmentations(monkeypatch, longest):
    monkeypatch.setattr(lattice_lm, "MATRIX_LONGEST", longest)
    lattice, weights = small_lattice()
    words = ["a", "ab", "abab", "baba", "éa", "漢b", "x", "", "abaabbaabab", "\U0001f600"]
    got = lattice.score(words)
    for word, value in zip(words, got, strict=True):
        assert math.isclose(math.exp(value), brute_probability("▁" + word, weights, [0.001] * 256), rel_tol=1e-9)


@pytest.mark.parametrize("longest", [48, 0])
def test_expected_counts_are_the_gradient(monkeypatch, longest):
    monkeypatch.setattr(lattice_lm, "MATRIX_LONGEST", longest)
    lattice, _ = small_lattice()
    words, counts = ["abab", "ba", "漢ab"], [2.0, 1.0, 3.0]
    expected = np.zeros(len(lattice.weights))
    lattice.score(words, counts, expected)
    for edge in [*range(9), *(lattice.bytes_of("漢"))]:
        kept = lattice.weights[edge]
        moved = []
        for step in (1e-5, -1e-5):
            lattice.weights[edge] = kept + step
            moved.append(lattice.score(words) @ np.array(counts))
        lattice.weights[edge] = kept
        assert math.isclose((moved[0] - moved[1]) / 2e-5, expected[edge], abs_tol=1e-4)


def brute_base(rows, train):
    tokens = {}
    for key, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for space in "\t\n\x0b\x0c\r":
            lowered = lowered.replace(space, " ")
        tokens[key] = [w for w in lowered.split(" ") if w] + ["</end>"]
    count = Counter(t for k, ts in tokens.items() if train(k) for t in ts)
    total, kinds = sum(count.values()), len(count)
    return {
        k: (len(ts), sum(count[t] > 0 for t in ts), total,
            sum(math.log10((count[t] + 1) / (total + kinds + 1)) for t in ts))
        for k, ts in tokens.items()
    }


@pytest.mark.parametrize("frequent", [100_000, 40])
def test_language_model_counts(spark, folder, frequent):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    settings = lattice_lm.Settings(frequent=frequent, flush=500)
    got = lattice_lm.lattice_likelihood(docs, F.col("doc_id") % 3 != 1, settings=settings).collect()
    want = brute_base(plain(docs, "doc_id", "text"), lambda k: k % 3 != 1)
    assert len(got) == len(want)
    for row in got:
        n, known, total, base = want[row["doc_id"]]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (n, known, total)
        assert math.isclose(row["base_score"], base, rel_tol=1e-9)
        assert -60 * n < row["score"] < 0


def test_weights_fit_the_training_texts(spark):
    """More rounds make the training texts likelier, and their words likelier than others."""
    from pyspark.sql import functions as F

    rows = [(i, "the theater thing " * (i % 5 + 1)) for i in range(40)] + [(100, "zqxj vvkw")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    scores = []
    for rounds in (1, 4):
        got = lattice_lm.lattice_likelihood(df, F.col("doc_id") < 50, settings=lattice_lm.Settings(rounds=rounds))
        by_id = {r["doc_id"]: r["score"] for r in got.collect()}
        scores.append(sum(v for k, v in by_id.items() if k < 50))
        assert by_id[100] / 3 < by_id[0] / 4
    assert scores[1] > scores[0]


def test_language_model_odd_rows(odd, odd_rows, spark):
    from pyspark.sql import functions as F

    got = lattice_lm.lattice_likelihood(odd("word"), F.col("doc_id") != 8).collect()
    assert len(got) == len(odd_rows)
    by = {(r["doc_id"], r["n_tokens"]): r for r in got}
    assert by[1, 1]["n_known"] == by[2, 1]["n_known"] == by[3, 1]["n_known"] == 1
    assert by[1, 1]["score"] == by[2, 1]["score"] == by[None, 1]["score"]
    assert by[5, 7]["score"] == by[6, 7]["score"] == by[None, 7]["score"]
    assert by[4, 40001]["n_known"] == 40001 and math.isfinite(by[4, 40001]["score"])
    assert by[8, 8]["n_known"] == 1
    # 1, 2, 3, 4, 5 twice, 6 and 7 train: an end each, 40 000 + 3 * 6 + 3 words.
    assert by[8, 8]["train_tokens"] == 8 + 40_000 + 18 + 3
    nothing = lattice_lm.lattice_likelihood(odd(), F.lit(False)).where("doc_id = 5").first()
    assert (nothing["n_known"], nothing["train_tokens"], nothing["base_score"]) == (0, 0, 0.0)
    assert lattice_lm.lattice_likelihood(odd(rows=[]), F.lit(True)).count() == 0
    glued = spark.createDataFrame([(1, "x" * 100_000)], "doc_id long, text string")
    assert math.isfinite(lattice_lm.lattice_likelihood(glued, F.lit(True)).first()["score"])


def test_lattice_query_holds_out_a_seventh(spark, folder):
    import zlib

    rows = QUERIES["op6_lattice_lm"](spark, folder).collect()
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 7 == 2)


def test_backpropagation_equals_differences(monkeypatch):
    """Gradients by backpropagation through time against finite differences."""
    settings = language.Settings(hidden=3, window=5, steps=1, batch=4)
    weights = {k: v.astype(np.float64) for k, v in language._fresh(2, settings).items()}
    random_ = np.random.default_rng(1)
    codes = random_.integers(0, 256, (5, 4))
    target = random_.normal(size=(5, 3, 4))

    def loss(w):
        states, _ = language._forward(w, codes, True)
        return sum((s * t).sum() for s, t in zip(states, target, strict=True))

    side = {"table": weights["left_table"], "u": weights["left_u"]}
    _, kept = language._forward(side, codes, True)
    grads = {k: np.zeros_like(v) for k, v in side.items()}
    language._backward(side, codes, kept, list(target), grads)
    for name, places in (("u", [(0, 0), (4, 2), (8, 1)]), ("table", [(1, codes[0, 0]), (5, codes[4, 3]), (7, codes[2, 2])])):
        for place in places:
            moved = []
            for step in (1e-4, -1e-4):
                changed = {k: v.copy() for k, v in side.items()}
                changed[name][place] += step
                moved.append(loss(changed))
            assert math.isclose((moved[0] - moved[1]) / 2e-4, grads[name][place], rel_tol=2e-2, abs_tol=2e-3)


def test_held_out_languages(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op10_language"](spark, folder).join(docs, "doc_id").where("held_out").collect()
    right = sum(r["lang_pred"] == r["lang"] for r in got)
    assert len(got) > 200 and right >= 0.97 * len(got)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_every_position_is_labelled_and_pooled():
    samples = [(("abc " * 40).encode(), "x"), (("éçà " * 30).encode(), "y")]
    network = language.train(samples, language.Settings(steps=30, batch=16, window=16))
    texts = ["abc abc éçà", "é", "a" * 1000, None, ""]
    means = language.predict(network, texts, group=3)
    codes, owner = language.windows([t.encode() if t else b"" for t in texts], 16)
    sums = np.zeros((5, 2))
    for row, probabilities in language.position_probabilities(network, codes):
        for w in np.flatnonzero(row != language.PAD):
            sums[owner[w]] += probabilities[:, w]
    sizes = [max(1, len((t or "").encode())) for t in texts]
    assert np.allclose(means, sums / np.array(sizes)[:, None], atol=1e-6)
    assert np.allclose(means[:3].sum(axis=1), 1, atol=1e-5)


def test_language_odd_rows(odd, odd_rows):
    settings = language.Settings(steps=5, batch=8)
    network = language.fit_language(odd("lang_pred"), settings=settings)
    got = language.identify_language(odd("lang_pred"), network)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "lang_pred", "score"]
    rows = {r["doc_id"]: r for r in got.collect()}
    assert {k for k, r in rows.items() if k and r["lang_pred"] == "und"} == {1, 2, 3, 7}
    assert rows[8]["lang_pred"] in ("en", "de") and rows[4]["score"] > 0
    assert got.count() == len(odd_rows)
    empty = language.fit_language(odd(rows=[]), settings=settings)
    assert {r[0] for r in language.identify_language(odd(), empty).select("lang_pred").collect()} == {"und"}
    single = language.fit_language(odd().where("lang = 'de'"), settings=settings)
    assert language.identify_language(odd(), single).where("doc_id = 6").first()["lang_pred"] == "de"
    assert language.identify_language(odd(rows=[]), network).count() == 0


BAD = ["blorg", "snarf", "grunk"]


def toxic_rows(seed, count):
    chance = random.Random(seed)
    rows, labels = [], []
    for i in range(count):
        words = [f"word{chance.randint(0, 400)}" for _ in range(chance.randint(5, 150))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(chance.randint(2, 4)):
                words.insert(chance.randrange(len(words)), chance.choice(BAD) + chance.choice(["", "ed", "ing"]))
        severe = toxic and i % 10 == 0
        if severe:
            words.append("zzkill")
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic), int(severe)))
    return rows, labels


def test_chain_finds_planted_toxic_texts(spark):
    rows, labels = toxic_rows(1, 900)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, severe int")
    chain = toxicity.learn_toxicity(
        docs, marks.where("doc_id < 600"), {"toxic": "toxic = 1", "severe": "severe = 1"}
    )
    assert [len(m) - len(chain.words) for m in chain.models] == [1, 2]
    got = toxicity.score_toxicity(docs.where("doc_id >= 600"), chain).join(marks, "doc_id").collect()
    for name in ("toxic", "severe"):
        wrong = sum(r[f"is_{name}"] != (r[name] == 1) for r in got)
        assert wrong <= 0.02 * len(got), name
    assert chain.models[1][len(chain.words)] > 0  # the earlier category speaks for the later


def test_earlier_probabilities_are_out_of_fold(monkeypatch):
    seen = []
    original = toxicity.fit_linear

    def spy(rows, dense, y, use, settings):
        seen.append((dense.copy(), use.copy()))
        return original(rows, dense, y, use, settings)

    monkeypatch.setattr(toxicity, "fit_linear", spy)
    found = [np.array([i % 3]) for i in range(30)]
    labels = np.array([[i % 3 == 0, i % 2 == 0] for i in range(30)]).astype(int)
    folds = np.arange(30) % 3
    settings = toxicity.Settings(folds=3)
    chain = toxicity.fit_chain(["a", "b"], {"x": 0, "y": 1, "z": 2}, found, labels, folds, settings)
    assert len(seen) == 8 and len(chain.models) == 2
    rows, dense = toxicity.Rows(found, 3), np.zeros((30, 0))
    expected = np.zeros(30)
    for fold in range(3):
        w = original(rows, dense, labels[:, 0].astype(float), (folds != fold).astype(float), settings)
        expected[folds == fold] = toxicity._probability(rows, dense, w)[folds == fold]
    assert np.allclose(seen[-1][0][:, 0], expected)


def test_linear_model_reaches_the_optimum():
    random_ = np.random.default_rng(0)
    found = [np.flatnonzero(random_.random(12) < 0.3) for _ in range(200)]
    y = np.array([float(2 in f or random_.random() < 0.2) for f in found])
    settings = toxicity.Settings(steps=2000)
    rows, dense, use = toxicity.Rows(found, 12), np.zeros((200, 0)), np.ones(200)
    w = toxicity.fit_linear(rows, dense, y, use, settings)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (200 - y.sum())) * 200
    wrong = weight * (toxicity._probability(rows, dense, w) - y)
    slope = np.concatenate([rows.back(wrong), [wrong.sum()]]) + settings.penalty * w
    assert np.abs(slope).max() < 1e-3


def test_toxicity_odd_rows(odd, odd_rows, spark):
    marks = spark.createDataFrame(
        [(5, 1), (5, 0), (6, 1), (8, 0), (4, 0), (7, None), (None, 1), (99, 1)], "doc_id long, toxic int"
    )
    chain = toxicity.learn_toxicity(odd("toxic"), marks, {"toxic": "toxic = 1"}, settings=toxicity.Settings(least_documents=1))
    got = toxicity.score_toxicity(odd("p_toxic"), chain)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "p_toxic", "is_toxic"]
    assert got.count() == len(odd_rows)
    rows = {r["doc_id"]: r for r in got.collect()}
    assert rows[1]["p_toxic"] == rows[2]["p_toxic"] == rows[3]["p_toxic"]
    nothing = toxicity.learn_toxicity(odd(), marks.where("doc_id > 1000"), {"toxic": "toxic = 1"})
    assert not [r for r in toxicity.score_toxicity(odd(), nothing).collect() if r["is_toxic"]]
    assert toxicity.score_toxicity(odd(rows=[]), chain).count() == 0
    assert toxicity.score_toxicity(odd(), toxicity.learn_toxicity(odd(rows=[]), marks, {"toxic": "toxic = 1"})).count() == len(odd_rows)


def test_toxicity_query(spark, folder):
    rows = QUERIES["op9_toxicity"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r["p_toxic"] <= 1 and 0 <= r["p_low_quality"] <= 1 for r in rows)


def test_bounded_sample_of_each_key(spark):
    from tidemark.llm.sampling import sample_each

    df = spark.range(30_000).selectExpr("xxhash64(id) AS h", "CASE WHEN id % 3 > 0 THEN 'a' WHEN id % 30 = 0 THEN 'b' ELSE concat('c', id % 7) END AS k")
    got = sample_each(df, ["k"], "h", 100, 4).groupBy("k").count().collect()
    assert len(got) == 4 and "a" in {r["k"] for r in got} and all(r["count"] == 100 for r in got)
    picked = {r["h"] for r in sample_each(df, ["k"], "h", 100, 50).where("k = 'a'").collect()}
    every = sorted((r["h"] % 2**31, r["h"]) for r in df.where("k = 'a'").collect())
    assert picked == {h for _, h in every[:100]}


def test_thresholds_do_not_depend_on_the_size_of_the_sample(spark, monkeypatch):
    chance = np.random.default_rng(4)
    y = (np.arange(20000) % 9 == 0).astype(float)
    p = toxicity.sigmoid(chance.normal(0, 1, len(y)) + 3 * y)
    use = np.concatenate([np.flatnonzero(y == 1)[:2000], np.flatnonzero(y == 0)[:2000]])
    stands = np.where(y[use] == 1, y.sum() / 2000, (1 - y).sum() / 2000)
    whole, cut = toxicity.best_threshold(p, y), toxicity.best_threshold(p[use], y[use], stands)
    clean = p[y == 0]
    assert abs((clean > whole).mean() - (clean > cut).mean()) < 0.012
    # What learn_toxicity hands over adds up to the labelled rows of each combination.
    seen = []
    original = toxicity.best_threshold
    monkeypatch.setattr(toxicity, "best_threshold", lambda p, y, s: seen.append((y, s)) or original(p, y, s))
    rows, labels = toxic_rows(2, 400)
    toxicity.learn_toxicity(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int, severe int"),
        {"toxic": "toxic = 1"}, settings=toxicity.Settings(sample_per_class=50),
    )
    (y, s), = seen
    assert len(y) == 100 and abs((s * y).sum() - 80) < 1e-6 and abs(s.sum() - 400) < 1e-6


def test_repeated_documents_count_once(spark, monkeypatch):
    rows, labels = toxic_rows(3, 200)
    docs = spark.createDataFrame(rows + [rows[1]] * 500, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int, severe int")
    sizes = []
    original = toxicity.fit_chain
    monkeypatch.setattr(toxicity, "fit_chain", lambda *a: sizes.append(len(a[2])) or original(*a))
    toxicity.learn_toxicity(docs, marks, {"toxic": "toxic = 1"})
    assert sizes == [200]
