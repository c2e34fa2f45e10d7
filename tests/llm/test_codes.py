"""Vector codes and fill-in-the-middle texts."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.compare import compare
from tests.llm.conftest import plain
from tidemark.llm import fill_middle, vector_codes
from tidemark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ["op12_vector_codes", "op13_fill_middle"])
def test_queries(spark, duck, folder, name):
    assert compare(spark, duck, folder, name, QUERIES[name], ORACLES[name])[2] is None


@pytest.mark.parametrize("spread", [1, 3, 40, 1000, 1 << 27])
@pytest.mark.parametrize("entries", [1, 2, 63, 64])
def test_nearest_equals_brute_force(spread, entries):
    chance = np.random.default_rng(spread + entries)
    books = chance.integers(-spread, spread, (entries, 4), endpoint=True)
    points = chance.integers(-spread, spread, (500, 4), endpoint=True)
    points[:50] = books[chance.integers(0, entries, 50)]
    found = vector_codes.Slices(books)
    squares = ((points[:, None, :] - books[None]) ** 2).sum(axis=2)
    entry, least = found.nearest(points)
    assert (entry == squares.argmin(axis=1)).all() and (least == squares.min(axis=1)).all()
    # The bit masks hold all nearest entries, and far ones are left out.
    masks = found.candidates(points, found.radius(points))
    for mask, row in zip(masks.tolist(), squares.tolist(), strict=True):
        assert all(mask >> e & 1 for e, d in enumerate(row) if d == min(row))
    if spread == 1000 and entries == 64:
        assert np.bitwise_count(masks).mean() < 16


def test_more_entries_than_bits_are_refused():
    with pytest.raises(ValueError):
        vector_codes.Slices(np.zeros((65, 4), np.int64))


VECTORS = "vec_id long, embedding array<float>, label int, code string, `a b` string"


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (5, [0.5, -0.001, 1.0, 2.0], 1, "x", "y"),
        (5, [0.5, -0.001, 1.0, 2.0], 1, "x", "y"),
        (3, [0.0, 0.0, 0.0, 0.0], None, None, None),
        (None, [1.0, 1.0, 1.0, 1.0], None, "x", "y"),
        (1, None, 1, "x", "y"), (2, [None, 0.0, 0.0, 0.0], 1, "x", "y"),
        (4, [nan, 0.0, 0.0, 0.0], 1, "x", "y"), (6, [0.0, -inf, 0.0, 0.0], 1, "x", "y"),
        (7, [], 2, "x", "y"), (8, [1.0], 2, "x", "y"),
    ]
    coded, books = vector_codes.vector_codes(spark.createDataFrame(rows, VECTORS), parts=2, entries=2, rounds=0)
    assert books.tolist() == [[[0, 0], [128, -1]], [[0, 0], [256, 512]]]
    got = plain(vector_codes.with_group_error(coded), "vec_id", "code", "error", "label_error")
    # [1, 1] lies nearer to (128, -1) than to the origin, and as near to (256, 512) as to it.
    far = 128 * 128 + 257 * 257 + 256 * 256
    assert got == [
        (3, "0000", 0, far), (5, "0101", 0, 0), (5, "0101", 0, 0),
        (7, None, None, None), (8, None, None, None), (None, "0101", far, far),
    ]
    salted = vector_codes.with_group_error(coded, most=0)
    assert plain(salted, "vec_id", "code", "error", "label_error") == got
    empty, books = vector_codes.vector_codes(spark.createDataFrame([], VECTORS))
    assert vector_codes.with_group_error(empty).collect() == [] and books.size == 0


def test_entries_move_to_floored_means(spark):
    chance = np.random.default_rng(3)
    vectors = chance.normal(0, 0.3, (300, 8)).astype(np.float32)
    rows = [(i, v.tolist(), i % 3, "x", "y") for i, v in enumerate(vectors)]
    coded, books = vector_codes.vector_codes(spark.createDataFrame(rows, VECTORS), parts=2, entries=5, rounds=3)
    whole = np.floor(vectors.astype(float) * 256).astype(np.int64)
    codes = {i: "" for i in range(300)}
    for part in range(2):
        points = whole[:, 4 * part : 4 * part + 4]
        entries = points[:5].copy()
        for step in range(4):
            nearest = ((points[:, None] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
            for e in range(5):
                if step < 3 and (nearest == e).any():
                    entries[e] = points[nearest == e].sum(axis=0) // (nearest == e).sum()
        assert (books[part] == entries).all()
        for i, e in enumerate(nearest):
            codes[i] += f"{e:02x}"
    assert dict(coded.select("vec_id", "code").collect()) == codes


def test_components_beyond_the_range_are_an_error(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0], 0, "x", "y")], VECTORS)
    with pytest.raises(Exception, match="lies beyond"):
        vector_codes.vector_codes(df, parts=1)


def test_cut_equals_slices(monkeypatch):
    monkeypatch.setattr(fill_middle, "PIECE_BYTES", 64)
    chance = random.Random(2)
    letters = "ab é漢\U0001f600\n<\x00"
    texts = ["".join(chance.choices(letters, k=chance.choice([0, 1, 5, 40, 300]))) for _ in range(200)]
    start, end = [], []
    for text in texts:
        a, b = sorted(chance.choices(range(len(text) + 1), k=2))
        start.append(a), end.append(b)
    forms = [chance.choice(["plain", "psm", "spm"]) for _ in texts]
    whole = pa.array(["skipped", *texts], pa.string())[1:]  # a slice with an offset
    out = fill_middle.rearranged(
        whole, pa.array(forms), pa.array(start, pa.int32()), pa.array(end, pa.int32()), fill_middle.Marks()
    ).to_pylist()
    for text, form, a, b, got in zip(texts, forms, start, end, out, strict=True):
        p, m, s = text[:a], text[a:b], text[b:]
        assert got == {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]


def test_marks_that_overlap_are_refused():
    for marks in [("<P>", "<S>", ""), ("aba", "x", "y"), ("xa", "ab", "c"), ("<P>", "<P>", "<M>")]:
        with pytest.raises(ValueError):
            fill_middle.Marks(*marks)


def test_odd_texts(odd):
    for extra in ("form", "output", "c0", "text2 x", "h1", "START"):
        made = fill_middle.fill_in_middle(odd(extra))
        assert made.columns[-5:] == ["n", "form", "prefix_chars", "middle_chars", "output"]
        back = fill_middle.restored(F.col("output"), F.col("form"))
        rows = made.select(F.coalesce("text", F.lit("")).alias("was"), back.alias("back"), "form", "n", "output")
        got = rows.collect()
        assert len(got) == 11 and all(r["was"] == r["back"] and r["n"] == len(r["was"]) for r in got)
        assert all(r["form"] == "plain" for r in got if r["was"] == "")
    assert fill_middle.fill_in_middle(odd("x", [])).collect() == []


def test_marks_within_texts_and_shares(spark):
    texts = [f"{'a <' * (i % 7)}>P> S>{i}" for i in range(3000)] + ["x<P>y", "<S>", "z<M>"] * 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = fill_middle.fill_in_middle(df, plain_percent=30, spm_percent=50)
    back = fill_middle.restored(F.col("output"), F.col("form"))
    assert made.where(F.col("text") != back).count() == 0
    forms = {r["form"]: r["count"] for r in made.where("doc_id < 3000").groupBy("form").count().collect()}
    assert abs(forms["plain"] / 3000 - 0.3) < 0.05 and abs(forms["spm"] / 3000 - 0.35) < 0.05
    assert made.where("doc_id >= 3000 and form <> 'plain'").count() == 0
    one = made.where("form = 'psm'").first()
    h = hashlib.sha256(f"1:{one['doc_id']}".encode()).hexdigest()
    a, b = sorted(int(h[i : i + 8], 16) % (one["n"] + 1) for i in (0, 8))
    assert (one["prefix_chars"], one["middle_chars"]) == (a, b - a)
