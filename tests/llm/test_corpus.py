"""Benchmark leaks, mixing and the pipeline."""

import random

import numpy as np
import pytest

from tests.compare import compare
from tests.llm.conftest import plain
from tidemark.llm import decontamination, mixing
from tidemark.llm.queries import MIX_BLOCK, MIX_PERIOD, MIXTURE, ORACLES, QUERIES


def edits_within(patterns, text):
    """For each of several patterns of one length the fewest edits against any stretch of the text."""
    symbols = np.array([[ord(c) for c in p] for p in patterns])
    steps = np.arange(symbols.shape[1] + 1)
    row = np.tile(steps, (len(patterns), 1))
    best = row[:, -1].copy()
    for c in text:
        moved = np.minimum(row[:, 1:] + 1, row[:, :-1] + (symbols != ord(c)))
        row = np.concatenate([np.zeros((len(patterns), 1), int), moved], axis=1)
        row = np.minimum.accumulate(row - steps, axis=1) + steps
        best = np.minimum(best, row[:, -1])
    return best


def windows_of(item, settings):
    m = min(settings.window, len(item))
    return sorted({item[start : start + m] for start in range(len(item) - m + 1)})


def brute_leaks(text, items, settings):
    text = decontamination.normalised(text)
    out = set()
    for number, item in enumerate(items):
        item = decontamination.normalised(item)
        if len(item) < max(settings.least, settings.q):
            continue
        windows = windows_of(item, settings)
        if edits_within(windows, text).min() <= decontamination.edit_budget(len(windows[0]), settings):
            out.add(number)
    return out


def passages(seed):
    chance = random.Random(seed)
    words = ["".join(chance.choice("abcdefgh") for _ in range(chance.randint(2, 7))) for _ in range(60)]

    def prose(n):
        return " ".join(chance.choice(words) for _ in range(n))

    items = [prose(chance.randint(5, 40)) for _ in range(12)] + ["short", "", prose(90)]
    texts = []
    for _ in range(45):
        item = chance.choice(items)
        a = chance.randrange(max(1, len(item) // 3))
        piece = list(item[a : a + chance.randint(60, 400)])
        for _ in range(chance.randint(0, 12)):
            if piece:
                place = chance.randrange(len(piece))
                piece[place] = chance.choice(["", "x", piece[place] + "y", piece[place].upper()])
        texts.append(prose(chance.randint(0, 40)) + " " + "".join(piece) + "\n " + prose(chance.randint(0, 40)))
    return items, texts


@pytest.mark.parametrize("settings", [decontamination.Settings(), decontamination.Settings(window=60, rate=0.1, q=6)])
def test_leaks_equal_brute_force(settings):
    items, texts = passages(4)
    index = decontamination.Index([decontamination.normalised(i) for i in items], settings)
    hits = 0
    for text in texts:
        plain_text = decontamination.normalised(text)
        found = index.find(plain_text)
        assert {n for n, *_ in found} == brute_leaks(text, items, settings)
        hits += len(found)
        for number, start, end, edits in found:
            item = decontamination.normalised(items[number])
            assert edits_within(windows_of(item, settings), plain_text[start:end]).min() <= edits
    assert 0 < hits


def test_clean_texts_are_left_alone_and_blocks_agree(spark):
    items, texts = passages(9)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    one = plain(decontamination.find_leaks(docs, bench), "doc_id", "item", "start", "end", "edits")
    small = decontamination.Settings(block_chars=500)
    assert plain(decontamination.find_leaks(docs, bench, settings=small), "doc_id", "item", "start", "end", "edits") == one
    leaking = {r[0] for r in one}
    assert leaking == {i for i, t in enumerate(texts) if brute_leaks(t, items, decontamination.Settings())}
    kept = decontamination.drop_leaking(docs, bench)
    assert {r[0] for r in plain(kept, "doc_id")} == set(range(len(texts))) - leaking


def test_verbatim_parts_are_found_wherever_they_start(spark):
    chance = random.Random(5)

    def letters(n):
        return "".join(chance.choice("abcdefghijklmnop") for _ in range(n))

    item, short = letters(260), "what is 7 x 8"
    texts = [letters(60) + item[at : at + 100] + letters(60) for at in range(161)]
    texts += [letters(60) + item[at : at + 60] + letters(60) for at in range(0, 200, 9)]
    texts += [f"{letters(20)} {short.upper()} {letters(20)}", f"{letters(20)} what is 8 x 7 {letters(20)}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # Equal texts of several items are searched once and found under every id.
    items = [(1, item), (2, short), (3, item), (3, item), (4, letters(80)), (5, "too short")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(plain(decontamination.find_leaks(docs, bench), "doc_id", "item", "start", "end", "edits"))
    last = len(texts) - 2
    # The first window within the budget may begin a little before the part.
    assert [r[:2] for r in got] == [(d, i) for d in range(161) for i in (1, 3, 3)] + [(last, 2)]
    assert got[-1] == (last, 2, 21, 34, 0)
    assert all(r[4] <= 8 and abs(r[2] - 60) <= 16 and abs(r[3] - 160) <= 16 for r in got[:-1])


def test_leaks_odd_rows(odd, spark):
    bench = spark.createDataFrame(
        [(1, "lorem ipsum dolor sit amet lorem ipsum"), (2, None), (None, "one two"), (3, ""), (4, "x")],
        "item_id long, text string",
    )
    got = plain(decontamination.find_leaks(odd("item"), bench), "doc_id", "item", "start", "edits")
    assert got == [(4, 1, 0, 0)]
    kept = decontamination.drop_leaking(odd("_key"), bench)
    assert kept.columns == odd("_key").columns and kept.count() == odd().count() - 1
    assert decontamination.find_leaks(odd(rows=[]), bench).count() == 0
    assert decontamination.find_leaks(odd(), bench.where("item_id > 9")).count() == 0


def test_planted_benchmark_passages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    texts, items = dict(plain(docs, "doc_id", "text")), plain(bench, "item_id", "text")
    whole = {(d, i) for d, t in texts.items() for i, item in items if t and item in t}
    got = {(r["doc_id"], r["item"]) for r in QUERIES["op7_decontamination"](spark, folder).collect()}
    assert whole and whole <= got


@pytest.mark.parametrize("weights, period", [({"a": 5, "b": 3, "c": 1, "d": 0.5}, 60), (MIXTURE, MIX_PERIOD), ({"a": 1}, 1)])
def test_windows_hold_and_deviation_stays_below_a_block(weights, period):
    slots = mixing.shares(weights, period)
    assert sum(slots.values()) == period
    taken = dict.fromkeys(slots, 0)
    for source, block, slot in mixing.period_order(slots):
        assert block == taken[source]
        share = slots[source] / period
        assert int(block / share + 1e-9) <= slot <= -(-(block + 1) * period // slots[source]) - 1
        taken[source] += 1
        for name, n in taken.items():
            assert abs(n - (slot + 1) * slots[name] / period) < 1


def test_mixing_equals_sql(spark, duck, folder):
    name = "op3_mixing"
    assert compare(spark, duck, folder, name, QUERIES[name], ORACLES[name])[2] is None


def test_mixture_follows_weights_until_a_source_ends(spark):
    rows = [(i, f"s{i % 3}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string").selectExpr("doc_id", "'t' AS text", "source")
    weights = {"s0": 0.5, "s1": 0.3, mixing.REST: 0.2}
    got = mixing.mix_sources(df, weights, period=10, block_rows=8, bucket_rows=100)
    placed = got.orderBy("mix_position").collect()
    assert len(placed) == 3000 and len({r["mix_position"] for r in placed}) == 3000
    balanced = [r for r in placed if r["mix_balanced"]]
    # s0 is used up first: 125 blocks at half of the slots.
    assert 240 <= balanced[-1]["mix_slot"] < 260
    counts = {"s0": 0, "s1": 0, "s2": 0}
    for n, row in enumerate(balanced, 1):
        counts[row["source"]] += 1
        for source, share in (("s0", 0.5), ("s1", 0.3), ("s2", 0.2)):
            assert abs(counts[source] - n * share) < 8
    again = mixing.mix_sources(df.repartition(7), weights, period=10, block_rows=8, bucket_rows=1000)
    assert plain(again, "doc_id", "mix_position") == plain(got, "doc_id", "mix_position")


def test_mixing_odd_rows(odd, odd_rows):
    got = mixing.mix_sources(odd("mix_slot"), {"src0": 1, "src1": 1}, period=10, block_rows=2)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", *got.columns[5:]]
    assert plain(got, "doc_id", "text") == sorted([r[:2] for r in odd_rows], key=repr)
    assert got.select("mix_position").distinct().count() == len(odd_rows)
    assert mixing.mix_sources(odd(rows=[]), {"src0": 1}).count() == 0


def test_pipeline(spark, folder):
    import corpus_pipeline

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = [t for (t,) in plain(spark.read.parquet(f"{folder}/benchmark.parquet"), "text")]
    rows = corpus_pipeline.run(spark, folder).collect()
    kept = {r["doc_id"]: r for r in rows}
    texts = dict(plain(docs, "doc_id", "text"))
    assert len(kept) == len(rows) < len(texts)
    assert not [t for r in rows for t in bench if t in r["text"]]
    assert len({" ".join(r["text"].split()) for r in rows}) == len(rows)
    assert len({r["mix_position"] for r in rows}) == len(rows)
    assert all(r["text"] == texts[k] for k, r in kept.items())
    assert set(docs.columns) <= set(rows[0].asDict())


def test_pipeline_stages_on_odd_rows(odd, odd_rows, spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, "lorem ipsum dolor sit amet lorem ipsum")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    for rows in (odd_rows, []):
        for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = odd("_own", rows)
            got = stage(spark, docs, str(tmp_path))
            got.collect()
            if at < 4:
                assert got.columns == docs.columns, name


def test_language_stage_uses_the_network(spark, folder, monkeypatch):
    from pyspark.sql import functions as F

    import corpus_pipeline
    from tidemark.llm import language

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    lettered = docs.where("text rlike '\\\\p{L}'").count()
    unlabelled = docs.drop("lang").selectExpr("*", "cast(null as string) as lang").select(docs.columns)
    assert corpus_pipeline.identify_language(spark, unlabelled, folder).count() == lettered > 0
    kept = corpus_pipeline.identify_language(spark, docs, folder)
    network = language.fit_language(docs.where(~corpus_pipeline.held_out(F.col("doc_id"), 4)))
    scored = language.identify_language(docs.select("doc_id", "text"), network)
    sure = scored.where((scored.lang_pred != "und") & (scored.score >= corpus_pipeline.LEAST_SCORE))
    assert plain(kept, "doc_id") == plain(sure, "doc_id")
    # Held-out documents stay, texts of no learned language go.
    held = docs.where(corpus_pipeline.held_out(F.col("doc_id"), 4)).where("lang is not null and text rlike '\\\\p{L}'")
    assert kept.join(held.select("doc_id"), "doc_id").count() >= 0.97 * held.count()
    monkeypatch.setattr(corpus_pipeline, "LEAST_SCORE", 1.1)
    assert corpus_pipeline.identify_language(spark, docs, folder).count() == 0
