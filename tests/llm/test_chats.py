"""Reply trees, their template and what is read back from it."""

import random

import pytest
from pyspark.sql import functions as F

from tests.compare import compare
from tests.llm.conftest import plain
from tidemark.llm import chat_trees
from tidemark.llm.queries import ORACLES, QUERIES

SCHEMA = "id long, parent long, role string, text string, score double, leaf string"


def test_chats_query(spark, duck, folder):
    assert compare(spark, duck, folder, "op11_chats", QUERIES["op11_chats"], ORACLES["op11_chats"])[2] is None


def test_chats_query_with_hot_conversations(spark, duck, folder, hot):
    assert compare(spark, duck, folder, "op11_chats", QUERIES["op11_chats"], ORACLES["op11_chats"])[2] is None


def brute_paths(rows, branches):
    """(root, leaf, rank, path) of the best leaves of every tree."""
    of = {r[0]: r for r in rows}
    parents = {r[1] for r in rows if r[1] in of}
    paths = {}
    for leaf in of:
        if leaf in parents:
            continue
        path = [leaf]
        while of[path[-1]][1] in of and len(path) <= len(of):
            path.append(of[path[-1]][1])
        if len(path) <= len(of):
            paths[leaf] = path[::-1]
    trees = {}
    for leaf, path in paths.items():
        score = sum(of[n][4] or 0.0 for n in path)
        trees.setdefault(path[0], []).append((-score, leaf, path))
    return sorted(
        (root, leaf, rank, path)
        for root, found in trees.items()
        for rank, (_, leaf, path) in enumerate(sorted(found), 1)
        if branches is None or rank <= branches
    )


@pytest.mark.parametrize("branches", [1, 2, None])
def test_best_branches_equal_brute_force(spark, branches):
    chance = random.Random(5)
    rows = []
    for i in range(90):
        parent = None if i % 30 == 0 else chance.randrange(i // 30 * 30, i)
        score = chance.choice([None, 0.0, 0.25, 0.5, -1.0])
        rows.append((i, parent, chance.choice(["user", "assistant"]), f"m{i}", score, "x"))
    rows += [(200, 999, "user", "m200", 0.0, "x")]  # its parent is not there
    rows += [(300, 301, "user", "a", 0.0, "x"), (301, 300, "user", "b", 0.0, "x"), (302, 301, "user", "c", 0.0, "x")]
    chats = chat_trees.format_chats(spark.createDataFrame(rows, SCHEMA), score_col="score", branches=branches)
    texts = chats.select("root", "leaf", "rank", chat_trees.read_turns(chat_trees.turns_of(F.col("formatted")))["text"])
    got = sorted((a, b, c, [int(t[1:]) for t in texts]) for a, b, c, texts in texts.collect())
    assert got == brute_paths(rows, branches)


def test_long_path_is_whole(spark):
    rows = [(i, i - 1 if i else None, "user", f"m{i}", None, "x") for i in range(700)]
    chats = chat_trees.format_chats(spark.createDataFrame(rows, SCHEMA))
    (row,) = chats.select("leaf", chat_trees.read_turns(chat_trees.turns_of(F.col("formatted")))["text"]).collect()
    assert tuple(row) == (699, [f"m{i}" for i in range(700)])


CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE:", "[/ROLE]", " [/INST]", "\n<</SYS>>"]


def test_texts_come_back_whatever_they_hold(spark):
    chance = random.Random(9)
    pieces = [*CONTROLS, "<", "[", "\\", "\\\\", "</", "[/", " ", "\n", "s>", "INST]", "SYS>>", "a", "\U0001f600", "é", ">", "]"]
    texts = ["".join(chance.choices(pieces, k=chance.randint(0, 12))) for _ in range(400)]
    texts += [c[:i] + "\\" * k + c[i:] for c in CONTROLS for i in range(len(c)) for k in range(3)]
    roles = ["user", "assistant", "system", "tool", "", "a]b <s>\n%20+", None]
    rows = []
    for i, text in enumerate(texts):
        parent = i - 1 if i % 25 else None
        rows.append((i, parent, chance.choice(roles), None if text == "a" else text, None, "x"))
    chats = chat_trees.format_chats(spark.createDataFrame(rows, SCHEMA))
    read = chats.select(
        "root", "formatted", "turns",
        chat_trees.read_turns(chat_trees.turns_of(F.col("formatted"))).alias("back"),
        chat_trees.read_loss(chat_trees.turns_of(F.col("formatted")), F.col("turns")).alias("loss"),
        chat_trees.unescape(F.lit("x")).alias("x"),
    ).collect()
    assert len(read) == len(range(0, len(texts), 25))
    for root, formatted, turns, back, loss, _ in read:
        want = [(r[2] or "", r[3] or "") for r in rows[root : root + 25]]
        assert [tuple(b) for b in back] == want
        assert loss == [text if role == "assistant" else "" for role, text in want]
        # The marks are places in the whole formatted text.
        assert [t["begin"] for t in turns] == sorted(t["begin"] for t in turns)
        for turn, (role, text) in zip(turns, want, strict=True):
            assert (turn["loss_start"] is not None) == (role == "assistant")
            if role == "assistant":
                held = formatted[turn["loss_start"] : turn["loss_end"]]
                assert formatted[turn["loss_end"] :].startswith("</s>") and "</s>" not in held


def test_odd_messages(spark):
    rows = [
        (1, None, None, None, None, "x"),
        (2, 1, "user", "", float("nan"), None),
        (2, 1, "user", "", float("nan"), None),  # repeated
        (None, 1, "user", "no id", 1.0, "x"),
        (None, None, None, None, None, None),
        (3, 3, "user", "replies to itself", 1.0, "x"),
        (4, None, "assistant", "w " * 100_000, 1.0, "x"),
    ]
    chats = chat_trees.format_chats(spark.createDataFrame(rows, SCHEMA), score_col="score", branches=None)
    got = plain(chats.select("leaf", F.size("turns").alias("n"), F.length("formatted").alias("chars")), "leaf", "n")
    assert got == [(2, 2), (4, 1), (None, 1)]
    empty = chat_trees.format_chats(spark.createDataFrame([], SCHEMA), score_col="score")
    assert empty.collect() == []


def test_chained_ties_nulls_and_repeated_rows(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", None),
            (None, 1, "user", "x"), (None, 0, None, "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chats = chat_trees.format_chats(chat_trees.chained(df, "conv_id", "turn", "role", "text"))
    texts = chats.select("root.group", chat_trees.read_turns(chat_trees.turns_of(F.col("formatted")))["text"].alias("t"))
    assert plain(texts, "group", "t") == [(1, ["", "a", "a", "b"]), (None, ["y", "x"])]
