"""Ordered operators against plain Python on small and random rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import asof, percentiles
from tidemark.operators import sequences as seq
from tidemark.operators.hotkeys import hot_keys, join_unique
from tidemark.operators.running import running

START = datetime(2024, 1, 1)
SCHEMA = "transaction_id long, user_id long, timestamp timestamp, amount double, merchant_id long"


def at(seconds):
    return START + timedelta(seconds=seconds)


def events(spark, items):
    return spark.createDataFrame(
        [(i, u, at(s), v) for i, (u, s, v) in enumerate(items)],
        "id long, user_id long, ts timestamp, value string",
    )


def random_transactions(seed, count=300, users=4, span=4 * 86400):
    r = random.Random(seed)
    # A third of the rows belongs to one user.
    return [
        (
            i,
            1 if r.random() < 0.34 else r.randrange(2, users + 2),
            at(r.randrange(span)),
            round(r.uniform(0, 500), 2),
            r.randrange(6),
        )
        for i in range(count)
    ]


def test_first_row_defaults(spark):
    df = spark.createDataFrame([(1, 1, at(0), 5.0, 1)], SCHEMA)
    row = seq.acceleration(df).first()
    assert row["hours_since_last_transaction"] == 24.0
    assert row["transaction_acceleration"] == 0.0
    assert seq.days_since_previous(df).first()["days_since_last_transaction"] is None


@pytest.mark.parametrize("mode", ["plain", "split"])
@pytest.mark.parametrize("seed", [1, 2])
def test_velocity_equals_brute_force(spark, request, mode, seed):
    if mode == "split":
        request.getfixturevalue("hot")
    data = random_transactions(seed)
    got = {r["transaction_id"]: r for r in seq.velocity(spark.createDataFrame(data, SCHEMA), {"1h": 3600, "24h": 86400}).collect()}
    assert len(got) == len(data)
    for suffix, span in (("1h", 3600), ("24h", 86400)):
        for i, user, t, _, _ in data:
            window = [d for d in data if d[1] == user and t - timedelta(seconds=span) <= d[2] <= t]
            amounts = [d[3] for d in window]
            mean = sum(amounts) / len(amounts)
            assert got[i][f"transaction_count_{suffix}"] == len(window)
            assert got[i][f"total_amount_{suffix}"] == pytest.approx(sum(amounts))
            assert got[i][f"unique_merchants_{suffix}"] == len({d[4] for d in window})
            if len(amounts) > 1:
                std = (sum((a - mean) ** 2 for a in amounts) / (len(amounts) - 1)) ** 0.5
                assert got[i][f"std_amount_{suffix}"] == pytest.approx(std, abs=1e-6)


def test_velocity_of_unknown_and_fine_amounts(spark):
    data = [(1, 1, at(0), 10.0, 1), (2, 1, at(10), None, 1), (3, 1, at(20), 20.0, 1), (4, 2, at(0), None, 1),
            (5, 3, at(0), 0.004, 1), (6, 4, at(0), 1e6, 1), (7, 4, at(1), 1e6, 1)]
    got = {r["transaction_id"]: r for r in seq.velocity(spark.createDataFrame(data, SCHEMA), {"1h": 3600}).collect()}
    assert (got[3]["transaction_count_1h"], got[3]["avg_amount_1h"]) == (3, 15.0)
    assert got[3]["std_amount_1h"] == pytest.approx(50**0.5)
    assert (got[4]["total_amount_1h"], got[4]["avg_amount_1h"], got[4]["std_amount_1h"]) == (None, None, None)
    assert got[5]["total_amount_1h"] == 0.004
    assert got[7]["std_amount_1h"] == 0.0


def test_session_gap_is_inclusive(spark):
    df = events(spark, [(1, 0, ""), (1, 30, ""), (1, 61, ""), (2, 0, "")])
    found = rows(seq.gap_sessions(df, 30), "user_id", "event_count", "window_start", "window_end")
    assert found == [(1, 1, at(61), at(61)), (1, 2, at(0), at(30)), (2, 1, at(0), at(0))]


def pattern(spark, items):
    df = events(spark, items)
    found = seq.followed_by(df, F.col("value").contains("rapid"), F.col("value").contains("fire"), 30)
    return rows(found, "user_id", "window_start", "window_end", "avg_processing_time")


def test_pattern_bounds(spark):
    assert pattern(spark, [(1, 0, "rapid"), (1, 29, "fire")]) == [(1, at(0), at(29), 29000.0)]
    assert pattern(spark, [(1, 0, "rapid"), (1, 30, "fire")]) == []
    assert pattern(spark, [(1, 0, "rapid fire")]) == []
    assert pattern(spark, [(1, 0, "rapid"), (2, 5, "fire")]) == []
    assert pattern(spark, [(1, 0, None), (1, 1, "rapid"), (1, 2, "x"), (1, 3, "fire"), (1, 4, "fire")]) == [
        (1, at(1), at(3), 2000.0)
    ]
    assert len(pattern(spark, [(1, 0, "rapid"), (1, 1, "rapid"), (1, 3, "fire")])) == 2


def test_every_nth(spark):
    df = events(spark, [(1, s, "") for s in range(250)] + [(2, s, "") for s in range(99)])
    assert rows(seq.every_nth(df), "user_id", "event_count") == [(1, 100), (1, 200)]


def test_held_for(spark):
    df = events(spark, [(1, 0, "y"), (1, 100, "y"), (1, 200, "n"), (1, 300, "y"), (1, 350, "y")])
    found = seq.held_for(df, F.col("value") == "y", 100, ["user_id"])
    assert rows(found, "started_at", "last_seen_at", "samples") == [(at(0), at(100), 2)]


def test_as_of_ttl_excludes_exact_age(spark):
    view = spark.createDataFrame([(1, at(0), 7)], "user_id long, event_timestamp timestamp, n long")
    day = 86400
    entities = spark.createDataFrame(
        [(1, 1, at(-1)), (2, 1, at(0)), (3, 1, at(day - 1)), (4, 1, at(day)), (5, 2, at(5))],
        "row_id long, user_id long, event_timestamp timestamp",
    )
    found = rows(asof.as_of_join(entities, view, "user_id", ["n"], "1 DAY"), "row_id", "n")
    assert found == [(1, None), (2, 7), (3, 7), (4, None), (5, None)]


def test_hot_keys_are_found_and_bounded(spark, hot):
    df = spark.range(30000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    found = hot_keys(df, ["k"])
    assert found == [df.where("id = 0").select(F.xxhash64("k")).first()[0]]


def test_null_keys_can_be_hot(spark, hot):
    data = [(None if i % 3 else i, at(i), i) for i in range(900)]
    df = spark.createDataFrame(data, "k long, ts timestamp, id long")
    out = running(df, ["k"], ["ts", "id"], [("n", "count", F.lit(1))])
    assert out.where("k IS NULL").agg(F.max("n")).first()[0] == 600
    assert out.where("k IS NOT NULL").agg(F.max("n")).first()[0] == 1


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_kinds_split_equals_plain(spark, request, reverse, inclusive):
    data = random_transactions(5)
    df = spark.createDataFrame(data, SCHEMA)
    specs = [
        ("s", "sum", F.col("merchant_id")),
        ("n", "count", F.when(F.col("merchant_id") > 2, 1)),
        ("hi", "max", F.col("amount")),
        ("lo", "min", F.col("amount")),
        ("prev", "last", F.when(F.col("merchant_id") > 3, F.col("transaction_id"))),
    ]

    def result():
        out = running(
            df, ["user_id"], ["timestamp", "transaction_id"], specs, inclusive=inclusive, reverse=reverse
        )
        filled = out.withColumn("n", F.coalesce("n", F.lit(0)))
        return rows(filled, "transaction_id", "s", "n", "hi", "lo", "prev")

    plain = result()
    request.getfixturevalue("hot")
    assert result() == plain


def test_percentiles_split_equals_builtin(spark, hot):
    df = spark.createDataFrame(random_transactions(9), SCHEMA)
    found = percentiles.percentiles(df, ["user_id"], "amount", {"a": 0.5, "b": 0.95, "c": 1.0})
    want = df.groupBy("user_id").agg(
        *[F.percentile("amount", q).alias(n) for n, q in (("a", 0.5), ("b", 0.95), ("c", 1.0))]
    )
    for x, y in zip(rows(found, "user_id", "a", "b", "c"), rows(want)):
        assert x == pytest.approx(y)


def test_join_unique_keeps_all_rows(spark, hot):
    left = spark.range(300).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    right = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert rows(join_unique(left, right, ["k"]), "id", "v") == rows(left.join(right, "k", "left"), "id", "v")
    assert join_unique(left, right, ["k"], "inner").count() == left.join(right, "k").count()


def brute_sessions(data, life):
    """(id, session start) by walking through each user's rows."""
    starts, out = {}, []
    for row_id, ts, user in sorted((r for r in data if r[1]), key=lambda r: r[1]):
        start = starts.get(user)
        if start is None or (ts - start).total_seconds() > life:
            start = starts[user] = ts
        out.append((row_id, start))
    return sorted(out + [(r[0], None) for r in data if not r[1]], key=repr)


@pytest.mark.parametrize("users", [1, 4])
@pytest.mark.parametrize("split", [False, True])
def test_fixed_life_sessions_equal_brute_force(spark, request, users, split):
    if split:
        request.getfixturevalue("hot")
    chance = random.Random(users)
    data = []
    at = datetime(2024, 1, 1)
    for i in range(1500):
        # Mostly chains of short gaps, ties, and gaps of exactly a life or just above.
        at += timedelta(seconds=chance.choice([0, 1, 3, 7, 7, 20, 100 if i % 9 == 0 else 2, 101 if i % 50 == 0 else 5]))
        data.append((i, at, chance.randrange(users) if i % 11 else None))
    data += [(9000, None, 0), (9001, None, None)]
    df = spark.createDataFrame(data, "id long, ts timestamp, user_id long")
    got = seq.fixed_life_sessions(df, 100)
    assert got.columns == ["id", "ts", "user_id", "session_start"]
    assert rows(got, "id", "session_start") == brute_sessions(data, 100)


def test_fixed_life_sessions_of_one_user_are_spread(spark, hot):
    """All rows of one user: they are numbered in several tasks, and log n rounds suffice."""
    df = spark.range(20_000).select(
        "id", F.lit(7).alias("user_id"), (F.lit(datetime(2024, 1, 1)).cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 3)).alias("ts")
    )
    got = seq.fixed_life_sessions(df, 10)
    assert got.where("session_start <> timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id div 4 * 12)").count() == 0
    ranges = got.groupBy(F.spark_partition_id()).count().collect()
    assert len(ranges) > 1 and max(r["count"] for r in ranges) < 20_000


def test_fixed_life_sessions_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id long, ts timestamp, user_id long")
    assert seq.fixed_life_sessions(df).collect() == []


def test_hot_key_in_the_order_of_text(spark, hot):
    chance = random.Random(12)
    names = ["", "a", "ab", "abcdefg", "abcdefh", "abcdef", "é", "zz\U0001f600", "漢字", None]
    data = [(i, 1 if i % 3 else 2, chance.choice(names) if i % 2 else f"n{chance.randrange(400)}") for i in range(900)]
    df = spark.createDataFrame(data, "id long, k long, name string")
    specs = [("n", "count", F.lit(1)), ("last", "last", F.col("id")), ("least", "min", F.col("id"))]
    split = running(df, ["k"], ["name", "id"], specs)
    whole = running(df, ["k"], ["name", "id"], specs, hot=[])
    assert "_bucket" in split._jdf.queryExecution().analyzed().toString()
    assert rows(split) == rows(whole)


def test_buckets_follow_the_rows_of_a_key(spark, monkeypatch):
    from tidemark.operators import hotkeys

    monkeypatch.setattr(hotkeys, "BUCKET_ROWS", 100)
    df = spark.range(4600).select("id", F.when(F.col("id") < 4000, 1).when(F.col("id") < 4500, 2).otherwise(3).alias("k"))
    of = dict(df.select("k", hotkeys.key_hash(["k"]).alias("h")).distinct().collect())
    parted = hotkeys.with_buckets(df, ["k"], [of[1], of[2]], "id")
    sizes = parted.groupBy("k", "_bucket").count().collect()
    per_key = {k: [r["count"] for r in sizes if r["k"] == k] for k in (1, 2, 3)}
    assert len(per_key[1]) == 40 and len(per_key[2]) == 5 and len(per_key[3]) == 1
    assert max(per_key[1] + per_key[2]) <= 130


@pytest.mark.parametrize("split", [False, True])
def test_velocity_of_amounts_of_any_size(spark, request, split):
    if split:
        request.getfixturevalue("hot")
    amounts = [1e13, 3e13, float("nan"), float("inf"), None, 2.5e15, 7.0, 1e13]
    data = [(i, 1, at(60 * i), a, 1) for i, a in enumerate(amounts)]
    got = seq.velocity(spark.createDataFrame(data, SCHEMA), {"1h": 3600}).orderBy("transaction_id").collect()
    known = []
    for row, amount in zip(got, amounts):
        if amount is not None and abs(amount) < float("inf"):
            known.append(amount)
        assert row["transaction_count_1h"] == row["transaction_id"] + 1
        assert row["total_amount_1h"] == pytest.approx(sum(known), rel=1e-13)
        assert row["avg_amount_1h"] == pytest.approx(sum(known) / len(known), rel=1e-13)
        if len(known) > 1:
            mean = sum(known) / len(known)
            spread = (sum((a - mean) ** 2 for a in known) / (len(known) - 1)) ** 0.5
            assert row["std_amount_1h"] == pytest.approx(spread, rel=1e-9)
