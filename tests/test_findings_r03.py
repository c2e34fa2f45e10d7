"""Cases of the findings of round 3."""

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.ml import models, network
from tidemark.model import table
from tidemark.operators import sequences as seq
from tidemark.queries import QUERIES
from tidemark.streaming import jobs, rule_versions, stateful

START = datetime(2024, 1, 1)
TRANSACTIONS = (
    "transaction_id long, user_id long, timestamp timestamp, amount double, merchant_category string, merchant_id long"
)


def test_arrival_keeps_few_groups_and_windows_cross_their_slices(spark, tmp_path):
    chance = random.Random(3)
    data = [(i, i % 2, START + timedelta(seconds=chance.randrange(9000)), float(i), "c", 1) for i in range(60)]
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for k in range(0, 60, 20):
        spark.createDataFrame(data[k : k + 20], TRANSACTIONS).coalesce(1).write.mode("append").parquet(folder)
    known = spark.createDataFrame(data, TRANSACTIONS)
    source = jobs.file_stream(spark, folder, known.schema, files_per_trigger=1)
    found = stateful.velocity_on_arrival(source, 300, "3 hours")
    jobs.start(jobs.batches(found, jobs.append_batches(out), state)).awaitTermination()
    columns = ["transaction_id", "transaction_count_1h", F.round("total_amount_1h", 6).alias("t")]
    want = rows(seq.velocity(known, {"1h": 300}), *columns)
    assert rows(stateful.newest_revisions(spark.read.parquet(out)), *columns) == want
    held = spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "rows").load(state)
    assert held.count() <= 6  # 30 slices of a span and their next ones before


def test_equal_rows_are_learned_from_as_one(spark, monkeypatch):
    """Copies add weight, not rows, so a round of training does not grow with them."""
    data = [(i, i % 4, i % 3, int(i % 4 > 1)) for i in range(400)]
    known = spark.createDataFrame(data, "id long, a long, b long, label int")
    train, test = models.stratified_split(known)
    seen, summed = [], network._summed
    monkeypatch.setattr(network, "_summed", lambda rows, net: seen.append(rows.count()) or summed(rows, net))
    plain, losses = network.fit_weighted(train, test, ["a", "b"], hidden=(4,), positive_weight=2.0, rounds=3)
    assert max(seen) <= 24  # 4 * 3 features in two parts, 400 rows before
    x, y = (np.array([[float(v) for v in r[1:3]] for r in train.collect()]), np.array([r[3] for r in train.collect()]))
    assert plain.mean == pytest.approx(x.mean(axis=0)) and plain.deviation == pytest.approx(x.std(axis=0))
    start = network._start(("a", "b"), (4,), plain.mean, plain.deviation, 42)
    weight = np.where(y == 1, 2.0, 1.0)
    loss, _ = start.loss_and_gradient((x - plain.mean) / plain.deviation, y, weight)
    assert losses[0][0] == pytest.approx(loss / weight.sum())


def test_patience_of_one_is_a_single_fit(spark, monkeypatch):
    data = [(i, i % 7, i % 5, int((i * 37) % 11 > 5)) for i in range(600)]
    known = spark.createDataFrame(data, "id long, a long, b long, label int")
    fits, fit = [], models.GBTClassifier.fit
    monkeypatch.setattr(models.GBTClassifier, "fit", lambda self, df: fits.append(df.count()) or fit(self, df))
    model, _, _ = models.fit_boosted(known, ["a", "b"], rounds=12, depth=3, rate=0.5, patience=1)
    assert len(fits) == 1 and fits[0] <= 7 * 5 * 2 * 2  # several fits of all rows before
    _, test = models.stratified_split(known)
    long = models.GBTClassifier(labelCol="label", weightCol="weight", maxIter=12, maxDepth=3, stepSize=0.5, seed=42)
    train, _ = models.stratified_split(known)
    held = model.stages[0].transform(test.withColumn("weight", F.lit(1.0)))
    trees = fit(long, model.stages[0].transform(models.class_weights(train)))
    assert model.stages[-1].getNumTrees == models.rounds_kept(trees.evaluateEachIteration(held), 1)[0]


def test_a_log_with_lines_of_one_time_is_in_order(spark, folder, tmp_path):
    """Order of time is all that a log promises; lines of one time may come in any order."""
    events = table(spark, folder, "events").limit(400).withColumn("ts", F.lit(START))
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    found = QUERIES["scanned_logs"](spark, str(tmp_path)).first()
    assert (found["lines"], found["out_of_order"]) == (400, 0)


def test_volume_folders_are_written_without_a_sort(spark, folder):
    statuses = spark._jsparkSession.sharedState().statusStore()
    before = statuses.executionsList().size()
    assert QUERIES["storage_volume"](spark, folder).count() == 3
    made = statuses.executionsList()
    plans = [made.apply(i).physicalPlanDescription() for i in range(before, made.size())]
    writes = [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p]
    assert writes and not any("Sort" in p for p in writes)


class Held:
    """A state variable of a processor without a stream."""

    def __init__(self):
        self.values = []

    def exists(self):
        return bool(self.values)

    def get(self):
        return iter(list(self.values))

    def clear(self):
        self.values = []

    def appendValue(self, value):
        self.values.append(value)


class Versions(Held):
    def get(self):
        return self.values[0]

    def update(self, value):
        self.values = [value]


class Timers(list):
    registerTimer = list.append


class Passed:
    def __init__(self, millis):
        self.getCurrentWatermarkInMs = lambda: millis


def test_waiting_events_are_taken_up_array_by_array():
    lookup = rule_versions.VersionLookup()
    lookup.handle, lookup.versions, lookup.waiting = Timers(), Versions(), Held()
    parts = [
        pd.DataFrame({"at": [1000 * (10 * k + i) for i in range(10)], "event": [f"e{10 * k + i}" for i in range(10)], "rule": None})
        for k in range(5)
    ]
    parts[2] = pd.concat([parts[2], pd.DataFrame({"at": [12_000], "event": [None], "rule": ["r"]})])
    list(lookup.handleInputRows(("k", 0), iter(parts), Passed(0)))
    assert [len(times) for times, _ in lookup.waiting.values] == [10] * 5 and lookup.handle == [0]
    given = list(lookup.handleExpiredTimer(("k", 0), Passed(34), None))
    assert [len(g) for g in given] == [10, 10, 10, 5] and lookup.handle[-1] == 35
    every = pd.concat(given)
    assert list(every["event"]) == [f"e{i}" for i in range(35)]
    assert list(every["rule"]) == [None] * 12 + ["r"] * 23
    rest = list(lookup.handleExpiredTimer(("k", 0), Passed(99), None))
    assert sum(map(len, rest)) == 15 and not lookup.waiting.exists()


def test_a_forest_learns_from_equal_rows_as_one(spark, monkeypatch, tmp_path):
    """A tree is fitted on different rows only, each drawn as often as all of its copies would be."""
    data = [(i % 4, i % 3, int(i % 4 > 1 or i % 30 == 0)) for i in range(3000)]
    known = spark.createDataFrame(data, "a long, b long, label int").repartition(5)
    seen, fit = [], models.RandomForestClassifier.fit
    monkeypatch.setattr(models.RandomForestClassifier, "fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    forest = models.fit_forest(known, ["a", "b"], trees=12, depth=4)
    assert len(seen) == 12 and max(seen) <= 24  # 4 * 3 features in two classes, 3000 rows before
    assert forest.stages[-1].getNumTrees == 12
    models.save(forest, str(tmp_path / "forest"))
    distinct = known.select("a", "b").distinct()
    got = rows(models.score(distinct, forest), "a", "b", "probability")
    assert got == rows(models.score(distinct, models.load(str(tmp_path / "forest"))), "a", "b", "probability")
    assert not [c for c in models.score(distinct, forest).columns if c.startswith(models.BIN_PREFIX)]
    shares = {}
    for a, b, label in data:
        shares.setdefault((a, b), []).append(label)
    assert all(abs(p - np.mean(shares[a, b])) < 0.25 for a, b, p in got)
    one = spark.createDataFrame([(1.0, 0, 400)], "a double, label int, n long")
    drawn = np.array(models.bootstrapped(one, "n", 2000, 1).first()["draws"])
    assert abs(drawn.mean() - 400) < 3 and 340 < drawn.var() < 460


def test_bins_of_a_forest_keep_rare_values_and_whole_tails(spark):
    many = spark.createDataFrame([(float(i), int(i == 7)) for i in range(5000)], "a double, b long")
    wide, rare = models.bin_edges(many, ["a", "b"])
    assert rare[1:-1] == [0.5] and len(wide) == models.BINS + 1
    assert all(abs(edge - 5000 * (i + 1) / models.BINS) < 10 for i, edge in enumerate(wide[1:-1]))
    with pytest.raises(ValueError):
        models.fit_forest(many.limit(0), ["a"], label="b", trees=2)
