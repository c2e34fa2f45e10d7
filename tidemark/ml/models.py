"""Model training, persistence and scoring on tables and streams with Spark ML."""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Callable, Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
from py4j.protocol import Py4JJavaError
from pyspark import SparkContext, inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.protect import hash_slot
from tidemark.session import cut_lineage

FEATURES = ["user_id", "item_id", "hour_of_day", "day_of_week"]

BINS = 32  # of a feature in a forest, Spark's own number
BIN_PREFIX = "_bin_"
FEW_ROWS = 10_000_000  # different rows up to which the tasks of a tree are counted by rows
ROWS_A_TASK = 20_000

# What Spark says of a path without files.
MISSING = ("Input path does not exist", "PATH_NOT_FOUND", "FileNotFoundException")


class ModelUnavailable(RuntimeError):
    """No usable model at the given path."""


def interaction_label(user="user_id", item="item_id", id="id", seed=42) -> Column:
    """1 if user % 3 + item % 2 + a noise bit of the id exceeds 2."""
    noise = hash_slot(F.concat_ws("-", F.lit(seed), F.col(id)), 2)
    return (F.col(user) % 3 + F.col(item) % 2 + noise > 2).cast("int")


def assembler(features) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features")


def fit_logistic(train: DataFrame, features=FEATURES, label="label", max_iter=200, reg=1e-4):
    """Logistic regression with a small L2 penalty."""
    model = LogisticRegression(
        featuresCol="features", labelCol=label, maxIter=max_iter, regParam=reg
    )
    return Pipeline(stages=[assembler(features), model]).fit(train)


def bin_edges(df: DataFrame, features, bins=BINS) -> list[list[float]]:
    """The edges of at most ``bins`` bins of each feature, over all rows: between neighbouring
    values if there are no more values than bins, at quantiles otherwise."""
    cuts = [i / bins for i in range(1, bins)]
    about = df.agg(*[
        F.struct(
            F.approx_count_distinct(f).alias("values"),
            F.percentile_approx(F.col(f).cast("double"), cuts, 10_000).alias("cuts"),
        ).alias(f"f{i}")
        for i, f in enumerate(features)
    ]).first()
    found = []
    for f, (values, edges) in zip(features, about, strict=True):
        if values <= 2 * bins:  # an estimate, so that a long list is never read
            few = df.select(F.col(f).cast("double").alias("v")).where("v IS NOT NULL").distinct()
            few = sorted(r[0] for r in few.limit(bins + 1).collect())
            if len(few) <= bins:
                edges = [(a + b) / 2 for a, b in zip(few, few[1:])]
        edges = sorted({e for e in edges or [] if math.isfinite(e)})
        found.append([-math.inf, *(edges or [0.0]), math.inf])
    return found


def bootstrapped(grouped: DataFrame, rows: str, trees: int, seed: int) -> DataFrame:
    """Add ``draws``: how often each tree draws a row that stands for ``rows`` equal ones.

    A forest draws every row by a Poisson number of mean 1; the numbers of n equal rows
    add up to one of mean n. A draw depends on the values of its row only."""
    key = F.xxhash64(F.lit(seed), *[c for c in grouped.columns if c != rows])
    keyed = grouped.withColumn("_key", key)
    schema = T.StructType([*grouped.schema.fields, T.StructField("draws", T.ArrayType(T.LongType()))])

    def draw(frames: Iterator) -> Iterator:
        for frame in frames:
            drawn = [
                np.random.default_rng(int(k) % 2**64).poisson(n, trees)
                for k, n in zip(frame["_key"], frame[rows], strict=True)
            ]
            yield frame.drop(columns="_key").assign(draws=drawn)

    return keyed.mapInPandas(draw, schema)


def fit_forest(train: DataFrame, features, label="label", trees=100, depth=10, seed=42, threads=8):
    """A random forest over binned features, of which ``threads`` trees are fitted at a time.

    Spark's forest compares bins, too, but walks all trees for every row and level. Here rows
    with equal bins and label become one row with their number, of which each tree draws its
    own part, so rounds grow with the different rows; of those there are at most as many
    as combinations of bins.
    """
    binned = [BIN_PREFIX + f for f in features]
    edges = bin_edges(train, features)
    binner = Bucketizer(inputCols=list(features), outputCols=binned, splitsArray=edges)
    grouped = binner.transform(train).groupBy(*binned, label).agg(F.count(F.lit(1)).alias("_rows"))
    drawn = cut_lineage(bootstrapped(grouped, "_rows", trees, seed))
    classes, different = drawn.agg(F.max(label), F.count(F.lit(1))).first()
    if not different:
        raise ValueError("no rows to learn from")
    if different <= FEW_ROWS:
        drawn = drawn.coalesce(1 + different // ROWS_A_TASK)
    joined = assembler(binned)
    totals = {r[0]: r[1] for r in drawn.select(F.posexplode("draws")).groupBy("pos").agg(F.sum("col")).collect()}
    # A tree may draw rows of one class only; the classes are known from all rows.
    known = {"ml_attr": {"type": "nominal", "num_vals": max(int(classes) + 1, 2)}}
    points = joined.transform(drawn).select(
        "features", F.col(label).cast("double").alias("label", metadata=known), "draws", "_rows"
    )

    def fitted(tree):
        # A tree of very few rows that draws none of them learns from each once.
        weight = F.col("draws")[tree] if totals[tree] else F.col("_rows")
        learner = RandomForestClassifier(
            numTrees=1, maxDepth=depth, maxBins=BINS, bootstrap=False, weightCol="weight",
            featureSubsetStrategy="sqrt", seed=seed + tree,
        )
        return learner.fit(points.withColumn("weight", weight).where("weight > 0")).trees[0]

    with ThreadPool(threads) as pool:
        found = pool.map(inheritable_thread_target(train.sparkSession)(fitted), range(trees))
    return PipelineModel(stages=[binner, joined, joined_trees(found, len(binned))])


def joined_trees(trees: list, features: int) -> RandomForestClassificationModel:
    """One forest of fitted trees, made as PySpark makes a model of several others."""
    classes = trees[0].numClasses
    kind = "org.apache.spark.ml.classification."
    jvm = SparkContext._active_spark_context._jvm
    array = JavaWrapper._new_java_array(
        [t._java_obj for t in trees],
        getattr(jvm, kind + "DecisionTreeClassificationModel"),
    )
    uid = f"RandomForestClassifier_{uuid.uuid4().hex[:12]}"
    made = JavaWrapper._new_java_obj(kind + "RandomForestClassificationModel", uid, array, features, classes)
    made.set(made.getParam("numTrees"), len(trees))  # a saved forest is read by this number
    return RandomForestClassificationModel(made)


def stratified_split(df: DataFrame, label="label", id="id", test_share=0.2, seed=42):
    """(train, test): the share holds within each class, and a row always falls the same way."""
    slot = F.pmod(F.xxhash64(F.lit(seed), F.col(label), F.col(id)), F.lit(10_000))
    is_test = slot < int(test_share * 10_000)
    return df.where(~is_test), df.where(is_test)


def class_weights(train: DataFrame, label="label", positive_weight=None) -> DataFrame:
    """Add ``weight``: negatives per positive for the positive class, 1 for the other."""
    if positive_weight is None:
        positive = F.count(F.when(F.col(label) == 1, 1)).cast("double")
        weight = train.agg(F.try_divide(F.count(F.lit(1)) - positive, positive)).scalar()
    else:
        weight = F.lit(float(positive_weight))
    return train.withColumn("weight", F.when(F.col(label) == 1, weight).otherwise(1.0))


def rounds_kept(losses: list[float], patience: int) -> tuple[int, bool]:
    """Rounds up to the least loss, looking until ``patience`` rounds in a row have brought no
    lower one, and whether that came before the losses ended."""
    best = 0
    for n, loss in enumerate(losses):
        if loss < losses[best]:
            best = n
        elif n - best >= patience:
            return best + 1, True
    return best + 1, False


def fit_boosted(
    df: DataFrame, features, label="label", id="id", rounds=1000, depth=10, rate=0.01, seed=42, patience=50
):
    """(model, test AUC, importances): class-weighted boosted trees on an 80/20 split.

    The model ends at the round with the least loss on the test part, before ``patience``
    rounds in a row that bring no lower one. A patience of one round is what Spark's learner
    does in a single fit. It takes no further rounds on a model it has fitted, so for others
    twice the patience is fitted first, then twice as many rounds while the losses still fall;
    equal seeds give equal trees, and the last fit stops at the best one. Rows with equal
    features, label and part are learned from as one with the sum of their weights.
    """
    train, test = stratified_split(df, label, id, seed=seed)
    joined = assembler(features)
    parts = class_weights(train, label).withColumn("held", F.lit(False)).unionByName(
        test.withColumns({"weight": F.lit(1.0), "held": F.lit(True)})
    )
    grouped = parts.groupBy(*features, label, "held").agg(F.sum("weight").alias("weight"))
    both = cut_lineage(joined.transform(grouped).select("features", label, "weight", "held"))
    weighted, held = both.where("NOT held"), both.where("held")

    def learner(count, **options):
        return GBTClassifier(
            featuresCol="features",
            labelCol=label,
            weightCol="weight",
            maxIter=count,
            maxDepth=depth,
            stepSize=rate,
            seed=seed,
            **options,
        )

    def fitted(count):
        return learner(count).fit(weighted)

    if patience == 1 and not held.isEmpty():
        # The least tolerance above 0: a round with an equal loss is the last one, too.
        once = learner(rounds, validationIndicatorCol="held", validationTol=sys.float_info.min)
        model = PipelineModel(stages=[joined, once.fit(both)])
        return model, auc(model.transform(test), label), importances(df.sparkSession, model, features)

    made = min(rounds, 2 * patience)
    while True:
        trees = fitted(made)
        kept, stopped = rounds_kept(trees.evaluateEachIteration(held), patience)
        if stopped or made == rounds:
            break
        made = min(rounds, 2 * made)
    if kept < made:
        trees = fitted(kept)
    model = PipelineModel(stages=[joined, trees])
    return model, auc(model.transform(test), label), importances(df.sparkSession, model, features)


def auc(scored: DataFrame, label="label", raw="rawPrediction") -> float:
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=raw, metricName="areaUnderROC"
    ).evaluate(scored)


def importances(spark, model: PipelineModel, features) -> DataFrame:
    """feature, importance in descending order."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    pairs = list(zip(features, values))
    return spark.createDataFrame(pairs, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    """The model saved at a path; only a missing one is ``ModelUnavailable``."""
    try:
        return PipelineModel.load(path)
    except (AnalysisException, Py4JJavaError) as error:
        if any(sign in str(error) for sign in MISSING):
            raise ModelUnavailable(f"no model at {path}") from error
        raise


def score(df: DataFrame, model: PipelineModel, threshold=0.5) -> DataFrame:
    """Add probability and prediction; also works on streams."""
    scored = model.transform(df).withColumn(
        "probability", vector_to_array("probability").getItem(1)
    )
    return scored.withColumn(
        "prediction", (F.col("probability") >= threshold).cast("int")
    ).drop("features", "raw", "rawPrediction", *[c for c in scored.columns if c.startswith(BIN_PREFIX)])


def score_or_rules(rows: DataFrame, path: str | None, **decision_options) -> DataFrame:
    """Fraud decisions by the model at ``path``, by the rules when there is none;
    ``model_used`` tells which."""
    from tidemark.plans.detector import decide

    try:
        scored = score(rows, load(path)) if path else rows
    except ModelUnavailable:
        scored, path = rows, None
    decided = decide(scored, "probability" if path else None, **decision_options)
    return decided.withColumn("model_used", F.lit(bool(path)))


def predict_batches(
    df: DataFrame, predictor: Callable, features, id="transaction_id", threshold=0.5
) -> DataFrame:
    """Score with a Python model, one Arrow batch at a time.

    ``predictor`` takes a pandas frame of the features and returns probabilities; the
    batch size is ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """
    columns = list(features)

    def run(frames: Iterator) -> Iterator:
        for frame in frames:
            probability = predictor(frame[columns])
            yield frame[[id]].assign(probability=probability)

    schema = f"{id} {dict(df.dtypes)[id]}, probability double"
    scored = df.select(id, *columns).mapInPandas(run, schema)
    return scored.withColumn("is_fraud", F.col("probability") > threshold)
