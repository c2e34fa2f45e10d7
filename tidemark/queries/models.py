"""Queries that train and apply models on the test tables (no SQL answer)."""

from pyspark.sql import functions as F

from tidemark.ml import models, network
from tidemark.model import fraud_transactions, table
from tidemark.plans.features import temporal_features, transaction_features
from tidemark.queries.registry import FRAUD_SQL, query
from tidemark.session import shared_folder


def interactions(spark, folder):
    """Labelled user-item rows made of the order lines."""
    lines = table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") % 1000).alias("user_id"),
        (F.col("l_partkey") % 500).alias("item_id"),
        (F.col("l_quantity") % 24).cast("int").alias("hour_of_day"),
        F.weekday("l_shipdate").alias("day_of_week"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
    )
    return lines.withColumn("label", models.interaction_label())


NOISE_SQL = """CAST('0x' || substr(md5(concat_ws('-', 42, l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 8)
    AS BIGINT) % 2"""


@query("interaction_labels", "user_class:i item_class:i rows:i",
       f"""SELECT l_orderkey % 1000 % 3 AS user_class, l_partkey % 500 % 2 AS item_class,
               sum(CASE WHEN l_orderkey % 1000 % 3 + l_partkey % 500 % 2 + {NOISE_SQL} > 2 THEN 1 ELSE 0 END) AS rows
           FROM lineitem GROUP BY 1, 2""")
def _(spark, folder):
    return (
        interactions(spark, folder)
        .groupBy(
            (F.col("user_id") % 3).alias("user_class"), (F.col("item_id") % 2).alias("item_class")
        )
        .agg(F.sum("label").alias("rows"))
    )


@query("logistic_scores", "prediction:i rows mean_probability:6")
def _(spark, folder):
    rows = interactions(spark, folder)
    path = shared_folder(spark, "logistic")
    models.save(models.fit_logistic(rows), path)
    scored = models.score(rows, models.load(path))
    return scored.groupBy("prediction").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("probability").alias("mean_probability")
    )


CLASSES = ["user_class", "item_class", "hour_of_day", "day_of_week"]


@query("weighted_network", "rows scored loss_falls auc_above_half",
       "SELECT count(*) AS rows, count(*) AS scored, true AS loss_falls, true AS auc_above_half FROM lineitem")
def _(spark, folder):
    """A network with weighted classes, its losses, and its ranking of the rows held back."""
    rows = interactions(spark, folder).withColumns(
        {"user_class": F.col("user_id") % 3, "item_class": F.col("item_id") % 2}
    )
    train, test = models.stratified_split(rows)
    fitted, losses = network.fit_weighted(train, test, CLASSES, hidden=(32, 16), positive_weight=5.0)
    scored = models.predict_batches(rows, fitted.probability, CLASSES, id="id")
    held = models.predict_batches(test, fitted.probability, ["label", *CLASSES], id="id")
    ranked = test.select("id", "label").join(held.dropDuplicates(["id"]), "id")
    found = models.auc(ranked, raw="probability")
    counts = rows.select(F.lit(1).alias("rows"), F.lit(0).alias("scored")).unionByName(
        scored.where(F.col("probability").between(0, 1)).select(F.lit(0).alias("rows"), F.lit(1).alias("scored"))
    )
    return counts.agg(F.sum("rows").alias("rows"), F.sum("scored").alias("scored")).withColumns(
        {"loss_falls": F.lit(losses[-1][0] < losses[0][0]), "auc_above_half": F.lit(found > 0.5)}
    )


FRAUD_FEATURES = ["amount_log", "is_round_amount", "hour", "day_of_week", "is_weekend", "is_night"]


def fraud_rows(spark, folder):
    rows = temporal_features(transaction_features(fraud_transactions(spark, folder)))
    return rows.withColumn("label", F.col("is_fraud").cast("int"))


@query("boosted_importances", "feature importance:6")
def _(spark, folder):
    _, _, found = models.fit_boosted(
        fraud_rows(spark, folder), FRAUD_FEATURES, id="transaction_id", patience=1
    )
    return found


@query("boosted_patience", "rows scored auc_above_half trees_within importance_is_one",
       """SELECT count(*) AS rows, count(*) AS scored, true AS auc_above_half, true AS trees_within,
              true AS importance_is_one FROM lineitem""")
def _(spark, folder):
    """Boosted trees that end at the least loss on the rows held back, and what they find."""
    rows = interactions(spark, folder).withColumns(
        {"user_class": F.col("user_id") % 3, "item_class": F.col("item_id") % 2}
    )
    model, area, weights = models.fit_boosted(
        rows, CLASSES, rounds=12, depth=3, rate=0.3, patience=3
    )
    total = weights.agg(F.sum("importance")).first()[0]
    scored = models.score(rows, model)
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("probability").between(0, 1)).alias("scored"),
        F.lit(area > 0.5).alias("auc_above_half"),
        F.lit(1 <= model.stages[-1].getNumTrees <= 12).alias("trees_within"),
        F.lit(abs(total - 1) < 1e-6).alias("importance_is_one"),
    )


@query("forest_scores", "label:i rows mean_probability:6")
def _(spark, folder):
    rows = fraud_rows(spark, folder)
    model = models.fit_forest(rows, FRAUD_FEATURES)
    return models.score(rows, model).groupBy("label").agg(
        F.count(F.lit(1)).alias("rows"), F.avg("probability").alias("mean_probability")
    )


@query("python_model_scores", "transaction_id probability:6 is_fraud",
       f"""SELECT transaction_id, least(amount / 100, 1) AS probability, amount / 100 > 0.5 AS is_fraud
           FROM {FRAUD_SQL}""")
def _(spark, folder):
    def predictor(frame):
        return (frame["amount"] / 100).clip(upper=1.0)

    return models.predict_batches(fraud_transactions(spark, folder), predictor, ["amount"])


# No category of the events is a risky one.
RULE_SCORE_SQL = """CASE WHEN amount > 5000 THEN 0.3 ELSE 0 END
    + CASE WHEN hour(timestamp) < 6 THEN 0.2 ELSE 0 END"""


def decided(spark, folder, path, threshold):
    rows = fraud_rows(spark, folder).withColumn("hour_of_day", F.col("hour"))
    return models.score_or_rules(rows, path, threshold=threshold)


@query("model_or_rules", "is_fraud model_used rows",
       f"""SELECT score > 0.1 AS is_fraud, false AS model_used, count(*) AS rows
           FROM (SELECT {RULE_SCORE_SQL} AS score FROM {FRAUD_SQL}) GROUP BY 1""")
def _(spark, folder):
    """No model is there, so the rules decide."""
    found = decided(spark, folder, shared_folder(spark, "no-model"), 0.1)
    return found.groupBy("is_fraud", "model_used").agg(F.count(F.lit(1)).alias("rows"))


@query("model_decisions", "model_used decisions same_as_model:i",
       f"SELECT true AS model_used, count(*) AS decisions, count(*) AS same_as_model FROM {FRAUD_SQL}")
def _(spark, folder):
    """A saved model decides; every decision is the one of its probability."""
    rows = fraud_rows(spark, folder).withColumn("hour_of_day", F.col("hour"))
    path = shared_folder(spark, "fraud-model")
    models.save(models.fit_forest(rows, FRAUD_FEATURES, trees=20, depth=5), path)
    scored = models.score(rows, models.load(path)).select("transaction_id", "probability")
    same = (F.col("fraud_probability") == F.col("probability")) & (
        F.col("is_fraud") == (F.col("probability") > 0.5)
    )
    return (
        decided(spark, folder, path, 0.5)
        .join(scored, "transaction_id")
        .groupBy("model_used")
        .agg(F.count(F.lit(1)).alias("decisions"), F.sum(same.cast("int")).alias("same_as_model"))
    )
