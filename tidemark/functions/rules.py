"""Risk rules, scores, labels and explanations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import _c, is_night

# Category sets, thresholds and weights of the risk rules.
HIGH_RISK_CATEGORIES = ("jewelry", "casino", "crypto")
EXPLAINED_CATEGORIES = ("jewelry", "casino")
HIGH_AMOUNT = 5000.0
FALLBACK_MARK = "fallback_model_used"
STREAM_WEIGHTS = {
    "rule_high_amount": 0.3,
    "rule_unusual_time": 0.2,
    "rule_rapid_transactions": 0.3,
    "rule_high_zscore": 0.2,
}
MART_WEIGHTS = {
    "high_velocity_risk": 0.2,
    "unusual_amount_risk": 0.25,
    "high_risk_category": 0.15,
    "category_diversity_risk": 0.1,
    "unusual_time_risk": 0.1,
}
HISTORY_WEIGHT = 0.2
MODEL_THRESHOLD = 0.7


def holds(rule) -> Column:
    """A rule that cannot be decided (null) does not hold."""
    return F.coalesce(_c(rule), F.lit(False))


def flag(rule) -> Column:
    return holds(rule).cast("int")


def points(rule, weight) -> Column:
    return F.when(holds(rule), F.lit(float(weight))).otherwise(F.lit(0.0))


def total(parts) -> Column:
    out = None
    for part in parts:
        out = part if out is None else out + part
    return out


def found(named_rules: dict[str, Column]) -> Column:
    """Array of the names whose rule holds, in the given order."""
    return F.array_compact(
        F.array(*[F.when(holds(rule), F.lit(name)) for name, rule in named_rules.items()])
    )


def stream_flags(df: DataFrame, high_risk=HIGH_RISK_CATEGORIES) -> DataFrame:
    """Time and category flags of a transaction; works on streams and tables alike."""
    return df.withColumns(
        {
            "hour_of_day": F.hour("timestamp"),
            "day_of_week": F.dayofweek("timestamp"),
            "is_weekend": F.dayofweek("timestamp").isin(1, 7),
            "is_night": is_night("timestamp"),
            "is_high_risk_category": F.col("merchant_category").isin(*high_risk),
            "is_high_amount": F.col("amount") > HIGH_AMOUNT,
        }
    )


def stream_rules(df: DataFrame, high_amount=10000.0, night_amount=1000.0, rapid=10, z=3.0):
    """The four anomaly rules and their weighted score over enriched transactions."""
    ruled = df.withColumns(
        {
            "rule_high_amount": holds(F.col("amount") > high_amount),
            "rule_unusual_time": holds(F.col("is_night") & (F.col("amount") > night_amount)),
            "rule_rapid_transactions": holds(F.col("transaction_count_1h") > rapid),
            "rule_high_zscore": holds(F.col("amount_zscore") > z),
        }
    )
    score = total(points(F.col(name), w) for name, w in STREAM_WEIGHTS.items())
    return ruled.withColumn("risk_score", score)


def mart_score(history="historical_fraud_rate") -> Column:
    """Weighted score of the 0/1 risk columns plus the fraud history."""
    parts = [F.col(name) * F.lit(weight) for name, weight in MART_WEIGHTS.items()]
    return total(parts) + F.coalesce(_c(history), F.lit(0.0)) * F.lit(HISTORY_WEIGHT)


def mart_explanation() -> Column:
    return found(
        {
            "high_velocity": F.col("high_velocity_risk") == 1,
            "unusual_amount": F.col("unusual_amount_risk") == 1,
            "risky_category": F.col("high_risk_category") == 1,
            "unusual_diversity": F.col("category_diversity_risk") == 1,
            "unusual_time": F.col("unusual_time_risk") == 1,
            "fraud_history": F.col("historical_fraud_rate") > 0.05,
        }
    )


def fallback_score(amount, hour, category, categories=HIGH_RISK_CATEGORIES) -> Column:
    """Score of the rule model: 0.3 large amount, 0.2 before six, 0.3 risky category."""
    return F.least(
        points(_c(amount) > HIGH_AMOUNT, 0.3)
        + points(_c(hour) < 6, 0.2)
        + points(_c(category).isin(*categories), 0.3),
        F.lit(1.0),
    )


def simple_score(amount, hour, category, categories=EXPLAINED_CATEGORIES) -> Column:
    """Score of the simpler rule model: 0.5 very large amount, 0.3 category, 0.2 before six."""
    return F.least(
        points(_c(amount) > 10000, 0.5)
        + points(_c(category).isin(*categories), 0.3)
        + points(_c(hour) < 6, 0.2),
        F.lit(1.0),
    )


def simple_is_fraud(score) -> Column:
    return _c(score) >= 0.5


def is_fraud(probability, threshold=MODEL_THRESHOLD) -> Column:
    """Strictly above the threshold."""
    return _c(probability) > threshold


def service_factors(amount, hour, category, categories=EXPLAINED_CATEGORIES) -> Column:
    return found(
        {
            "high_amount": _c(amount) > HIGH_AMOUNT,
            "unusual_time": _c(hour) < 6,
            "high_risk_merchant": _c(category).isin(*categories),
        }
    )


def documented_factors(amount, night, probability) -> Column:
    return found(
        {
            "high_amount": _c(amount) > HIGH_AMOUNT,
            "unusual_time": _c(night),
            "high_ml_score": _c(probability) > 0.8,
        }
    )


def extended_factors(
    amount, zscore, count_1h, category, hour, probability, categories=HIGH_RISK_CATEGORIES
) -> Column:
    probability = _c(probability)
    return found(
        {
            "high_amount": _c(amount) > HIGH_AMOUNT,
            "unusual_amount_for_user": _c(zscore) > 3,
            "high_velocity": _c(count_1h) > 10,
            "high_risk_merchant_category": _c(category).isin(*categories),
            "unusual_time": _c(hour) < 6,
            "very_high_ml_confidence": probability > 0.9,
            "high_ml_confidence": (probability > 0.7) & (probability <= 0.9),
        }
    )


def fallback_factors() -> Column:
    return F.array(F.lit(FALLBACK_MARK))


def risk_category(rate) -> Column:
    rate = _c(rate)
    return (
        F.when(rate > 0.1, "very_high_risk")
        .when(rate > 0.05, "high_risk")
        .when(rate > 0.02, "medium_risk")
        .otherwise("low_risk")
    )


def ladder(score, high, names, middle=0.5) -> Column:
    score = _c(score)
    return (
        F.when(score >= high, names[0]).when(score >= middle, names[1]).otherwise(names[2])
    )


def risk_level(score, high=MODEL_THRESHOLD) -> Column:
    return ladder(score, high, ("high", "medium", "low"))


def recommendation(score, high=MODEL_THRESHOLD) -> Column:
    return ladder(score, high, ("block", "review", "approve"))
