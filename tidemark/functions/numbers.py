"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.times import _c
from tidemark.model import MONEY


def safe_ratio(numerator, denominator, default=None) -> Column:
    """Quotient in double; a zero or null denominator gives ``default`` (null)."""
    out = F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def percent(part, whole, places=2) -> Column:
    """100 * part / whole rounded; 0 when the whole is 0."""
    return F.round(F.coalesce(safe_ratio(_c(part) * 100, whole), F.lit(0.0)), places)


def right_closed_bin(value, edges, labels) -> Column:
    """Label of the bin (low, high] that holds the value; null outside all bins."""
    value = _c(value)
    out = None
    for low, high, label in zip(edges, edges[1:], labels):
        test = (value > F.lit(low)) & (value <= F.lit(high))
        out = F.when(test, label) if out is None else out.when(test, label)
    return out


# Bin edges and labels.
AMOUNT_EDGES = [0.0, 50.0, 200.0, 1000.0, 5000.0, float("inf")]
AMOUNT_LABELS = ["very_low", "low", "medium", "high", "very_high"]
FRAUD_RATE_EDGES = [0.0, 0.01, 0.05, 0.1, 1.0]
FRAUD_RATE_LABELS = ["low", "medium", "high", "very_high"]


def amount_category(amount) -> Column:
    return right_closed_bin(amount, AMOUNT_EDGES, AMOUNT_LABELS)


def fraud_rate_category(rate) -> Column:
    """A rate of exactly 0 lies in no bin and gives null."""
    return right_closed_bin(rate, FRAUD_RATE_EDGES, FRAUD_RATE_LABELS)


def is_round_amount(amount) -> Column:
    """1 for multiples of 10; tested on decimals, where 0.1 is exact."""
    return (F.pmod(_c(amount).cast(MONEY), F.lit(10).cast(MONEY)) == 0).cast("int")


def clip(value, low=None, high=None) -> Column:
    value = _c(value)
    if low is not None:
        value = F.greatest(value, F.lit(low))
    if high is not None:
        value = F.least(value, F.lit(high))
    return value


def zscore_clipped(value, mean, std, floor=1.0) -> Column:
    """(value - mean) / max(std, floor); null while std is null."""
    std = _c(std)
    return F.when(
        std.isNotNull(), (_c(value) - _c(mean)) / F.greatest(std, F.lit(float(floor)))
    )


def zscore_or_zero(value, mean, std) -> Column:
    std = _c(std)
    return F.when(std > 0, F.try_divide(_c(value) - _c(mean), std)).otherwise(F.lit(0.0))


def zscore_relative(value, mean, share=0.3) -> Column:
    """Z-score that takes ``share`` of the mean as the deviation, rounded to 2 places."""
    mean = _c(mean)
    return F.round(F.try_divide(_c(value) - mean, mean * F.lit(share)), 2)


def relative_change(current, baseline) -> Column:
    return F.try_divide(F.abs(_c(current) - _c(baseline)), _c(baseline))


def degradation(current, baseline) -> Column:
    return F.try_divide(_c(baseline) - _c(current), _c(baseline))
