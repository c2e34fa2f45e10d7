"""Date and time expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def parse_time(text) -> Column:
    """Text to timestamp: ISO with offset or Z, ``YYYY-MM-DD HH:MM:SS``, epoch millis; else null.

    Casts that give null are used throughout; a parser that raises per bad row is slow.
    """
    text = _c(text)
    return F.when(
        text.rlike("^-?[0-9]+$"), F.timestamp_millis(text.try_cast("bigint"))
    ).otherwise(text.try_cast("timestamp"))


def epoch_millis(ts) -> Column:
    return F.unix_millis(_c(ts))


def seconds_between(later, earlier) -> Column:
    return (F.unix_micros(_c(later)) - F.unix_micros(_c(earlier))) / F.lit(1_000_000.0)


def hours_between(later, earlier) -> Column:
    return seconds_between(later, earlier) / F.lit(3600.0)


def whole_days_between(later, earlier) -> Column:
    """Whole 24-hour days in a timestamp difference, as opposed to calendar days."""
    return F.floor(seconds_between(later, earlier) / F.lit(86400.0)).cast("long")


def spark_day_of_week(ts) -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(ts))


def monday_day_of_week(ts) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(_c(ts))


def is_weekend(ts) -> Column:
    return F.dayofweek(_c(ts)).isin(1, 7)


def is_night(ts) -> Column:
    """Hours 0 to 6, both included."""
    return F.hour(_c(ts)).between(0, 6)


def is_unusual_hour(ts) -> Column:
    """Hours 0 to 5: the scoring rules use a shorter night than ``is_night``."""
    return F.hour(_c(ts)) < 6


def is_business_hours(ts) -> Column:
    return F.hour(_c(ts)).between(9, 17) & ~is_weekend(ts)


def season(ts) -> Column:
    month = F.month(_c(ts))
    return (
        F.when(month.isin(12, 1, 2), "winter")
        .when(month.between(3, 5), "spring")
        .when(month.between(6, 8), "summer")
        .otherwise("fall")
    )


def activity_band(ts) -> Column:
    """high from 6 to 18 o'clock, both included, else low."""
    return F.when(F.hour(_c(ts)).between(6, 18), "high").otherwise("low")


def month_label(ts) -> Column:
    return F.date_format(_c(ts), "yyyy-MM")


def date_parts(ts) -> dict[str, Column]:
    """year, month, day as zero-padded text, the partition columns of the lake."""
    ts = _c(ts)
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    }


PERIODS = ("HOUR", "DAY", "WEEK", "MONTH")


def period_start(period: str, ts) -> Column:
    if period.upper() not in PERIODS:
        raise ValueError(f"period must be one of {PERIODS}")
    return F.date_trunc(period, _c(ts))


def since(ts, as_of, interval: str) -> Column:
    """``ts`` not older than ``interval`` before ``as_of``."""
    return _c(ts) >= as_of - F.expr(f"INTERVAL {interval}")


def on_previous_day(ts, as_of) -> Column:
    today = F.date_trunc("DAY", as_of)
    return (_c(ts) >= today - F.expr("INTERVAL 1 DAY")) & (_c(ts) < today)


def all_not_null(columns) -> Column:
    return reduce(lambda a, b: a & b, [_c(c).isNotNull() for c in columns])
