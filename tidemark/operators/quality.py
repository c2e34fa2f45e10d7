"""Data-quality checks, profiles, cleaning and drift."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from tidemark.functions.numbers import safe_ratio
from tidemark.operators.percentiles import percentiles
from tidemark.operators.running import running
from tidemark.session import cut_lineage

RESULT_SCHEMA = "check_name string, column_name string, observed double, low double, high double, success boolean"


@dataclass(frozen=True)
class Check:
    """One expectation: an aggregate that is observed, and the bounds it must keep."""

    name: str
    column: str | None = None
    observed: Column | None = None
    low: float | None = None
    high: float | None = None
    known: float | None = None  # observed from the schema, not from the rows
    distinct_of: str | None = None
    options: dict = field(default_factory=dict)


def share(condition: Column, base: Column) -> Column:
    """Share of the rows with ``base`` that meet the condition; 1 when there are none."""
    return F.coalesce(
        safe_ratio(F.count(F.when(base & condition, 1)), F.count(F.when(base, 1))), F.lit(1.0)
    )


def not_null(column):
    return Check("not_null", column, F.count(F.when(F.col(column).isNull(), 1)), 0, 0)


def unique(column):
    return Check("unique", column, None, 0, 0, distinct_of=column)


def column_exists(df, column):
    return Check("column_exists", column, None, 1, 1, known=float(column in df.columns))


def columns_are(df, names):
    return Check("columns_are", None, None, 1, 1, known=float(set(df.columns) == set(names)))


def row_count_between(low, high):
    return Check("row_count_between", None, F.count(F.lit(1)), low, high)


def values_between(column, low, high, mostly=1.0):
    c = F.col(column)
    return Check("values_between", column, share(c.between(low, high), c.isNotNull()), mostly, 1)


def values_match(column, pattern, mostly=1.0):
    c = F.col(column).cast("string")
    return Check("values_match", column, share(c.rlike(pattern), c.isNotNull()), mostly, 1)


def values_in(column, allowed, mostly=1.0):
    c = F.col(column)
    return Check("values_in", column, share(c.isin(*allowed), c.isNotNull()), mostly, 1)


def _number(column):
    return F.col(column).cast("int") if column.startswith("is_") else F.col(column)


def mean_between(column, low, high):
    return Check("mean_between", column, F.avg(_number(column)), low, high)


def stdev_between(column, low, high):
    return Check("stdev_between", column, F.stddev(F.col(column)), low, high)


def length_at_most(column, limit):
    longest = F.coalesce(F.max(F.length(column)), F.lit(0))
    return Check("length_at_most", column, longest, 0, limit)


def run_suite(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One result row per check.

    All row checks share a single aggregate; each uniqueness check is one more pass that
    counts rows per value first, so no task gathers the values.
    """
    spark = df.sparkSession
    passes = []

    def rows(number_and_check, aggregated):
        structs = [
            F.struct(
                F.lit(number).alias("n"),
                F.lit(c.name).alias("check_name"),
                F.lit(c.column).cast("string").alias("column_name"),
                F.col(f"o{number}").cast("double").alias("observed"),
                F.lit(c.low).cast("double").alias("low"),
                F.lit(c.high).cast("double").alias("high"),
            )
            for number, c in number_and_check
        ]
        return aggregated.select(F.explode(F.array(*structs)).alias("r")).select("r.*")

    numbered = list(enumerate(checks))
    plain = [(n, c) for n, c in numbered if c.observed is not None]
    if plain:
        passes.append(
            rows(plain, df.agg(*[c.observed.cast("double").alias(f"o{n}") for n, c in plain]))
        )
    for n, c in numbered:
        if c.distinct_of:
            extra = (
                df.where(F.col(c.distinct_of).isNotNull())
                .groupBy(c.distinct_of)
                .agg(F.count(F.lit(1)).alias("k"))
                .agg(F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).alias(f"o{n}"))
            )
            passes.append(rows([(n, c)], extra))
    static = [(n, c) for n, c in numbered if c.known is not None]
    if static:
        one = spark.range(1).select(*[F.lit(c.known).alias(f"o{n}") for n, c in static])
        passes.append(rows(static, one))
    out = passes[0]
    for part in passes[1:]:
        out = out.unionByName(part)
    inside = F.col("observed").between(F.col("low"), F.col("high"))
    return out.withColumn("success", F.coalesce(inside, F.lit(False))).orderBy("n").drop("n")


def transaction_suite(df: DataFrame) -> list[Check]:
    """The documented expectations for the transaction table."""
    return [
        row_count_between(10_000, 10_000_000),
        columns_are(
            df,
            [
                "transaction_id",
                "timestamp",
                "user_id",
                "merchant_id",
                "amount",
                "currency",
                "merchant_category",
                "is_fraud",
            ],
        ),
        unique("transaction_id"),
        not_null("transaction_id"),
        not_null("user_id"),
        values_between("amount", 0.01, 1_000_000, mostly=0.99),
        values_match("transaction_id", r"^TXN_\d{8}_\d{6}$"),
        values_in("currency", ["USD", "EUR", "GBP", "JPY"]),
        mean_between("amount", 50, 500),
        stdev_between("amount", 10, 1000),
        values_in("is_fraud", [True, False]),
        mean_between("is_fraud", 0.001, 0.05),
    ]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def value_percentiles(df: DataFrame, columns: list[str], q=0.99) -> DataFrame:
    """column_name, p: the exact percentile of several numeric columns in one job."""
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"))
                    for c in columns
                ]
            )
        ).alias("r")
    ).select("r.*")
    return percentiles(long, ["column_name"], "v", {"p": q})


def outliers_above(df: DataFrame, columns: list[str], q=0.99) -> DataFrame:
    """column_name, outliers: values above the column's own percentile."""
    per_column = value_percentiles(df, columns, q)
    limits = per_column.agg(
        F.struct(
            *[F.max(F.when(F.col("column_name") == c, F.col("p"))).alias(c) for c in columns]
        ).alias("limits")
    ).scalar()

    counted = df.agg(
        *[F.count(F.when(F.col(c) > limits.getField(c), 1)).alias(c) for c in columns]
    )
    return counted.unpivot([], columns, "column_name", "outliers")


def profile(df: DataFrame) -> DataFrame:
    """Long profile: metric, column_name, value (as text)."""
    numbers = numeric_columns(df)
    measures = {("rows", None): F.count(F.lit(1)).cast("double")}
    for name in df.columns:
        measures[("nulls", name)] = F.count(F.when(F.col(name).isNull(), 1)).cast("double")
    for name in numbers:
        measures[("mean", name)] = F.avg(name).cast("double")
        measures[("std", name)] = F.stddev(name).cast("double")
        measures[("min", name)] = F.min(name).cast("double")
        measures[("max", name)] = F.max(name).cast("double")
    items = list(measures.items())
    wide = df.agg(*[column.alias(f"v{i}") for i, (_, column) in enumerate(items)])
    long = wide.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(metric).alias("metric"),
                        F.lit(name).cast("string").alias("column_name"),
                        F.col(f"v{i}").alias("value"),
                    )
                    for i, ((metric, name), _) in enumerate(items)
                ]
            )
        ).alias("r")
    ).select("r.*")
    from tidemark.operators.sets import duplicate_rows

    copies = duplicate_rows(df).select(
        F.lit("duplicates").alias("metric"),
        F.lit(None).cast("string").alias("column_name"),
        F.col("duplicate_rows").cast("double").alias("value"),
    )
    out = long.unionByName(copies)
    if numbers:
        out = out.unionByName(
            outliers_above(df, numbers).select(
                F.lit("outliers").alias("metric"),
                "column_name",
                F.col("outliers").cast("double").alias("value"),
            )
        )
    return out


def column_types(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def quality_metrics(df: DataFrame, value="amount", time="timestamp") -> DataFrame:
    """One row: rows, duplicate and null rates, p99 outliers, date range, passed flag."""
    from tidemark.operators.sets import duplicate_rows

    cells = len(df.columns)
    nulls = None
    for name in df.columns:
        one = F.count(F.when(F.col(name).isNull(), 1))
        nulls = one if nulls is None else nulls + one
    limit = percentiles(df, [], value, {"p": 0.99}).scalar()
    copies = duplicate_rows(df).select("duplicate_rows").scalar()
    return (
        df.agg(
            F.count(F.lit(1)).alias("total_rows"),
            safe_ratio(nulls, F.count(F.lit(1)) * cells).alias("null_rate"),
            F.count(F.when(F.col(value) > limit, 1)).alias("outliers"),
            F.min(time).alias("min_time"),
            F.max(time).alias("max_time"),
        )
        .withColumn("duplicate_rate", safe_ratio(copies, "total_rows"))
        .withColumn(
            "passed", (F.col("duplicate_rate") <= 0.01) & (F.col("null_rate") <= 0.05)
        )
    )


class QualityError(ValueError):
    """Data did not pass a quality gate."""


def quality_gate(df, value="amount", time="timestamp", max_duplicates=0.01, max_nulls=0.05):
    """The metrics row as a dict; raises when duplicates or nulls exceed their limit."""
    row = quality_metrics(df, value, time).first().asDict()
    if (row["duplicate_rate"] or 0) > max_duplicates:
        raise QualityError(f"duplicate rate {row['duplicate_rate']:.4f}")
    if (row["null_rate"] or 0) > max_nulls:
        raise QualityError(f"null rate {row['null_rate']:.4f}")
    return row


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """The frame itself if every column exists and holds no null, else an error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise QualityError(f"missing columns: {missing}")
    row = df.agg(*[F.count(F.when(F.col(n).isNull(), 1)).alias(n) for n in names]).first()
    empty = [n for n in names if row[n]]
    if empty:
        raise QualityError(f"null values in: {empty}")
    return df


def fill_and_cast(df: DataFrame, key: str, fills: dict, types: dict) -> DataFrame:
    """Drop duplicate ids, fill nulls (``mean``, ``mode`` or a value) and cast columns.

    Of rows with one id the first in the order of the other columns stays, nulls last. The
    rows that stay are checkpointed once, so every fill is taken from the rows it fills. A
    value that cannot be cast becomes null.
    """
    from tidemark.operators.aggregates import count_rows

    others = [F.asc_nulls_last(c) for c in df.columns if c != key]
    first = W.partitionBy(key).orderBy(*others or [F.lit(0)])
    ranked = df.withColumn("_rank", F.row_number().over(first))
    unique_rows = cut_lineage(ranked.where("_rank = 1").drop("_rank"))
    out = unique_rows
    for name, how in fills.items():
        known = unique_rows.where(F.col(name).isNotNull())
        if how == "mean":
            value = known.agg(F.avg(name)).scalar()
        elif how == "mode":
            value = (
                known.groupBy(name)
                .agg(count_rows().alias("_n"))
                .orderBy(F.desc("_n"), F.asc(name))
                .limit(1)
                .select(name)
                .scalar()
            )
        else:
            value = F.lit(how)
        out = out.withColumn(name, F.coalesce(F.col(name), value))
    return out.withColumns({n: F.col(n).try_cast(t) for n, t in types.items()})


def low_volume_days(df: DataFrame, time: str, as_of: Column, ratio=0.1, days=30) -> DataFrame:
    """Days whose count is below ``ratio`` of the mean daily count."""
    daily = (
        df.where(F.col(time) >= as_of - F.expr(f"INTERVAL {days} DAYS"))
        .groupBy(F.to_date(time).alias("day"))
        .agg(F.count(F.lit(1)).alias("rows_of_day"))
    )
    mean = daily.agg(F.avg("rows_of_day")).scalar()
    return daily.where(F.col("rows_of_day") < mean * F.lit(ratio))


def freshness(df: DataFrame, time: str, columns: list[str], as_of: Column) -> DataFrame:
    """Seconds since the newest row and the non-null share of each column."""
    newest = F.max(time)
    return df.agg(
        newest.alias("newest"),
        *[F.avg(F.col(c).isNotNull().cast("int")).alias(f"complete_{c}") for c in columns],
    ).withColumn(
        "age_seconds", (F.unix_micros(as_of) - F.unix_micros("newest")) / F.lit(1e6)
    )


def ks_drift(reference: DataFrame, current: DataFrame, features: list[str], alpha=0.05):
    """Two-sample Kolmogorov-Smirnov statistic and asymptotic p-value per feature.

    Rows are counted per value first; the cumulative shares are running sums over the
    values, taken in value ranges when there are very many.
    """

    def long(df, reference_rows):
        return df.select(
            F.explode(
                F.array(
                    *[
                        F.struct(
                            F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")
                        )
                        for f in features
                    ]
                )
            ).alias("r")
        ).select(
            "r.*",
            F.lit(1 if reference_rows else 0).cast("long").alias("in_reference"),
            F.lit(0 if reference_rows else 1).cast("long").alias("in_current"),
        )

    rows = long(reference, True).unionByName(long(current, False)).where("value IS NOT NULL")
    counts = rows.groupBy("feature", "value").agg(
        F.sum("in_reference").alias("r"), F.sum("in_current").alias("c")
    )
    upto = running(
        counts,
        ["feature"],
        ["value"],
        [("upto_r", "sum", F.col("r")), ("upto_c", "sum", F.col("c"))],
    )
    sizes = counts.groupBy("feature").agg(
        F.sum("r").alias("n_reference"), F.sum("c").alias("n_current")
    )
    gap = F.abs(
        F.try_divide(F.col("upto_r").cast("double"), F.col("n_reference").cast("double"))
        - F.try_divide(F.col("upto_c").cast("double"), F.col("n_current").cast("double"))
    )
    statistic = (
        upto.join(F.broadcast(sizes), "feature")  # one row per feature
        .groupBy("feature")
        .agg(
            F.max(gap).alias("ks_statistic"),
            F.max("n_reference").alias("n_reference"),
            F.max("n_current").alias("n_current"),
        )
    )
    n, m = F.col("n_reference").cast("double"), F.col("n_current").cast("double")
    return statistic.withColumn(
        "p_value", kolmogorov_tail(F.col("ks_statistic") * F.sqrt(n * m / (n + m)))
    ).withColumn("drift_detected", F.col("p_value") < alpha)


def kolmogorov_tail(x: Column, terms=100) -> Column:
    """Asymptotic P(K > x) as column arithmetic.

    The alternating series converges for large x; for small x its transformed form does.
    """
    large = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, 2.0).otherwise(-2.0)
        * F.exp(F.lit(-2.0) * k.cast("double") * k.cast("double") * x * x),
    )
    odd = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.exp(
            F.lit(-(math.pi**2) / 8.0)
            * (k * 2 - 1).cast("double")
            * (k * 2 - 1).cast("double")
            / (x * x)
        ),
    )
    small = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / x * odd
    return F.when(x <= 0, 1.0).when(x < 1.0, small).otherwise(F.least(large, F.lit(1.0)))


def malformed_count(df: DataFrame, corrupt="_corrupt_record") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.count(F.col(corrupt)).alias("malformed_records"),
    )
