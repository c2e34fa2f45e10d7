"""Each check with a passing and a failing table, gates, cleaning and drift."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import aggregates as agg
from tidemark.operators import monitoring as mon
from tidemark.operators import quality as q
from tidemark.operators import sets

GOOD = [("TXN_20240101_000001", 10.0, "USD", 1), ("TXN_20240101_000002", 20.0, "EUR", 2)]
COLUMNS = "id string, amount double, currency string, user_id long"


@pytest.fixture
def good(spark):
    return spark.createDataFrame(GOOD, COLUMNS)


def passes(df, check):
    return q.run_suite(df, [check]).first()["success"]


@pytest.mark.parametrize(
    "check, bad",
    [
        (lambda: q.not_null("user_id"), ("x", 1.0, "USD", None)),
        (lambda: q.unique("id"), GOOD[0]),
        (lambda: q.values_between("amount", 0.01, 100), ("x", 1000.0, "USD", 1)),
        (lambda: q.values_match("id", r"^TXN_\d{8}_\d{6}$"), ("x", 1.0, "USD", 1)),
        (lambda: q.values_in("currency", ["USD", "EUR"]), ("x", 1.0, "XXX", 1)),
        (lambda: q.mean_between("amount", 1, 50), ("x", 1e6, "USD", 1)),
        (lambda: q.stdev_between("amount", 1, 50), ("x", 1e6, "USD", 1)),
        (lambda: q.row_count_between(1, 2), ("x", 1.0, "USD", 1)),
        (lambda: q.length_at_most("currency", 3), ("x", 1.0, "DOLLAR", 1)),
    ],
)
def test_check(spark, good, check, bad):
    assert passes(good, check())
    assert not passes(spark.createDataFrame([*GOOD, bad], COLUMNS), check())


def test_schema_checks(good):
    assert passes(good, q.column_exists(good, "amount"))
    assert not passes(good, q.column_exists(good, "other"))
    assert passes(good, q.columns_are(good, ["id", "amount", "currency", "user_id"]))
    assert not passes(good, q.columns_are(good, ["id"]))


def test_mostly_and_nulls(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 100)] + [(None,)], "amount double")
    assert passes(df, q.values_between("amount", 2, 99, mostly=0.98))
    assert not passes(df, q.values_between("amount", 2, 99))


def test_documented_suite_runs(spark):
    df = spark.createDataFrame(
        [("TXN_20240101_000001", datetime(2024, 1, 1), 1, 1, 60.0, "USD", "food", False)],
        "transaction_id string, timestamp timestamp, user_id long, merchant_id long, amount double, "
        "currency string, merchant_category string, is_fraud boolean",
    )
    results = {(r[0], r[1]): r["success"] for r in q.run_suite(df, q.transaction_suite(df)).collect()}
    assert results[("columns_are", None)] and results[("unique", "transaction_id")]
    assert not results[("row_count_between", None)]


def test_gate(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), float(i)) for i in range(200)], "timestamp timestamp, amount double")
    assert q.quality_gate(df)["total_rows"] == 200
    with pytest.raises(q.QualityError):
        q.quality_gate(df.union(df.limit(10)))
    with pytest.raises(q.QualityError):
        q.quality_gate(df.withColumn("amount", F.when(F.col("amount") > 50, F.col("amount"))))


def test_require_columns(spark, good):
    assert q.require_columns(good, ["id"]) is good
    with pytest.raises(q.QualityError):
        q.require_columns(good, ["other"])
    with pytest.raises(q.QualityError):
        q.require_columns(spark.createDataFrame([(None,)], "id string"), ["id"])


def test_fill_and_cast(spark):
    df = spark.createDataFrame(
        [(1, 10.0, "a", "5"), (1, 10.0, "a", "5"), (2, None, "a", "x"), (3, 20.0, None, "7")],
        "id long, amount double, kind string, n string",
    )
    out = q.fill_and_cast(df, "id", {"amount": "mean", "kind": "mode"}, {"n": "int"})
    assert rows(out) == [(1, 10.0, "a", 5), (2, 15.0, "a", None), (3, 20.0, "a", 7)]


def test_low_volume_day(spark):
    data = [(datetime(2024, 1, d, 1),) for d in range(1, 11) for _ in range(30)]
    data.append((datetime(2024, 1, 11),))
    df = spark.createDataFrame(data, "ts timestamp")
    as_of = F.lit("2024-01-12").cast("timestamp")
    assert [str(r["day"]) for r in q.low_volume_days(df, "ts", as_of).collect()] == ["2024-01-11"]


def test_ks_same_and_shifted(spark):
    a = spark.range(500).select((F.col("id") % 100).cast("double").alias("x"))
    b = a.select((F.col("x") + 40).alias("x"))
    same = q.ks_drift(a, a, ["x"]).first()
    assert same["ks_statistic"] == 0 and not same["drift_detected"]
    moved = q.ks_drift(a, b, ["x"]).first()
    assert moved["ks_statistic"] == pytest.approx(0.4) and moved["drift_detected"]


@pytest.mark.parametrize("x, p", [(0.5, 0.9639452), (0.8275735, 0.5), (1.0, 0.2699997), (1.3581, 0.05)])
def test_kolmogorov_tail(spark, x, p):
    got = spark.range(1).select(q.kolmogorov_tail(F.lit(x)).alias("p")).first()["p"]
    assert got == pytest.approx(p, abs=1e-4)


def test_zero_totals(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1), "purchase", "failed", 5.0)],
        "user_id long, timestamp timestamp, transaction_type string, status string, amount double",
    )
    users = spark.createDataFrame([(1, "DE")], "user_id long, country string")
    row = agg.transaction_rollup(df, users).first()
    assert row["success_rate"] == 0.0 and row["completed_revenue"] == 0.0


def test_merchant_without_fraud_has_no_bin(spark):
    df = spark.createDataFrame(
        [(1, 1, 5.0, False), (2, 1, 5.0, True)],
        "merchant_id long, user_id long, amount double, is_fraud boolean",
    )
    assert rows(agg.merchant_features(df), "merchant_id", "risk_category") == [(1, None), (2, "very_high")]


def test_mode_takes_the_lowest_on_a_tie(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (2, "z")], "k long, v string")
    assert rows(agg.modal_value(df, "k", "v", "m")) == [(1, "a"), (2, "z")]


def test_missing_table_is_reported(spark):
    spark.range(3).createOrReplaceTempView("present_table")
    report = agg.volume_report(spark, ["present_table", "absent_table"])
    assert rows(report) == [("absent_table", None, "missing"), ("present_table", 3, "ok")]


def test_alert_routes(spark):
    df = spark.createDataFrame(
        [("critical", "core", "fraud-detection"), ("warning", "core", "api"), ("critical", "x", "y")],
        "severity string, team string, service string",
    )
    assert sorted(r["receiver"] for r in mon.route_alerts(df).collect()) == [
        "default", "fraud-team", "pagerduty", "pagerduty",
    ]


def test_histogram_quantile_in_last_bucket(spark):
    df = spark.createDataFrame([(0.2,), (50.0,), (60.0,)], "v double")
    histogram = mon.latency_histogram(df, "v", [0.1, 1.0])
    assert mon.histogram_quantile(histogram, 0.9).first()[0] == 1.0


def test_sets(spark, good):
    assert sets.has_columns_exactly(good, ["currency", "id", "amount", "user_id"])
    combined = sets.combine([good.select("id"), good.select("amount")])
    assert combined.columns == ["id", "amount"] and combined.count() == 4
    assert sets.duplicate_rows(good.union(good)).first()["duplicate_rows"] == 2


def test_of_repeated_ids_one_row_is_filled(spark):
    data = [(1, None, "b"), (1, 4.0, None), (1, 2.0, "c"), (2, None, None), (3, 8.0, "b"), (None, 1.0, "z")]
    df = spark.createDataFrame(data, "id long, amount double, kind string").repartition(5)
    got = q.fill_and_cast(df, "id", {"amount": "mean", "kind": "mode"}, {"amount": "decimal(9,3)"})
    # Kept: (1, 2.0, c), (2, null, null), (3, 8.0, b) and the row without an id.
    assert [(r[0], float(r[1]), r[2]) for r in rows(got)] == [(1, 2.0, "c"), (2, pytest.approx(11 / 3, abs=1e-3), "b"), (3, 8.0, "b"), (None, 1.0, "z")]
