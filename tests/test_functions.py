"""Boundary rows of the scalar functions and rules."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import devices, numbers, protect, rules, texts, times
from tidemark.sources import messages


def one(spark, expression, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(0).alias("_")])
    return df.select(expression.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "text",
    ["2024-01-01T10:00:00+00:00", "2024-01-01T10:00:00Z", "2024-01-01 10:00:00", "1704103200000",
     "2024-01-01T12:00:00+02:00"],
)
def test_time_forms_name_the_same_instant(spark, text):
    assert one(spark, times.parse_time("t"), t=text) == datetime(2024, 1, 1, 10)


def test_unreadable_time_is_null(spark):
    assert one(spark, times.parse_time("t"), t="yesterday") is None


@pytest.mark.parametrize(
    "hour, night, unusual, business",
    [(0, True, True, False), (5, True, True, False), (6, True, False, False), (7, False, False, False),
     (9, False, False, True), (17, False, False, True), (18, False, False, False)],
)
def test_hour_flags_on_a_monday(spark, hour, night, unusual, business):
    t = datetime(2024, 1, 1, hour)
    assert one(spark, times.is_night("t"), t=t) is night
    assert one(spark, times.is_unusual_hour("t"), t=t) is unusual
    assert one(spark, times.is_business_hours("t"), t=t) is business


def test_weekend_numbering(spark):
    sunday = datetime(2024, 1, 7, 10)
    assert one(spark, times.spark_day_of_week("t"), t=sunday) == 1
    assert one(spark, times.monday_day_of_week("t"), t=sunday) == 6
    assert one(spark, times.is_weekend("t"), t=sunday)
    assert not one(spark, times.is_business_hours("t"), t=sunday)


@pytest.mark.parametrize(
    "amount, label",
    [(0.0, None), (-1.0, None), (50.0, "very_low"), (50.01, "low"), (200.0, "low"), (1000.0, "medium"),
     (5000.0, "high"), (5000.01, "very_high")],
)
def test_amount_bins_are_closed_on_the_right(spark, amount, label):
    assert one(spark, numbers.amount_category("a"), a=amount) == label


@pytest.mark.parametrize(
    "rate, label",
    [(0.0, None), (0.01, "low"), (0.011, "medium"), (0.05, "medium"), (0.1, "high"), (1.0, "very_high")],
)
def test_fraud_rate_bins(spark, rate, label):
    assert one(spark, numbers.fraud_rate_category("r"), r=rate) == label


def test_round_amounts_and_ratios(spark):
    assert one(spark, numbers.is_round_amount("a"), a=120.0) == 1
    assert one(spark, numbers.is_round_amount("a"), a=120.1) == 0
    assert one(spark, numbers.safe_ratio("a", "b"), a=1.0, b=0.0) is None
    assert one(spark, numbers.safe_ratio("a", "b", 0), a=1.0, b=0.0) == 0.0
    assert one(spark, numbers.percent("a", "b"), a=0, b=0) == 0.0


def test_high_amount_is_strict(spark):
    factors = rules.service_factors("a", "h", "c")
    assert one(spark, factors, a=5000.0, h=12, c="food") == []
    assert one(spark, factors, a=5000.01, h=5, c="casino") == [
        "high_amount",
        "unusual_time",
        "high_risk_merchant",
    ]
    assert one(spark, factors, a=1.0, h=6, c="crypto") == []


def test_fallback_scores(spark):
    score = rules.fallback_score("a", "h", "c")
    assert one(spark, score, a=10000.0, h=3, c="casino") == pytest.approx(0.8)
    assert one(spark, score, a=10000.0, h=12, c="casino") == pytest.approx(0.6)
    assert one(spark, score, a=100.0, h=12, c="food") == 0.0
    simple = rules.simple_score("a", "h", "c")
    assert one(spark, simple, a=10000.0, h=12, c="crypto") == 0.0
    assert one(spark, simple, a=10001.0, h=2, c="jewelry") == pytest.approx(1.0)


def test_threshold_is_strict(spark):
    assert one(spark, rules.is_fraud("p"), p=0.7) is False
    assert one(spark, rules.is_fraud("p"), p=0.71) is True


def test_a_null_rule_does_not_null_the_score(spark):
    df = spark.createDataFrame(
        [(20000.0, None, None, False)],
        "amount double, transaction_count_1h long, amount_zscore double, is_night boolean",
    )
    assert rules.stream_rules(df).first()["risk_score"] == pytest.approx(0.3)


@pytest.mark.parametrize(
    "rate, label",
    [(0.02, "low_risk"), (0.021, "medium_risk"), (0.051, "high_risk"), (0.11, "very_high_risk")],
)
def test_risk_category(spark, rate, label):
    assert one(spark, rules.risk_category("r"), r=rate) == label


def test_levels_and_recommendations(spark):
    for score, level, advice in ((0.7, "high", "block"), (0.5, "medium", "review"), (0.49, "low", "approve")):
        assert one(spark, rules.risk_level("s"), s=score) == level
        assert one(spark, rules.recommendation("s"), s=score) == advice


def test_extended_factors_take_one_confidence(spark):
    def factors(p):
        return one(
            spark, rules.extended_factors("a", "z", "n", "c", "h", "p"),
            a=1.0, z=0.0, n=1, c="food", h=12, p=p,
        )

    assert factors(0.95) == ["very_high_ml_confidence"]
    assert factors(0.8) == ["high_ml_confidence"]
    assert factors(0.7) == []


def test_log_lines(spark):
    lines = spark.createDataFrame(
        [
            ("2024-01-01 10:20:30 [ERROR] Payment Service : it failed - RequestID:7",),
            ("2024-01-01 10:20:30 [FATAL] Core: down",),
            ("junk",),
        ],
        "value string",
    )
    parsed = texts.parse_log_lines(lines).collect()
    assert [tuple(r) for r in parsed] == [("2024-01-01 10", "ERROR", "Payment Service")]
    assert texts.parse_log_lines(lines, ("ERROR", "FATAL")).count() == 2


def test_error_blocks_from_files(spark, tmp_path):
    from tidemark.sources.files import read_blocks

    (tmp_path / "error.log").write_text(
        "2024-01-01 10:00:00 [ERROR] Db: SQLException: broke\n\tat a.B.c(B.java:1)\n\tat d.E.f(E.java:2)\n\n"
        "2024-01-01 10:00:01 [ERROR] Net: NetworkException: lost\n\tat x.Y.z(Y.java:3)\n\n"
    )
    found = texts.parse_error_blocks(read_blocks(spark, str(tmp_path))).collect()
    assert sorted(tuple(r) for r in found) == [
        ("Db", "SQLException", 2, "a.B.c"),
        ("Net", "NetworkException", 1, "x.Y.z"),
    ]


def test_text_helpers(spark):
    assert one(spark, texts.is_transaction_id("t"), t="TXN_20240101_000001") is True
    assert one(spark, texts.is_transaction_id("t"), t="TXN_2024_1") is False
    assert one(spark, texts.contains("t", "rapid"), t=None) is False
    assert one(spark, texts.clean("t"), t="  CaSino ") == "casino"
    assert one(spark, texts.json_number("t", "$.lat"), t='{"lat": "x"}') is None
    assert one(spark, texts.two_places("t"), t=1.005) in ("1.00", "1.01")


def test_cards(spark):
    assert one(spark, protect.mask_card("c"), c="4111111111111111") == "4111********1111"
    assert one(spark, protect.luhn_valid("c"), c="4111111111111111") is True
    assert one(spark, protect.luhn_digit("c"), c="411111111111111") == 1


def test_encryption_skips_empty_values(spark):
    key = "0123456789abcdef"
    df = spark.createDataFrame([("a",), ("",), (None,)], "v string")
    sealed = protect.encrypt_columns(df, ["v"], key)
    assert [r[0] for r in sealed.collect()][1:] == ["", None]
    assert [r[0] for r in protect.decrypt_columns(sealed, ["v"], key).collect()] == ["a", "", None]


def test_surrogate_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    assert df.select(protect.surrogate_key("x", "y").alias("k")).distinct().count() == 2


def test_variant_share_is_repeatable(spark):
    df = spark.range(20000).withColumn("v", protect.variant("id", 0.1))
    share = df.where("v = 'canary'").count() / 20000
    assert 0.08 < share < 0.12


def test_devices(spark):
    score = devices.health_score("b", "s", "d")
    assert one(spark, score, b=100.0, s=-30, d=0) == pytest.approx(100.0)
    assert one(spark, score, b=0.0, s=-100, d=400) == pytest.approx(0.0)
    assert one(spark, devices.in_normal_range("t", "v"), t="temperature", v=25.0) is True
    assert one(spark, devices.in_normal_range("t", "v"), t="temperature", v=25.1) is False
    assert one(spark, devices.in_normal_range("t", "v"), t="other", v=1.0) is None


def test_topics(spark):
    df = spark.createDataFrame([("purchase",), ("humidity",), ("like",), ("odd",)], "e string")
    topics = [r[0] for r in df.select(messages.topic_for("e")).collect()]
    assert topics == ["user_activity", "iot_sensors", "social_media", "events"]


def test_source_options():
    options = messages.topic_options("b:1", "t", max_per_trigger=10000, group="g")
    assert options["subscribe"] == "t" and options["startingOffsets"] == "latest"
    assert options["maxOffsetsPerTrigger"] == "10000" and options["kafka.group.id"] == "g"
