"""Schemas of the data model and adapters from the shared test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("value", T.StringType()),
        T.StructField("user_id", T.LongType()),
    ]
)

# The wire form keeps ts as text: a bare JSON number would be read as seconds.
EVENT_WIRE_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("ts", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("user_id", T.LongType()),
    ]
)

LOCATION = T.StructType(
    [
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("country", T.StringType()),
    ]
)

FRAUD_WIRE_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("location", LOCATION),
    ]
)

BATCH_WIRE_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("transaction_type", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("processing_time_ms", T.DoubleType()),
    ]
)

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("metric_type", T.StringType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("avg_processing_time", T.DoubleType()),
        T.StructField("additional_data", T.StringType()),
    ]
)

MONEY = T.DecimalType(12, 2)


# Tables with a time column are read with a declared schema: the column then is a
# timestamp in the scan itself, so filters on it reach the Parquet reader.
TABLE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, "
    "value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_totalprice double, o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{folder}/{name}.parquet")


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """id, ts, value, user_id: the event table in its reference shape."""
    return table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("value"),
        "user_id",
    )


def fraud_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Card transactions read from the event table."""
    return fraud_columns(table(spark, folder, "events"))


def fraud_columns(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("transaction_id"),
        "user_id",
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").alias("amount"),
        F.get_json_object("props", "$.k").cast("long").alias("merchant_id"),
        F.col("event_type").alias("merchant_category"),
        (F.col("event_type") == "error").alias("is_fraud"),
    )


# How the test tables' codes stand for the entity's own codes.
TRANSACTION_TYPES = {"1-URGENT": "purchase", "2-HIGH": "refund", "3-MEDIUM": "subscription"}
STATUSES = {"F": "completed", "O": "pending", "P": "failed"}
USER_TYPES = {"BUILDING": "premium", "MACHINERY": "enterprise"}


def recode(column, mapping, default):
    """Replace codes by names; a code outside the mapping becomes ``default``."""
    out = F.lit(default)
    for code, name in mapping.items():
        out = F.when(F.col(column) == code, name).otherwise(out)
    return out


def users(spark: SparkSession, folder: str) -> DataFrame:
    """User dimension: customer with its nation."""
    nation = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
    )
    return (
        table(spark, folder, "customer")
        .join(nation, "c_nationkey")
        .select(
            F.col("c_custkey").alias("user_id"),
            "country",
            F.date_add(F.lit("1990-01-01").cast("date"), F.col("c_nationkey") * 30).alias(
                "signup_date"
            ),
            recode("c_mktsegment", USER_TYPES, "basic").alias("user_type"),
            F.when(F.col("c_acctbal") < 2500, "18-25")
            .when(F.col("c_acctbal") < 5000, "26-35")
            .otherwise("36+")
            .alias("age_group"),
        )
    )


def batch_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Batch transactions without country: orders with renamed codes, no join."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.col("o_totalprice").alias("amount"),
        recode("o_orderpriority", TRANSACTION_TYPES, "transfer").alias("transaction_type"),
        recode("o_orderstatus", STATUSES, "cancelled").alias("status"),
        F.floor(F.col("o_totalprice") / 1000).cast("double").alias("processing_time_ms"),
    )


def require_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail on drift: every declared column present, with its declared type, none extra."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in schema.fields}
    if have != want:
        changed = sorted(set(have.items()) ^ set(want.items()))
        raise ValueError(f"schema drift: {changed}")
    return df


def latest(df: DataFrame, column: str):
    """The newest value of ``column`` as a scalar subquery, used as a fixed 'now'."""
    return df.agg(F.max(column)).scalar()
