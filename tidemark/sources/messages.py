"""Message topics: source options, tolerant decoding, topic volume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.texts import text
from tidemark.functions.times import parse_time
from tidemark.model import EVENT_WIRE_SCHEMA, FRAUD_WIRE_SCHEMA


def topic_options(
    servers: str, topic: str, starting="latest", max_per_trigger=None, group=None, extra=None
) -> dict[str, str]:
    """Options of a topic source; the rate cap and the consumer group are optional."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if group:
        options["kafka.group.id"] = group
    return {**options, **(extra or {})}


def read_topic(spark: SparkSession, **options) -> DataFrame:
    """Streaming key, value, topic, partition, offset, timestamp of a topic."""
    return spark.readStream.format("kafka").options(**topic_options(**options)).load()


def read_topic_range(
    spark: SparkSession, servers: str, topic: str, starting="earliest", ending="latest"
) -> DataFrame:
    """All records between two positions, each a name or offsets per partition as JSON."""
    options = topic_options(servers, topic, starting, extra={"endingOffsets": ending})
    return spark.read.format("kafka").options(**options).load()


def decode(messages: DataFrame, schema, times=("ts",), required=("id",), keep=()) -> DataFrame:
    """JSON messages to columns; records without the required fields are skipped.

    Time fields arrive as text: ISO with or without offset, or epoch milliseconds.
    """
    # Filters are not pushed below a generator, so every message is parsed once.
    flat = messages.select(F.inline(F.array(F.from_json(text("value"), schema))), *keep)
    flat = flat.withColumns({t: parse_time(t) for t in times})
    for name in required:
        flat = flat.where(F.col(name).isNotNull())
    return flat


def decode_events(messages: DataFrame) -> DataFrame:
    """id, ts, value, user_id; records without id, user or a readable time are skipped."""
    return decode(messages, EVENT_WIRE_SCHEMA, ("ts",), ("id", "user_id", "ts"))


def decode_transactions(messages: DataFrame) -> DataFrame:
    """Card transactions with the message key and the broker's time."""
    named = messages.select(
        "value",
        text("key").alias("kafka_key"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
    return decode(
        named,
        FRAUD_WIRE_SCHEMA,
        ("timestamp",),
        ("transaction_id", "timestamp"),
        ("kafka_key", "kafka_timestamp"),
    )


def undecodable(messages: DataFrame, schema=FRAUD_WIRE_SCHEMA, times=("timestamp",), required=("transaction_id", "timestamp")) -> DataFrame:
    """The messages that ``decode`` skips, unchanged."""
    parsed = messages.withColumn("_parsed", F.from_json(text("value"), schema))
    fields = [
        parse_time(F.col(f"_parsed.{n}")) if n in times else F.col(f"_parsed.{n}") for n in required
    ]
    whole = F.lit(True)
    for field in fields:
        whole = whole & field.isNotNull()
    return parsed.where(~F.coalesce(whole, F.lit(False))).drop("_parsed")


# Event types per topic.
TOPICS = {
    "user_activity": (
        "page_view",
        "product_view",
        "add_to_cart",
        "remove_from_cart",
        "checkout_start",
        "purchase",
        "search",
        "login",
        "logout",
        "review_write",
        "wishlist_add",
    ),
    "iot_sensors": ("temperature", "humidity", "pressure", "motion", "light"),
    "social_media": ("post", "like", "share", "comment", "follow", "unfollow"),
}


def topic_for(event_type, topics=None, default="events") -> Column:
    """Topic of an event type, the default topic for unknown types."""
    column = F.col(event_type) if isinstance(event_type, str) else event_type
    out = F.lit(default)
    for topic, types in reversed(list((topics or TOPICS).items())):
        out = F.when(column.isin(*types), topic).otherwise(out)
    return out


def as_messages(df: DataFrame, key: str, topic: Column | None = None) -> DataFrame:
    """Rows as key and JSON value, with a topic column when given."""
    columns = [F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")]
    if topic is not None:
        columns.append(topic.alias("topic"))
    return df.select(*columns)


def topic_volume(messages: DataFrame, bytes_per_message=500) -> DataFrame:
    """Partitions, messages and estimated MB per topic from the offset range."""
    per_partition = messages.groupBy("topic", "partition").agg(
        (F.max("offset") - F.min("offset") + 1).alias("n")
    )
    return per_partition.groupBy("topic").agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("n").alias("messages"),
        (F.sum("n") * bytes_per_message / F.lit(1024.0 * 1024.0)).alias("size_mb"),
    )
