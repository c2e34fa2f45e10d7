"""Text and JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import parse_time
from tidemark.model import BATCH_WIRE_SCHEMA


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """All text files below a folder, one row per line."""
    return spark.read.option("recursiveFileLookup", True).text(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Text blocks separated by an empty line."""
    return spark.read.option("recursiveFileLookup", True).text(path, lineSep="\n\n")


def read_json_lines(
    spark: SparkSession, glob: str, schema=BATCH_WIRE_SCHEMA, corrupt="_corrupt_record"
) -> DataFrame:
    """JSON lines with the text of unreadable records in the ``corrupt`` column."""
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    # Filters are not pushed below a generator, so every line is parsed once.
    parsed = F.from_json("value", full, options)
    return spark.read.text(glob).select(F.inline(F.array(parsed)))


def readable_transactions(records: DataFrame, corrupt="_corrupt_record") -> DataFrame:
    """Readable records with their time parsed; unreadable ones are left out."""
    good = records.where(F.col(corrupt).isNull()).drop(corrupt)
    return good.withColumn("timestamp", parse_time("timestamp")).where(
        F.col("timestamp").isNotNull()
    )


def write_readable(records: DataFrame, path: str, corrupt="_corrupt_record") -> dict:
    """Write the readable records; counts of all and of the malformed ones.

    Both counts are taken by the job that writes, without a second pass over the records.
    """
    seen = Observation("records")
    counted = records.observe(
        seen,
        F.count(F.lit(1)).alias("records"),
        F.count(F.col(corrupt)).alias("malformed_records"),
    )
    counted.where(F.col(corrupt).isNull()).drop(corrupt).write.mode("overwrite").parquet(path)
    return seen.get


def write_log(lines: DataFrame, path: str, time="ts") -> None:
    """Write log lines ordered by time within each file."""
    lines.sortWithinPartitions(time).select("value").write.mode("overwrite").text(path)
