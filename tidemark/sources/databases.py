"""JDBC reads and idempotent per-batch writes."""

from __future__ import annotations

import time as clock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.lake import path_exists


def previous_day_query(table: str, time="timestamp") -> str:
    return (
        f"SELECT * FROM {table} WHERE {time} >= CURRENT_DATE - INTERVAL '1 day' "
        f"AND {time} < CURRENT_DATE"
    )


def read_previous_day(spark: SparkSession, url: str, table: str, properties: dict) -> DataFrame:
    """Yesterday's rows; the database evaluates the filter."""
    return (
        spark.read.format("jdbc")
        .options(url=url, query=previous_day_query(table), **properties)
        .load()
    )


def per_batch(clear, append):
    """A batch writer for ``retrying``: what an earlier attempt of the batch left is cleared
    first, so a batch that is repeated, or was half written, is there once.

    ``clear(batch_id)`` removes the rows of a batch, ``append(rows)`` adds rows that have a
    ``batch_id`` column.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        clear(batch_id)
        append(batch.withColumn("batch_id", F.lit(batch_id).cast("long")))

    return write


def folder_table(spark: SparkSession, path: str):
    """``clear`` and ``append`` of a Parquet table with a folder per batch.

    An append replaces the batch's folder, so an empty one is all that clearing needs.
    """

    def clear(batch_id: int) -> None:
        held = f"{path}/batch_id={batch_id}"
        if path_exists(spark, held):
            none = spark.createDataFrame([], spark.read.parquet(held).schema)
            none.write.mode("overwrite").parquet(held)

    def append(rows: DataFrame) -> None:
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    return clear, append


def database_table(url: str, table: str, properties: dict, execute):
    """``clear`` and ``append`` of a database table.

    ``execute(statement, batch_id)`` runs a statement with one parameter on a connection of
    the caller, who has the driver; rows are written by Spark.
    """

    def clear(batch_id: int) -> None:
        execute(f"DELETE FROM {table} WHERE batch_id = ?", batch_id)

    def append(rows: DataFrame) -> None:
        rows.write.jdbc(url=url, table=table, mode="append", properties=properties)

    return clear, append


def file_batch(path: str):
    """A batch writer that replaces the folder of its batch: repeating it changes nothing."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def retrying(write, dead_letters: str | None = None, attempts=3, wait=1.0):
    """Repeat a failed batch write after 1, 2, ... waits.

    A batch that still fails goes to ``dead_letters`` with the error, or raises when no
    such folder is given: rows are never dropped.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        for attempt in range(1, attempts + 1):
            try:
                return write(batch, batch_id)
            except Exception as error:
                if attempt == attempts:
                    if dead_letters is None:
                        raise
                    batch.withColumns(
                        {"error": F.lit(str(error)[:1000]), "failed_at": F.current_timestamp()}
                    ).write.mode("overwrite").parquet(f"{dead_letters}/batch_id={batch_id}")
                else:
                    clock.sleep(wait * attempt)

    return run
