"""Partitioned files, tables, incremental loads, retention and storage volume."""

from __future__ import annotations

from functools import reduce
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import date_parts, month_label
from tidemark.operators.sequences import newest_per_key
from tidemark.operators.sets import combine
from tidemark.session import cut_lineage, shared_folder

FORMATS = ("csv", "json", "parquet")


def write_by_day(df: DataFrame, base: str, time="timestamp", formats=FORMATS, mode="append"):
    """One root per format below ``base``, partitioned by year, month and day.

    The rows are rebalanced first: a day's rows come together in files of the advisory
    partition size, and a very large day is split over several tasks.
    """
    parts = df.withColumns(date_parts(time))
    for form in formats:
        _write(parts, f"{base}/{form}", form, ["year", "month", "day"], mode)


def write_by_column(df: DataFrame, base: str, column="date", formats=FORMATS, mode="append"):
    """Partitioned by ``column`` if the frame has it, otherwise unpartitioned."""
    for form in formats:
        _write(df, f"{base}/{form}", form, [column] if column in df.columns else [], mode)


def _write(df, path, form, partition_by, mode):
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).format(form)
    if form == "csv":
        writer = writer.option("header", True)
    if form == "parquet":
        writer = writer.option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_by_month(df: DataFrame, path: str, time="timestamp", mode="append") -> None:
    rows = df.withColumn("month", month_label(time)).hint("rebalance", "month")
    rows.write.mode(mode).partitionBy("month").parquet(path)


def write_dimension(df: DataFrame, path: str) -> None:
    """Replace a dimension table, as Snappy Parquet."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def read_parquet_only(spark: SparkSession, path: str) -> DataFrame:
    """Read a folder that may also hold other formats; only its Parquet files count."""
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(path)


def external_table(spark: SparkSession, name: str, schema: str, partitions: str, location: str):
    """Create an external partitioned Parquet table and register its partitions."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet "
        f"PARTITIONED BY ({partitions}) LOCATION '{location}'"
    )
    spark.catalog.recoverPartitions(name)
    return spark.table(name)


def replace_table(df: DataFrame, name: str) -> None:
    """Drop the table if it exists and create it from the rows."""
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def replace_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def bucketed_table(df: DataFrame, name: str, column: str, buckets: int) -> None:
    """Bucketed and sorted by a join key: joins of equal buckets need no shuffle."""
    (
        df.write.mode("overwrite")
        .format("parquet")
        .bucketBy(buckets, column)
        .sortBy(column)
        .saveAsTable(name)
    )


def write_as(df: DataFrame, path: str, form: str, compression: str | None = None) -> None:
    """Write ORC, Avro (if its package is on the class path), Parquet, JSON or CSV."""
    writer = df.write.mode("overwrite").format(form)
    if compression:
        writer = writer.option("compression", compression)
    writer.save(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder has readable files; a path that cannot be listed is an error."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise
    return True


def combine_staged(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All staged Parquet sources that exist, by column name."""
    present = [p for p in paths if path_exists(spark, p)]
    if not present:
        raise FileNotFoundError(f"none of the staged sources exists: {paths}")
    return combine([spark.read.parquet(p) for p in present])


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace only the partitions that occur in ``df``."""
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def load_day(df: DataFrame, path: str, day, time="timestamp") -> None:
    """Replace one date partition with the rows of that day."""
    rows = df.withColumn("date", F.to_date(time)).where(
        F.col("date") == F.lit(day).cast("date")
    )
    overwrite_partitions(rows, path, ["date"])


def backfill(job, source: DataFrame, path: str, start, end, time="timestamp") -> None:
    """Recompute and replace the date partitions from start to end in one job."""
    inside = source.withColumn("date", F.to_date(time)).where(
        F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    )
    overwrite_partitions(job(inside), path, ["date"])


def export_features(tables: dict[str, DataFrame], base: str, day) -> list[str]:
    """Write each feature table below base/yyyymmdd."""
    folder = f"{base}/{str(day).replace('-', '')}"
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return [f"{folder}/{name}" for name in tables]


def newer_than_target(source: DataFrame, target: DataFrame, time="created_at") -> DataFrame:
    """Source rows above the target's high-water mark; all rows for an empty target."""
    mark = target.agg(F.max(time)).scalar()
    return source.where(mark.isNull() | (F.col(time) > mark))


def upsert(target: DataFrame, changes: DataFrame, key: str, time: str) -> DataFrame:
    """The target with the changes applied: per key the row with the newest ``time``.

    On equal times the change wins.
    """
    both = target.withColumn("_side", F.lit(0)).unionByName(changes.withColumn("_side", F.lit(1)))
    return newest_per_key(both, [key], [time, "_side"]).drop("_side")


def upsert_partitions(
    spark: SparkSession, path: str, changes: DataFrame, key: str, time: str, partition: str
) -> None:
    """Upsert into a partitioned table, rewriting only the partitions that change.

    A key that moves to another partition leaves its old one. The new rows are written to
    the shared folder first, since a table cannot be read and overwritten in one job.
    """
    stored = spark.read.parquet(path)
    held = stored.join(changes.select(key).distinct(), key, "left_semi").select(partition)
    touched = cut_lineage(changes.select(partition).union(held).distinct())
    # One row per partition, fewer than the table has folders.
    current = stored.join(touched, partition, "left_semi")
    merged = upsert(current.select(*changes.columns), changes, key, time)
    staging = shared_folder(spark, "upsert")
    merged.write.parquet(staging)
    kept = spark.read.schema(merged.schema).parquet(staging)
    empty = touched.join(kept.select(partition), partition, "left_anti").collect()  # partition values
    overwrite_partitions(kept, path, [partition])
    for (value,) in empty:
        folder = "__HIVE_DEFAULT_PARTITION__" if value is None else quote(str(value), safe=" -_.+")
        none = kept.limit(0).drop(partition)
        none.write.mode("overwrite").parquet(f"{path}/{partition}={folder}")


def record_feedback(feedback: DataFrame, updates: DataFrame) -> DataFrame:
    """Feedback table after an upsert by transaction_id."""
    return upsert(feedback, updates, "transaction_id", "updated_at")


def append_predictions(scored: DataFrame, path: str, model_version: str, at=None) -> None:
    """Append scored rows to the audit table."""
    scored.select(
        "user_id",
        "transaction_id",
        F.col("fraud_probability").alias("prediction"),
        F.lit(model_version).alias("model_version"),
        (F.current_timestamp() if at is None else at).alias("predicted_at"),
    ).write.mode("append").parquet(path)


def storage_volume(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, files, bytes per folder, read from the file listing only."""
    parts = [
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(p)
        .select(F.lit(p).alias("path"), "length")
        for p in paths
    ]
    return reduce(lambda a, b: a.unionByName(b), parts).groupBy("path").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def split_by_retention(df: DataFrame, as_of, days=90, time="timestamp"):
    """(rows kept, rows older than ``days`` before ``as_of``)."""
    old = F.col(time) < as_of - F.expr(f"INTERVAL {days} DAYS")
    return df.where(~old | F.col(time).isNull()), df.where(old)


def archive_old(
    spark: SparkSession, source: str, archive: str, kept: str, as_of, days=90, time="timestamp"
) -> dict:
    """Write old rows to ``archive`` and the others to ``kept``; counts and size ratio."""
    current, old = split_by_retention(spark.read.parquet(source), as_of, days, time)
    for rows, path in ((current, kept), (old, archive)):
        rows.write.mode("overwrite").option("compression", "snappy").parquet(path)
    sizes = {r["path"]: r["bytes"] for r in storage_volume(spark, [source, archive]).collect()}
    return {
        "kept_rows": spark.read.parquet(kept).count(),
        "archived_rows": spark.read.parquet(archive).count(),
        "compression_ratio": 1 - sizes.get(archive, 0) / sizes[source],
    }


def write_text_pairs(df: DataFrame, path: str) -> None:
    """Tab-separated key and value text files."""
    df.write.mode("overwrite").option("sep", "\t").csv(path)
