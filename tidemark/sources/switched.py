"""Changes of stored tables that become visible by one catalog command.

New rows go to new folders first. Then ``ALTER TABLE … SET LOCATION`` points the catalog entry
to them: readers see the table before or after the change, never in between, and a job that
dies before that command leaves the table whole. Replaced folders stay until they are cleaned
up by the caller, so queries that are reading them can end.
"""

from __future__ import annotations

import hashlib
import uuid
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut_lineage
from tidemark.sources.lake import split_by_retention, upsert

EMPTY_VALUE = "__HIVE_DEFAULT_PARTITION__"


def location(spark: SparkSession, table: str) -> str:
    """Where the catalog says the table's files are."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.where("col_name = 'Location'").first()["data_type"]


LISTED_CONF = "spark.sql.hive.manageFilesourcePartitions"


def create_table(df: DataFrame, table: str, folder: str, partition_by: list[str]) -> None:
    """A catalog table over a folder whose partitions are found in the folder.

    If the catalog listed the partitions, each would keep a location of its own, and no one
    command could replace them together.
    """
    conf = df.sparkSession.conf
    before = conf.get(LISTED_CONF)
    conf.set(LISTED_CONF, "false")
    try:
        writer = df.hint("rebalance", *partition_by).write.format("parquet").option("path", folder)
        writer.partitionBy(*partition_by).saveAsTable(table)
    finally:
        conf.set(LISTED_CONF, before)


def _partitions(spark: SparkSession, table: str) -> list[str]:
    """Names of the partition columns of a table that can be switched."""
    names = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if names:
        try:
            spark.sql(f"SHOW PARTITIONS {table}")
        except AnalysisException:  # the catalog does not list them
            return names
        raise ValueError(f"the catalog lists the partitions of {table}; make it with create_table")
    return names


def switch_location(spark: SparkSession, table: str, folder: str) -> None:
    """The one command that commits a change."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def new_folder(folder: str) -> str:
    """A sibling of a table's folder, named by a version."""
    return f"{folder.rstrip('/').partition('@')[0]}@{uuid.uuid4().hex}"


def archive_in_place(
    spark: SparkSession, table: str, archive: str, as_of, days=90, time="timestamp"
) -> str:
    """Move rows older than ``days`` before ``as_of`` from a catalog table to ``archive``.

    Returns the archive's folder of this run. It is named by the location the rows left: an
    attempt that failed before the switch left its rows in the table, and the next one writes
    the same folder again; after a switch the location is another one. Rows without a time stay.
    """
    old_location = location(spark, table)
    stored = spark.table(table)
    current, old = split_by_retention(stored, as_of, days, time)
    parts = _partitions(spark, table)
    run = f"{archive}/left={hashlib.md5(old_location.encode()).hexdigest()}"
    old.write.mode("overwrite").option("compression", "snappy").parquet(run)
    folder = new_folder(old_location)
    current.hint("rebalance", *parts).write.partitionBy(*parts).parquet(folder)
    switch_location(spark, table, folder)
    return run


def create_partitioned(
    df: DataFrame, root: str, directory: str, partition: str
) -> None:
    """A table whose partitions are folders listed by the catalog table ``directory``.

    ``directory`` has one row (``value``, ``version``) per partition, so changes of several
    partitions can be committed together by switching its location.
    """
    spark = df.sparkSession
    listed = _write_version(df, root, partition)
    folder = f"{root}/directory@{uuid.uuid4().hex}"
    listed.write.parquet(folder)
    spark.sql(f"CREATE TABLE {directory} (value STRING, version STRING) USING parquet LOCATION '{folder}'")


def _write_version(df: DataFrame, root: str, partition: str) -> DataFrame:
    """Write the rows as a new version; its rows of the directory."""
    version = uuid.uuid4().hex
    path = f"{root}/version={version}"
    df.hint("rebalance", partition).write.partitionBy(partition).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    values = written.select(F.col(partition).cast("string").alias("value")).distinct()
    return values.withColumn("version", F.lit(version))


def read_partitioned(
    spark: SparkSession, root: str, directory: str, partition: str, schema
) -> DataFrame:
    """The table as its directory lists it now; one path per partition goes through the driver."""
    paths = []
    for value, version in spark.table(directory).collect():
        name = EMPTY_VALUE if value is None else quote(value, safe=" -_.+")
        paths.append(f"{root}/version={version}/{partition}={name}")
    if not paths:
        return spark.createDataFrame([], schema)
    names = schema.fieldNames()
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*names)


def upsert_partitioned(
    root: str, directory: str, changes: DataFrame, key: str, time: str, partition: str
) -> None:
    """Upsert by key and newest ``time`` into such a table, in one commit.

    Only partitions that hold a changed key or get one are written again. A key that moves
    leaves its old partition in the same commit.
    """
    spark = changes.sparkSession
    stored = read_partitioned(spark, root, directory, partition, changes.schema)
    held = stored.join(changes.select(key).distinct(), key, "left_semi").select(partition)
    touched = cut_lineage(held.union(changes.select(partition)).distinct())
    mark = touched.withColumnRenamed(partition, "_touched")
    current = stored.join(mark, F.col(partition).eqNullSafe(F.col("_touched")), "left_semi")
    added = _write_version(upsert(current, changes, key, time), root, partition)
    gone = mark.select(F.col("_touched").cast("string").alias("_gone"))
    listed = spark.table(directory)
    kept = listed.join(gone, F.col("value").eqNullSafe(F.col("_gone")), "left_anti")
    folder = f"{root}/directory@{uuid.uuid4().hex}"
    kept.unionByName(added).coalesce(1).write.parquet(folder)  # one row per partition
    switch_location(spark, directory, folder)
