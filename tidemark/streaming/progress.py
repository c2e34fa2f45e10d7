"""The progress of running queries as a table, and how far they are behind."""

from __future__ import annotations

import time as clock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = (
    "query_id string, run_id string, name string, batch_id bigint, at string, source string, "
    "start_offset string, end_offset string, latest_offset string, rows bigint"
)
OFFSETS = "map<string,map<string,bigint>>"


class ProgressTable(StreamingQueryListener):
    """Listener that writes one row per source and micro-batch to a folder.

    A batch owns its folder, so a batch that is run again after a restart replaces its rows.
    Register with ``spark.streams.addListener(table)``.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self.written: set[tuple[str, int]] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rows = [
            (str(p.id), str(p.runId), p.name, p.batchId, p.timestamp, s.description,
             s.startOffset, s.endOffset, s.latestOffset, s.numInputRows)
            for s in p.sources
        ]
        folder = f"{self.path}/query={p.id}/batch={p.batchId}"
        self.spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("overwrite").parquet(folder)
        self.written.add((str(p.runId), p.batchId))

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Wait until the last batch of a finished query is in the table."""
        last = query.lastProgress
        end = clock.monotonic() + seconds
        while last and (str(last.runId), last.batchId) not in self.written:
            if clock.monotonic() > end:
                raise TimeoutError("the progress of the query has not arrived")
            clock.sleep(0.05)

    def read(self) -> DataFrame:
        return self.spark.read.schema(PROGRESS).option("recursiveFileLookup", "true").parquet(self.path)


def rows_read(progress: DataFrame) -> DataFrame:
    """Rows that each query has taken from each of its sources so far."""
    return progress.groupBy("query_id", "source").agg(
        F.sum("rows").alias("rows_read"), F.max("batch_id").alias("last_batch")
    )


def topic_lag(progress: DataFrame) -> DataFrame:
    """Offsets per topic and partition between the last batch of a query and the newest message."""
    newest = progress.groupBy("query_id", "source").agg(
        F.max_by(F.struct("end_offset", "latest_offset"), "batch_id").alias("last")
    )
    end, latest = (F.from_json(f"last.{c}", OFFSETS) for c in ("end_offset", "latest_offset"))
    topics = newest.select("query_id", end.alias("_end"), F.explode(latest).alias("topic", "_parts"))
    parts = topics.select(
        "query_id", "topic", F.col("_end")[F.col("topic")].alias("_read"),
        F.explode("_parts").alias("partition", "latest_offset"),
    )
    read = F.coalesce(F.col("_read")[F.col("partition")], F.lit(0))
    return parts.select(
        "query_id", "topic", F.col("partition").cast("int").alias("partition"), "latest_offset",
        read.alias("end_offset"), (F.col("latest_offset") - read).alias("lag"),
    )
