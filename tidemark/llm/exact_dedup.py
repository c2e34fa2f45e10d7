"""Exact duplicates by salted digest groups that are combined in three stages.

Local: Spark's map-side aggregation merges equal texts of a task. Salted: groups of (digest,
salt) merge what tasks found, so a text with a third of all rows still spreads over tasks.
Global: the few salt winners of a digest merge. The whole text is part of the grouping key at
every stage, so two texts with one digest never merge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rowwise import column, drop_rows, fresh

SALTS = 64


def normalised(text):
    """Null as empty, each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null texts are empty texts, and these form a group like others. The row with the
    smallest id of a group stays; a null id loses against any other. Of rows repeated with
    one id and one text exactly one is kept, also if all ids of a group are null. An empty
    table gives an empty result; other columns are not read.
    """
    found = _decided(df, id_col, text_col, salts)
    copies = F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_copy")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)
    return found.select("*", copies).select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256"
    )


def _decided(df: DataFrame, id_col: str, text_col: str, salts: int) -> DataFrame:
    """One row per id and text, with the ``_times`` that they occur together."""
    rows = (
        df.select(column(id_col).alias("doc_id"), normalised(column(text_col).cast("string")).alias("_text"))
        .withColumn("_sha", F.sha2("_text", 256))
        .withColumn("_mark", F.xxhash64("_text"))
        .withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    )
    salted = rows.groupBy("_sha", "_mark", "_salt", "_text").agg(
        F.min("doc_id").alias("_keep"), F.count(F.lit(1)).alias("_rows")
    )
    groups = salted.groupBy("_sha", "_mark", "_text").agg(
        F.min("_keep").alias("keep_id"), F.sum("_rows").alias("group_size"),
        F.collect_set("_salt").alias("_salts"),
    )
    spread = groups.select(
        "_sha", "_mark", "keep_id", "group_size", F.explode("_salts").alias("_salt")
    )
    ids = rows.groupBy("_sha", "_mark", "_salt", "doc_id").agg(F.count(F.lit(1)).alias("_times"))
    return ids.join(spread, ["_sha", "_mark", "_salt"]).select(
        "doc_id", "keep_id", "group_size", F.col("_sha").alias("text_sha256"), "_times"
    )


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns.

    Of rows repeated with one id and one text one stays. Cases as in ``exact_groups``.
    """
    found = _decided(df, id_col, text_col, SALTS).select("doc_id", "text_sha256", "keep_id", "_times")
    found = found.where(~F.col("doc_id").eqNullSafe(F.col("keep_id")) | (F.col("_times") > 1)).checkpoint()
    goes = found.where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    again = found.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc_id", "text_sha256")
    ids = [column(id_col), F.sha2(normalised(column(text_col).cast("string")), 256)]
    left = drop_rows(df, ids, goes.select("doc_id", "text_sha256"))
    if again.isEmpty():
        return left
    sha, own = fresh(df, "_sha"), fresh(df, "_own")
    marked = df.withColumns({own: ids[0], sha: ids[1]})
    repeated = marked.join(
        again, marked[own].eqNullSafe(again["doc_id"]) & (marked[sha] == again["text_sha256"]), "left_semi"
    )
    return drop_rows(left, ids, again).unionByName(repeated.dropDuplicates([own, sha]).drop(own, sha))
