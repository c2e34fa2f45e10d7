"""From raw documents to a mixed training corpus, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps of ``docs`` with the
columns of ``docs``; the last adds the place of each row in the mixture. ``run`` writes every
stage's rows as Parquet to the shared folder and reads them for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, exact_dedup, language, mixing, ngram_join
from tidemark.llm.queries import MIX_BLOCK, MIX_PERIOD, MIXTURE, held_out
from tidemark.session import shared_folder

NEAR = ngram_join.Settings(words=5, percent=80, sampled=3)


# The mean probability of a text's label below which it fits no language. The lowest of 250
# held-out documents of sf0.01 has 0.51, their hundredth part 0.78.
LEAST_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: those without a letter or text go, and those whose
    label has a mean probability below ``LEAST_SCORE``.

    The network learns from the documents themselves, without the held-out quarter. It knows
    their languages only, and may be sure of a label for a script it never saw; such texts
    stay. If no document to learn from has a label, all with a letter stay.
    """
    network = language.fit_language(docs.where(~held_out(F.col("doc_id"), 4)))
    if not network.labels:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    known = language.identify_language(whole, network).where(
        (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    )
    return known.select("row.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shared shingles of five words."""
    return ngram_join.keep_one_of_each(docs, settings=NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return decontamination.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mixture of sources."""
    return mixing.mix_sources(docs, MIXTURE, MIX_PERIOD, MIX_BLOCK)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix),
]

# A recurrent network, hashes of sets and alignments have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        folder = shared_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
