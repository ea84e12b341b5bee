"""A corpus pipeline of five operators, registered as query ``pipeline``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read as the next one's docs. Every stage works
on all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.llm import decontam, exact_dedup, mixing, simhash, toxicity
from gridcast.llm.common import drop_rows, keep_rows, saved, table
from gridcast.llm.queries import labels
from gridcast.session import ensure_utc


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the factorization machine does not call toxic."""
    machine = toxicity.learn_machine(docs, labels(spark, sf_dir, "toxic", 5, 0))
    scored = toxicity.score_toxicity(docs.withColumn("__all", F.struct(*docs.columns)).select("__all", "text"), machine)
    return scored.where("predicted = 0").select("__all.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    winners = exact_dedup.exact_duplicates(docs).where("kept").select(
        F.col("doc_id").alias("win_id"), F.col("text_key").alias("win_key"))
    return keep_rows(docs, winners)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates: the one with the smallest doc_id."""
    near = simhash.near_duplicates(docs)
    winners = (near.where(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_key") == F.col("winner_key")))
               .select(F.col("doc_id").alias("win_id"), F.col("text_key").alias("win_key")))
    return keep_rows(docs, winners)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a benchmark passage."""
    found = decontam.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return drop_rows(docs, found.select(F.col("doc_id").alias("win_id"), F.col("text_key").alias("win_key")).distinct())


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the mix takes, in its order, with ``size``, ``target`` and ``taken`` words."""
    return mixing.in_mix_order(mixing.fair_mix(docs.withColumn("size", mixing.word_count()), cells=4096))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("decontamination", drop_contaminated), ("mixing", mix_sources)]

#: The factorization machine is not SQL; tests/llm holds the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and read from there."""
    ensure_utc(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
