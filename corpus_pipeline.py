"""The corpus pipeline: raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; :func:`run` writes each stage's result as Parquet to the
shared folder and gives it to the next. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallow.llm import compression_bands, mixing, near_dedup, packing, toxicity
from tallow.llm.common import drop_table, materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples vote toxic go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or their compression band go."""
    return compression_bands.keep_quality(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (five-word shingles, 0.8)."""
    return near_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at 5:2:1, by exact word budgets; epochs repeat documents."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document in mixed sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("quality rules", keep_quality), ("near-dedup", drop_near_duplicates),
          ("mixing", mix_sources), ("packing", pack_sequences)]

# Nearest neighbours, sketches and tokenizers are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table; returns the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"pipeline_{i}")
        drop_table(before)
    return docs
