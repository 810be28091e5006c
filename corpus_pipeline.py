"""The corpus pipeline: five stages, each applied to all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import cotraining, exact_dedup, mixing, packing, simhash
from tessera.llm.common import stage_table, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return cotraining.accepted(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the row with the largest id."""
    return exact_dedup.survivors(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the row with the smallest id."""
    return simhash.representatives(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token sequences: one row per piece."""
    return packing.pack(docs, packing.vocabulary_path())


STAGES = [("quality", quality), ("exact_dedup", exact), ("simhash", near), ("mixing", mixture), ("packing", packed)]

#: Hashes, trained models and a tokenizer: SQL cannot state the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
