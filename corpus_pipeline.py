"""The corpus pipeline: quality, near-duplicates, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result as Parquet in
the cluster's shared folder, deletes what the stage wrote on its way and hands the reread table to the next one. All stages but the last return the
columns of ``documents``; the last returns each document's shard. What a stage does with nulls, empty and very long texts, ties and
repeated rows is stated in its operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from alpina.llm import decontaminate, mixing, near_dups, quality, sharding
from alpina.llm.common import importable, settled, table

ORACLE_SQL = None  # the classifier and the alignment have no SQL form


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier (trained on ``labels``) rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    importable(spark)
    return near_dups.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of ``benchmark``."""
    return decontaminate.drop_leaked(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw the documents of each source (up to three times each) to its target."""
    return mixing.mix_sources(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Name the shard of every drawn document."""
    return sharding.assign_shards(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settled(spark, f"pipeline-{name}", lambda stage=stage, docs=docs: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
