"""Corpus pipeline: documents in, a clean, deduplicated, decontaminated and mixed corpus out.

Each stage takes what the one before kept, written as Parquet and read again.
All but the last return the columns of documents; the last adds how many words
of each document the mix takes and leaves out those it does not take.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratamart.llm import decontaminate, exact_dedup, mixing, near_dedup, toxicity
from stratamart.llm.common import stored


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the document with the smallest id stays."""
    return near_dedup.drop_near_duplicates(docs, words=5, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the schedule takes, with size, source_size, target and taken words."""
    return mixing.mixed(docs)


# STAGES are applied in this order. Models and searches of a stage see that stage's input only.
STAGES = [("toxicity", toxicity_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage),
          ("decontamination", benchmark_stage), ("mixing", mix_stage)]

#: SQL expresses neither the trained classifier nor the schedule; tests hold run() against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
