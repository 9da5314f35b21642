"""Corpus pipeline: quality rules, line dedup, near dedup, decontamination, mixture.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the docs of
the next one. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywire.llm import decontaminate, line_dedup, mixing, quality, simhash
from tallywire.llm.text import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; cutoffs are certified on the labelled ones."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines go; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest id, of each group stays; groups as in op6: runs of three words, at most two differing bits."""
    return simhash.keep_one(docs, shingle=3).select(COLUMNS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at their training positions; one that is repeated stands once for each pass."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing", mixing_stage),
]

#: fingerprints and exact binomial bounds are not SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
