"""The corpus pipeline: its stages in order, and ``run``, which applies them to ``documents``.

Every stage works on all rows that the one before it kept, and its result is written as Parquet and read again by the
next. All stages but the last return the columns of ``documents``; the last one returns a row per packed piece.
The stages carry models and searches that SQL cannot express, so there is no oracle; the tests compare each stage, and
the whole, with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from searchlens.llm import decontaminate, quality
from searchlens.llm.common import saved
from searchlens.llm.exact_dedup import drop_copies
from searchlens.llm.packing import pack_documents
from searchlens.llm.simhash import drop_near_copies


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.train(docs, labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies by SimHash stays."""
    return drop_near_copies(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents' token pieces, placed in sequences."""
    return pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("benchmark_decontamination", clean),
    ("best_fit_packing", packed),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's result written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
