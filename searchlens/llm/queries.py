"""Registered queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality, secrets
from .common import scratch_path
from .decontaminate import find_leaks
from .exact_dedup import exact_dedup
from .hard_negatives import hard_negatives
from .licenses import find_licenses
from .packing import pack_documents
from .periods import collapse_runs, repeated, run_report
from .pieces import piece_digests
from .sharding import shard_rows
from .simhash import near_dedup
from .token_counts import token_counts
from .token_files import read_token_files, write_token_files


def _table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    return read_token_files(spark, folder, write_token_files(_table(spark, sf_dir), folder))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir)
    return secrets.find_secrets(docs, secrets.train(docs))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(_table(spark, sf_dir), shards=24)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(_table(spark, sf_dir))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(_table(spark, sf_dir))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir)
    return quality.score_documents(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def relabelled(vectors: DataFrame) -> DataFrame:
    """The rows with (label + 1) mod 10 in place of the label where 7 divides the id."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(relabelled(_table(spark, sf_dir, "embeddings")), F.col("vec_id") % 50 == 0)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(collapse_runs(repeated(_table(spark, sf_dir))))


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(_table(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_exact_dedup, op2_token_files, op3_best_fit_packing, op4_secret_scan, op5_sharding,
              op6_decontamination, op7_simhash_dedup, op8_token_counts, op9_license_scan, op10_quality,
              op11_hard_negatives, op12_periodic_runs, op13_sentence_pieces)
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
          row_number() OVER (PARTITION BY t ORDER BY doc_id DESC) = 1 AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""",
}
