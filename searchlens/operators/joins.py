"""Equi-joins.

Join strategy is Catalyst's: with AQE on, a catalog whose runtime size is
under ``spark.sql.autoBroadcastJoinThreshold`` is broadcast, a larger one is
sort-merge joined with skewed partitions split. Raw rows, of which one video
may hold a third, are joined with ``split_heavy``: see ``operators.skew``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import to_int_id
from .skew import skew_join


def join_catalog_type(plays: DataFrame, catalog: DataFrame, sid_col: str = "sid",
                      type_col: str = "content_type", catalog_sid_col: str = "sid", split_heavy: bool = False) -> DataFrame:
    """The catalog's content type replaces the log's.

    ``catalog`` holds ``(catalog_sid_col, type_col)``; the log's own type
    column is dropped first. With ``split_heavy`` a catalog too large to be
    broadcast is joined apart from its rows of the heavy sids, whose plays
    stay out of the shuffle; ``plays`` is then read three times.
    """
    cat = catalog.select(F.col(catalog_sid_col).alias(sid_col), F.col(type_col))
    plays = plays.drop(type_col)
    return skew_join(plays, cat, sid_col) if split_heavy else plays.join(cat, sid_col)


def join_titles(counts: DataFrame, titles: DataFrame, sid_col: str = "sid", split_heavy: bool = False) -> DataFrame:
    """D3: attach catalog title and status; a sid with several catalog rows keeps all. ``split_heavy`` as above."""
    titles = titles.select(sid_col, "title", "status")
    return skew_join(counts, titles, sid_col) if split_heavy else counts.join(titles, sid_col)


def join_scores_by_id(scores: DataFrame, catalog: DataFrame, code_col: str = "sid_or_subject_code",
                      id_col: str = "id") -> DataFrame:
    """D4 with H17: numeric id of the score's code joined to the catalog id.

    Codes that are not integers do not join (the original job fails on them).
    Both sides are compared as bigint, so no catalog id can overflow a cast.
    """
    keyed = scores.withColumn(id_col, to_int_id(code_col))
    return keyed.join(catalog.withColumn(id_col, F.col(id_col).cast("bigint")), id_col)


def join_type_means(counts: DataFrame, means: DataFrame, type_col: str = "content_type") -> DataFrame:
    """Per-video counts with their type's mean.

    ``means`` has one row per content type; Spark broadcasts it when its size
    is under the threshold.
    """
    return counts.join(means, type_col)


def keep_valid(left: DataFrame, valid: DataFrame, left_col: str = "sid", valid_col: str = "sid") -> DataFrame:
    """Rows of ``left`` whose key is in ``valid``; only left columns kept.

    A left-semi join: a key that occurs several times in ``valid`` does not
    duplicate rows (the original's inner join would when ids repeat).
    """
    return left.join(valid.select(F.col(valid_col).alias("_valid_key")), F.col(left_col) == F.col("_valid_key"), "left_semi")
