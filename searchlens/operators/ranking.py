"""Top-k and seeded samples.

``row_number() <= k`` over a grouped window is planned by Spark as a
``WindowGroupLimit`` for k up to a threshold: each map task keeps only its k
best rows per group before the shuffle, so a group as large as a whole content
type sends k rows per task, not all its rows. For a larger k a first ranking by
group and salt keeps k rows of each salt, so that a group's rows are ranked in
many tasks and only k per salt meet. Every order ends in a full tie-break so
results repeat run to run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _orders(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


# Up to this many rows per group Spark limits before the shuffle, by the setting's default.
GROUP_LIMIT, DEFAULT_GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold", 1000


def top_k(df: DataFrame, k: int, order: Sequence[Column | str], group: Sequence[str] = (),
          rank_col: str = "rank", salts: int | None = None) -> DataFrame:
    """The first ``k`` rows of each group (or of all rows) by ``order``, ranked from 1.

    Without ``group`` the rows are limited first (``TakeOrderedAndProject``:
    each task keeps its k best rows), and only those k are numbered. With
    ``group``, Spark limits before the shuffle for k up to its threshold; for
    a larger k the rows are ranked in two levels, over ``salts`` parts of each
    group first (the number of shuffle partitions unless given).
    """
    if not group:
        return df.orderBy(*_orders(order)).limit(k).withColumn(
            rank_col, F.row_number().over(Window.orderBy(*_orders(order))))
    conf = df.sparkSession.conf
    if k > min(DEFAULT_GROUP_LIMIT, int(conf.get(GROUP_LIMIT))):
        salts = salts or int(conf.get("spark.sql.shuffle.partitions"))
        # The part of the input that a row comes from: rows alike in every column do not share a salt by that.
        salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        within = Window.partitionBy(*group, "_salt").orderBy(*_orders(order))
        df = salted.withColumn("_place", F.row_number().over(within)).where(F.col("_place") <= k).drop("_salt", "_place")
    w = Window.partitionBy(*group).orderBy(*_orders(order))
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def seeded_key(seed: int | str, key: Column | str) -> Column:
    """Repeatable pseudo-random order: ``md5('<seed>:' || key)``, equal in Spark and DuckDB."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), k.cast("string")))


def seeded_order(df: DataFrame, seed: int | str, key: str = "sid") -> list[Column]:
    """Seeded hash order of the key, with the whole row as the tie-break."""
    return [seeded_key(seed, key), F.col(key)] + [F.col(c) for c in df.columns if c != key]


def seeded_sample(df: DataFrame, k: int, seed: int | str, key: str = "sid", group: Sequence[str] = (),
                  rank_col: str = "rank") -> DataFrame:
    """``k`` rows per group (or overall) drawn without replacement in seeded hash order.

    Rows whose key repeats keep their whole-row order as a tie-break.
    """
    return top_k(df, k, seeded_order(df, seed, key), group, rank_col)
