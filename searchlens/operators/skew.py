"""Equi-joins of many rows to a keyed table that no hot key slows down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import written

# A key with at least 1/HEAVY_SHARE of all rows is heavy; there are at most HEAVY_SHARE of them, whatever the data.
HEAVY_SHARE = 1000
# Rows of the keyed table that may be broadcast.
BROADCAST_ROWS = 100_000


def heavy_keys(counts: DataFrame, key: str, count_col: str = "n") -> DataFrame:
    """The heavy keys of a table of (key, count) rows, NULL left out: at most ``HEAVY_SHARE`` rows."""
    total = counts.agg(F.sum(count_col)).first()[0] or 0
    return counts.where(F.col(key).isNotNull() & (F.col(count_col) * HEAVY_SHARE >= F.lit(total))).select(key)


def skew_join(facts: DataFrame, dim: DataFrame, key: str, how: str = "inner", counts: DataFrame | None = None,
              count_col: str = "n") -> DataFrame:
    """Join of ``facts`` to ``dim`` on ``key`` (``how``: inner or left): columns of ``facts``, then the others of ``dim``.

    A ``dim`` of up to ``BROADCAST_ROWS`` rows is broadcast, and ``facts`` are read once. For a larger one the rows of
    each key are counted first, combined map-side (``counts`` holds them where they are known). The rows of ``dim`` with
    a heavy key are broadcast, so heavy facts stay where they are; the others are joined as Spark plans it, and no key
    has 1/HEAVY_SHARE of the rows there; facts without a key are kept apart. Where the heavy keys have over
    ``BROADCAST_ROWS`` rows in ``dim`` themselves, all rows are joined the usual way, and adaptive execution splits
    large partitions.
    """
    if dim.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return facts.join(F.broadcast(dim), key, how)
    if counts is None:
        counts = written(facts.groupBy(key).agg(F.count(F.lit(1)).alias(count_col)), "key-counts")
    heavy = written(heavy_keys(counts, key, count_col), "heavy-keys")
    hot_dim = dim.join(F.broadcast(heavy), key, "left_semi")
    if hot_dim.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return facts.join(dim, key, how)
    keyed = facts.where(F.col(key).isNotNull())
    near = keyed.join(F.broadcast(heavy), key, "left_semi").join(F.broadcast(hot_dim), key, how)
    far = keyed.join(F.broadcast(heavy), key, "left_anti").join(dim, key, how)
    out = near.unionByName(far)
    if how == "left":
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema if f.name != key]
        out = out.unionByName(facts.where(F.col(key).isNull()).select("*", *none).select(out.columns))
    return out
