"""Helpers that the corpus operators share: scratch tables, skew-safe lookups, text batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import scratch_path
from ..scratch import written as saved

__all__ = ["HOT_SHARE", "lookup", "pieces_of", "saved", "scratch_path", "strings", "text_of"]

# A key with at least 1/HOT_SHARE of all rows is hot; there can be at most HOT_SHARE such keys.
HOT_SHARE = 1000


def text_of(name: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lookup(facts: DataFrame, dim: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join of ``facts`` to ``dim`` (one row per ``key``) that no hot key can slow down.

    ``weight`` says how many facts a key of ``dim`` has. Keys with 1/HOT_SHARE of all ``total`` facts or more
    - at most HOT_SHARE keys, whatever the data - are broadcast; the others are joined by shuffle, where no key
    now has more than 1/HOT_SHARE of the rows. Both inputs are read twice, so pass written tables.
    """
    heavy = F.col(weight) * HOT_SHARE >= F.lit(max(total, 1))
    hot, cold = dim.where(heavy), dim.where(~heavy)
    names = hot.select(key)
    return facts.join(F.broadcast(hot), key).unionByName(
        facts.join(F.broadcast(names), key, "left_anti").join(cold, key))


def strings(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """The values of a string column, null as the empty text."""
    return [x or "" for x in column.to_pylist()]


def pieces_of(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most about ``limit`` bytes of ``column`` (or one longer row)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)
