"""Sharding by jump consistent hashing.

A stable key decides the shard, with no ring table: the published jump hash walks a key-seeded random sequence and
stops at the last jump inside the shard count. When a shard is appended, exactly the keys whose next jump lands on it
move, a fraction of 1/(n+1) in expectation; no row moves between old shards. A key of any integer type is hashed as
a 64-bit integer, so that the column's type does not decide the shard; keys of other types are hashed as they are.

Everything is SQL expressions. Defined results: a null key is a key like any other (all null keys share a shard); a
null text has size 8 and the crc32 of no bytes; repeated rows get slots of their own; an empty table gives no rows;
other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, text_of

# Fixed values of the published algorithm: the multiplier of its 64-bit linear congruential generator.
MULTIPLIER = 2862933555777941757
_LOW, _HIGH, _MASK = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32, 0xFFFFFFFF


def _times32(x: Column, c: int) -> Column:
    """x * c modulo 2**32 for x, c below 2**32, in steps that stay inside a signed 64-bit number."""
    return F.shiftleft((F.shiftright(x, 16) * F.lit(c)).bitwiseAND(F.lit(0xFFFF)), 16) + x.bitwiseAND(F.lit(0xFFFF)) * F.lit(c)


def jump_shard(key: Column, shards: int) -> Column:
    """The jump consistent hash of a 64-bit key: an int from 0 to ``shards`` - 1.

    The state holds the key as two 32-bit halves, since SQL's 64-bit product raises an error where the generator
    wraps around.
    """
    if shards < 1:
        raise ValueError("shards must be 1 or more")
    key = key.cast("bigint")
    start = F.struct(F.lit(-1).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("j"),
                     F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(_MASK)).alias("lo"))

    def jump(state: Column) -> Column:
        lo, hi, j = state["lo"], state["hi"], state["j"]
        low = lo.bitwiseAND(F.lit(0xFFFF)) * F.lit(_LOW) + F.lit(1)
        mid = F.shiftright(lo, 16) * F.lit(_LOW) + F.shiftright(low, 16)
        new_lo = F.shiftleft(mid.bitwiseAND(F.lit(0xFFFF)), 16) + low.bitwiseAND(F.lit(0xFFFF))
        new_hi = (F.shiftright(mid, 16) + _times32(hi, _LOW) + _times32(lo, _HIGH)).bitwiseAND(F.lit(_MASK))
        step = (j + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(new_hi, 1) + 1).cast("double"))
        return F.struct(j.alias("b"), step.cast("bigint").alias("j"), new_hi.alias("hi"), new_lo.alias("lo"))

    # A key makes about ln(shards) jumps and never more than ``shards``, since j grows with each.
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start,
                       lambda s, _: F.when(s["j"] < shards, jump(s)).otherwise(s), lambda s: s["b"].cast("int"))


def stable_key(key: Column, kind: str) -> Column:
    """The 64-bit hash of a key of the given column type, the same for all integer types."""
    return F.xxhash64(key.cast("bigint") if kind in ("tinyint", "smallint", "int") else key)


def shard_rows(docs: DataFrame, shards: int = 24, key: str = "doc_id", ident: str = "doc_id", text: str = "text",
               cell_rows: int = 20_000) -> DataFrame:
    """One row per document: its shard, the shard with one more, and a gapless slot in its shard.

    A shard is too large to number in one task, so its rows are dealt over cells of about ``cell_rows`` rows; a cell
    numbers its own rows and starts where the cells before it end. The cell hashes the id together with the input
    partition, so that an id that repeats over a third of all rows is spread too.
    """
    hashed = stable_key(F.col(key), dict(docs.dtypes)[key])
    base = saved(docs.select(
        F.col(ident).alias("doc_id"),
        (F.octet_length(text_of(text)) + 8).cast("bigint").alias("size"),
        F.crc32(F.encode(text_of(text), "UTF-8")).alias("text_crc32"),
        jump_shard(hashed, shards).alias("shard"),
        jump_shard(hashed, shards + 1).alias("grown_shard"),
        F.xxhash64(F.col(ident), F.spark_partition_id()).alias("spread")), "shards")
    cells = base.count() // (shards * cell_rows) + 1
    celled = base.withColumn("cell", F.pmod("spread", F.lit(cells)))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = celled.groupBy("shard", "cell").agg(F.count("*").alias("n")).select(
        "shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    numbered = celled.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(starts, ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("first") + F.col("place")).cast("bigint").alias("slot"), "grown_shard")
