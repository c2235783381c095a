import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from searchlens.llm.sharding import MULTIPLIER, jump_shard, shard_rows

from .edge import TEXTS, documents, edge_docs


def _jump(key: int, shards: int) -> int:
    """The published algorithm, number by number."""
    b, j, key = -1, 0, key % 2**64
    while j < shards:
        b = j
        key = (key * MULTIPLIER + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 24, 25, 1000])
def test_jump_hash_is_the_published_one(spark, shards):
    keys = [0, 1, -1, 2**63 - 1, -2**63, 10863919174838991, 42, *range(100, 140)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").select("k", jump_shard(F.col("k"), shards).alias("s"))
    assert {r["k"]: r["s"] for r in df.collect()} == {k: _jump(k, shards) for k in keys}


def test_appending_a_shard_moves_rows_into_it_alone(spark):
    df = spark.range(20_000).select(jump_shard(F.xxhash64("id"), 24).alias("a"), jump_shard(F.xxhash64("id"), 25).alias("b"))
    moved = df.where("a != b")
    assert moved.where("b != 24").count() == 0
    assert abs(moved.count() / 20_000 - 1 / 25) < 0.01
    sizes = [r["count"] for r in df.groupBy("a").count().collect()]
    assert len(sizes) == 24 and max(sizes) < 1.2 * 20_000 / 24


def _check(out, texts):
    rows = out.collect()
    assert out.dtypes == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"),
                          ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    by_shard, by_id = {}, {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        assert by_id.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())


def test_awkward_documents(spark):
    _check(shard_rows(edge_docs(spark)), TEXTS)


def test_whole_table_with_small_cells(spark):
    docs = documents(spark)
    _check(shard_rows(docs, cell_rows=2), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_an_id_that_repeats_over_a_third_of_the_rows(spark):
    texts = [(7 if i % 3 == 0 else i, f"t{i % 5}") for i in range(900)]
    _check(shard_rows(edge_docs(spark, texts), cell_rows=5), texts)


def test_empty_table(spark):
    assert shard_rows(edge_docs(spark, [])).count() == 0


def test_the_type_of_integer_ids_does_not_decide(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    want = {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in shard_rows(docs).collect()}
    for kind in ("int", "smallint"):
        own = shard_rows(docs.withColumn("doc_id", F.col("doc_id").cast(kind))).collect()
        assert {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in own} == want
    texts = shard_rows(docs.withColumn("doc_id", F.col("doc_id").cast("string"))).collect()
    assert {r["shard"] for r in texts} == set(range(24)) and all(r["grown_shard"] in (r["shard"], 24) for r in texts)
