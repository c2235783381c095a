"""Operators on skewed or wide data: what one task or the driver gets stays bounded."""

from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from searchlens.operators import skew
from searchlens.operators.features import category_vocabulary, encode_categories, index_categories, vector_columns
from searchlens.operators.numbering import numbered
from searchlens.operators.skew import skew_join


@pytest.fixture
def no_broadcast(spark):
    """Only broadcasts that the code asks for, partitions as dealt."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_numbers_are_places_in_the_order(spark):
    df = spark.range(0, 20_000, 1, 7).select(F.pmod(F.xxhash64("id"), F.lit(50)).alias("g"), "id")
    got = [(r["g"], r["id"]) for r in numbered(df, [F.desc("g"), F.asc("id")], "k").orderBy("k").collect()]
    assert got == sorted(got, key=lambda r: (-r[0], r[1])) and len(got) == 20_000
    assert [r[0] for r in numbered(df, [F.asc("id")], "k").select((F.col("k") - F.col("id")).alias("d")).distinct().collect()] == [0]
    assert numbered(df.limit(0), [F.asc("id")], "k").count() == 0


@pytest.mark.parametrize("order", ["frequencyDesc", "frequencyAsc", "alphabetDesc", "alphabetAsc"])
def test_label_order_is_the_indexer_s(spark, order):
    from pyspark.ml.feature import StringIndexer
    df = spark.createDataFrame([(w,) for w in "b b a a c d d d e f f é".split()], "w string")
    want = StringIndexer(inputCol="w", outputCol="i", stringOrderType=order).fit(df).transform(df)
    got = index_categories(df, "w", "i", order)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.schema["i"].dataType == want.schema["i"].dataType


def test_null_labels_one_label_and_none(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "n int, w string")
    assert sorted(map(tuple, index_categories(df, "w").collect())) == [(1, "a", 0.0), (2, None, None), (3, "a", 0.0)]
    out = vector_columns(encode_categories(df, "w"), "category_vec")
    assert sorted((r["n"], r["vec_size"], r["vec_active"]) for r in out.collect()) == [(1, 1, 0), (2, None, None), (3, 1, 0)]
    assert encode_categories(df.limit(0), "w").count() == 0


def test_as_many_labels_as_there_are(spark):
    labels, rows = 300_000, 450_000
    # Half of the labels have one row, the others two; one third more rows share one label.
    df = spark.range(rows).select(F.concat(F.lit("w"), (F.col("id") % labels).cast("string")).alias("w")).unionByName(
        spark.range(rows // 2).select(F.lit("hot").alias("w")))
    vocabulary = category_vocabulary(df, "w")
    assert vocabulary.count() == labels + 1
    assert vocabulary.agg(F.min("index"), F.max("index"), F.count_distinct("index")).first()[:] == (0, labels, labels + 1)
    assert vocabulary.orderBy("index").first()["label"] == "hot"
    bad = vocabulary.alias("a").join(vocabulary.alias("b"), F.col("b.index") == F.col("a.index") + 1).where(
        "a.n < b.n OR (a.n = b.n AND a.label >= b.label)")
    assert bad.count() == 0
    out = vector_columns(encode_categories(df, "w"), "category_vec")
    sums = out.agg(F.count(F.lit(1)), F.min("vec_size"), F.max("vec_size"), F.count_if(F.col("vec_active") == F.col("category_index").cast("int")),
                   F.count_if(F.col("vec_active").isNull())).first()
    # The last label has one row, and no active position.
    assert tuple(sums) == (rows + rows // 2, labels, labels, rows + rows // 2 - 1, 1)


def test_a_key_with_a_third_of_the_rows(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 2000)   # of 5001
    n = 240_000
    sid = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000))).cast("string")
    plays = spark.range(0, n, 1, 16).select("id", sid.alias("sid"))
    catalog = spark.range(5000).select(F.col("id").cast("string").alias("sid"), (F.col("id") % 9).alias("kind"))
    catalog = catalog.unionByName(catalog.where("sid = '11'"))   # a sid that is listed twice
    out = skew_join(plays, catalog, "sid")
    plain = plays.join(catalog, "sid")
    assert out.columns == plain.columns
    check = [F.count(F.lit(1)), F.sum(F.xxhash64("id", "sid", "kind").cast("decimal(38,0)"))]
    assert out.agg(*check).first() == plain.agg(*check).first()

    def tasks(df):
        return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]

    assert max(tasks(plain)) > 4 * median(tasks(plain))
    # The heavy rows stay in the scan's tasks, the others are dealt by key: none gets over twice the median of its kind.
    near, far = tasks(out.where("sid = '7'")), tasks(out.where("sid <> '7'"))
    assert max(near) <= 2 * median(near) and max(far) <= 2 * median(far)


def test_many_heavy_rows_of_the_keyed_table_are_not_broadcast(spark, monkeypatch):
    plays = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "sid string, n int")
    catalog = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z"), ("c", "w")], "sid string, title string")
    want = [("a", 1, "x"), ("a", 1, "y"), ("a", 2, "x"), ("a", 2, "y")]
    assert sorted(map(tuple, skew_join(plays, catalog, "sid").collect())) == want
    left = [*want, ("b", 4, None), (None, 3, None)]
    for limit in (100, 3, 1):   # all of the catalog, its heavy rows alone, nothing
        monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
        assert sorted(map(tuple, skew_join(plays, catalog, "sid").collect())) == want
        assert sorted(map(tuple, skew_join(plays, catalog, "sid", "left").collect()), key=str) == sorted(left, key=str)
    assert Counter(map(tuple, skew_join(plays.limit(0), catalog, "sid").collect())) == Counter()
