import zlib

import numpy as np
from pyspark.sql import functions as F

from searchlens.llm import quality as Q

from .edge import SF, TEXTS, documents, edge_docs


def test_held_out_labels_are_told_apart(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = Q.score_documents(docs, Q.train(docs, labels))
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = out.collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    good = np.array([r["score"] for r in rows if r["held_out"] and known.get(r["doc_id"]) == 1])
    bad = np.array([r["score"] for r in rows if r["held_out"] and known.get(r["doc_id"]) == 0])
    assert len(good) and len(bad)
    assert (good >= 0.3).mean() > 0.98 and (bad >= 0.3).mean() < 0.2


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    spoilt = labels.withColumn("quality", F.when(Q.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.train(docs, labels), Q.train(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")), spoilt)
    assert np.array_equal(a.vectors, b.vectors) and np.array_equal(a.labels, b.labels)


def _slow_vote(model, x):
    close = np.round(model.vectors @ x, 6)
    near = sorted(range(len(close)), key=lambda k: (-close[k], k))[:model.neighbours]   # ties go to the smaller id
    w = [max(float(close[k]), 0.0) for k in near]
    return sum(a * model.labels[k] for a, k in zip(w, near, strict=True)) / sum(w)


def test_votes_are_those_of_the_nearest(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    model = Q.train(docs, labels)
    texts = [r["text"] or "" for r in docs.orderBy("doc_id").limit(60).collect()]
    x = model.embed(Q.term_matrix(texts))
    got = model._vote(x)
    assert np.allclose(got, [_slow_vote(model, v) for v in x], atol=1e-9)
    # Batches of another size round otherwise, but the votes are the same.
    assert np.abs(model.score(texts) - np.concatenate([model.score(texts[k:k + 7]) for k in range(0, 60, 7)])).max() < 1e-5


def test_ties_at_the_last_place_go_to_the_smaller_ids():
    vectors = np.zeros((20, 2), np.float32)
    vectors[:, 0] = 1   # all equally near
    model = Q.Model(np.ones(1), np.ones((1, 2)), vectors, np.array([1.0] * 4 + [0.0] * 16), 7)
    assert model._vote(np.array([[1.0, 0.0], [0.5, 0.1]], np.float32)).tolist() == [4 / 7, 4 / 7]


def test_long_texts_count_like_short_ones(monkeypatch):
    text = "Some words, and MORE words!! " * 400
    whole = Q.term_counts(text)
    monkeypatch.setattr(Q, "_BLOCK", 1000)
    assert np.allclose(Q.term_counts(text), whole, atol=1e-6)


def test_awkward_documents(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (3, 0, 0), (6, 0, 1), (7, 1, 0), (9, 1, 0), (99, 0, 0), (None, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    for y in (labels, labels.limit(0)):
        model = Q.train(docs, y)
        rows = Q.score_documents(docs, model).collect()
        assert len(rows) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in rows)
        kept = Q.keep_good(docs, model)
        assert kept.dtypes == docs.dtypes
        assert kept.count() == sum(r["predicted"] for r in rows)
        assert Q.score_documents(docs.limit(0), model).count() == 0 and Q.keep_good(docs.limit(0), model).count() == 0
    assert all(r["score"] == 1 for r in rows)   # without labels nothing is rejected


def test_at_most_so_many_labels_are_learnt_from(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    assert len(Q.train(docs, labels, max_labelled=10).labels) <= 10
