import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from searchlens.llm.exact_dedup import drop_copies, exact_dedup

from .edge import TEXTS, edge_docs, plain_docs


def _want(texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def _check(out, texts):
    rows = out.collect()
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows), key=str) == _want(texts)
    kept = [r for r in rows if r["kept"]]
    assert len(kept) == len({t or "" for _, t in texts})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_awkward_documents(spark):
    _check(exact_dedup(edge_docs(spark)), TEXTS)


def test_texts_that_share_a_digest_are_told_apart(spark):
    _check(exact_dedup(edge_docs(spark), digest=lambda t: F.unhex(F.lit("00"))), TEXTS)
    half = exact_dedup(edge_docs(spark), digest=lambda t: F.unhex(F.when(F.length(t) > 3, F.lit("01")).otherwise(F.lit("02"))))
    _check(half, TEXTS)


def test_a_third_of_all_rows_are_copies(spark):
    texts = [(i, "hot" if i % 3 == 0 else f"text {i % 500}") for i in range(3000)]
    _check(exact_dedup(plain_docs(spark, texts).repartition(7), salts=4), texts)


def test_empty_table(spark):
    assert exact_dedup(edge_docs(spark, [])).count() == 0
    assert drop_copies(edge_docs(spark, [])).count() == 0


def test_drop_copies_keeps_the_columns_and_one_row_of_each_text(spark):
    docs = edge_docs(spark)
    out = drop_copies(docs)
    assert out.dtypes == docs.dtypes
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    best = {}
    for i, t in TEXTS:
        best[t or ""] = max(best.get(t or "", (-1,)), (-1 if i is None else i,))
    assert sorted((t or "", -1 if i is None else i) for i, t in got) == sorted((t, i) for t, (i,) in best.items())
    assert all(r["digest"] == "d" and r["n"] == 5 for r in out.collect())
