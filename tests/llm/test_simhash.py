import random
import re

import numpy as np
import xxhash

from searchlens.llm import simhash as S
from searchlens.llm.components import components
from searchlens.llm.common import saved

from .edge import TEXTS, documents, edge_docs, plain_docs, texts_of


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def slow_components(prints, max_bits=2):
    """Index -> smallest index reachable, over all pairs."""
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= max_bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(prints))]


def test_fingerprints(monkeypatch):
    texts = [t for _, t in TEXTS if t and len(t) < 10_000] + ["", "a b", "A b  C\x0bd\x1ce", "x " * 50, "É é É é"]
    assert [S.fingerprint(t) for t in texts] == [slow_print(t) for t in texts]
    monkeypatch.setattr(S, "_BLOCK", 7)
    assert [S.fingerprint(t) for t in texts] == [slow_print(t) for t in texts]


def _clustered(seed, n=600):
    """Fingerprints in clusters, chains and alone, on both sides of the sign bit."""
    rng = random.Random(seed)
    out = [0, 1, 3, 2**63, 2**64 - 1, 2**64 - 2]
    while len(out) < n:
        f = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 5, 30])):
            out.append(f)
            for _ in range(rng.randint(1, 3)):
                f ^= 1 << rng.randrange(64)
    return sorted(set(out))


def test_trie_walk_links_all_pairs_within_the_budget():
    for seed in range(3):
        prints = _clustered(seed)
        x = np.array(prints, np.uint64)
        u, v = S._forest_of(x, None, 2)
        assert len(u) < len(x)
        for first, exact in S.turns(2):     # each block's trie alone finds no more than that, and together all
            turned = np.sort(S.turn_left(x, first))
            a, b = (S.turn_left(f, 64 - first) for f in S._forest_of(turned, None, 2, exact))
            u, v = (np.concatenate([u, a]), np.concatenate([v, b])) if first else (a, b)
        got = S.Forest(len(x))
        got.link(np.searchsorted(x, u), np.searchsorted(x, v))
        assert got.root.tolist() == slow_components(prints)


def _labels(spark, prints, node_size):
    fps = saved(S.same_bits(spark, prints), "test")
    labels = {r["node"] % 2**64: r["label"] for r in components(S.near_links(fps, 2, node_size)).collect()}
    groups = {}
    for f in prints:
        groups.setdefault(labels.get(f, S._signed(f)), set()).add(f)
    return sorted(map(sorted, groups.values()))


def test_distributed_join_equals_all_pairs(spark):
    prints = _clustered(11, 300)
    root = slow_components(prints)
    want = {}
    for f, r in zip(prints, root, strict=True):
        want.setdefault(r, []).append(f)
    for node_size in (1 << 15, 9):
        assert _labels(spark, prints, node_size) == sorted(want.values())


def test_a_tight_cluster_is_cut_into_bounded_nodes(spark):
    centre = 0x0123456789ABCDEF
    prints = sorted({centre ^ (1 << a) ^ (1 << b) for a in range(40, 64) for b in range(20)})
    fps = saved(S.same_bits(spark, prints), "test")
    paths, depths = S.trie_nodes(fps, 60)
    homes = np.searchsorted(paths, np.array(prints, np.uint64), side="right") - 1
    assert np.bincount(homes).max() <= 60
    assert _labels(spark, prints, 60) == [prints]


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(6, 40)] + [(7, 7), (300, 299), (299, 300)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    want = {k: 100 for k in range(100, 161)} | {k: 5 for k in range(5, 40)} | {299: 299, 300: 299}
    assert got == want
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def _check(out, texts):
    ids = [i for i, _ in texts]
    prints = [slow_print(t) if t is None or len(t) < 10_000 else S.fingerprint(t) for _, t in texts]
    root = slow_components(prints)
    least = {}
    for i, r in zip(ids, root, strict=True):
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = sorted(((i, f"{f:016x}", least[r]) for i, f, r in zip(ids, prints, root, strict=True)), key=str)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in out.collect()), key=str) == want
    return len(least)


def test_a_star_of_a_third_of_all_nodes(spark):
    """No task of a round's join gets many more rows than the others."""
    from statistics import median

    from pyspark.sql import functions as F

    from searchlens.llm.components import _large_star, _small_star
    n = 30_000
    star = spark.range(1, n, 1, 16).select(F.lit(0).cast("bigint").alias("u"), F.col("id").alias("v"))
    pairs = spark.range(n, 3 * n, 2, 16).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    paths = spark.range(4 * n, 5 * n, 3, 16).selectExpr("inline(array(struct(id AS u, id + 1 AS v), struct(id + 1 AS u, id + 2 AS v)))")
    links = saved(star.unionByName(pairs).unionByName(paths).repartition(16), "star-links")
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        for out in (_large_star(links, links.count(), "t-large"), _small_star(links, links.count(), "t-small")):
            tasks = [r["count"] for r in out.where("v = 0").groupBy(F.spark_partition_id()).count().collect()]
            assert sum(tasks) >= n - 1 - 1 and max(tasks) <= 2 * median(tasks) and len(tasks) >= 8
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = components(links)
    assert got.where(f"node < {n}").agg(F.count("*"), F.max("label")).first()[:] == (n, 0)
    assert got.where(f"node >= {4 * n} AND label = node").count() == n // 3


def test_of_rows_alike_in_id_and_text_the_same_one_stays(spark):
    rows = [(1, "a b c d", "x"), (1, "a b c d", "y"), (1, "a b c d", None), (2, "other words in here", "z")]
    schema = "doc_id bigint, text string, source string"
    kept = {tuple(sorted(map(tuple, S.drop_near_copies(spark.createDataFrame(rows[k:] + rows[:k], schema).repartition(3)).collect()), key=str)
            ) for k in range(3)}
    assert len(kept) == 1 and len(next(iter(kept))) == 2
    only = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None)], "doc_id bigint, text string")
    assert sorted(map(tuple, S.drop_near_copies(only).collect()), key=str) == [(1, "a b"), (2, None)]


def test_awkward_documents(spark):
    docs = edge_docs(spark)
    groups = _check(S.near_dedup(docs), TEXTS)
    kept = S.drop_near_copies(docs)
    assert kept.dtypes == docs.dtypes and kept.count() == groups
    assert S.near_dedup(edge_docs(spark, [])).count() == 0 and S.drop_near_copies(edge_docs(spark, [])).count() == 0


def test_documents_of_the_table(spark):
    docs = documents(spark)
    out = S.near_dedup(docs)
    groups = _check(out, texts_of(docs))
    kept = [r["doc_id"] for r in S.drop_near_copies(docs).collect()]
    assert sorted(kept) == sorted({r["component_id"] for r in out.collect()}) and len(kept) == groups


def test_a_third_of_all_rows_are_copies(spark):
    texts = [(i, "same words over and over" if i % 3 == 0 else f"own words number {i} here") for i in range(600)]
    _check(S.near_dedup(plain_docs(spark, texts).repartition(5)), texts)
