"""Hard negatives against every integer score."""

import math
import random

import numpy as np
import pytest

import searchlens.llm.hard_negatives as H
from searchlens.llm.hard_negatives import Queries, entry_type, hard_negatives, index_entries, rotate
from searchlens.llm.queries import op11_hard_negatives

from .edge import SF

SCHEMA = "vec_id bigint, embedding array<float>, label int, anchor string, entry string, copies int, score int"


def plain(rows):
    """Of (vec_id, vector, label) rows, by the contract's words."""
    good = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            if i is not None and i % 7 == 0:
                label = (label + 1) % 10
            good.append((i, [math.floor(256 * float(x)) for x in v], label))
    out = []
    for k, (i, v, label) in enumerate(good):
        if i is None or i % 50:
            continue
        scored = sorted(((-sum(map(int.__mul__, v, w)), j is None, j or 0, j, other, m)
                         for m, (j, w, other) in enumerate(good)), key=lambda x: x[:3])
        same = [(j, -s) for s, _, _, j, other, m in scored if other == label and m != k][:5]
        for j, ps in same:
            bad = [(n, -s) for s, _, _, n, other, _ in scored if other != label and 50 * ps <= -100 * s <= 95 * ps][:3]
            out += [(i, j, r, n, ps, ns) for r, (n, ns) in enumerate(bad, 1)]
    return sorted(out, key=str)


def _query(spark, rows, tmp_path):
    extra = [(*r, "a", "e", 1, 2) for r in rows]
    spark.createDataFrame(extra, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
    return sorted(map(tuple, op11_hard_negatives(spark, str(tmp_path)).collect()), key=str)


def test_rotation_keeps_products():
    rng = np.random.default_rng(1)
    for dim in (1, 3, 64, 100):
        a, b = rng.normal(size=(2, 5, dim))
        assert np.allclose(rotate(a) @ rotate(b).T, a @ b.T)


@pytest.mark.parametrize("dim", [1, 5, 64, 130])
def test_the_interval_holds_every_score(dim):
    rng = np.random.default_rng(dim)
    rows = np.concatenate([rng.integers(-300, 300, (400, dim)), np.zeros((2, dim), np.int64), np.full((2, dim), 10**6)])
    anchors = rows[::7]
    lower, upper = Queries(anchors).interval(slice(0, len(anchors)), index_entries(rows))
    true = anchors @ rows.T
    assert (lower <= true).all() and (true <= upper).all()
    if dim == 64:   # and is narrow enough to pass over most rows
        assert np.median(upper - lower) < 0.4 * np.median(np.linalg.norm(anchors, axis=1)) * np.median(np.linalg.norm(rows, axis=1))


def test_most_rows_are_never_scored(monkeypatch):
    rng = np.random.default_rng(2)
    rows, scored = rng.normal(size=(20_000, 64)), []
    rows = np.floor(256 * rows / np.linalg.norm(rows, axis=1)[:, None]).astype(np.int64)
    real = H._scores
    monkeypatch.setattr(H, "_scores", lambda a, b, i, j: scored.append(len(i)) or real(a, b, i, j))
    import pyarrow as pa
    n = len(rows)
    table = pa.table({"id": np.arange(n), "anchor": pa.array([str(i) if i < 64 else None for i in range(n)], pa.string()),
                      "label": pa.array(["x"] * n), "copies": np.ones(n, np.int64),
                      "entry": pa.array([e.tobytes() for e in index_entries(rows)], pa.binary())})
    got = H.best_of_label(table.slice(0, 64), table, entry_type(64), 5)
    true = rows[:64] @ rows.T
    true[np.arange(64), np.arange(64)] = np.iinfo(np.int64).min
    assert sorted(got["score"].to_pylist()) == sorted(np.sort(true, 1)[:, -5:].ravel().tolist())
    assert sum(scored) < 0.25 * 64 * n


def test_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want = plain(rows)
    assert len(want) > 20
    assert sorted(map(tuple, op11_hard_negatives(spark, SF).collect()), key=str) == want


def test_small_blocks_and_tiles(spark, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    monkeypatch.setattr(H, "BLOCK", 4)   # many blocks of anchors and of rows
    small = spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id < 160")
    from searchlens.llm.queries import relabelled
    got = hard_negatives(relabelled(small), relabelled(small)["vec_id"] % 50 == 0)
    assert sorted(map(tuple, got.collect()), key=str) == plain([r for r in rows if r[0] < 160])


def test_awkward_rows(spark, tmp_path):
    rng = random.Random(5)

    def vector(n=6):
        return [rng.choice([-1.0, -0.5, 0.25, 0.5, 0.75]) for _ in range(n)]

    same = vector()
    rows = [(i, vector(), rng.randrange(3)) for i in range(260)]
    rows += [(1000 + i, same, rng.randrange(3)) for i in range(300)]            # one vector again and again
    rows += [(50, same, 1)] * 4 + [(3, same, 1)] * 7                            # repeated rows, an anchor too
    rows += [(None, same, 1)] * 3 + [(None, same, 2)] * 3 + [(2000, None, 1), (2050, same, None), (None, None, None)]
    rows += [(2100, [None, *same[1:]], 1), (2150, [float("nan"), *same[1:]], 1), (2200, [float("inf"), *same[1:]], 2)]
    want = plain(rows)
    assert want
    assert _query(spark, rows, tmp_path / "a") == want
    assert _query(spark, [(50, [], 1), (51, [], 1), (52, [], 2), (100, [0.0], 1)], tmp_path / "b") == plain(
        [(50, [0.0], 1), (51, [0.0], 1), (52, [0.0], 2), (100, [0.0], 1)])
    low = [0.7 * x for x in same]
    nulls = [(50, same, 1), (None, same, 1), (None, same, 1), (None, low, 2), (8, low, 2), (None, low, 3)]
    want = plain(nulls)
    assert any(r[1] is None for r in want) and any(r[3] is None for r in want)
    assert _query(spark, nulls, tmp_path / "e") == want
    assert _query(spark, [], tmp_path / "c") == []
    assert _query(spark, [(51, same, 1), (52, same, 2)], tmp_path / "d") == []   # no anchors


def test_numbers_that_64_bits_may_not_hold(spark):
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(50, [1e30, 1.0], 1)], "vec_id bigint, embedding array<double>, label int")
    with pytest.raises(ValueError):
        hard_negatives(rows, F.col("vec_id") % 50 == 0)
