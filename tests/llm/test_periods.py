"""Runs against a plain search over every start and period."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

import searchlens.llm.periods as P
from searchlens.llm.periods import COVER, V, Extensions, collapse_runs, find_runs, repeated, run_report

from .edge import TEXTS, documents, edge_docs, texts_of


def plain_runs(words):
    """(start, length, period): stretches of equal words at each distance, with the smallest period of each."""
    n, best = len(words), {}
    for p in range(n // 3, 0, -1):
        i = 0
        while i < n - p:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(24, 3 * p):
                best[i, j + p - i] = p     # smaller periods come later
            i = j
    return sorted(((s, length, p) for (s, length), p in best.items()), key=lambda r: (r[0], r[2]))


def _coded(words):
    seen = {}
    return np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)


def test_the_cover_has_every_difference():
    assert {(a - b) % V for a in COVER for b in COVER} == set(range(V))


def test_extensions_against_plain_comparison():
    rng = random.Random(1)
    for _ in range(60):
        base = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randint(1, 40))]
        words = (base * rng.randint(1, 8))[:rng.randint(20, 200)]
        full = np.array([*words, *range(-1, -V - 3, -1)], np.int64)
        pairs = [(i, j) for i in range(len(words)) for j in range(len(words)) if i != j]
        got = Extensions(full).of(*(np.array(x, np.int64) for x in zip(*pairs, strict=True)))
        for (i, j), value in zip(pairs, got, strict=True):
            k = 0
            while full[i + k] == full[j + k]:
                k += 1
            assert value == k


def _random_document(rng):
    out = []
    while len(out) < rng.randint(0, 250):
        unit = [rng.randrange(rng.choice([2, 4, 1000])) for _ in range(rng.randint(1, rng.choice([3, 10, 40])))]
        out += unit * rng.choice([1, 2, 3, 4, 9, 30]) + unit[:rng.randint(0, len(unit))]
    return out


@pytest.mark.parametrize("bits", [False, True])
def test_random_documents(bits, monkeypatch):
    rng = random.Random(2)
    if bits:
        monkeypatch.setattr(P, "SLICE", 7)   # many slices
    for _ in range(40):
        docs = [_random_document(rng) for _ in range(rng.randint(1, 12))]
        if bits:   # codes that 21 bits do not hold
            docs = [[w * 5_000_000 for w in d] for d in docs]
        got = find_runs([np.array(d, np.int64) for d in docs])
        for d, runs in zip(docs, got, strict=True):
            assert [tuple(r) for r in runs.tolist()] == plain_runs(d)


def test_one_word_again_and_again_and_none():
    assert find_runs([]) == []
    assert find_runs([np.zeros(0, np.int64)])[0].shape == (0, 3)
    assert find_runs([np.zeros(5000, np.int64)])[0].tolist() == [[0, 5000, 1]]
    assert find_runs([np.zeros(23, np.int64)])[0].tolist() == []
    assert find_runs([np.arange(3000) % 1000])[0].tolist() == [[0, 3000, 1000]]
    assert find_runs([np.arange(2999) % 1000])[0].tolist() == []


def _want(i, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if i is not None and n and (h := zlib.crc32(str(i).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
    runs = plain_runs(_coded(words))
    kept = [w for k, w in enumerate(words) if not any(s + p <= k < s + length for s, length, p in runs)]
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    return (i, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            hashlib.sha256("".join(f"{s},{length},{p}\n" for s, length, p in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(kept).encode()).hexdigest())


def _report(docs):
    return sorted(map(tuple, run_report(collapse_runs(repeated(docs))).collect()), key=str)


def test_documents_of_the_table(spark):
    docs = documents(spark)
    texts = texts_of(docs)
    out = _report(docs)
    assert out == sorted((_want(*r) for r in texts), key=str)
    assert sum(r[1] > 0 for r in out) > 10


def test_awkward_documents(spark):
    more = [(20, "x " * 24), (21, "\x1cx\x85 a b\t\n" * 9), (22, "a b " * 30 + "c " * 40), (23, "a b c d e f g h i j " * 3),
            (24, "a " * 24 + "b " * 24), (30, " lead a b c d e f g a b c d e f g " * 4)]
    docs = edge_docs(spark, [*((i, t if len(t or "") < 10_000 else "w v " * 2000) for i, t in TEXTS), *more])
    assert _report(docs) == sorted((_want(*r) for r in texts_of_all(docs)), key=str)
    assert run_report(collapse_runs(repeated(edge_docs(spark, [])))).count() == 0


def texts_of_all(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_a_very_long_text(spark):
    words = 400_000
    docs = edge_docs(spark, [(3, "lorem ipsum dolor " * (words // 3) + "end"), (4, " ".join(map(str, range(200_000))))])
    out = {r["doc_id"]: r for r in collapse_runs(docs).collect()}
    assert [tuple(r) for r in out[3]["runs"]] == [(0, 3 * (words // 3), 3)] and out[3]["text"] == "lorem ipsum dolor end"
    assert out[4]["runs"] == [] and out[4]["text"].startswith("0 1 2 ")
