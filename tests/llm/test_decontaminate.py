import random

import numpy as np

from searchlens.llm import decontaminate as D

from .edge import SF, TEXTS, documents, edge_docs, plain_docs, texts_of


def _words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    stored = rng.integers(0, 2**64, 300, np.uint64)
    asked = np.concatenate([rng.integers(0, 2**64, 500, np.uint64), stored])
    for i in range(500, 800):
        for b in rng.choice(64, int(rng.integers(0, 10)), replace=False):
            asked[i] ^= np.uint64(1) << np.uint64(b)
    at, entry = D.MultiIndex(stored).find(asked)
    near = np.bitwise_count(asked[:, None] ^ stored[None, :]) <= D.RADIUS
    assert set(zip(at.tolist(), entry.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def test_window_prints_are_those_of_each_window():
    words = _words(random.Random(2), 80)
    hashes = D.word_hashes(words)
    got = D.window_prints(D.bit_sums(hashes), 20, 3)
    for k, p in enumerate(got.tolist()):
        part = hashes[3 * k:3 * k + 20]
        assert p == sum(1 << b for b in range(64) if 2 * int(((part >> np.uint64(b)) & np.uint64(1)).sum()) > 20)
    assert len(got) == 21


def slow_leaks(text, items):
    out = set()
    words = D.words_of(text or "")
    for i, t in items:
        own = D.words_of(t or "")
        if own and any(D.weighted_similarity(D.shingle_counts(words[k:k + len(own)]), D.shingle_counts(own)) >= 0.8
                       for k in range(max(1, len(words)))):
            out.add(i)
    return out


def test_planted_passages_are_found_and_clean_texts_left_alone(spark):
    rng = random.Random(5)
    items = [(k, " ".join(_words(rng, rng.randint(15, 60)))) for k in range(30)]
    texts, want = [], set()
    for k in range(120):
        body = _words(rng, rng.randint(0, 400))
        if k % 3 == 0:
            i = rng.randrange(30)
            passage = items[i][1].split()
            if k % 2 and len(passage) >= 50:
                passage[len(passage) // 2] = "changed"      # one word of a long passage
            elif k % 4 == 0:
                passage = [w.upper() + "," for w in passage]  # letters and marks
            at = rng.randint(0, len(body))
            body[at:at] = passage
            want.add((k, i))
        texts.append((k, "  ".join(body)))
    docs = plain_docs(spark, texts)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = D.find_leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want
    assert all(r["similarity"] >= 0.8 for r in found)
    clean = sorted(r["doc_id"] for r in D.drop_leaks(docs, bench).collect())
    assert clean == [k for k in range(120) if k % 3]


def test_a_passage_without_its_end_still_counts():
    rng = random.Random(9)
    items = [(k, " ".join(_words(rng, rng.randint(30, 60)))) for k in range(40)]
    index = D.Index(items)
    for i, t in items:
        words = t.split()
        cut = words[: len(words) - len(words) // 12]
        text = " ".join(_words(rng, 37) + cut + _words(rng, 50))
        assert {m[0] for m in index.leaks([text])[0]} == slow_leaks(text, items)


def test_parts_that_can_be_similar_hold_a_window():
    for similarity in (0.5, 0.8, 0.95):
        for n in range(1, 1200):
            size = D.window_size(n, similarity)
            assert 1 <= size and size + D.step_of(size) - 1 <= D.least_words(n, similarity) <= n


def test_cut_passages_at_the_ends_of_texts_are_found():
    rng = random.Random(11)
    for n in [*range(12, 160, 21), 92]:
        for share in (0.80, 0.82, 0.85, 0.87):
            items = [(0, " ".join(_words(rng, n)))]
            index = D.Index(items)
            words, cut = items[0][1].split(), round(n * share)
            head, tail, inner = words[:cut], words[n - cut:], words[(n - cut) // 2:][:cut]
            rest = _words(rng, 37 + cut % 13)
            texts = [" ".join(x) for x in (rest + head, head, tail, inner, rest + tail, rest + inner, head + rest)]
            want = [slow_leaks(x, items) for x in texts]
            assert [{m[0] for m in found} for found in index.leaks(texts)] == want, (n, share)
            assert bool(want[0]) == ((cut - 4) / (n - 4) >= 0.8)
            (found,) = index.leaks([" ".join(tail + rest)])     # the item would begin before the text
            assert bool(found) == bool(want[0])


def test_cuts_between_stretches_are_no_ends_of_texts(monkeypatch):
    rng = random.Random(12)
    items = [(0, " ".join(_words(rng, 40)))]
    index = D.Index(items)
    monkeypatch.setattr(D, "_WORDS", 50)
    monkeypatch.setattr(D, "_CHARS", 90)
    words = items[0][1].split()
    for k in range(12, 250, 17):
        for passage in (words[:34], words[-34:]):
            body = _words(rng, 300)
            body[k + 1:k + 1] = passage
            assert index.leaks([" ".join(body)]) == [[]]


def test_long_texts_are_worked_on_in_stretches(monkeypatch):
    rng = random.Random(3)
    items = [(k, " ".join(_words(rng, 20 + k))) for k in range(8)]
    index = D.Index(items)
    monkeypatch.setattr(D, "_WORDS", 50)
    monkeypatch.setattr(D, "_CHARS", 90)
    for k in range(0, 400, 9):
        words = _words(rng, 500)
        words[k:k] = items[k % 8][1].split()
        ((found,),) = index.leaks([" ".join(words)])
        assert found == (k % 8, 1.0, k, 20 + k % 8)


def test_documents_of_the_table(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = documents(spark)
    found = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    index = {}
    for i, t in items:
        for s in D.shingle_counts(D.words_of(t)):
            index.setdefault(s, set()).add(i)
    want = set()
    for d, t in texts_of(docs):
        near = set().union(*(index.get(s, set()) for s in D.shingle_counts(D.words_of(t))))
        want |= {(d, i) for i in slow_leaks(t, [x for x in items if x[0] in near])}
    assert found == want and want


def test_awkward_documents_and_items(spark):
    docs = edge_docs(spark)
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one two three four five six"), (4, "ONE"), (None, "no id")],
                                  "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, bench).collect()}
    six = [i for i, t in TEXTS if t and t.lower() == "one two three four five six"]
    assert {(i, 3) for i in six} <= found and (None, None) in found and (4, 4) in found
    assert not any(i in (1, 2, 3, 9) for i, _ in found)
    kept = D.drop_leaks(docs, bench)
    assert kept.dtypes == docs.dtypes and kept.where("doc_id in (6, 7, 8, 12)").count() == 0
    assert kept.where("doc_id in (1, 2, 3, 9)").count() == 4
    none = bench.limit(0)
    assert D.find_leaks(docs, none).count() == 0 and D.drop_leaks(docs, none).count() == docs.count()
    assert D.find_leaks(docs.limit(0), bench).count() == 0
    import searchlens.llm.decontaminate as module
    old, module.BLOCK_BYTES = module.BLOCK_BYTES, 1     # every item a block of its own
    try:
        assert {(r["doc_id"], r["item_id"]) for r in D.find_leaks(docs, bench).collect()} == found
        assert D.drop_leaks(docs, bench).count() == kept.count()
    finally:
        module.BLOCK_BYTES = old
