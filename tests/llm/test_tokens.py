import random
import tempfile
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from searchlens.llm.packing import LocalSearch, best_fit, pack_documents, pack_sizes, packed_sequences, piece_lengths
from searchlens.llm.token_files import BATCH, TokenFile, local_files, read_token_files, write_token_files
from searchlens.llm.tokens import Encoder

from .edge import LONG, TEXTS, documents, edge_docs, texts_of

ALPHABET = ["a", "B", "é", "ß", "ſ", "1", "٣", "²", "'s", "'t", "'re", " ", " ", " ", "\n", ".", ",", "!", "\t", "　", "\x85",
            "\xa0", "\x1c", "文", "😀", "<|endoftext|>", "_", "\r", "̀"]


@pytest.fixture(scope="module")
def enc():
    return Encoder(cache=2000)


def direct(enc, text):
    return np.array(enc.tokenizer.encode(text, add_special_tokens=False).ids + [2], "<u4").tobytes()


def test_cached_words_give_the_library_s_ids(enc):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ALPHABET[:19] if k % 2 else ALPHABET) for _ in range(rng.randint(0, 40))) for k in range(1500)]
    texts += [t or "" for _, t in TEXTS if t != LONG] + ["a\nb c.\nd, e.f", "word. word, word.,", "a b", "x  y", " lead", "trail ", "\n"]
    for k in range(0, len(texts), 100):
        part = texts[k:k + 100]
        assert enc.encode(part) == [direct(enc, t) for t in part]


def test_documents_of_the_table(spark, enc):
    texts = [t for _, t in texts_of(documents(spark))]
    assert enc.encode(texts) == [direct(enc, t) for t in texts]


def _expected(enc, texts):
    ids = [(i, direct(enc, t or "")) for i, t in texts]
    return Counter((i, len(b) // 4, zlib.crc32(b)) for i, b in ids)


@pytest.mark.parametrize("files", [1, 5])
def test_token_files_round_trip(spark, enc, files):
    folder = "file://" + tempfile.mkdtemp(prefix="tokens-")
    texts = [(i, t) for i, t in TEXTS if i is not None]
    out = read_token_files(spark, folder, write_token_files(edge_docs(spark, texts), folder, files=files, length=64))
    rows = sorted(out.collect(), key=lambda r: r["start"])
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == _expected(enc, texts)
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in rows)
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    whole = b"".join(direct(enc, dict(texts)[r["doc_id"]] or "") for r in rows)
    # every sequence and mask, in any order and without a copy
    parts = []
    for path in local_files(folder):
        f = TokenFile.mapped(path)
        for k in reversed(range(f.sequences)):
            ids, mask = f.sequence(k)
            assert len(ids) == len(mask) == 64 and not ids.flags.owndata
        real = [f.sequence(k) for k in range(f.sequences)]
        parts.append(np.concatenate([ids[np.array(mask.to_pylist())] for ids, mask in real]))
        assert all(all(m.to_pylist()) for _, m in real[:-1])
        assert f.tokens(0, len(parts[-1])).tolist() == parts[-1].tolist()
        if f.sequences > BATCH:
            assert f.tokens(BATCH * 64 - 3, 9).tolist() == parts[-1][BATCH * 64 - 3:BATCH * 64 + 6].tolist()
    assert np.concatenate(parts).astype("<u4").tobytes() == whole


def test_documents_without_an_id_come_first(spark, enc):
    folder = "file://" + tempfile.mkdtemp(prefix="tokens-")
    texts = [(3, "three"), (None, "no id"), (1, None), (None, None), (None, "no id")]
    out = read_token_files(spark, folder, write_token_files(edge_docs(spark, texts), folder, files=3, length=64))
    rows = sorted(out.collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, None, None, 1, 3]
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == _expected(enc, texts)
    assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows])[:-1]]


def test_token_files_of_no_documents(spark):
    folder = "file://" + tempfile.mkdtemp(prefix="tokens-")
    assert read_token_files(spark, folder, write_token_files(edge_docs(spark, []), folder)).count() == 0


def _check_packing(out, enc, texts, capacity):
    by_doc, by_seq = {}, {}
    for r in out.collect():
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    whole = Counter((i, direct(enc, t or "")) for i, t in texts)
    assert {i for i, _ in whole} == set(by_doc)
    total = 0
    for i, pieces in by_doc.items():
        copies = sum(n for (j, _), n in whole.items() if j == i)
        for k in sorted({p["piece"] for p in pieces}):
            same = [p for p in pieces if p["piece"] == k]
            if copies == 1:
                ids = next(b for j, b in whole if j == i)
                part = ids[4 * same[0]["start"]:4 * (same[0]["start"] + same[0]["length"])]
                assert len(same) == 1 and zlib.crc32(part) == same[0]["ids_crc32"]
        if copies == 1:
            assert [p["length"] for p in sorted(pieces, key=lambda p: p["piece"])] == piece_lengths(len(ids) // 4, capacity)
        total += sum(p["length"] for p in pieces)
    assert total == sum(len(b) // 4 * n for (_, b), n in whole.items())
    for spans in by_seq.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_seq), -(-total // capacity)


def test_packing_of_awkward_documents(spark, enc):
    _check_packing(pack_documents(edge_docs(spark)), enc, TEXTS, 1024)
    short = [(i, t) for i, t in TEXTS if t != LONG]
    _check_packing(pack_documents(edge_docs(spark, short), capacity=8), enc, short, 8)
    assert pack_documents(edge_docs(spark, [])).count() == 0


def test_packing_of_the_table_in_many_groups(spark, enc):
    docs = documents(spark)
    for group, spare in ((8192, 2), (20, docs.count() // 20 + 2)):   # each group may leave one bin half empty
        used, bound = _check_packing(pack_documents(docs, group_pieces=group), enc, texts_of(docs), 1024)
        assert used <= bound + spare


def test_packed_sequences_hold_the_ids(spark, enc):
    texts = [(i, t) for i, t in TEXTS if t != LONG]
    seqs = packed_sequences(edge_docs(spark, texts), capacity=16).collect()
    got = Counter()
    for s in seqs:
        assert len(s["ids"]) == 4 * sum(s["lengths"]) <= 64
        at = 0
        for i, n in zip(s["doc_ids"], s["lengths"], strict=True):
            got[(i, bytes(s["ids"][at:at + 4 * n]))] += 1
            at += 4 * n
    want = Counter()
    for i, t in texts:
        ids, at = direct(enc, t or ""), 0
        for n in piece_lengths(len(ids) // 4, 16):
            want[(i, ids[4 * at:4 * (at + n)])] += 1
            at += n
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_search_packs_everything_and_never_worsens_best_fit(sizes):
    bins = pack_sizes(sizes, 50)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 50 for b in bins)
    assert -(-sum(sizes) // 50) <= len(bins) <= len(best_fit(sizes, 50))


def test_search_finds_what_best_fit_misses():
    """Pairs that fill a bin exactly, which best fit breaks up."""
    sizes = [44, 24, 24, 22, 21, 17, 8, 8, 6, 6]
    assert len(best_fit(sizes, 60)) == 4 > len(pack_sizes(sizes, 60)) == 3


def test_every_underfull_bin_gives_not_only_the_emptiest():
    """Sizes of about a third of a bin: best fit puts the large ones together, and three of them do not fit."""
    rng = np.random.default_rng(2)
    sizes = rng.integers(300, 400, 600).tolist()
    search = LocalSearch(sizes, best_fit(sizes, 1024), 1024)
    start = int((search.fill ** 2).sum())
    bins = search.run()
    assert len(bins) < 0.97 * len(best_fit(sizes, 1024))
    assert int((search.fill ** 2).sum()) > start and search.fill.max() <= 1024
    assert sorted(i for b in bins for i in b) == list(range(600))


def test_every_pair_of_a_bin_of_many_documents_is_tried():
    """The only exchange that fits gives two of the sixty smallest documents of the bin for one."""
    sizes = [50, 49, *[3] * 60, *[4] * 60, 41, 52]
    bins = [[0, 1], list(range(2, 122)), [122, 123]]
    search = LocalSearch(sizes, bins, 500)
    search.run()
    assert sum(len(b) > 0 for b in search.bins) == search.bound == 2


def test_a_step_always_raises_the_squared_fill():
    rng = np.random.default_rng(3)
    for _ in range(200):
        sizes = rng.integers(1, 40, 40).tolist()
        bins, k = [], 0
        while k < 40:
            n = int(rng.integers(1, 4))
            bins.append([i for i in range(k, min(40, k + n))])
            k += n
        search = LocalSearch(sizes, bins, 120)
        for _ in range(50):
            before = int((search.fill ** 2).sum())
            if not search._step(int(rng.choice(np.flatnonzero(search.fill > 0)))):
                continue
            assert int((search.fill ** 2).sum()) > before and search.fill.max() <= 120
