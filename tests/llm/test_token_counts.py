import random

import pytest

from searchlens.llm.token_counts import Automaton, automaton, byte_pieces, token_counts

from .edge import TEXTS, documents, edge_docs, texts_of


def greedy(word, pieces, longest):
    at = n = 0
    while at < len(word):
        size = min(longest, len(word) - at)
        while word[at:at + size] not in pieces:
            size -= 1
        at, n = at + size, n + 1
    return n


def test_small_vocabularies_against_greedy_matching():
    rng = random.Random(1)
    for _ in range(40):
        pieces = {bytes([b]) for b in range(256)} | {bytes(rng.choice(b"ab c") for _ in range(rng.randint(2, 7))) for _ in range(25)}
        walker, longest = Automaton(pieces), max(map(len, pieces))
        words = [bytes(rng.choice(b"ab cd") for _ in range(rng.randint(0, 30))) for _ in range(60)]
        want = [greedy(w, pieces, longest) for w in words]
        assert walker.counts(words).tolist() == want == [walker.count(w) for w in words]


def test_a_byte_without_a_piece_is_an_error():
    with pytest.raises(ValueError):
        Automaton([b"a"])


def _check(out, texts):
    pieces = set(byte_pieces())
    longest = max(map(len, pieces))
    want = sorted(((i, len(w := (t or "").encode().split()), sum(greedy(b" " + x, pieces, longest) for x in w)) for i, t in texts), key=str)
    assert sorted(((r["doc_id"], r["n_words"], r["n_pieces"]) for r in out.collect()), key=str) == want


def test_documents_of_the_table(spark):
    docs = documents(spark)
    _check(token_counts(docs), texts_of(docs))


def test_awkward_documents(spark):
    _check(token_counts(edge_docs(spark)), TEXTS)
    assert token_counts(edge_docs(spark, [])).count() == 0


def test_long_words_and_many_words(monkeypatch):
    import searchlens.llm.token_counts as T
    texts = ["x" * 5000 + " " + "ab" * 300, "one two " * 50, " ".join(f"w{i}" for i in range(500))]
    before = T._batch_counts(texts, automaton())
    monkeypatch.setattr(T, "_MANY", 10)
    after = T._batch_counts(texts, automaton())
    assert before[0] == after[0] and before[1].tolist() == after[1].tolist()
