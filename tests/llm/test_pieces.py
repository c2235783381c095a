"""Encoding and decoding against the library itself."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from searchlens.llm.pieces import PieceModel, decode_pieces, encode_pieces, piece_digests, piece_model
from searchlens.llm.tokens import vocabulary_path

from .edge import TEXTS, documents, edge_docs, texts_of

ODD = ["", " ", "  a", "a ", "a  ", " \n ", "a▁b", "▁▁", "<s> a </s>", "<0x41>", "\x00a", "a\n\nb", "\nstart", "end\n",
       "​ \xe9 é Ａ", "�", "aaaaaaa" * 9, " " * 40 + "x" + " " * 17, "hello   the   world", "今日は \U0001f600\U0001f468‍\U0001f469",
       "a\tb\r\nc", "a b", "the  the", "1234567890 3.14159", "\u0000", "\U0010ffff", "x" * 5000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))


def _same(model, library, text):
    ids = np.frombuffer(model.encode(text), "<u4").tolist()
    assert ids == library.encode(text), text
    assert model.digits(np.array(ids, np.int64)).decode() == ",".join(map(str, ids))
    assert model.decode(np.array(ids, np.int64)) == library.decode(ids), text


def test_odd_texts(library):
    for text in ODD:
        _same(piece_model(), library, text)


def test_random_texts(library):
    rng = random.Random(3)
    alphabets = ["ab ", "the in on er  ", "▁ a", "er\n ", "abcdefghijklmnopqrstuvwxyz    ", "\xe9ü一ا\U0001f600 a", "0123456789., "]
    model = PieceModel(vocabulary_path("piece_bpe_32k.model"), cache=50)   # emptied again and again
    for _ in range(1500):
        alphabet = rng.choice(alphabets)
        _same(model, library, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))))
    words = [library.id_to_piece(i) for i in rng.sample(range(300, 32000), 3000)]
    for _ in range(1500):   # pieces in a row, so that many neighbours are not compatible
        _same(model, library, "".join(rng.choice(words) for _ in range(rng.randint(1, 12))))


def test_any_ids_decode_as_the_library_does(library):
    rng = random.Random(4)
    for _ in range(2000):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), 28705, 259, rng.randrange(32000)]) for _ in range(rng.randint(0, 9))]
        assert piece_model().decode(np.array(ids, np.int64)) == library.decode(ids), ids


def test_backtracking_against_plain_merging():
    model = piece_model()
    rng = random.Random(5)
    for _ in range(400):
        text = "".join(rng.choice("theinaros") for _ in range(rng.randint(1, 25)))
        parts = list(text)
        while True:
            scores = [(model.score[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in model.score]
            if not scores:
                break
            k = -max(scores)[1]
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        assert model.pieces(text) == parts


def test_compatible_pairs_against_merging_them_again():
    model = piece_model()
    rng = random.Random(6)
    names = [p for p in model.ids if len(p) > 1]
    singles = [p for p in model.ids if len(p) == 1]
    found = 0
    for _ in range(30_000):
        left, right = (rng.choice(names if rng.random() < 0.8 else singles) for _ in range(2))
        if rng.random() < 0.5:   # two halves of a piece, which often do merge
            piece = rng.choice(names)
            k = rng.randrange(1, len(piece))
            left, right = piece[:k], piece[k:]
            if left not in model.ids or right not in model.ids:
                continue
        good = model.compatible(left, right)
        assert good == (model._merged(left + right, len(left)) == [left, right]), (left, right)
        found += not good
    assert found > 1000


def test_a_model_of_another_type_is_an_error(tmp_path):
    path = tmp_path / "other.model"
    path.write_bytes(b"\x12\x02\x18\x01")   # trainer: unigram
    with pytest.raises(ValueError):
        PieceModel(str(path))


def _want(library, texts):
    out = []
    for i, t in texts:
        ids = library.encode(t or "")
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    return sorted(out, key=str)


def test_documents_of_the_table(spark, library):
    docs = documents(spark)
    assert sorted(map(tuple, piece_digests(docs).collect()), key=str) == _want(library, texts_of(docs))


def test_awkward_documents(spark, library):
    assert sorted(map(tuple, piece_digests(edge_docs(spark)).collect()), key=str) == _want(library, TEXTS)
    empty = edge_docs(spark, [])
    assert piece_digests(empty).count() == 0 and decode_pieces(encode_pieces(empty)).count() == 0


def test_round_trip(spark, library):
    docs = edge_docs(spark, [*TEXTS, *((100 + k, t) for k, t in enumerate(ODD))])
    coded = encode_pieces(docs)
    assert {(r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in coded.collect() if r["doc_id"]} == {
        (r["doc_id"], tuple(library.encode(r["text"] or ""))) for r in docs.collect() if r["doc_id"]}
    back = sorted(((r["doc_id"], r["text"]) for r in decode_pieces(coded).collect()), key=str)
    assert back == sorted(((r["doc_id"], (r["text"] or "").replace("▁", " ")) for r in docs.collect()), key=str)
