"""Exact encoding and decoding with a SentencePiece model of merge type (BPE), by backtracking.

Merging takes, again and again, the pair of neighbours whose joined piece has the highest score, the leftmost of equal
ones. The result is the only way to cut a text into pieces in which every two neighbours are compatible: merging the two
alone ends in just these two. So the encoder goes from left to right. At each position it tries the longest piece that
starts there, found by an Aho-Corasick automaton, then that piece's shorter prefixes, and takes the first that is
compatible with the piece before. Where none is, it goes back one piece and marks the position as failed in a bitfield.
The pieces up to a position are always the encoding of the text up to there, so a failed position has failed for good,
and the work is linear. Two pieces are compatible if no merge across their border would have come before the merges
inside them: the last merges on both sides are undone one by one, the later one first, and what then meets at the border
is looked up. Where pieces of the same score meet, the two are merged again from their characters instead.

A character that has no piece is written as the pieces of its UTF-8 bytes. A text is cut before runs of spaces where no
piece of the model goes on across such a place, and the encoding of what lies between is kept for the next time.

The text is taken as it is, with one space set before it, which is what models without a character map do; a model with
a character map, without byte pieces or with user-defined pieces is an error.

Defined results: a null or empty text has no ids and decodes to the empty text; repeated rows are reported each; an empty
table gives no rows; other columns are ignored, whatever their names; of merges of equal score the leftmost comes first.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of, strings, text_of
from .tokens import vocabulary_path

SPACE = "▁"         # how a model writes a space
KEEP = 64           # characters of the longest part whose encoding is kept, and of the longest piece
UNKNOWN_TEXT = " ⁇ "  # what an unknown id decodes to
# Piece types of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a message in protocol buffer format."""

    def number(at: int) -> tuple[int, int]:
        out = shift = 0
        while True:
            b = data[at]
            out |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return out, at

    at = 0
    while at < len(data):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at:at + size], at + size
        yield key >> 3, value


class _Ones(dict):
    """Lengths of pieces in characters: one where nothing else is known."""

    def __missing__(self, code: int) -> int:
        return 1


class _Codes(dict):
    """Numbers of pieces, and of characters without one: ``count`` plus the code point."""

    def __init__(self, count: int, ids: dict[str, int]):
        super().__init__(ids)
        self.count, self.names = count, {i: p for p, i in ids.items()}

    def __missing__(self, char: str) -> int:
        return self.count + ord(char)

    def text(self, code: int) -> str:
        return self.names[code] if code < self.count else chr(code - self.count)


class _Written(dict):
    """The ids that a piece, or a character without one, is written as."""

    def __init__(self, model: PieceModel):
        super().__init__({i: np.array([i], "<u4").tobytes() for i in model.ids.values()})
        self.codes, self.byte_ids = model.codes, model.byte_ids

    def __missing__(self, code: int) -> bytes:
        return np.array([self.byte_ids[b] for b in self.codes.text(code).encode()], "<u4").tobytes()


class PieceModel:
    """The pieces of a model file, with encoding and decoding. ``cache`` bounds the kept parts of texts and pairs."""

    def __init__(self, path: str, cache: int = 400_000):
        import ahocorasick

        with open(path, "rb") as f:
            model = list(_fields(f.read()))
        pieces, scores, kinds = [], [], []
        for body in (v for k, v in model if k == 1):
            entry = dict(_fields(body))
            pieces.append(entry[1].decode())
            scores.append(float(np.frombuffer(entry.get(2, bytes(4)), "<f4")[0]))
            kinds.append(entry.get(3, NORMAL))
        trainer = dict(_fields(next((v for k, v in model if k == 2), b"")))
        rules = dict(_fields(next((v for k, v in model if k == 3), b"")))
        self.prefix = rules.get(3, 1) == 1
        if trainer.get(3, 1) != 2 or rules.get(2) or rules.get(4, 1) or not rules.get(5, 1) or trainer.get(24, 0):
            raise ValueError("not a merge-type model that takes texts as they are")
        if USER_DEFINED in kinds or UNUSED in kinds or kinds.count(BYTE) != 256:
            raise ValueError("a model with byte pieces and without user-defined or unused pieces is needed")
        self.score = {p: s for p, s, kind in zip(pieces, scores, kinds, strict=True) if kind == NORMAL}
        # The parts that a piece's last merge joins. A piece that merging never makes is in no encoding.
        self.halves = {p: tuple(parts) for p in self.score if len(parts := self._merged(p)) == 2}
        self.ids = {p: i for i, p in enumerate(pieces) if kinds[i] == NORMAL and (len(p) == 1 or p in self.halves)}
        order = sorted(self.score, key=lambda p: -self.score[p])
        self.rank = {p: k for k, p in enumerate(order) if len(p) > 1}
        self.tied = {x + y for p, q in zip(order, order[1:], strict=False) if self.score[p] == self.score[q]
                     for both in (p, q) for x, y in zip(both, both[1:], strict=False)}
        self.byte_ids = [0] * 256
        raw = [b""] * len(pieces)
        for i, (piece, kind) in enumerate(zip(pieces, kinds, strict=True)):
            if kind == BYTE:
                self.byte_ids[int(piece[3:5], 16)] = i
                raw[i] = bytes([int(piece[3:5], 16)])
            elif kind != CONTROL:
                raw[i] = (UNKNOWN_TEXT if kind == UNKNOWN else piece.replace(SPACE, " ")).encode()
        self.kind = np.array(kinds, np.uint8)
        self.leads = np.array([k == NORMAL and p.startswith(SPACE) for p, k in zip(pieces, kinds, strict=True)])
        self.raw = self._table(raw)
        self.numbers = self._table([b"%d," % i for i in range(len(pieces))])
        if max(map(len, self.ids)) > KEEP:
            raise ValueError(f"a piece has more than {KEEP} characters")
        # Inside the encoder a piece goes by its id, a character without a piece by a number above all ids.
        self.codes = _Codes(len(pieces), self.ids)
        self.automaton = ahocorasick.Automaton()
        self.sizes_of, self.shorter = _Ones(), {}
        for piece, code in self.ids.items():
            if len(piece) > 1:
                self.automaton.add_word(piece, (len(piece) - 1, code))
                self.sizes_of[code] = len(piece)
                # The next shorter piece that it begins with, or its first character.
                self.shorter[code] = next(self.codes[piece[:k]] for k in range(len(piece) - 1, 0, -1)
                                          if k == 1 or piece[:k] in self.ids)
        self.automaton.make_automaton()
        # A text may be cut between two characters that no piece has next to each other.
        self.inside = {x + y for piece in self.ids for x, y in zip(piece, piece[1:], strict=False)}
        self.cuts = not any(pair[1] == SPACE != pair[0] for pair in self.inside)
        self.feeds = any("\n" in pair for pair in self.inside)
        self.cache = cache
        self.agrees: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.written = _Written(self)

    @staticmethod
    def _table(values: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(all bytes, where each value starts, how long it is)."""
        sizes = np.array([len(x) for x in values], np.int64)
        return np.frombuffer(b"".join(values), np.uint8), np.cumsum(sizes) - sizes, sizes

    def _merged(self, text: str, border: int = 0) -> list[str]:
        """The parts of a text when all merges are made but the one that would make it whole.

        With a ``border``, merging ends with a merge across it, and the list is empty.
        """
        parts, score = list(text), self.score.get
        while len(parts) > 2 or border:
            best, at = None, -1
            for k in range(len(parts) - 1):
                s = score(parts[k] + parts[k + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, k
            if best is None:
                break
            if border and at == border - 1:
                return []
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            border -= at < border
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the characters of both pieces ends in just these two."""
        joined = left + right
        if any(pair in joined for pair in self.tied):
            return self._merged(joined, len(left)) == [left, right]
        rank, halves, limit = self.rank.get, self.halves, len(self.rank)
        while True:
            if rank(left + right, limit) < limit:
                return False
            of_left, of_right = rank(left, -1), rank(right, -1)
            # Of equal merges the left one comes first, so the right one is undone first.
            if of_left > of_right:
                left, limit = halves[left][1], of_left
            elif of_right >= 0:
                right, limit = halves[right][0], of_right + 1
            else:
                return True

    def _agree(self, before: int, code: int) -> bool:
        if len(self.agrees) > 2 * self.cache:
            self.agrees.clear()
        good = self.agrees[before << 21 | code] = self.compatible(self.codes.text(before), self.codes.text(code))
        return good

    def _cut(self, text: str) -> list[int]:
        """The codes of the pieces of a text whose spaces are written as the model does."""
        size = len(text)
        longest = list(map(self.codes.__getitem__, text))
        for end, (more, code) in self.automaton.iter(text):
            longest[end - more] = code     # ends rise, so the last match of a start is its longest
        failed, out, at = bytearray(size + 1), [], 0
        agrees, shorter, sizes, agree = self.agrees, self.shorter, self.sizes_of, self._agree
        code = longest[0] if size else None
        while at < size:
            before = out[-1] if out else None
            while True:
                end = at + sizes[code]
                if not failed[end]:
                    if before is None:
                        break
                    good = agrees.get(before << 21 | code)
                    if good or good is None and agree(before, code):
                        break
                code = shorter.get(code)
                if code is None:
                    break
            if code is not None:
                out.append(code)
                at = end
                if at < size:
                    code = longest[at]
            elif before is None:
                raise ValueError("the model's merges cannot spell the text")
            else:
                failed[at] = 1
                code = out.pop()
                at -= sizes[code]
        return out

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text whose spaces are written as the model does; a character without a piece stands alone."""
        return [self.codes.text(code) for code in self._cut(text)]

    def _part(self, part: str) -> bytes:
        """The ids of a part between two cuts.

        Parts after a space are kept under what follows it. When there are too many, those that were not used since
        the last time go.
        """
        if len(part) == 1:
            return self.written[self.codes[part]]
        word = part[1:]
        kept = self.cuts and part[0] == SPACE and len(part) <= KEEP
        out = self.older.get(word) or self.known.get(word) if kept else None
        if out is None:
            if not self.feeds and "\n" in part:
                return b"".join([self._part(x) for x in re.split("(\n)", part) if x])
            if part[-2:] not in self.inside:
                out = self._part(part[:-1]) + self.written[self.codes[part[-1]]]
            else:
                out = b"".join([self.written[code] for code in self._cut(part)])
        if kept:
            if len(self.known) >= self.cache:
                self.known, self.older = {}, self.known
            self.known[word] = out
        return out

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        fill = self._part
        if self.cuts and self.prefix and "  " not in text and text[0] != " " and SPACE not in text:
            words = text.split(" ")
            found = list(map(self.known.get, words))
            if None in found:
                found = [x or fill(SPACE + w) for w, x in zip(words, found, strict=True)]
            return b"".join(found)
        text = SPACE * self.prefix + text.replace(" ", SPACE)
        return b"".join(map(fill, re.findall(f"{SPACE}+[^{SPACE}]*|^[^{SPACE}]+", text) if self.cuts else [text]))

    def digits(self, ids: np.ndarray) -> bytes:
        """The ids as decimal numbers joined by commas."""
        return self._spread(self.numbers, ids)[:-1]

    @staticmethod
    def _spread(table: tuple[np.ndarray, np.ndarray, np.ndarray], ids: np.ndarray) -> bytes:
        """What a table has for each id, end to end."""
        flat, starts, lengths = table
        sizes = lengths[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ids) else 0
        return flat[np.repeat(starts[ids] - (ends - sizes), sizes) + np.arange(total)].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The text of an array of ids: control ids are nothing, unknown ids a sign, broken bytes U+FFFD each."""
        raw = self._spread(self.raw, ids)
        if self.prefix and len(ids):
            # The space that encoding sets first goes: the first piece that is not a control has it, or none.
            first = int(np.argmax(self.kind[ids] != CONTROL))
            if self.leads[ids[first]]:
                raw = raw[1:]
        return raw.decode("utf-8", "searchlens-per-byte")


# Each byte that is not part of a character becomes a sign of its own.
codecs.register_error("searchlens-per-byte", lambda e: ("�", e.start + 1))

_models: dict[tuple, PieceModel] = {}


def piece_model(path: str | None = None) -> PieceModel:
    """The worker's model, kept between tasks."""
    if path not in _models:
        _models[path] = PieceModel(path or vocabulary_path("piece_bpe_32k.model"))
    return _models[path]


def encode_pieces(docs: DataFrame, ident: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """One row per document: doc_id, ids (binary: little-endian unsigned 32-bit integers)."""
    rows = docs.select(F.col(ident).alias("doc_id"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_model(model)
        for batch in pieces_of(batches, "text", 2 << 20):
            ids = [coder.encode(t) for t in strings(batch.column("text"))]
            yield pa.record_batch([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, ids binary")


def decode_pieces(rows: DataFrame, ident: str = "doc_id", ids: str = "ids", model: str | None = None) -> DataFrame:
    """One row per row: doc_id, text, from ``ids`` as ``encode_pieces`` gives them; null ids are no ids."""
    rows = rows.select(F.col(ident).alias("doc_id"), F.coalesce(F.col(ids), F.lit(b"")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_model(model)
        for batch in pieces_of(batches, "ids", 4 << 20):
            texts = [coder.decode(np.frombuffer(x, "<u4")) for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, text string")


def piece_digests(docs: DataFrame, ident: str = "doc_id", text: str = "text", model: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256. Ids and texts never leave the task."""
    rows = docs.select(F.col(ident).alias("doc_id"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = piece_model(model)
        for batch in pieces_of(batches, "text", 2 << 20):
            counts, of_ids, of_text = [], [], []
            for t in strings(batch.column("text")):
                ids = np.frombuffer(coder.encode(t), "<u4")
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(coder.digits(ids)).hexdigest())
                of_text.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            yield pa.record_batch([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()),
                                   pa.array(of_text, pa.string())],
                                  names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(
        run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
