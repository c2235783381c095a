"""Word-piece counts by a linear longest-match automaton.

The vocabulary is a trie of byte strings. Greedy longest match takes the longest piece that starts a word, then the
longest that starts its rest, and so on. The automaton does so without going back: when a node has no child for the
next byte, its failure link leads to the node for what is left after the pieces that can be taken for certain, and
the node knows how many pieces that were. Counts are thus added up along the way and no piece is ever built, and a
word of n bytes takes at most 2n steps.

A word is a run of bytes between ASCII white space, looked up with one space before it, which is how pieces that start
a word are written in the vocabulary. Every single byte is a piece, so there is no unknown word.

Defined results: a null or empty text has no words and no pieces; repeated rows are reported each; an empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of, strings, text_of
from .simhash import word_blocks
from .tokens import vocabulary_path

LONG_WORD = 128   # bytes from which a word is walked by itself and not together with others
_MANY = 1 << 18   # different words that are counted at a time


def byte_pieces(path: str | None = None) -> list[bytes]:
    """The pieces of a byte-level vocabulary file as bytes, special tokens left out.

    Such files write a byte as a printable character: itself where it is one, else the next free one from 256 on.
    """
    with open(path or vocabulary_path()) as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    return [bytes(byte_of[c] for c in piece) for piece in spec["model"]["vocab"] if piece not in special]


class Automaton:
    """The trie with failure links; node 0 is the root."""

    def __init__(self, pieces: Iterable[bytes]):
        child: dict[int, int] = {}      # node * 256 + byte
        whole = {0: False}
        for piece in pieces:
            node = 0
            for b in piece:
                node = child.setdefault(node << 8 | b, len(child) + 1)
            whole[node] = True
        n = len(child) + 1
        missing = [b for b in range(256) if b not in child]
        if missing:
            raise ValueError(f"bytes without a piece of their own: {missing}")
        links: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for key, node in child.items():
            links[key >> 8].append((key & 255, node))
        self.fail, self.popped, self.at_end = (np.zeros(n, np.int64) for _ in range(3))
        fail, popped, at_end = [0] * n, [0] * n, [0] * n
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for b, node in links[parent]:
                if whole.get(node):
                    fail[node], popped[node] = 0, 1
                else:
                    z, taken = fail[parent], popped[parent]
                    while (z << 8 | b) not in child:
                        z, taken = fail[z], taken + popped[z]
                    fail[node], popped[node] = child[z << 8 | b], taken
                at_end[node] = popped[node] + at_end[fail[node]]
                queue.append(node)
        self.fail[:], self.popped[:], self.at_end[:] = fail, popped, at_end
        self.child = child
        order = sorted(child)
        self.keys = np.array(order, np.int64)
        self.nodes = np.array([child[k] for k in order], np.int64)

    def count(self, word: bytes) -> int:
        """Pieces of one word, byte by byte."""
        node = total = 0
        child, fail, popped = self.child, self.fail, self.popped
        for b in word:
            while (to := child.get(node << 8 | b)) is None:
                total += int(popped[node])
                node = int(fail[node])
            node = to
        return total + int(self.at_end[node])

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Pieces of many words, all of which take a step at a time."""
        out = np.zeros(len(words), np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(sizes > LONG_WORD):
            out[i] = self.count(words[i])
        active = np.flatnonzero((sizes > 0) & (sizes <= LONG_WORD))
        data = np.frombuffer(b"".join(words), np.uint8)
        at = (np.cumsum(sizes) - sizes)[active]
        end = at + sizes[active]
        node = np.zeros(len(active), np.int64)
        while len(active):
            key = node << 8 | data[at]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            goes = self.keys[place] == key
            stays = ~goes
            out[active[stays]] += self.popped[node[stays]]
            node = np.where(goes, self.nodes[place], self.fail[node])
            at = at + goes
            over = at == end
            if over.any():
                out[active[over]] += self.at_end[node[over]]
                left = ~over
                active, at, end, node = active[left], at[left], end[left], node[left]
        return out


_automata: dict[str | None, Automaton] = {}


def automaton(path: str | None = None) -> Automaton:
    """The worker's automaton, kept between tasks."""
    if path not in _automata:
        _automata[path] = Automaton(byte_pieces(path))
    return _automata[path]


def _batch_counts(texts: list[str], walker: Automaton) -> tuple[list[int], np.ndarray]:
    """(words, pieces) of each text; a word that occurs often is walked once a batch."""
    seen: dict[bytes, int] = {}
    n_words, n_pieces = [0] * len(texts), np.zeros(len(texts), np.int64)
    held: list[tuple[int, np.ndarray]] = []

    def settle() -> None:
        each = walker.counts([b" " + w for w in seen])
        for k, codes in held:
            n_pieces[k] += each[codes].sum()
        seen.clear()
        held.clear()

    for k, text in enumerate(texts):
        for words in word_blocks(text.encode()):
            n_words[k] += len(words)
            held.append((k, np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))))
            if len(seen) > _MANY:
                settle()
    settle()
    return n_words, n_pieces


def token_counts(docs: DataFrame, ident: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_pieces."""
    rows = docs.select(F.col(ident).alias("doc_id"), text_of(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walker = automaton(vocabulary)
        for batch in pieces_of(batches, "text"):
            n_words, n_pieces = _batch_counts(strings(batch.column("text")), walker)
            yield pa.record_batch([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_pieces)],
                                  names=["doc_id", "n_words", "n_pieces"])

    return rows.mapInArrow(count, f"doc_id {dict(rows.dtypes)['doc_id']}, n_words bigint, n_pieces bigint")
