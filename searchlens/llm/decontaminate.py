"""Benchmark decontamination by SimHash over item-sized windows.

1. Every benchmark item gets a window size below its own size, from a grid of sizes, and a 64-bit SimHash of its word
   pairs at every offset of that window. The shortest unbroken part of the item that can be similar enough - a text that
   is this part, or that begins or ends with it - holds such a window whole wherever the document's windows, which step
   by a tenth of their size, happen to begin.
2. Windows of each size run over the whole text of every document. A multi-index over four blocks of 16 bits finds
   all item fingerprints within ``RADIUS`` bits of a window's: by the pigeonhole principle one of the blocks differs
   in at most RADIUS // 4 bits, and each item is entered under all block values that near to its own.
3. The stretch of the document that the item would cover, and those that begin a little before or after it, are then
   compared by their five-word shingles, weighted by how often they occur: the sum of the smaller counts over the sum of
   the larger ones must reach 0.8. Stretches end with the text; where the text begins with the end of an item, so does
   the stretch.

Words are runs of characters between white space and ASCII punctuation, in lower case. Benchmark items are broadcast
in blocks of at most ``BLOCK_BYTES``; documents are neither shuffled nor gathered. An edited word moves two of a
window's pairs but five of its shingles, so pairs keep the fingerprints of lightly edited passages close.

Defined results: a null or empty text, of a document or an item, matches nothing; an item of fewer than five words is
one shingle; equal items are reported each; of equally similar places in a document the first one is reported; repeated rows are reported each; an empty table gives no rows; other
columns are ignored or, in ``drop_leaks``, kept whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces_of, strings, text_of

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 7
BLOCKS = 4                  # of 16 bits
SHARE = 0.76                # of an item's words that its window has at most
GROWTH = 1.12               # from a window size to the next
BLOCK_BYTES = 4 << 20       # of benchmark text that is broadcast at once
PAIRED = 4                  # words from which an item's features are word pairs and not words
_WORDS = 1 << 15            # words that are worked on at a time
_CHARS = 8 << 20
_ROWS = 1 << 10             # windows that are counted at a time

_PUNCTUATION = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_TO_SPACE = bytes.maketrans(_PUNCTUATION, b" " * len(_PUNCTUATION))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_TO_SPACE).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words, repeat(0)), np.uint64, len(words))


def features(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hashes of all runs of ``width`` words (1 or 2), from those of the words."""
    if width == 1:
        return hashes
    mixed = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """Running sums of each of the 64 bits; differences of two rows count a window's bits, modulo 2**16."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, 64), np.uint16)
    np.cumsum(bits, axis=0, dtype=np.uint16, out=sums[1:])
    return sums


def window_prints(sums: np.ndarray, size: int, step: int) -> np.ndarray:
    """The SimHash of every window of ``size`` features, ``step`` features apart."""
    if len(sums) <= size:
        return np.empty(0, np.uint64)
    later, earlier = sums[size::step], sums[:-size:step]
    # Some windows at a time, so that what is worked on stays in the processor's cache.
    out, counts, more = np.empty((len(later), 8), np.uint8), np.empty((_ROWS, 64), np.uint16), np.empty((_ROWS, 64), bool)
    for k in range(0, len(later), _ROWS):
        n = min(_ROWS, len(later) - k)
        np.subtract(later[k:k + n], earlier[k:k + n], out=counts[:n])
        np.greater(counts[:n], size // 2, out=more[:n])
        out[k:k + n] = np.packbits(more[:n], axis=1, bitorder="little")
    return out.view("<u8").ravel()


def least_words(words: int, similarity: float = SIMILARITY) -> int:
    """The fewest words in a row of an item that can be as similar to it, with no other words beside them."""
    if words < SHINGLE:
        return words
    return max(1, math.ceil(similarity * (words - SHINGLE + 1) - 1e-9)) + SHINGLE - 1


def window_size(words: int, similarity: float = SIMILARITY) -> int:
    """The largest size of the grid of which ``least_words`` hold a window at any step; the grid has every size below 8."""
    target, least = max(1, int(words * SHARE)), least_words(words, similarity)
    while target + step_of(target) - 1 > least:
        target -= 1
    if target < 8:
        return target
    return int(8 * GROWTH ** math.floor(math.log(target / 8) / math.log(GROWTH) + 1e-9))


def step_of(size: int) -> int:
    return max(1, size // 10)


class MultiIndex:
    """Finds all stored 64-bit fingerprints within ``radius`` bits of those asked for."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS):
        self.prints, self.radius = prints, radius
        near = [0]
        for _ in range(radius // BLOCKS):
            near = sorted({x ^ (1 << b) for x in near for b in range(16)} | set(near))
        near = np.array(near, np.uint16)
        self.tables = []
        for k in range(BLOCKS):
            own = prints.view(np.uint16).reshape(-1, BLOCKS)[:, k]
            keys = (own[:, None] ^ near[None, :]).ravel()
            who = np.repeat(np.arange(len(prints)), len(near))
            order = np.argsort(keys, kind="stable")
            ends = np.searchsorted(keys[order], np.arange(65537, dtype=np.int64))
            self.tables.append((np.diff(ends) > 0, ends, who[order]))

    def find(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``asked``, place in the index) of every pair within the radius, without repeats."""
        blocks = asked.view(np.uint16).reshape(-1, BLOCKS)
        found = []
        for k, (some, ends, who) in enumerate(self.tables):
            at = np.flatnonzero(some[blocks[:, k]])
            if not len(at):
                continue
            key = blocks[at, k].astype(np.int64)
            n = ends[key + 1] - ends[key]
            place = np.repeat(at, n)
            entry = who[np.repeat(ends[key], n) + np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n)]
            near = np.bitwise_count(asked[place] ^ self.prints[entry]) <= self.radius
            found.append(place[near] * len(self.prints) + entry[near])
        both = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        return both // max(1, len(self.prints)), both % max(1, len(self.prints))


def shingle_counts(words: list[bytes]) -> Counter:
    if len(words) < SHINGLE:
        return Counter([tuple(words)] if words else [])
    return Counter(zip(*(words[k:] for k in range(SHINGLE)), strict=False))


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Sum of the smaller counts over the sum of the larger ones."""
    shared = (a & b).total()
    either = a.total() + b.total() - shared
    return shared / either if either else 0.0


Leak = tuple[int, float, int, int]              # item id, similarity, first word, words
Stretch = tuple[int, int, list[bytes], bool]    # number of the text, words of it before, words, whether it is the last


class Index:
    """A block of benchmark items, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], radius: int = RADIUS, similarity: float = SIMILARITY):
        self.similarity = similarity
        self.items = [(i, w) for i, t in items if (w := words_of(t or ""))]
        self.shingles = [shingle_counts(w) for _, w in self.items]
        by_size: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for k, (_, words) in enumerate(self.items):
            width = 2 if len(words) >= PAIRED else 1
            size = window_size(len(words), similarity)
            prints = window_prints(bit_sums(features(word_hashes(words), width)), size - width + 1, 1)
            by_size.setdefault((width, size), []).extend((int(p), k, at) for at, p in enumerate(prints))
        self.sizes = [(width, size, MultiIndex(np.array([p for p, _, _ in e], np.uint64), radius),
                       np.array([k for _, k, _ in e]), np.array([at for _, _, at in e]))
                      for (width, size), e in sorted(by_size.items())]
        self.longest = max((len(w) for _, w in self.items), default=0)

    def leaks(self, texts: list[str]) -> list[list[Leak]]:
        """The best match of each item that a text leaks, for every text."""
        best: list[dict[int, tuple[float, int]]] = [{} for _ in texts]
        held: list[Stretch] = []
        count = 0
        for n, text in enumerate(texts):
            for stretch in self._stretches(n, text):
                held.append(stretch)
                count += len(stretch[2])
                if count >= _WORDS:
                    self._match(held, best)
                    held, count = [], 0
        self._match(held, best)
        return [[(self.items[k][0], s, at, len(self.items[k][1])) for k, (s, at) in sorted(b.items())] for b in best]

    def _stretches(self, n: int, text: str) -> Iterator[Stretch]:
        """A text's words in stretches of bounded size, each with the head of the next one."""
        over, words, at, before = 2 * self.longest, [], 0, 0
        while at < len(text) or words:
            while at < len(text) and len(words) < _WORDS + over:
                end = min(len(text), at + _CHARS)
                while end < len(text) and not text[end].isspace():
                    end += 1
                words += words_of(text[at:end])
                at = end
            if at >= len(text) and len(words) <= _WORDS + over:
                yield n, before, words, True
                return
            yield n, before, words[:_WORDS + over], False
            words, before = words[_WORDS:], before + _WORDS

    def _match(self, held: list[Stretch], best: list[dict[int, tuple[float, int]]]) -> None:
        """Look for all items in the given stretches at once, and verify what the windows find."""
        words = [w for _, _, own, _ in held for w in own]
        if not words or not self.sizes:
            return
        ends = np.cumsum([len(own) for _, _, own, _ in held])
        home = np.repeat(np.arange(len(held)), [len(own) for _, _, own, _ in held])
        hashes = word_hashes(words)
        sums = {w: bit_sums(features(hashes, w)) for w in {width for width, *_ in self.sizes}}
        found: set[tuple[int, int, int]] = set()
        for width, size, index, item, offset in self.sizes:
            step = step_of(size)
            at, entry = index.find(window_prints(sums[width], size - width + 1, step))
            at = at * step
            inside = home[at] == home[at + size - 1]   # not across two stretches
            at, entry = at[inside], entry[inside]
            found.update(zip(home[at].tolist(), item[entry].tolist(), (at - offset[entry]).tolist(), strict=True))
        for h, k, start in found:
            n, before, own, last = held[h]
            size = len(self.items[k][1])
            slack = size - least_words(size, self.similarity)
            start -= int(ends[h]) - len(own)
            around = shingle_counts(own[max(0, start - slack):max(0, start + size + slack)])
            if (around & self.shingles[k]).total() < self.similarity * self.shingles[k].total() - 1e-9:
                continue
            for lo in sorted(range(start - slack, start + slack + 1), key=lambda x: abs(x - start)):
                if lo < 0 and (before or lo != start or 2 * sum(map(eq, own, self.items[k][1][-lo:])) < size + lo) \
                        or lo + size > len(own) and not last:
                    continue                           # a text begins and ends only where its first and last stretch do
                s = weighted_similarity(shingle_counts(own[max(0, lo):max(0, lo + size)]), self.shingles[k])
                lo = max(0, lo)
                if s >= self.similarity and (s, -before - lo) > (best[n].get(k, (0.0, 0))[0], -best[n].get(k, (0.0, 0))[1]):
                    best[n][k] = s, before + lo
                if s == 1:
                    break


def item_blocks(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of at most ``BLOCK_BYTES`` of text (or one longer item)."""
    rows = benchmark.select(F.col(item).alias("item"), text_of(text).alias("text"))
    block, held = [], 0
    for r in rows.toLocalIterator():
        n = len(r["text"].encode())
        if block and held + n > BLOCK_BYTES:
            yield block
            block, held = [], 0
        block.append((r["item"], r["text"]))
        held += n
    if block:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, ident: str = "doc_id", text: str = "text",
               similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, n_words) for every document and item that it leaks."""
    rows = docs.select(F.col(ident).alias("doc_id"), text_of(text).alias("text"))
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, item_id {dict(benchmark.dtypes)['item_id']}, " \
             "similarity double, first_word bigint, n_words bigint"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, similarity=similarity)
            for batch in pieces_of(batches, "text"):
                leaks = index.leaks(strings(batch.column("text")))
                found = [(d, *m) for d, own in zip(batch.column("doc_id").to_pylist(), leaks, strict=True) for m in own]
                if found:
                    columns = list(zip(*found, strict=True))
                    yield pa.record_batch([pa.array(columns[0], batch.schema.field("doc_id").type),
                                           *(pa.array(c) for c in columns[1:])],
                                          names=["doc_id", "item_id", "similarity", "first_word", "n_words"])

        out = out.unionByName(rows.mapInArrow(find, schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text",
               similarity: float = SIMILARITY) -> DataFrame:
    """The documents that leak no item, in the columns of ``docs``."""
    at = docs.columns.index(text)
    out = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    for block in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, similarity=similarity)
            for batch in pieces_of(batches, f"c{at}"):
                clean = [not own for own in index.leaks(strings(batch.column(at)))]
                yield batch.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(keep, out.schema)
    return out.toDF(*docs.columns)
