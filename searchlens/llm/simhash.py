"""SimHash near-dedup by a self-join of the binary trie of all fingerprints.

A fingerprint is 64 bits over the word shingles of the whole text. The trie of all different fingerprints is walked
in pairs of nodes: a pair of nodes carries the bits in which their paths differ, its children are the four pairs of
child nodes, and a pair with more than the allowed number of differing bits is dropped with all that lies below it.

Spark deals that walk out. Fingerprints within k bits agree in one of k + 1 blocks of bits, so the trie is built once per
block, with that block's bits first and no budget to differ in them: near the root only the pairs of a node with itself
are left. The upper part of each trie is cut into nodes of at most ``node_size`` fingerprints, however uneven they lie;
every pair of such nodes that the walk still allows is one group, which holds at most two nodes' fingerprints and goes on
from there in numpy over sorted arrays, where a node is a range. (Different nodes meet only below the first block, where
a block's value alone has more than ``node_size`` fingerprints.) A group gives a spanning forest of its links, never all
pairs, and the components come from those forests.

Defined results: a null or empty text, or one without words, has fingerprint zero and links like any other; a text of
fewer words than a shingle is one shingle; equal fingerprints link; repeated rows are all reported, and
``drop_near_copies`` keeps one of them; of a group the smallest id stays, null ids last; an empty table gives no rows;
other columns are ignored or, in ``drop_near_copies``, kept whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lookup, pieces_of, saved, strings, text_of
from .components import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
NODE_SIZE = 1 << 15
MAX_COUNTED = 1 << 16   # trie nodes that are counted in one step on the way down
_SPACE = re.compile(rb"[ \t-\r]")
_BLOCK = 4 << 20
_ALL = 64


def word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size, so that a very long text needs no more memory than a block."""
    at = 0
    while at < len(data):
        end = min(at + _BLOCK, len(data))
        if end < len(data):
            space = _SPACE.search(data, end)
            end = space.start() if space else len(data)
        yield data[at:end].split()
        at = end


def _bit_counts(shingles: list[bytes], hasher) -> np.ndarray:
    total = np.zeros(_ALL, np.int64)
    for k in range(0, len(shingles), 1 << 16):
        part = shingles[k:k + (1 << 16)]
        h = np.fromiter(map(hasher, part, repeat(SEED)), np.uint64, len(part))
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a text: A-Z in lower case, words between ASCII white space."""
    from xxhash import xxh64_intdigest

    counts, n, tail = np.zeros(_ALL, np.int64), 0, []
    for words in word_blocks(text.encode().lower()):
        words = tail + words
        if len(words) >= shingle:
            shingles = list(map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)))
            counts += _bit_counts(shingles, xxh64_intdigest)
            n += len(shingles)
        tail = words[-(shingle - 1):] if shingle > 1 else []
    if not n and tail:
        counts, n = _bit_counts([b" ".join(tail)], xxh64_intdigest), 1
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, ident: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) of every document; fp is the fingerprint as a signed 64-bit number."""
    rows = docs.select(F.col(ident).alias("doc_id"), F.xxhash64(text_of(text)).alias("text_hash"),
                       text_of(text).alias("text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            fps = np.array([fingerprint(t, shingle) for t in strings(batch.column("text"))], np.uint64)
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_hash"), pa.array(fps.view(np.int64))],
                                  names=["doc_id", "text_hash", "fp"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(compute, f"doc_id {kind}, text_hash bigint, fp bigint")


# ---- the upper trie: nodes of bounded size

def trie_nodes(fps: DataFrame, node_size: int) -> tuple[np.ndarray, np.ndarray]:
    """(paths, depths) of disjoint trie nodes that cover all of ``fps``, none with over ``node_size`` of them.

    Only counts come to the driver, about MAX_COUNTED at a time. Nodes that turn out too large are counted anew by
    their descendants, as many levels down as that allows, until all fit (a node of depth 64 is one fingerprint).
    Between two counts, the largest nodes that fit are taken.
    """
    total = fps.count()
    if total <= node_size:
        return np.zeros(1, np.uint64), np.zeros(1, np.int64)
    spark, done, large, depth = fps.sparkSession, [], [0], 0
    while large:
        step = int(np.log2(max(2, MAX_COUNTED / len(large))))
        if not depth:   # evenly spread fingerprints need no more than this
            step = min(step, int(np.ceil(np.log2(total / node_size))) + 1)
        step = min(step, _ALL - depth)
        parents = fps if not depth else fps.join(
            F.broadcast(spark.createDataFrame([(_signed(p),) for p in large], "path bigint")),
            F.expr(f"(fp & {_mask(depth)}) = path"), "left_semi")
        counted = parents.groupBy(F.expr(f"fp & {_mask(depth + step)}").alias("path")).count().collect()
        fitting, large = _largest_nodes({path % 2**64: n for path, n in counted}, depth, depth + step, node_size)
        done += fitting
        depth += step
    done.sort()
    return np.array([p for p, _ in done], np.uint64), np.array([d for _, d in done], np.int64)


def _largest_nodes(counts: dict[int, int], top: int, bottom: int, node_size: int) -> tuple[list[tuple[int, int]], list[int]]:
    """The largest nodes between two depths that fit, as (path, depth), and the paths at ``bottom`` that do not."""
    large = [p for p, n in counts.items() if n > node_size and bottom < _ALL]
    done = [(p, bottom) for p, n in counts.items() if n > node_size and bottom == _ALL]
    split = {p for p, n in counts.items() if n > node_size}
    nodes = {p: n for p, n in counts.items() if n <= node_size}
    for depth in range(bottom - 1, top - 1, -1):
        keep = 2**64 - 2 ** (_ALL - depth)
        above: dict[int, int] = {}
        for p, n in nodes.items():
            above[p & keep] = above.get(p & keep, 0) + n
        cut = {p & keep for p in split} | {p for p, n in above.items() if n > node_size}
        done += [(p, depth + 1) for p in nodes if p & keep in cut]
        nodes = {p: n for p, n in above.items() if p not in cut}
        split = cut
    return done + [(p, top) for p in nodes], large


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _mask(depth: int) -> str:
    """The upper ``depth`` bits as a signed SQL number."""
    return f"CAST({_signed((2**64 - 1) ^ (2**(_ALL - depth) - 1))}BD AS BIGINT)"


def turns(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, length) of each of the ``max_bits`` + 1 blocks of a fingerprint."""
    edges = [k * _ALL // (max_bits + 1) for k in range(max_bits + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def turn_left(x: np.ndarray, bits: int) -> np.ndarray:
    """The fingerprints with their first ``bits`` bits moved to the end."""
    return x if bits % _ALL == 0 else (x << np.uint64(bits % _ALL)) | (x >> np.uint64(_ALL - bits % _ALL))


def _upper(x: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """The first ``depths`` bits; shifted in two steps, since a shift by 64 is undefined."""
    half = (_ALL - depths) // 2
    return (x >> half.astype(np.uint64)) >> (_ALL - depths - half).astype(np.uint64)


class NodePairs:
    """The upper trie of one turn: which nodes a node has to meet."""

    def __init__(self, paths: np.ndarray, depths: np.ndarray, max_bits: int, exact: int):
        self.paths, self.depths, self.max_bits, self.exact = paths, depths, max_bits, exact
        self.known: dict[int, np.ndarray] = {}

    def of(self, node: int) -> np.ndarray:
        """The nodes whose paths, as far as both go, agree in the first ``exact`` bits and differ in at most
        ``max_bits`` others."""
        if node not in self.known:
            # nodes that agree in the exact bits stand together, since the paths are in order
            span = np.uint64(2 ** (_ALL - min(self.exact, int(self.depths[node]))) - 1)
            lo = np.searchsorted(self.paths, self.paths[node] & ~span)
            hi = np.searchsorted(self.paths, self.paths[node] | span, side="right")
            shared = np.minimum(self.depths[lo:hi], self.depths[node])
            apart = np.bitwise_count(_upper(self.paths[lo:hi] ^ self.paths[node], shared))
            self.known[node] = lo + np.flatnonzero(apart <= self.max_bits)
        return self.known[node]


Trie = tuple[int, int, np.ndarray, np.ndarray]   # first bit and length of the block, paths and depths of the nodes


def tries(fps: DataFrame, max_bits: int, node_size: int) -> list[Trie]:
    """The upper trie of every turn."""
    out = []
    for first, exact in turns(max_bits):
        turned = fps if not first else fps.select(
            F.expr(f"shiftleft(fp, {first}) | shiftrightunsigned(fp, {_ALL - first})").alias("fp"))
        out.append((first, exact, *trie_nodes(turned, node_size)))
    return out


def node_pairs(fps: DataFrame, upper: list[Trie], max_bits: int) -> DataFrame:
    """Each fingerprint, turned, once for every pair of nodes that its node is part of: (turn, a, b, fp), a <= b."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = [NodePairs(paths, depths, max_bits, exact) for _, exact, paths, depths in upper]
        for batch in batches:
            plain = batch.column("fp").to_numpy().view(np.uint64)
            for turn, (first, *_) in enumerate(upper):
                fp = turn_left(plain, first)
                home = np.searchsorted(pairs[turn].paths, fp, side="right") - 1
                met = [pairs[turn].of(int(h)) for h in home]
                for k in range(0, len(fp), 1 << 13):
                    sizes = [len(m) for m in met[k:k + (1 << 13)]]
                    other = np.concatenate(met[k:k + (1 << 13)])
                    own = np.repeat(home[k:k + (1 << 13)], sizes)
                    yield pa.record_batch([
                        pa.array(np.full(len(own), turn)), pa.array(np.minimum(other, own)), pa.array(np.maximum(other, own)),
                        pa.array(np.repeat(fp[k:k + (1 << 13)], sizes).view(np.int64))], names=["turn", "a", "b", "fp"])

    return fps.select("fp").mapInArrow(deal, "turn bigint, a bigint, b bigint, fp bigint")


# ---- the lower trie: a sorted array, in which a node is a range

class Forest:
    """Components of the places of one sorted array."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            open_ = a != b
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


_SMALL = 32     # pairs of fingerprints below which a pair of nodes is compared outright
_WIDE = 1 << 18  # pairs of nodes that are walked at a time


def _compare(x: np.ndarray, forest: Forest, max_bits: int, lo1, n1, lo2, n2) -> None:
    """All pairs of the given small ranges; where both ranges are the same one, each pair once."""
    sizes = n1 * n2
    which = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    i, j = lo1[which] + place // n2[which], lo2[which] + place % n2[which]
    near = np.bitwise_count(x[i] ^ x[j]) <= max_bits
    near &= i < j
    forest.link(i[near], j[near])


def walk(x: np.ndarray, first: tuple[int, int, int, int], max_bits: int, forest: Forest, exact: int = 0) -> None:
    """Walk the tries below two ranges of the sorted fingerprints ``x`` together and link what is near.

    ``first`` is (start, end) of the two ranges, which are the same or disjoint. No bit may differ among the first
    ``exact`` ones.
    """
    start = [np.array([v], np.int64) for v in first]
    todo = [(0, *start, np.zeros(1, np.int64))]
    while todo:
        depth, lo1, hi1, lo2, hi2, diff = todo.pop()
        if len(lo1) > _WIDE:
            for k in range(0, len(lo1), _WIDE):
                todo.append((depth, *(v[k:k + _WIDE] for v in (lo1, hi1, lo2, hi2, diff))))
            continue
        n1, n2 = hi1 - lo1, hi2 - lo2
        small = (n1 * n2 <= _SMALL) | (depth == _ALL)
        if small.any():
            _compare(x, forest, max_bits, lo1[small], n1[small], lo2[small], n2[small])
            lo1, hi1, lo2, hi2, diff = (v[~small] for v in (lo1, hi1, lo2, hi2, diff))
        if not len(lo1):
            continue
        bit = np.uint64(1) << np.uint64(_ALL - 1 - depth)
        above = ~(bit | (bit - np.uint64(1)))

        def middle(lo, hi):
            """Where the range's child with the next bit set begins."""
            return np.clip(np.searchsorted(x, (x[lo] & above) | bit), lo, hi)

        m1, same = middle(lo1, hi1), (lo1 == lo2) & (hi1 == hi2)
        m2 = np.where(same, m1, middle(lo2, hi2))
        children = [(lo1, m1, lo2, m2, diff), (m1, hi1, m2, hi2, diff), (lo1, m1, m2, hi2, diff + 1)]
        cross = ~same  # the fourth pair of a node with itself mirrors the third
        children.append(tuple(v[cross] for v in (m1, hi1, lo2, m2, diff + 1)))
        lo1, hi1, lo2, hi2, diff = (np.concatenate(c) for c in zip(*children, strict=True))
        alive = (hi1 > lo1) & (hi2 > lo2) & (diff <= (max_bits if depth >= exact else 0))
        todo.append((depth + 1, *(v[alive] for v in (lo1, hi1, lo2, hi2, diff))))


def _forest_of(x: np.ndarray, split: int | None, max_bits: int, exact: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(u, v) of a spanning forest: within ``x``, or between the parts of ``x`` before and after ``split``."""
    forest = Forest(len(x))
    walk(x, (0, len(x), 0, len(x)) if split is None else (0, split, split, len(x)), max_bits, forest, exact)
    tied = np.flatnonzero(forest.root != np.arange(len(x)))
    return x[tied], x[forest.root[tied]]


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, node_size: int = NODE_SIZE) -> DataFrame:
    """Links (u, v) between different fingerprints that join all pairs within ``max_bits`` into their components.

    ``fps`` is a written table of different fingerprints, column ``fp``.
    """
    upper = tries(fps, max_bits, node_size)

    def join(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        x = np.sort(group["fp"].to_numpy().view(np.uint64))
        turn, a, b = key
        first, exact, paths, _ = upper[turn]
        split = None if a == b else int(np.searchsorted(x, paths[b]))
        links = [turn_left(f, _ALL - first).view(np.int64) for f in _forest_of(x, split, max_bits, exact)]
        return pd.DataFrame({"u": links[0], "v": links[1]})

    return node_pairs(fps, upper, max_bits).groupBy("turn", "a", "b").applyInPandas(join, "u bigint, v bigint")


# ---- documents

def _answers(facts: DataFrame, max_bits: int, node_size: int) -> DataFrame:
    """(fp, n, label, component_id) of every different fingerprint."""
    fps = saved(facts.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "fingerprints")
    labels = components(near_links(fps, max_bits, node_size))
    labelled = saved(fps.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "label", F.coalesce("label", "fp")), "labelled")
    # A component may hold most fingerprints, so its label is looked up by the number of them.
    ids = saved(labelled.groupBy("label").agg(F.min("least").alias("component_id"), F.count("*").alias("members")), "components")
    return saved(lookup(labelled, ids, "label", "members", labelled.count()).select("fp", "n", "label", "component_id"), "answers")


def near_dedup(docs: DataFrame, ident: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
               max_bits: int = MAX_BITS, node_size: int = NODE_SIZE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (the smallest id it can reach)."""
    facts = saved(fingerprints(docs, ident, text, shingle), "facts")
    answers = _answers(facts, max_bits, node_size)
    return lookup(facts, answers, "fp", "n", facts.count()).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, ident: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                     max_bits: int = MAX_BITS, node_size: int = NODE_SIZE) -> DataFrame:
    """The documents with one of each component left, in the columns of ``docs``.

    What stays is named by id and text hash, 16 bytes a document, so texts are shuffled once, to meet that list.
    Of rows that are equal in id and text, the one whose other columns have the smallest hash stays.
    """
    facts = saved(fingerprints(docs, ident, text, shingle), "facts")
    answers = _answers(facts, max_bits, node_size)
    first = lookup(facts, answers, "fp", "n", facts.count()).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = first.groupBy("label").agg(F.min(F.struct("doc_id", "text_hash")).alias("k")).select(
        F.col("k.doc_id").alias("id"), F.col("k.text_hash").alias("text_hash"))
    rows = docs.select(F.col(ident).alias("id"), F.xxhash64(text_of(text)).alias("text_hash"),
                       F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    k = keep.select(F.struct("id", "text_hash").alias("key"))
    kept = rows.withColumn("key", F.struct("id", "text_hash")).join(k, "key", "left_semi")
    others = F.to_json(F.struct("key.id", *[F.col("row")[c].alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text]))
    return kept.groupBy("key").agg(F.min_by("row", F.xxhash64(others)).alias("row")).select("row.*")


def same_bits(spark: SparkSession, fps: list[int]) -> DataFrame:
    """A table of fingerprints for ``near_links``, from unsigned numbers."""
    return spark.createDataFrame([(_signed(f),) for f in fps], "fp bigint").distinct()
