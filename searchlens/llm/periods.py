"""Runs of words that repeat with a period, by longest common extensions over a difference cover.

A run is a stretch of consecutive words with smallest period q, at least max(24, 3 q) words long, that cannot be made
longer on either side with that period. To find them all, every period p is tried on a grid of positions. A run with
period p holds at least step = max(24, 3 p) - p consecutive positions i such that words i and i + p both lie in it, so a
grid of that step meets every run; the grids of all periods together have about n ln(n) / 2 points. At each point whose
two words are equal, the longest common extensions of i and i + p to the right and to the left give the stretch with
period p around them.

An extension is found with a difference cover: of every V positions a few are sampled, such that any two positions
reach sampled ones together within V steps. So fewer than V words are compared first; where all are equal, the rest lies
between two sampled suffixes. Only those are sorted, by prefix doubling over the sample. What neighbours in this order
share is read off the ranks of the doubling, and a sparse table gives the minimum over any range of them. The left
extension is the same over the words in reverse. A first pass over the grids compares these few words alone; documents
in which no point can then belong to a run have none, and the sorted sample is made of the others.

Documents are worked on together, a few megabytes of text at a time; a longer one is worked on alone, its grids in slices.

Defined results: a null or empty text has no words, no runs, and collapses to the empty text; words that no run contains
all stay; a stretch counts once, with its smallest period; of runs with the same exponent the one that starts first, then
the one with the smaller period, is reported; repeated rows are reported each; a null id has no digits, so ``repeated``
leaves its text alone; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces_of, strings, text_of

LEAST, TIMES = 24, 3         # a run has at least LEAST words and TIMES periods
COVER, V = (0, 1, 3, 9), 13  # a perfect difference set: every difference modulo V is that of two of its members
SLICE = 1 << 20              # grid points that are held at a time
RUNS_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"

# For positions i and i + d: the steps after which both are sampled, by d and i modulo V.
_REACH = np.array([[next(s for s in range(V) if (a + s) % V in COVER and (a + s + d) % V in COVER) for a in range(V)]
                   for d in range(V)], np.int64)


class Extensions:
    """Longest common extensions to the right over an array of codes.

    Negative codes all differ from one another and end every comparison. The array ends with V + 1 of them at least.
    """

    def __init__(self, words: np.ndarray):
        self.words = words
        self.table: list[np.ndarray] | None = None

    def near(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(equal words from i and j on before both are sampled, whether the rest is left to the sorted sample)."""
        reach = _REACH[(j - i) % V, i % V]
        out = self._compare(i, j, reach)
        open_ = out == reach
        return out, open_ & (self.words[i + out] == self.words[j + out])

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For each pair of different positions, how many words from there on are equal."""
        out, open_ = self.near(i, j)
        far = np.flatnonzero(open_)
        if len(far):
            if self.table is None:
                self._sort()
            a, b = self.rank[self.place[i[far] + out[far]]], self.rank[self.place[j[far] + out[far]]]
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp((high - low).astype(np.float64))[1] - 1   # floor of the binary logarithm
            for k in np.unique(level):
                at = np.flatnonzero(level == k)
                row = self.table[k]
                out[far[at]] += np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        return out

    def _compare(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Equal words from i and j on, ``most`` at most, word by word."""
        words, out = self.words, np.zeros(len(i), np.int64)
        active = np.arange(len(i))
        for step in range(int(most.max(initial=0))):
            active = active[most[active] > step]
            active = active[words[i[active] + step] == words[j[active] + step]]
            out[active] += 1
        return out

    def _sort(self) -> None:
        """The order of the sampled suffixes, and the sparse table over what its neighbours share."""
        words, n = self.words, len(self.words) - V
        at = np.sort(np.concatenate([np.arange(r, n, V) for r in COVER]))
        m = len(at)
        self.place = np.zeros(n, np.int64)   # of a sampled position in the sample
        self.place[at] = np.arange(m)
        # The first V words of each suffix as a rank; three words to a key where 21 bits hold a code.
        low, wide = int(words.min()), int(words.max()) - int(words.min()) < 1 << 21
        keys = []
        for k in range(0, V, 3 if wide else 1):
            key = words[at + k] - low
            for j in range(k + 1, min(k + 3, V) if wide else k):
                key = (key << 21) | (words[at + j] - low)
            keys.append(key)
        order = np.lexsort(keys[::-1])
        fresh = np.zeros(m, bool)
        for key in keys:
            fresh[1:] |= key[order][1:] != key[order][:-1]
        rank = np.empty(m, np.int64)
        rank[order] = np.cumsum(fresh)
        # Doubling: the suffix ``size`` words on is sampled too. Equal words hold no negative code, so that one is there.
        ranks, size = [rank], V
        while rank.max() < m - 1:
            there = at + size < n
            key = rank * (m + 1)
            key[there] += rank[self.place[at[there] + size]] + 1
            order = np.argsort(key, kind="stable")
            rank = np.empty(m, np.int64)
            rank[order] = np.cumsum(np.concatenate([[False], key[order][1:] != key[order][:-1]]))
            ranks.append(rank)
            size *= 2
        self.rank = rank
        left, right = at[order[:-1]], at[order[1:]]
        shared = np.zeros(m - 1, np.int64)
        for level in reversed(ranks[:-1]):
            size //= 2
            same = level[self.place[left]] == level[self.place[right]]
            shared += size * same
            left, right = left + size * same, right + size * same
        shared += self._compare(left, right, np.full(m - 1, V))
        self.table, width = [shared], 1
        while 2 * width <= m - 1:
            last = self.table[-1]
            self.table.append(np.minimum(last[:-width], last[width:]))
            width *= 2


class _Joined:
    """Documents in falling order of length, in one array, with a negative code after each and V + 1 around all."""

    def __init__(self, documents: list[np.ndarray], chosen: list[int]):
        self.order = sorted(chosen, key=lambda k: -len(documents[k]))
        self.sizes = np.array([len(documents[k]) for k in self.order], np.int64)
        self.starts = V + 1 + np.concatenate([[0], np.cumsum(self.sizes + 1)])
        self.words = -1 - np.arange(self.starts[-1] + V + 1, dtype=np.int64)
        for at, k in zip(self.starts, self.order, strict=False):
            self.words[at:at + len(documents[k])] = documents[k]
        # Small negative codes, so that keys of several words stay small.
        marks = np.flatnonzero(self.words < 0)
        self.words[marks] = -1 - np.arange(len(marks))

    def document(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, side="right") - 1

    def points(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(i, p) of the grid points of all periods whose words i and i + p are equal, about SLICE at a time."""
        words, parts, held = self.words, [], 0
        for period in range(1, int(self.sizes[0]) // TIMES + 1):
            need = max(LEAST, TIMES * period)
            # The documents that are long enough come first.
            end = int(self.starts[np.searchsorted(-self.sizes, -need, side="right")]) - period
            step = need - period
            for begin in range(int(self.starts[0]), end, step * SLICE):
                stop = min(end, begin + step * SLICE)
                hit = np.flatnonzero(words[begin:stop:step] == words[begin + period:stop + period:step])
                if not len(hit):
                    continue
                hit = begin + step * hit
                hit = hit[self.document(hit) == self.document(hit + period)]
                parts.append((hit, np.full(len(hit), period, np.int64)))
                held += len(hit)
                if held >= SLICE:
                    yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))
                    parts, held = [], 0
        if parts:
            yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _may_hold_runs(joined: _Joined) -> list[int]:
    """The documents with a grid point around which the few compared words leave room for a run."""
    right, left, last = Extensions(joined.words), Extensions(joined.words[::-1].copy()), len(joined.words)
    out: set[int] = set()
    for i, p in joined.points():
        after, open_after = right.near(i, i + p)
        before, open_before = left.near(last - i, last - i - p)
        room = open_after | open_before | (p + after + before >= np.maximum(LEAST, TIMES * p))
        out.update(np.unique(joined.document(i[room])).tolist())
    return [joined.order[k] for k in sorted(out)]


def find_runs(documents: list[np.ndarray]) -> list[np.ndarray]:
    """For each document, an array of word codes >= 0, its runs as rows (start, length, period) by start, then period."""
    found = [np.empty((0, 3), np.int64)] * len(documents)
    chosen = [k for k, d in enumerate(documents) if len(d) >= LEAST]
    chosen = chosen and _may_hold_runs(_Joined(documents, chosen))
    if not chosen:
        return found
    joined = _Joined(documents, chosen)
    right, left, last = Extensions(joined.words), Extensions(joined.words[::-1].copy()), len(joined.words)
    runs = np.empty((0, 3), np.int64)
    for i, p in joined.points():
        start = i - left.of(last - i, last - i - p)
        end = i + p + right.of(i, i + p)
        long = end - start >= np.maximum(LEAST, TIMES * p)
        runs = np.concatenate([runs, np.stack([start, end - start, p], 1)[long]])
        # The same stretch comes from several points, and with multiples of its smallest period.
        runs = runs[np.lexsort(runs.T[::-1])]
        fresh = np.ones(len(runs), bool)
        fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
        runs = runs[fresh]
    # By start, then period, as the words of a run with a smaller period need not come first by length.
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    owner = joined.document(runs[:, 0])
    edges = np.searchsorted(owner, np.arange(len(joined.order) + 1))
    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        found[joined.order[k]] = runs[a:b] - [joined.starts[k], 0, 0]
    return found


def kept_words(count: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``count`` words stay when every run is cut to its first period."""
    edge = np.zeros(count + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) == 0


def collapse_runs(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, runs (start, length, period in words), text with each run cut to its first period.

    Words are what stands between ASCII white space; the words that stay are joined by one space.
    """
    rows = docs.select(F.col(ident).alias("doc_id"), text_of(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text", 4 << 20):
            code: dict[bytes, int] = {}
            split = [t.encode().split() for t in strings(batch.column("text"))]
            coded = [np.fromiter((code.setdefault(w, len(code)) for w in words), np.int64, len(words)) for words in split]
            found = find_runs(coded)
            texts = []
            for words, runs in zip(split, found, strict=True):
                if len(runs):
                    words = [words[k] for k in np.flatnonzero(kept_words(len(words), runs))]
                texts.append(b" ".join(words))
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in found])])
            every = np.concatenate(found)
            structs = pa.StructArray.from_arrays([pa.array(every[:, k]) for k in range(3)], ["start", "length", "period"])
            yield pa.record_batch(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs),
                 pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "text"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, runs {RUNS_TYPE}, text string")


def best_run(runs: Column) -> Column:
    """The run with the greatest length / period, compared as whole numbers; of equals the first one. Null if there is none."""
    return F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, F.lit(0)),
                       lambda top, x: F.when(x["length"] * top["period"] > top["length"] * x["period"], x).otherwise(top))


def run_report(collapsed: DataFrame) -> DataFrame:
    """The runs of ``collapse_runs`` in figures and digests: one row per document."""
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    return collapsed.withColumn("best", best_run(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))


def repeated(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and text, in which about a tenth of the documents repeat themselves from some word on.

    With h the crc32 of the id's digits and g = h div 10: where 10 divides h, the words from a = g mod n on are replaced
    by repetitions of the first 1 + (n - a) div (3 + g mod 8) of them.
    """
    rows = docs.select(F.col(ident).alias("doc_id"), text_of(text).alias("text"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    marked = rows.withColumn("h", h).withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn(
        "n", F.size("words")).withColumn("g", F.expr("h div 10")).withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    period = F.expr("1 + (n - a) div (3 + g % 8)")
    again = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n").cast("bigint") - 1), lambda i: F.get(
        F.col("words"), F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return marked.withColumn("p", period).select(
        "doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))
