"""Hard negatives by rotated one-bit codes, deterministic intervals and integer scores.

A row's vector is turned by a fixed random rotation (signs and Walsh-Hadamard transforms) and written as a sum of
``STAGES`` one-bit codes: the signs of what is left, times the code vector's alignment with it, that is the mean of its
magnitudes. What is left at last is orthogonal to the last code; its length is stored. An anchor's rotated vector is
rounded to ``BITS`` bits a component, as bit planes. Its product with a code is then a weighted sum of popcounts, and the
products with all codes times their alignments give an estimate of the score. By Cauchy-Schwarz the score differs from it
by at most |left| * |part of the rounded anchor orthogonal to the last code| + |rounding| * |row|. This interval is certain,
so a row is passed over only if its interval ends below what is already known to be reached, or lies outside the wanted
range of scores; all others get their integer score. The result is exact: its recall is 1.

Rows and anchors are dealt into blocks by hash, and every task meets one block of each, so no label, vector or anchor
gathers rows in one task. A first pass finds each anchor's best rows of its label, a second one, with those known, the best
rows of other labels in the wanted range; each task returns its own best ones, which a ranking then merges. Anchors grow
with the rows, so the pairs grow with their product; the blocks' sizes bound what one task holds.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part; a row with a null
id does, after all others of its score; a shorter vector counts as filled up with zeros; repeated rows are rows of their
own, as anchors, positives and negatives alike; rows with the same id and score are in any order, which their numbers
do not show; an empty table gives no rows; other columns are ignored, whatever their names. An integer score that 64
bits may not hold is an error.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

STAGES = 4        # one-bit codes of a row
BITS = 8          # bits of a component of an anchor
BLOCK = 8192      # rows, and anchors, of a block
ROWS, ANCHORS = 4096, 32   # that are estimated at a time
PAIRS = 1 << 15   # scored at a time
SLACK = 1e-9      # for rounding of the bounds themselves, relative to the lengths


@cache
def _signs(size: int) -> np.ndarray:
    return np.random.default_rng(11).choice(np.array([-1.0, 1.0]), (3, size))


def rotate(vectors: np.ndarray) -> np.ndarray:
    """The rows turned by the fixed rotation, filled up with zeros to a power of two, 64 at least."""
    n, dim = vectors.shape
    size = max(64, 1 << (dim - 1).bit_length() if dim else 0)
    out = np.zeros((n, size))
    out[:, :dim] = vectors
    for signs in _signs(size):
        out *= signs
        half = 1
        while half < size:
            pair = out.reshape(n, size // (2 * half), 2, half)
            out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(n, size)
            half *= 2
        out /= np.sqrt(size)
    return out


def _pack(bits: np.ndarray) -> np.ndarray:
    """The last axis of 0 and 1, 64 to a word."""
    return np.packbits(bits, axis=-1, bitorder="little").view("<u8")


def entry_type(dim: int) -> np.dtype:
    """What the index stores of a row: its integers, codes, alignments, and the lengths of what is left and of all."""
    words = max(64, 1 << (dim - 1).bit_length() if dim else 0) // 64
    return np.dtype([("vector", "<i8", (dim,)), ("code", "<u8", (STAGES, words)), ("align", "<f8", (STAGES,)),
                     ("left", "<f8"), ("length", "<f8")])


def index_entries(vectors: np.ndarray) -> np.ndarray:
    """Index entries of integer vectors."""
    out = np.zeros(len(vectors), entry_type(vectors.shape[1]))
    left = rotate(vectors.astype(np.float64))
    out["vector"], out["length"] = vectors, np.sqrt((left * left).sum(1))
    for k in range(STAGES):
        signs = np.where(left >= 0, 1.0, -1.0)
        align = np.abs(left).mean(1)
        out["code"][:, k], out["align"][:, k] = _pack(left >= 0), align
        left = left - align[:, None] * signs
    out["left"] = np.sqrt((left * left).sum(1))
    return out


class Queries:
    """Anchors as bit planes."""

    def __init__(self, vectors: np.ndarray):
        turned = rotate(vectors.astype(np.float64))
        self.size = turned.shape[1]
        self.low = turned.min(1, initial=0)
        self.step = np.maximum((turned.max(1, initial=0) - self.low) / ((1 << BITS) - 1), 1e-300)
        levels = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        rounded = self.low[:, None] + self.step[:, None] * levels
        self.rounding = np.sqrt(((turned - rounded) ** 2).sum(1))
        self.square = (rounded * rounded).sum(1)
        self.sum = levels.sum(1)
        self.planes = np.stack([_pack((levels >> b & 1).astype(bool)) for b in range(BITS)], 1)

    def interval(self, of: slice, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bounds of the products of the anchors ``of`` with all entries."""
        planes, step, low = self.planes[of], self.step[of, None], self.low[of, None]
        estimate = product = None
        for k in range(STAGES):
            code = entries["code"][:, k]
            ones = np.bitwise_count(code).sum(1, dtype=np.int64)
            weighted = np.zeros((len(planes), len(entries)), np.int32)
            for b in range(BITS):
                for w in range(code.shape[1]):
                    weighted += np.bitwise_count(planes[:, b, w, None] & code[None, :, w]).astype(np.int32) << b
            # The product with a vector of signs is twice the sum over its ones, less the whole sum.
            product = low * (2 * ones - self.size) + step * (2 * weighted - self.sum[of, None])
            part = product * entries["align"][:, k]
            estimate = part if estimate is None else estimate + part
        beside = np.sqrt(np.maximum(self.square[of, None] - product * product / self.size, 0))
        error = beside * entries["left"] + self.rounding[of, None] * entries["length"]
        error += SLACK * (np.sqrt(self.square[of, None]) + self.rounding[of, None]) * entries["length"]
        return estimate - error, estimate + error


def _scores(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i), np.int64)
    for k in range(0, len(i), PAIRS):
        out[k:k + PAIRS] = np.einsum("ij,ij->i", a[i[k:k + PAIRS]], b[j[k:k + PAIRS]])
    return out


class _Best:
    """The best ``most`` rows of each of many groups, as (group, score, id, id is null); rows may repeat."""

    def __init__(self, groups: int, most: int):
        self.most = most
        self.rows = [np.empty(0, np.int64) for _ in range(4)]
        self.reached = np.full(groups, -np.inf)   # the score of the last one, once there are ``most``

    def add(self, *rows: np.ndarray) -> None:
        rows = [np.concatenate(x) for x in zip(self.rows, rows, strict=True)]
        group, score, ident, none = rows
        order = np.lexsort((ident, none, -score, group))
        group, score, ident, none = rows = [x[order] for x in rows]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        last = place == self.most - 1
        self.reached[group[last]] = score[last]
        self.rows = [x[place < self.most] for x in rows]

    def table(self, names: list[str], **more: pa.Array) -> pa.Table:
        """The rows, the group as an index into the columns ``more``."""
        group, score, ident, none = self.rows
        columns = {k: v.take(pa.array(group)) for k, v in more.items()}
        return pa.table({**columns, names[0]: pa.array(ident, mask=none.astype(bool)), names[1]: pa.array(score)})


class _Block:
    """The columns of a task's rows or anchors, as arrays."""

    def __init__(self, table: pa.Table, kind: np.dtype):
        self.ident = table["id"].combine_chunks()
        self.none = self.ident.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
        self.ids = self.ident.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.copies = table["copies"].to_numpy().astype(np.int64)
        self.anchor = table["anchor"].combine_chunks()
        self.label = table["label"].combine_chunks()
        self.entries = np.frombuffer(b"".join(table["entry"].to_pylist()), kind)


def _numbered(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two string columns as numbers that are equal where the strings are; null is -1 in the first and -2 in the second."""
    every = pa.concat_arrays([x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for x in (a, b)])
    codes = every.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    left, right = codes[:len(a)], codes[len(a):]
    return left, np.where(right < 0, -2, right)


def _tiles(anchors: int, rows: int):
    for r in range(0, rows, ROWS):
        for a in range(0, anchors, ANCHORS):
            yield slice(a, min(a + ANCHORS, anchors)), slice(r, min(r + ROWS, rows))


def best_of_label(anchors: pa.Table, rows: pa.Table, kind: np.dtype, most: int) -> pa.Table:
    """The anchors' ``most`` best other rows of their label among ``rows``: anchor, id, score."""
    a, r = _Block(anchors, kind), _Block(rows, kind)
    of_a, of_r = _numbered(a.label, r.label)
    self_a, self_r = _numbered(a.anchor, r.anchor)
    queries, best = Queries(a.entries["vector"]), _Best(len(a.ids), most)
    for these, those in _tiles(len(a.ids), len(r.ids)):
        lower, upper = queries.interval(these, r.entries[those])
        mine = of_a[these, None] == of_r[None, those]
        own = self_a[these, None] == self_r[None, those]
        lower[~mine | own] = -np.inf
        reached = best.reached[these].copy()
        if lower.shape[1] >= most:   # at least ``most`` rows reach the lower bound that comes at this place
            reached = np.maximum(reached, np.partition(lower, -most, axis=1)[:, -most])
        i, j = np.nonzero(mine & (upper >= reached[:, None]))
        score = _scores(a.entries["vector"][these], r.entries["vector"][those], i, j)
        times = np.minimum(r.copies[those][j] - own[i, j], most)
        i, j, score = (np.repeat(x, times) for x in (i, j, score))
        best.add(i + these.start, score, r.ids[those][j], r.none[those][j])
    return best.table(["id", "score"], anchor=a.anchor)


def best_in_range(anchors: pa.Table, rows: pa.Table, kind: np.dtype, most: int, low: tuple[int, int],
                  high: tuple[int, int]) -> pa.Table:
    """For each score in the anchors' lists ``known``, the ``most`` best rows of other labels in its range.

    Returned: anchor, place (in the list), id, score.
    """
    a, r = _Block(anchors, kind), _Block(rows, kind)
    of_a, of_r = _numbered(a.label, r.label)
    lists = anchors["known"].to_pylist()
    width = max(map(len, lists), default=0)
    known = np.zeros((len(lists), width), np.int64)
    there = np.zeros((len(lists), width), bool)
    for k, scores in enumerate(lists):
        known[k, :len(scores)], there[k, :len(scores)] = scores, True
    # The range low * score <= x <= high * score is empty under zero, where low < high turns round.
    floor, ceiling = known * low[0] / low[1], known * high[0] / high[1]
    there &= floor <= ceiling
    queries, best = Queries(a.entries["vector"]), _Best(known.size, most)
    for these, those in _tiles(len(a.ids), len(r.ids)):
        lower, upper = queries.interval(these, r.entries[those])
        reached = best.reached.reshape(known.shape)[these]
        least = np.where(there[these], np.maximum(floor[these], reached), np.inf).min(1, initial=np.inf)
        greatest = np.where(there[these], ceiling[these], -np.inf).max(1, initial=-np.inf)
        # The bounds are of floating point, the scores whole: half a point and rounding are let through.
        slack = 0.5 + SLACK * np.abs(known[these]).max(1, initial=0)
        i, j = np.nonzero((of_a[these, None] != of_r[None, those]) & (upper >= (least - slack)[:, None])
                          & (lower <= (greatest + slack)[:, None]))
        score = _scores(a.entries["vector"][these], r.entries["vector"][those], i, j)
        i += these.start
        inside = there[i] & (low[1] * score[:, None] >= low[0] * known[i]) & (high[1] * score[:, None] <= high[0] * known[i])
        pair, place = np.nonzero(inside)
        times = np.minimum(r.copies[those][j[pair]], most)
        pair, place = np.repeat(pair, times), np.repeat(place, times)
        best.add(i[pair] * width + place, score[pair], r.ids[those][j[pair]], r.none[those][j[pair]])
    flat = np.repeat(np.arange(len(lists)), width)
    return best.table(["id", "score"], anchor=a.anchor.take(pa.array(flat)),
                      place=pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(lists)), pa.int32()))


def _index(vectors: DataFrame, ident: str, vector: str, label: str, anchor: Column, scale: int) -> tuple[DataFrame, int]:
    """The written index: anchor (a name where the row is one), id, label, copies, entry; and the vectors' length."""
    value = F.col(vector)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.where(F.col(label).isNotNull() & value.isNotNull() & finite).select(
        F.col(ident).cast("bigint").alias("id"), F.col(label).cast("string").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
        F.transform(value, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("vector"))
    # Repeated rows become one with a count.
    rows = saved(rows.groupBy("id", "label", "is_anchor", "vector").agg(F.count("*").alias("copies")), "integers")
    dim, largest = rows.agg(F.max(F.size("vector")), F.max(F.array_max(F.transform("vector", lambda x: F.abs(x).cast("double"))))).first()
    dim = dim or 0
    # Scores are multiplied by up to 100 when they are compared with a range.
    if dim * (largest or 0) ** 2 >= 2.0 ** 63 / 100:
        raise ValueError("the vectors are too long for integer scores of 64 bits")
    named = rows.withColumn("anchor", F.when(F.col("is_anchor"), F.sha2(F.concat_ws(
        "|", F.coalesce(F.col("id").cast("string"), F.lit("")), F.array_join("vector", ","), "label"), 256)))

    def build(batches):
        for batch in batches:
            lists = batch.column("vector")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            vectors = np.zeros((len(sizes), dim), np.int64)
            vectors[np.arange(dim) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            entries = index_entries(vectors)
            yield pa.record_batch([batch.column(k) for k in ("anchor", "id", "label", "copies")]
                                  + [pa.array([e.tobytes() for e in entries], pa.binary())],
                                  names=["anchor", "id", "label", "copies", "entry"])

    schema = "anchor string, id bigint, label string, copies bigint, entry binary"
    return saved(named.select("anchor", "id", "label", "copies", "vector").mapInArrow(build, schema), "index"), dim


def _met(anchors: DataFrame, rows: DataFrame, counts: tuple[int, int], work, schema: str) -> DataFrame:
    """``work`` on every pair of a block of anchors and a block of rows."""
    blocks = [max(1, -(-n // BLOCK)) for n in counts]
    dealt = [F.pmod(F.xxhash64("id", "label", "entry"), F.lit(n)).cast("int") for n in blocks]
    every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in blocks]
    left = anchors.withColumn("ablock", dealt[0]).withColumn("rblock", every[1])
    # Columns of their own, as the anchors come from the same table.
    right = rows.select([F.col(c).alias(c) for c in rows.columns]).withColumn("rblock", dealt[1]).withColumn("ablock", every[0])
    return left.groupBy("ablock", "rblock").cogroup(right.groupBy("ablock", "rblock")).applyInArrow(work, schema)


def hard_negatives(vectors: DataFrame, anchor: Column, ident: str = "vec_id", vector: str = "embedding", label: str = "label",
                   positives: int = 5, negatives: int = 3, low: tuple[int, int] = (1, 2), high: tuple[int, int] = (19, 20),
                   scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Vectors are taken as whole numbers, ``scale`` times the component rounded down. The rows where ``anchor`` holds are
    anchors; each one's ``positives`` best other rows of its label get the ``negatives`` best rows of other labels with
    low * positive score <= score <= high * positive score, ``low`` and ``high`` as fractions with whole numbers.
    Rows come by falling score, then rising id.
    """
    index, dim = _index(vectors, ident, vector, label, anchor, scale)
    kind, empty = entry_type(dim), pa.schema([("anchor", pa.string()), ("place", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])
    anchors = index.where("anchor IS NOT NULL")
    counts = anchors.count(), index.count()

    def first(a: pa.Table, r: pa.Table) -> pa.Table:
        names = ["anchor", "id", "score"]
        if not (a.num_rows and r.num_rows):
            return pa.schema([empty.field(n) for n in names]).empty_table()
        return best_of_label(a, r, kind, positives).select(names)

    def second(a: pa.Table, r: pa.Table) -> pa.Table:
        if not (a.num_rows and r.num_rows):
            return empty.empty_table()
        return best_in_range(a, r, kind, negatives, low, high).select(empty.names)

    best = [F.desc("score"), F.col("id").asc_nulls_last()]
    near = _met(anchors, index, counts, first, "anchor string, id bigint, score bigint").withColumn(
        "place", F.row_number().over(Window.partitionBy("anchor").orderBy(*best))).where(F.col("place") <= positives)
    known = saved(near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("near")), "positives")
    asked = anchors.join(known.select("anchor", F.col("near.score").alias("known")), "anchor")
    far = _met(asked.select(*index.columns, "known"), index, counts, second,
               "anchor string, place int, id bigint, score bigint").withColumn(
        "rank", F.row_number().over(Window.partitionBy("anchor", "place").orderBy(*best))).where(F.col("rank") <= negatives)
    who = anchors.select("anchor", F.col("id").alias("anchor_id"), "copies").join(known, "anchor").select(
        "anchor", "anchor_id", "copies", F.explode("near").alias("n")).select(
        "anchor", "anchor_id", "copies", F.col("n.place").alias("place"), F.col("n.id").alias("positive_id"), F.col("n.score").alias("positive_score"))
    # An anchor that is there several times returns its rows as many times.
    return far.join(who, ["anchor", "place"]).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
