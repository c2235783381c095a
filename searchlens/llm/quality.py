"""Quality scores by nearest-neighbour voting in a latent-semantic space.

A text's terms are its byte trigrams by kind of character (letters, digits, each punctuation mark, ...), its byte
trigrams as they are, hashed, and how far its words repeat. A truncated singular value decomposition of the tf-idf
matrix of labelled texts gives the latent space. The labelled vectors are broadcast; every document is compared with
all of them by blocked matrix products, and its nearest neighbours vote with their cosine as weight.

The model is fitted on at most ``max_labelled`` labelled rows, chosen by a hash of their id; that number bounds what
the driver gathers and what is broadcast. Nothing but the text enters a score.

Defined results: a null or empty text is a text without terms, whose neighbours are the labelled texts nearest to
none, that is all with weight zero, so it gets the share of good labels; labels that are null, or whose document is missing, are not
learnt from; without any labels every score is 1; of labelled texts that are equally near, to six places, those with
the smallest ids vote; repeated rows get equal scores; other columns are ignored or, in
``keep_good``, kept whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces_of, strings, text_of
from .simhash import word_blocks

MAX_LABELLED = 4096
RANK = 48
NEIGHBOURS = 7
THRESHOLD = 0.3
FOLDS = 5           # a row is held out if crc32(id as text) modulo this is 0
_BLOCK = 1 << 20    # bytes of text, and rows of a matrix product's result, at a time

# Kinds of bytes: small letter, capital, digit, space, line feed, other control, first and later bytes of a
# character beyond ASCII, and each punctuation mark for itself.
_KIND = np.zeros(256, np.int32)
_KIND[65:91], _KIND[48:58], _KIND[32], _KIND[10] = 1, 2, 3, 4
_KIND[[*range(10), *range(11, 32), 127]] = 5
_KIND[0xC0:], _KIND[0x80:0xC0] = 6, 7
_marks = [b for b in range(33, 127) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)]
_KIND[_marks] = np.arange(8, 8 + len(_marks))
KINDS = 8 + len(_marks)
BUCKETS = 1 << 11    # of each kind of trigram
_KIND_TERMS = KINDS ** 3
_FOLD = ((np.arange(_KIND_TERMS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(65 - BUCKETS.bit_length())).astype(np.int64)
TERMS = 2 * BUCKETS + 4


def term_counts(text: str) -> np.ndarray:
    """The term vector of a text: square roots of shares, in three blocks of norm 1 each (0 for an empty text)."""
    data = text.encode()
    kinds, raw = np.zeros(_KIND_TERMS, np.int64), np.zeros(BUCKETS, np.int64)
    for k in range(0, len(data), _BLOCK):
        b = np.frombuffer(data, np.uint8, min(_BLOCK + 2, len(data) - k), k)
        if len(b) < 3:
            break
        c = _KIND[b]
        kinds += np.bincount((c[:-2] * KINDS + c[1:-1]) * KINDS + c[2:], minlength=_KIND_TERMS)
        low = b.astype(np.int32) | 32
        raw += np.bincount((low[:-2] * 961 + low[1:-1] * 31 + low[2:]) % BUCKETS, minlength=BUCKETS)
    n = repeats = windows = 0
    distinct = 0.0
    for words in word_blocks(data):
        n += len(words)
        repeats += sum(map(bytes.__eq__, words, words[1:]))
        for k in range(0, len(words), 64):
            part = words[k:k + 64]
            distinct += len(set(part)) / len(part)
            windows += 1
    out = np.zeros(TERMS, np.float32)
    if total := kinds.sum():
        out[:BUCKETS] = np.sqrt(np.bincount(_FOLD, weights=kinds, minlength=BUCKETS) / total)
        out[BUCKETS:2 * BUCKETS] = np.sqrt(raw / total)
    if windows:
        again, fresh = repeats / n, distinct / windows
        out[-4:] = np.sqrt([again / 2, (1 - again) / 2, fresh / 2, (1 - fresh) / 2])
    return out


def term_matrix(texts: list[str]) -> np.ndarray:
    return np.stack([term_counts(t) for t in texts]) if texts else np.zeros((0, TERMS), np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    """The latent space and the labelled vectors in it."""

    weights: np.ndarray     # of the terms
    space: np.ndarray       # terms x rank
    vectors: np.ndarray     # labelled x rank, of norm 1
    labels: np.ndarray      # 0 or 1
    neighbours: int = NEIGHBOURS

    def embed(self, terms: np.ndarray) -> np.ndarray:
        return _unit((terms * self.weights) @ self.space)

    def score(self, texts: list[str]) -> np.ndarray:
        if not len(self.labels):
            return np.ones(len(texts))
        out = np.empty(len(texts))
        rows = max(1, _BLOCK // len(self.labels))
        for k in range(0, len(texts), rows):
            out[k:k + rows] = self._vote(self.embed(term_matrix(texts[k:k + rows])))
        return out

    def _vote(self, x: np.ndarray) -> np.ndarray:
        close = np.round(x @ self.vectors.T, 6)   # what differs by rounding alone is the same
        n = min(self.neighbours, close.shape[1])
        near = np.argpartition(-close, n - 1, axis=1)[:, :n]
        # Of equally near texts at the last place those with the smallest ids vote; they come first.
        last = np.take_along_axis(close, near, axis=1).min(axis=1)
        for i in np.flatnonzero((close >= last[:, None]).sum(axis=1) > n):
            tied = np.flatnonzero(close[i] >= last[i])
            near[i] = tied[np.argsort(-close[i, tied], kind="stable")[:n]]
        near.sort(axis=1)   # added up in one order
        w = np.maximum(np.take_along_axis(close, near, axis=1), 0).astype(np.float64)
        total = w.sum(axis=1)
        voted = (w * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-12)
        return np.where(total > 1e-9, np.clip(voted, 0, 1), self.labels.mean())


def fit(terms: np.ndarray, labels: np.ndarray, rank: int = RANK, neighbours: int = NEIGHBOURS, seed: int = 7) -> Model:
    """Term weights by document frequency, and the leading singular vectors by subspace iteration."""
    if not len(labels):
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels)
    idf = np.log1p(len(labels) / (1.0 + (terms > 0).sum(axis=0))).astype(np.float32)
    idf[-4:] = idf[:-4].max()
    x = np.multiply(terms, idf, dtype=np.float32)
    rank = min(rank, *x.shape)
    q = np.random.default_rng(seed).standard_normal((x.shape[1], min(rank + 16, x.shape[1]))).astype(np.float32)
    for _ in range(6):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    space = (q @ v.T)[:, :rank].astype(np.float32)
    model = Model(idf, space, np.zeros((0, rank), np.float32), labels.astype(np.float64), neighbours)
    model.vectors = _unit(x @ space)
    return model


def held_out(ident: str) -> Column:
    return F.crc32(F.encode(F.col(ident).cast("string"), "UTF-8")) % FOLDS == 0


def train(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", label: str = "quality",
          max_labelled: int = MAX_LABELLED) -> Model:
    """The model from at most ``max_labelled`` labelled rows that are not held out."""
    chosen = labels.where(F.col(label).isNotNull() & F.col(ident).isNotNull() & ~held_out(ident)) \
        .groupBy(F.col(ident).alias("id")).agg(F.max(F.col(label)).cast("int").alias("label")) \
        .orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    texts = docs.select(F.col(ident).alias("id"), text_of(text).alias("text")) \
        .join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            # 16 bits a term are enough for what is learnt from, and half of what the driver gathers.
            rows = [term_counts(t).astype(np.float16).tobytes() for t in strings(batch.column("text"))]
            yield pa.record_batch([batch.column("id"), batch.column("label"), pa.array(rows, pa.binary())],
                                  names=["id", "label", "terms"])

    rows = texts.mapInArrow(terms, f"id {dict(texts.dtypes)['id']}, label int, terms binary").toArrow()
    order = np.argsort(rows.column("id").to_numpy(), kind="stable")
    labels = rows.column("label").to_numpy()[order].astype(np.float64)
    terms = np.zeros((len(order), TERMS), np.float16)
    for k, i in enumerate(order):
        terms[k] = np.frombuffer(rows.column("terms")[int(i)].as_buffer(), np.float16)
    del rows
    return fit(terms, labels)


def score_documents(docs: DataFrame, model: Model, ident: str = "doc_id", text: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col(ident).alias("doc_id"), F.coalesce(held_out(ident), F.lit(False)).alias("held_out"),
                       text_of(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, "text"):
            s = shared.value.score(strings(batch.column("text")))
            yield pa.record_batch([batch.column("doc_id"), batch.column("held_out"), pa.array(s),
                                   pa.array((s >= threshold).astype(np.int32))],
                                  names=["doc_id", "held_out", "score", "predicted"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, in the columns of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    numbered = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, f"c{at}"):
            good = shared.value.score(strings(batch.column(at))) >= threshold
            yield batch.filter(pa.array(good))

    return numbered.mapInArrow(keep, numbered.schema).toDF(*docs.columns)
