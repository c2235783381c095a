"""Token ids in Arrow stream files of fixed-size-list batches.

A file holds the ids of its documents, one after the other, cut into sequences of equal length: every record batch
has the columns ``ids`` (fixed-size list of ``length`` unsigned integers) and ``mask`` (fixed-size list of ``length``
booleans, false where the last sequence of a file is filled up). Since all batches but the last have the same number
of sequences, and the buffers are stored as they lie in memory, a memory-mapped file gives any sequence and its mask
as numpy views without a copy. A second stream file beside it lists the documents and their token counts.

Files are numbered in ascending id order, and so are the documents in them; documents without an id come first.

Defined results: a null or empty text is a document with the end id alone; repeated rows are stored as often as they
occur, in an order that does not matter since they are equal; an empty table gives no files and no rows; other
columns are ignored, whatever their names. A task writes under a name of its own and renames at its end, and its
bytes follow from its rows alone, so a repeated task leaves the same file.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pieces_of, saved, strings, text_of
from .tokens import END_ID, encoder, vocabulary_path

LENGTH = 1024        # ids in a sequence
BATCH = 256          # sequences in a record batch
DOCS_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])
SUMMARY = "file int, docs bigint, tokens bigint"
READ_BACK = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def file_schema(id_type: pa.DataType, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.field("item", id_type, nullable=False), length)),
                      ("mask", pa.list_(pa.field("item", pa.bool_(), nullable=False), length))])


def id_type_for(vocabulary: int) -> pa.DataType:
    return pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()


def _names(folder: str, number: int) -> tuple[str, str]:
    return f"{folder}/tokens-{number:06d}.arrows", f"{folder}/documents-{number:06d}.arrows"


class SequenceWriter:
    """Appends ids and writes a record batch whenever ``BATCH`` sequences are full."""

    def __init__(self, sink, id_type: pa.DataType, length: int):
        self.schema, self.length = file_schema(id_type, length), length
        self.dtype = id_type.to_pandas_dtype()
        self.stream = pa.ipc.new_stream(sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.held = 0

    def append(self, ids: np.ndarray) -> None:
        self.parts.append(ids.astype(self.dtype))
        self.held += len(ids)
        if self.held >= self.length * BATCH:
            self._write(False)

    def _write(self, last: bool) -> None:
        flat = np.concatenate(self.parts) if self.parts else np.empty(0, self.dtype)
        whole = len(flat) if last else len(flat) // (self.length * BATCH) * self.length * BATCH
        self.parts, self.held = [flat[whole:]], len(flat) - whole
        for k in range(0, whole, self.length * BATCH):
            real = flat[k:min(k + self.length * BATCH, whole)]
            fill = -len(real) % self.length
            ids = np.concatenate([real, np.zeros(fill, self.dtype)])
            mask = np.arange(len(ids)) < len(real)
            self.stream.write_batch(pa.record_batch(
                [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type)
                 for x, f in zip((ids, mask), self.schema, strict=True)], schema=self.schema))

    def close(self) -> None:
        self._write(True)
        self.stream.close()


class TokenFile:
    """Random access to a written file. ``source``: a memory map for views without a copy, or any open file."""

    def __init__(self, source):
        reader = pa.ipc.open_stream(source)
        self.length = reader.schema.field("ids").type.list_size
        self.batches = list(reader)
        self.sequences = sum(b.num_rows for b in self.batches)

    @classmethod
    def mapped(cls, path: str) -> TokenFile:
        return cls(pa.memory_map(path))

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """The ids and the mask of sequence ``i``, as views into the file."""
        batch, row = self.batches[i // BATCH], i % BATCH
        ids, mask = (batch.column(k).flatten().slice(row * self.length, self.length) for k in ("ids", "mask"))
        return ids.to_numpy(zero_copy_only=True), mask

    def tokens(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` of the file on; a copy only where they cross a batch."""
        per, parts = BATCH * self.length, []
        while n:
            k, at = divmod(start, per)
            part = self.batches[k].column("ids").flatten().slice(at, min(n, per - at)).to_numpy(zero_copy_only=True)
            parts.append(part)
            start, n = start + len(part), n - len(part)
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint16)


def write_token_files(docs: DataFrame, folder: str, ident: str = "doc_id", text: str = "text",
                      vocabulary: str | None = None, end_id: int = END_ID, length: int = LENGTH,
                      files: int | None = None) -> DataFrame:
    """Write the ids of all documents to ``folder`` and return (file, docs, tokens) of each file.

    The documents are ranged by id into ``files`` files (default: the session's number of shuffle partitions), and
    by text and row where ids repeat, so that no id can make one file too large. Ids are 16 bits wide where the
    vocabulary allows it.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    path = vocabulary or vocabulary_path()
    id_type = id_type_for(max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1))
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(ident).cast("bigint").alias("doc_id"), text_of(text).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    ranged = rows.repartitionByRange(files, "doc_id", F.xxhash64("text"), "row").sortWithinPartitions(
        "doc_id", F.xxhash64("text"), "row").select("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary, end_id)
        filesystem, base = pafs.FileSystem.from_uri(folder)
        filesystem.create_dir(base, recursive=True)
        number = TaskContext.get().partitionId()
        finals = _names(base, number)
        own = [f"{f}.{uuid.uuid4().hex}" for f in finals]
        sequences = index = None
        docs_n = tokens_n = 0
        for batch in pieces_of(batches, "text"):
            if sequences is None:
                sinks = [filesystem.open_output_stream(f) for f in own]
                sequences = SequenceWriter(sinks[0], id_type, length)
                index = pa.ipc.new_stream(sinks[1], DOCS_SCHEMA)
            counts = []
            for ids in enc.encode(strings(batch.column("text"))):
                sequences.append(np.frombuffer(ids, "<u4"))
                counts.append(len(ids) // 4)
            index.write_batch(pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64())],
                                              schema=DOCS_SCHEMA))
            docs_n, tokens_n = docs_n + len(counts), tokens_n + sum(counts)
        if sequences is not None:
            for x in (sequences, index, *sinks):
                x.close()
            for a, b in zip(own, finals, strict=True):
                filesystem.move(a, b)
            yield pa.record_batch([pa.array([number], pa.int32()), pa.array([docs_n], pa.int64()),
                                   pa.array([tokens_n], pa.int64())], names=["file", "docs", "tokens"])

    return saved(ranged.mapInArrow(write, SUMMARY), "token_files")


def read_token_files(spark: SparkSession, folder: str, summary: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    One row per file gives its start by a running sum; then every file is read by a task of its own.
    """
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = summary.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
    count = max(1, summary.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for number, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with filesystem.open_input_file(_names(base, number)[1]) as docs_file:
                    listed = pa.ipc.open_stream(docs_file).read_all()
                counts = listed.column("n_tokens").to_numpy()
                crcs = np.zeros(len(counts), np.int64)
                with filesystem.open_input_file(_names(base, number)[0]) as f:
                    _checksums(f, counts, crcs)
                begins = start + np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else counts
                table = pa.table([listed.column("doc_id"), pa.array(begins, pa.int64()), listed.column("n_tokens"),
                                  pa.array(crcs)], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                yield from table.combine_chunks().to_batches()

    return starts.repartition(count, "file").mapInArrow(read, READ_BACK)


def _checksums(source, counts: np.ndarray, crcs: np.ndarray) -> None:
    """crc32 of each document's ids, batch after batch, without holding the whole file."""
    doc, left = 0, int(counts[0]) if len(counts) else 0
    crc = 0
    for batch in pa.ipc.open_stream(source):
        flat = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
        at = 0
        while doc < len(counts) and at < len(flat):
            n = min(left, len(flat) - at)
            crc = zlib.crc32(flat[at:at + n].astype("<u4").tobytes(), crc)
            at, left = at + n, left - n
            if not left:
                crcs[doc] = crc
                doc, crc = doc + 1, 0
                left = int(counts[doc]) if doc < len(counts) else 0


def local_files(folder: str) -> list[str]:
    """The token files of a folder on this machine, for ``TokenFile.mapped``."""
    base = folder.removeprefix("file://")
    return sorted(os.path.join(base, f) for f in os.listdir(base) if f.startswith("tokens-") and f.endswith(".arrows"))
