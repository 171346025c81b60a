"""Token-id files: ids of documents in the order of their ids, Simple-8b coded, with offsets of blocks and documents.

A file is

    8 bytes   ``MAGIC``
    blocks    for each ``simple8b.BLOCK`` ids (the last block may have fewer): its 64-bit words, then its escapes of 32 bits,
              filled up to 8 bytes
    blocks    for each its offset in the file (64 bits), words and escapes (32 bits each)
    documents for each its number (64 bits, signed), then for each the ids before it in this file (64 bits)
    trailer   ids, documents, documents without a number (they come first), blocks, offset of the block table (64 bits
              each), ``MAGIC``

all little-endian.  So a document, or a range of them, is read by the bytes of its blocks alone.

Documents are dealt out by ranges of their numbers, sorted there, encoded and written by the same task; a task begins a
new file after ``FILE_IDS`` ids or ``FILE_DOCS`` documents.  Files carry the partition and the task attempt in their names and only those of committed
tasks are in the manifest, so a file that a lost executor left half written is never read.  How many ids come before a file
follows from the manifest: a row for each file, summed first within tasks, then over tasks.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import simple8b
from .common import batched, fresh_path, rows_of, small_batches, text_of, written
from .packing import words_of

MAGIC = b"VXIDS8B1"
_TRAILER = struct.Struct("<5Q8s")
_BLOCK_ROW = np.dtype([("offset", "<u8"), ("words", "<u4"), ("escapes", "<u4")])
END_ID = 2
#: Ids, or documents, after which a task begins a new file; ids that are encoded or decoded at once.
FILE_IDS, FILE_DOCS, CHUNK_IDS = 1 << 26, 1 << 20, simple8b.BLOCK << 10

MANIFEST_SCHEMA = "part int, seq int, file string, docs long, ids long, first_doc long, last_doc long"


@dataclass
class _Writer:
    """One file that is being written."""

    out: pa.NativeFile
    at: int = 0
    ids: int = 0
    held: list[np.ndarray] = field(default_factory=list)
    n_held: int = 0
    table: list[np.ndarray] = field(default_factory=list)
    docs: list[int | None] = field(default_factory=list)
    starts: list[int] = field(default_factory=list)

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.starts.append(self.ids)
        self.ids += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        if self.n_held >= CHUNK_IDS:
            self.flush(self.n_held - self.n_held % simple8b.BLOCK)

    def flush(self, n: int) -> None:
        """Encodes the first ``n`` ids that are held: whole blocks, or all."""
        held = np.concatenate([np.zeros(0, "<u4"), *self.held])
        for first in range(0, n, CHUNK_IDS):
            self.put_blocks(held[first : min(n, first + CHUNK_IDS)])
        self.held, self.n_held = [held[n:]], len(held) - n

    def put_blocks(self, ids: np.ndarray) -> None:
        words, n_words, escapes, n_escapes = simple8b.encode(ids)
        row = np.zeros(len(n_words), _BLOCK_ROW)
        row["words"], row["escapes"] = n_words, n_escapes
        fours = 2 * (n_words + -(-n_escapes // 2))
        ends = np.cumsum(fours)
        row["offset"] = self.at + 4 * (ends - fours)
        out = np.zeros(int(ends[-1]), "<u4")
        begin = ends - fours
        _spread(out, begin, 2 * n_words, words.astype("<u8").view("<u4"))
        _spread(out, begin + 2 * n_words, n_escapes, escapes)
        self.table.append(row)
        self.put(out.tobytes())

    def close(self) -> tuple[int, int, int | None, int | None]:
        """Documents, ids, first and last number."""
        if self.n_held:
            self.flush(self.n_held)
        table, at = np.concatenate([np.zeros(0, _BLOCK_ROW), *self.table]), self.at
        nulls = self.docs.count(None)
        self.put(table.tobytes())
        self.put(np.array([0 if x is None else x for x in self.docs], "<i8").tobytes())
        self.put(np.array(self.starts, "<u8").tobytes())
        self.put(_TRAILER.pack(self.ids, len(self.docs), nulls, len(table), at, MAGIC))
        self.out.close()
        return len(self.docs), self.ids, self.docs[nulls] if nulls < len(self.docs) else None, self.docs[-1]


def _spread(out: np.ndarray, at: np.ndarray, n: np.ndarray, values: np.ndarray) -> None:
    """Puts stretches of ``n`` values, which follow one another, to the places ``at`` of ``out``."""
    out[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(len(values))] = values


def write_ids(docs: DataFrame, spec: str, to: str | None = None, end_id: int = END_ID, file_ids: int = FILE_IDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the ids of every row, ``end_id`` after each, to files in ``to`` (a new folder of the shared one if None); returns the manifest.

    ``spec`` is the tokenizer's JSON.  The order is that of ``id_col`` (whole numbers); rows without one come first, rows that
    share one follow in the order of their text's hash, then as they were read, so a number of very many rows is still dealt
    out to many tasks.  Null and empty texts are the end id alone; very long texts are encoded whole; an empty table gives no
    file and an empty manifest; further columns are not read.
    """
    spark = docs.sparkSession
    to = to or fresh_path(spark, "ids")
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("row"), text.alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash"), F.col("row")]
    held, end, run = spark.sparkContext.broadcast(spec), np.array([end_id], "<u4"), uuid.uuid4().hex[:8]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def files() -> Iterator[tuple]:
            words, task, file, name, seq = words_of(held.value), TaskContext.get(), None, "", 0
            fs, folder = pa.fs.FileSystem.from_uri(to)
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                if file is not None and (file.ids >= file_ids or len(file.docs) >= FILE_DOCS):
                    yield task.partitionId(), seq, name, *file.close()
                    file, seq = None, seq + 1
                if file is None:
                    fs.create_dir(folder, recursive=True)
                    name = f"part-{run}-{task.partitionId():06d}-{seq:04d}-{task.taskAttemptId()}.ids"
                    file = _Writer(fs.open_output_stream(f"{folder}/{name}", compression=None))
                    file.put(MAGIC)
                file.add(doc_id, np.concatenate([np.frombuffer(words.encode(text), "<u4"), end]))
            if file is not None:
                yield task.partitionId(), seq, name, *file.close()

        yield from batched(files(), pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), *((c, pa.int64()) for c in ("docs", "ids", "first_doc", "last_doc"))]))

    with small_batches(spark):
        made = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text").mapInArrow(put, MANIFEST_SCHEMA)
        return written(made.withColumn("file", F.concat(F.lit(to + "/"), "file")), "ids-manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``: the ids in all files before.  One task sees a row for each writing task, no more."""
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("ids"))
    before = parts.select("part", F.coalesce(F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.coalesce(F.sum("ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return manifest.withColumn("within", within).join(before, "part").withColumn("start", F.col("before") + F.col("within")).drop("before", "within")


class IdFile:
    """One file, opened for reading."""

    def __init__(self, uri: str):
        fs, path = pa.fs.FileSystem.from_uri(uri)
        self.source = fs.open_input_file(path)
        size = self.source.size()
        self.n_ids, n_docs, nulls, n_blocks, at, magic = _TRAILER.unpack(self.read(size - _TRAILER.size, _TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no id file")
        tables = self.read(at, size - _TRAILER.size - at)
        self.blocks = np.frombuffer(tables, _BLOCK_ROW, n_blocks)
        self.docs = np.frombuffer(tables, "<i8", n_docs, self.blocks.nbytes)
        self.starts = np.frombuffer(tables, "<u8", n_docs, self.blocks.nbytes + self.docs.nbytes).astype(np.int64)
        self.nulls, self.tables_at = nulls, at

    def read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids of the places ``first`` to ``last``, from the bytes of their blocks."""
        if first >= last:
            return np.zeros(0, "<u4")
        a, b = first // simple8b.BLOCK, -(-last // simple8b.BLOCK)
        rows = self.blocks[a:b]
        at = int(rows["offset"][0])
        to = int(self.blocks["offset"][b]) if b < len(self.blocks) else self.tables_at
        data = np.frombuffer(self.read(at, to - at), "<u4")
        begin, n_words, n_escapes = (rows["offset"].astype(np.int64) - at) // 4, rows["words"].astype(np.int64), rows["escapes"].astype(np.int64)
        words = _stretches(data, begin, 2 * n_words).view("<u8")
        escapes = _stretches(data, begin + 2 * n_words, n_escapes)
        n = min(self.n_ids, b * simple8b.BLOCK) - a * simple8b.BLOCK
        return simple8b.decode(words, n_words, escapes, n)[first - a * simple8b.BLOCK : last - a * simple8b.BLOCK]

    def documents(self, between: tuple[int, int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Number, ids before it in this file, and ids of each document, or of those whose number lies ``between``, ends included."""
        first, last = 0, len(self.docs)
        if between is not None:
            first = self.nulls + int(np.searchsorted(self.docs[self.nulls :], between[0], side="left"))
            last = self.nulls + int(np.searchsorted(self.docs[self.nulls :], between[1], side="right"))
        ends = np.r_[self.starts[1:], self.n_ids]
        k = first
        while k < last:
            # so many documents that their ids are one chunk, or a single longer one
            to = max(k + 1, min(last, int(np.searchsorted(ends, self.starts[k] + CHUNK_IDS, side="right"))))
            base = int(self.starts[k])
            some = self.ids(base, int(ends[to - 1]))
            for d in range(k, to):
                yield None if d < self.nulls else int(self.docs[d]), int(self.starts[d]), some[int(self.starts[d]) - base : int(ends[d]) - base]
            k = to


def _stretches(data: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The stretches of ``n`` values at the places ``at`` of ``data``, one after the other."""
    return data[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def read_ids(manifest: DataFrame, between: tuple[int, int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), ids (little-endian unsigned 32-bit integers) of every document in the files.

    With ``between`` only documents whose number lies there, ends included, are read, from the bytes of their blocks.  A file is a task's
    work at most, long files and short ones are dealt out alike; an empty manifest gives an empty result.
    """
    files = with_starts(manifest)
    if between is not None:
        files = files.where((F.col("first_doc") <= between[1]) & (F.col("last_doc") >= between[0]))
    tasks = max(manifest.sparkSession.sparkContext.defaultParallelism, manifest.count())

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for uri, start in rows_of(batches, "file", "start"):
                file = IdFile(uri)
                for doc_id, at, ids in file.documents(between):
                    yield doc_id, start + at, ids.tobytes()
                file.source.close()

        yield from batched(found(), pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())]), 256)

    return files.select("file", "start").repartition(tasks, "file").mapInArrow(get, "doc_id long, start long, ids binary")
