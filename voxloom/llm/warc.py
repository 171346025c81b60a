"""WARC archives, index first.

Writing gives an index row for every record: file, offset, length, URL, digest.  Each record is a gzip member of
its own, so a record is read by its byte range alone.  Reading starts from the index: select, deal out by file and
stretch, sort by offset, join neighbouring ranges into one read, and parse only those bytes.

Files are named by partition and task attempt; only the index rows of committed tasks name a file, so a file that a
lost executor left half written is never read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import batched, fresh_path, rows_of, text_of, written

INDEX_SCHEMA = "page_id long, url string, record_type string, payload_digest string, file string, offset long, length long"
RECORD_SCHEMA = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A new file after so many bytes; neighbouring ranges are read at once over gaps and up to lengths of so many bytes.
FILE_BYTES, GAP_BYTES, READ_BYTES = 256 << 20, 64 << 10, 8 << 20
#: Tasks in which the rows of one content meet its answer, where answers are too many to broadcast; bytes that one answer takes
#: in memory; bytes of archives that a reading task gets in the mean.
SALTS, ANSWER_BYTES, TASK_BYTES = 8, 100, 32 << 20


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _from_urn(urn: str | None) -> int | None:
    return int(urn[10:-1]) if urn and urn[10:-1] else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> tuple[bytes, str]:
    """The gzip member of a record, and its payload digest.  A revisit has the HTTP head but no payload."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if any(c in url for c in "\r\n") else "WARC-Target-URI: " + url)
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    body = http if revisit else http + payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return gzip.compress(("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode("utf-8", "surrogatepass") + body + b"\r\n\r\n", 2, mtime=0), digest


def parse(member: bytes) -> tuple:
    """The values of RECORD_SCHEMA; a payload that doesn't match its digest is an error."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return _from_urn(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, size, digest, _from_urn(fields.get("WARC-Refers-To")) if kind == "revisit" else None, payload if kind == "response" else None


def _asked(rows: DataFrame, many: DataFrame, max_broadcast_bytes: int) -> DataFrame:
    """``rows`` with what ``many`` says of their content.

    Few answers are broadcast, and every payload stays where it lies.  Else a filter of the contents that repeat, of a bounded
    size, tells the rows that can stay where they lie; the others meet the answers, each content in SALTS places, so that
    one of very many rows meets in as many tasks.
    """
    n_many = many.count()
    if n_many * ANSWER_BYTES <= max_broadcast_bytes:
        return rows.join(F.broadcast(many), "content", "left")
    held = rows.sparkSession.sparkContext.broadcast(bloom.filter_of(many.select(F.xxhash64("content").alias("h")), n_many, True))

    @F.pandas_udf("boolean")
    def repeats(hashes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for h in hashes:
            yield pd.Series(bloom.contains(held.value, h.to_numpy(np.int64).view(np.uint64)))

    marked = rows.withColumn("repeats", repeats(F.xxhash64("content")))
    alone = marked.where("not repeats").drop("repeats").withColumn("stays", F.lit(None).cast("long"))
    answers = many.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    shared = marked.where("repeats").withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    return alone.unionByName(shared.join(answers, ["content", "salt"], "left").drop("repeats", "salt"))


def write_archives(pages: DataFrame, to: str | None = None, min_payload_bytes: int = 0, date: str = "2000-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html", max_broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Writes a record per row to archives in ``to`` (a new folder of the shared one if None); returns the index.

    Of records with equal payloads of ``min_payload_bytes`` or more, the one with the largest id is the response and
    the others revisit it.  A null page is an empty payload, a null URL has no header; repeated rows get a record
    each; where the id that stays repeats, each of its records is a response; of records without ids all are.  Payloads are
    written by the task that reads them, not shuffled, as long as the contents that repeat take ``max_broadcast_bytes`` at most
    (by their number); beyond that only payloads of contents that repeat move.
    An empty table gives an empty index; further columns are not read.
    """
    spark = pages.sparkSession
    to = to or fresh_path(spark, "warc")
    html = text_of(html_col)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.cast("binary").alias("payload"), F.unhex(F.sha2(html, 256)).alias("content"))
    # the contents that repeat: digests and ids alone
    many = written(rows.groupBy("content").agg(F.max("page_id").alias("stays"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "warc-repeats")
    copy = F.col("stays").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("stays")) & (F.octet_length("payload") >= min_payload_bytes)
    asked = _asked(rows, many, max_broadcast_bytes).withColumn("revisit", copy)
    run = uuid.uuid4().hex[:8]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def index() -> Iterator[tuple]:
            fs, folder = pa.fs.FileSystem.from_uri(to)
            task, out, at, n = TaskContext.get(), None, 0, 0
            for page_id, url, payload, stays, revisit in rows_of(batches, "page_id", "url", "payload", "stays", "revisit"):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    fs.create_dir(folder, recursive=True)
                    name = f"part-{run}-{task.partitionId():05d}-{task.taskAttemptId()}-{n:03d}.warc.gz"
                    out, at, n = fs.open_output_stream(f"{folder}/{name}", compression=None), 0, n + 1
                member, digest = record(page_id, url, payload, stays, revisit, date)
                out.write(member)
                yield page_id, url, "revisit" if revisit else "response", digest, name, at, len(member)
                at += len(member)
            if out is not None:
                out.close()

        yield from batched(index(), pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]))

    found = asked.select("page_id", "url", "payload", "stays", "revisit").mapInArrow(put, INDEX_SCHEMA)
    return written(found.withColumn("file", F.concat(F.lit(to + "/"), "file")), "warc-index")


def _ranges(rows: Iterator[tuple]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Runs of neighbouring (offset, length) of one file, each to be read at once."""
    now, run = None, []
    for file, offset, length in rows:
        if run and (file != now or offset > run[-1][0] + run[-1][1] + GAP_BYTES or offset + length - run[0][0] > READ_BYTES):
            yield now, run
            run = []
        now = file
        run.append((offset, length))
    if run:
        yield now, run


def read_records(index: DataFrame) -> DataFrame:
    """The records that ``index`` (all or selected rows of it) names, as RECORD_SCHEMA.

    The bytes to read, not those of the index, decide the number of tasks.  A null page is an empty payload and a null id or
    URL is null again; a revisit has no payload.  An index row that repeats gives its record as often; an empty index gives an
    empty result; further columns are not read.
    """
    spark = index.sparkSession
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[tuple]:
            name, source = None, None
            for file, run in _ranges(rows_of(batches, "file", "offset", "length")):
                if file != name:
                    if source is not None:
                        source.close()
                    fs, path = pa.fs.FileSystem.from_uri(file)
                    name, source = file, fs.open_input_file(path)
                first = run[0][0]
                source.seek(first)
                block = source.read(run[-1][0] + run[-1][1] - first)
                for offset, length in run:
                    yield parse(block[offset - first : offset - first + length])
            if source is not None:
                source.close()

        yield from batched(records(), pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]), 256)

    stretch = F.expr(f"offset div {READ_BYTES}").alias("stretch")
    return index.select("file", "offset", "length", stretch).repartition(tasks, "file", "stretch").sortWithinPartitions("file", "offset").mapInArrow(get, RECORD_SCHEMA)


ORACLE_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS hex, max(page_id) OVER (PARTITION BY h) AS stays FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(hex, (k // 4 * 5 + 1)::BIGINT, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31) + 1)::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id = stays THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> stays THEN stays END AS refers_to
FROM x
"""
