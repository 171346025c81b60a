"""Line deduplication behind two Bloom filters.

Pass 1 hashes the distinct line keys of every document.  Hashes, counted per task first, go by range to tasks of their own (eight
bytes and a count each); every such task keeps two filters of its range, *once* for hashes met and *twice* for hashes met again.
Hashes that enter the second are counted from there on, and those that may be in ``min_docs`` documents are told.  A range has at
most ``RANGE_HASHES`` hashes or so, whatever the table, so neither filters nor counts of a task grow with the data.  The told
hashes make the filters of suspected lines: 16 bits each, at most ``max_filter_bytes`` for a filter, which bounds what is broadcast at
once.  Where they need more (33 million different lines that repeat so often, by default), they are cut by hash into so many
filters as it takes, and the texts are read once for each: no filter is fuller than another, so only suspects move at any size.

Pass 2 sends only suspected repeats to the shuffle, folded per task, where whole keys are counted exactly and the
first document is chosen.  Pass 3 drops lines: with the confirmed keys broadcast if their bytes, which are summed
first, are at most ``max_broadcast_bytes``, else by a join of the suspected lines.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import bloom
from .common import WS, batched, rows_of, text_of, written

_WS = WS.encode()
#: Hashes of a range, in expectation: filters of 16 MB in its task.
RANGE_HASHES = 4_000_000


def line_keys(text: str, min_chars: int) -> list[bytes | None]:
    """The key of each line, None if it has fewer than ``min_chars`` code points."""
    keys = [x.strip(_WS) for x in text.encode("utf-8", "surrogatepass").lower().split(b"\n")]
    return [k if len(k) >= min_chars and (min_chars <= 1 or len(k.decode("utf-8", "surrogatepass")) >= min_chars) and k else None for k in keys]


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def repeated_hashes(rows: DataFrame, min_chars: int, range_hashes: int = RANGE_HASHES, min_docs: int = 2) -> DataFrame:
    """(h) of the hashes that ``min_docs`` documents may share, each once; few are there by a false positive of a filter."""
    spark = rows.sparkSession
    lines = rows.select(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-lines // range_hashes))
    words = bloom.words_for(-(-lines // ranges) * 2)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for (text,) in rows_of(batches, "text"):
            h = _hashes(list({k for k in line_keys(text, min_chars) if k is not None}))
            held.append(h)
            n += len(h)
            if n >= bloom.FLUSH:
                yield _counted(held)
                held, n = [], 0
        if n:
            yield _counted(held)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
        # hashes met again and the documents that have them, in order; new ones wait until they are worth a merge
        known, docs = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        n_waiting = 0
        for batch in batches:
            h, of = np.unique(batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64), return_inverse=True)
            n = np.bincount(of, batch.column("n").to_numpy(zero_copy_only=False), len(h)).astype(np.int64)
            before, often = bloom.contains(once, h), bloom.contains(twice, h)
            again = (n > 1) | before
            bloom.add(once, h)
            bloom.add(twice, h[again])
            # a hash that enters the second filter was met once before
            waiting.append((h[again], (n + (before & ~often))[again]))
            n_waiting += int(again.sum())
            if n_waiting > max(100_000, len(known)):
                known, docs = _summed(known, docs, waiting)
                waiting, n_waiting = [], 0
        known, docs = _summed(known, docs, waiting)
        # a false positive of the second filter at the second meeting leaves the first one out
        told = known[docs >= min_docs - 1]
        if len(told):
            yield pa.RecordBatch.from_arrays([pa.array(told.view(np.int64))], names=["h"])

    return rows.mapInArrow(send, "h long, n int").repartition(ranges, "h").mapInArrow(meet, "h long")


def _counted(hashes: list[np.ndarray]) -> pa.RecordBatch:
    h, n = np.unique(np.concatenate(hashes), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int32))], names=["h", "n"])


def _summed(known: np.ndarray, docs: np.ndarray, more: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes in order, and the sums of their counts."""
    h, of = np.unique(np.concatenate([known, *(x[0] for x in more)]), return_inverse=True)
    return h, np.bincount(of, np.concatenate([docs, *(x[1] for x in more)]), len(h)).astype(np.int64)


def suspected(keys: list[bytes], words: np.ndarray, part: int = 0, parts: int = 1) -> list[bytes]:
    """Those of the keys that the filter, which is that of one part of the hashes, may hold."""
    if not keys:
        return keys
    h = _hashes(keys)
    ok = bloom.contains(words, h)
    if parts > 1:
        ok &= h.view(np.int64) % parts == part
    return [keys[i] for i in np.flatnonzero(ok)]


def _rebuilt(text: str, drop: dict, doc_id: object, min_chars: int) -> tuple[int, int, str]:
    """Lines before, lines dropped, the text that stays.  ``drop``: by key, the id whose first such line stays, or None."""
    keys = line_keys(text, min_chars)
    if not any(k in drop for k in keys):
        return len(keys), 0, text
    kept: list[str] = []
    spared: set[bytes] = set()
    for line, key in zip(text.split("\n"), keys, strict=True):
        if key not in drop:
            kept.append(line)
        elif doc_id is not None and drop[key] == doc_id and key not in spared:
            spared.add(key)
            kept.append(line)
    return len(keys), len(keys) - len(kept), "\n".join(kept)


def line_dedup(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_filter_bytes: int = bloom.MAX_BYTES,
    max_broadcast_bytes: int = 32 << 20,
    range_hashes: int = RANGE_HASHES,
) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (the lines that stay) for every row.

    A line whose key is in ``min_docs`` (2 at least) rows or more goes from every document; with ``keep_first`` its
    first occurrence, in the document with the smallest id, stays.  A null or empty text is one empty line, which is
    never dropped.  Each row is a document of its own, repeated rows too, whichever way the lines are dropped; where ids
    repeat, ``keep_first`` keeps a line in every row that has the smallest id.  Ids may be null; a null id is no first
    occurrence.  An empty table gives an empty result; further columns are not read.
    """
    if min_docs < 2:
        raise ValueError("min_docs must be 2 or more")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    id_arrow = to_arrow_type(rows.schema["doc_id"].dataType)
    told = written(repeated_hashes(rows, min_chars, range_hashes, min_docs), "repeated-hashes")
    n_told = told.count()
    parts = max(1, -(-n_told * bloom.BITS // 8 // max_filter_bytes))
    filters = [spark.sparkContext.broadcast(bloom.filter_of(told.where(F.pmod("h", F.lit(parts)) == k) if parts > 1 else told, -(-n_told // parts), True, max_filter_bytes)) for k in range(parts)]

    def suspects(batches: Iterator[pa.RecordBatch], part: int, words: Broadcast) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            held: dict[bytes, list] = {}
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                for key in suspected(list({k for k in line_keys(text, min_chars) if k is not None}), words.value, part, parts):
                    x = held.setdefault(key, [0, None])
                    x[0] += 1
                    if x[1] is None or doc_id is not None and doc_id < x[1]:
                        x[1] = doc_id
                if len(held) >= 100_000:
                    yield from ((k, n, first) for k, (n, first) in held.items())
                    held = {}
            yield from ((k, n, first) for k, (n, first) in held.items())

        yield from batched(found(), pa.schema([("key", pa.binary()), ("n", pa.int64()), ("first", id_arrow)]))

    each = [rows.mapInArrow(partial(suspects, part=k, words=words), f"key binary, n long, first {id_type}") for k, words in enumerate(filters)]
    counted = reduce(DataFrame.union, each).groupBy("key").agg(F.sum("n").alias("n"), F.min("first").alias("first"))
    repeated = written(counted.where(F.col("n") >= min_docs).select("key", F.col("first") if keep_first else F.lit(None).cast(id_type).alias("first")), "repeated-lines")
    held = repeated.agg(F.sum(F.octet_length("key") + 100)).first()[0] or 0
    out = f"doc_id {id_type}, n_lines long, n_dropped long, text string"
    out_arrow = pa.schema([("doc_id", id_arrow), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("text", pa.string())])
    if held <= max_broadcast_bytes:
        drop = spark.sparkContext.broadcast({bytes(k): first for k, first in repeated.toLocalIterator()})

        def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = ((doc_id, *_rebuilt(text, drop.value, doc_id, min_chars)) for doc_id, text in rows_of(batches, "doc_id", "text"))
            yield from batched(found, out_arrow, 512)

        return rows.mapInArrow(rebuild, out)

    # rows of one id and text have the same hits, so their digest stands for them, whatever the id
    keyed = rows.withColumn("row", F.md5(F.concat(F.md5("text"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))

    def lines(batches: Iterator[pa.RecordBatch], part: int, words: Broadcast) -> Iterator[pa.RecordBatch]:
        keys = ((row, list({k for k in line_keys(text, min_chars) if k is not None})) for row, text in rows_of(batches, "row", "text"))
        found = ((row, key) for row, some in keys for key in suspected(some, words.value, part, parts))
        yield from batched(found, pa.schema([("row", pa.string()), ("key", pa.binary())]))

    each = [keyed.mapInArrow(partial(lines, part=k, words=words), "row string, key binary") for k, words in enumerate(filters)]
    hits = reduce(DataFrame.union, each).join(repeated, "key").groupBy("row").agg(F.collect_set(F.struct("key", "first")).alias("hits"))
    with_hits = keyed.join(hits, "row", "left").select("doc_id", "text", "hits")

    def rebuild_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((doc_id, *_rebuilt(text, {x["key"]: x["first"] for x in hits or ()}, doc_id, min_chars)) for doc_id, text, hits in rows_of(batches, "doc_id", "text", "hits"))
        yield from batched(found, out_arrow, 512)

    return with_hits.mapInArrow(rebuild_joined, out)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, row, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d
),
k AS (
  SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l
),
r AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT row) >= 10)
SELECT doc_id, count(*) AS n_lines, count(r.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (r.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN r USING (key) GROUP BY doc_id, row
"""
