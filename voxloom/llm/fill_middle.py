r"""Fill-in-the-middle transformation over run-length encoded character classes.

A cut is a number of code points, a text is UTF-8 bytes.  The class of a character is the number of its bytes; a chunk
of texts is stored as its maximal runs of one class, each with the code points and the bytes before it.  A binary
search finds the run that holds a cut, and the byte there follows by arithmetic: the run's first byte plus the class times
the code points between.  Texts of one class are one run, however long they are, and no text is decoded.

Where the cuts go, and which form a document takes, is decided by SHA-256 of ``seed:id`` alone, so a retried task, another
partitioning or a copy of the row gives the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Bytes of text whose runs are made at once, unless a single text has more; rows of one result batch at most.
CHUNK_BYTES, CHUNK_ROWS = 2 << 20, 2048
#: Bytes of the character that each byte begins, 0 for a byte that continues one.
_CLASS = np.array([1] * 128 + [0] * 64 + [2] * 32 + [3] * 16 + [4] * 16, np.int64)


class ClassRuns:
    """Maximal runs of characters of one class in UTF-8 ``data``, with the units (code points) and bytes before each."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        if n and data.max() < 128:
            first, self.width, units = np.zeros(1, np.int64), np.ones(1, np.int64), np.zeros(1, np.int64)
            total = n
        else:
            begins = np.flatnonzero((data & 0xC0) != 0x80)
            classes = _CLASS[data[begins]]
            units = np.flatnonzero(np.r_[True, classes[1:] != classes[:-1]]) if len(classes) else np.zeros(0, np.int64)
            first, self.width, total = begins[units], classes[units], len(begins)
        # an end mark, so that the end of the data is a cut like any other
        self.units, self.bytes, self.width = np.r_[units, total], np.r_[first, n], np.r_[self.width, 1]

    def byte_at(self, unit: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.units, unit, side="right") - 1
        return self.bytes[run] + (unit - self.units[run]) * self.width[run]

    def unit_at(self, byte: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.bytes, byte, side="right") - 1
        return self.units[run] + (byte - self.bytes[run]) // self.width[run]


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most CHUNK_ROWS rows and about CHUNK_BYTES bytes of text, one row at least."""
    sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = min(at + CHUNK_ROWS, max(at + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, side="right"))))
        yield batch.slice(at, to - at)
        at = to


def _values(array: pa.Array) -> np.ndarray:
    return array.to_numpy(zero_copy_only=False).astype(np.int64)


def transform_chunk(texts: list[bytes], h: list[np.ndarray], plain_percent: int, spm_percent: int) -> tuple[list[int], list[str], list[int | None], list[int | None], list[bytes]]:
    """Code points, form, code points of prefix and middle, and output of each text."""
    whole = b"".join(texts)
    ends = np.cumsum([0, *map(len, texts)])
    runs = ClassRuns(np.frombuffer(whole, np.uint8))
    begin = runs.unit_at(ends)
    n = np.diff(begin)
    one, two = h[0] % (n + 1), h[1] % (n + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    a, b = runs.byte_at(begin[:-1] + low), runs.byte_at(begin[:-1] + high)
    plain, spm = h[2] % 100 >= 100 - plain_percent, h[3] % 100 < spm_percent
    form, prefix, middle, out = [], [], [], []
    for k, text in enumerate(texts):
        if not text or plain[k] or PREFIX in text or SUFFIX in text or MIDDLE in text:
            form.append("plain")
            prefix.append(None)
            middle.append(None)
            out.append(text)
            continue
        i, j, at, to = int(a[k]), int(b[k]), int(ends[k]), int(ends[k + 1])
        form.append("spm" if spm[k] else "psm")
        prefix.append(int(low[k]))
        middle.append(int(high[k] - low[k]))
        parts = (SUFFIX, whole[j:to], PREFIX, whole[at:i]) if spm[k] else (PREFIX, whole[at:i], SUFFIX, whole[j:to])
        out.append(b"".join((*parts, MIDDLE, whole[i:j])))
    return n.tolist(), form, prefix, middle, out


def fill_middle(docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (code points), form, prefix_chars, middle_chars, output of every row; no shuffle.

    ``plain`` (the text as it is) if the text is null or empty, holds a sentinel, or is one of ``plain_percent``; of the
    others ``spm_percent`` are suffix, prefix, middle, and the rest prefix, suffix, middle.  A null id is hashed as an
    empty one.  Repeated rows give equal rows; very long texts are cut whole; an empty table gives an empty result;
    further columns are not read.
    """
    ident = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(ident, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).cast("binary").alias("text"), *numbers)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _chunks(batch):
                n, form, prefix, middle, out = transform_chunk(part.column("text").to_pylist(), [_values(part.column(f"h{k}")) for k in (1, 2, 3, 4)], plain_percent, spm_percent)
                counts = (pa.array(x, pa.int64()) for x in (prefix, middle))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), *counts, pa.array(out, pa.binary())], names=names)

    made = rows.mapInArrow(run, f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output binary")
    return made.withColumn("output", F.col("output").cast("string"))


def restored(rows: DataFrame) -> DataFrame:
    """``rows`` with the column ``restored``: the text rebuilt from ``output`` and ``form`` alone.

    A transformed text holds each sentinel once, so the parts lie between them; a null output or form gives null; repeated
    rows and empty tables stay as they are; other columns are kept.
    """
    cut = F.split("output", f"{PREFIX.decode()}|{SUFFIX.decode()}|{MIDDLE.decode()}", -1)
    first, second, middle = (F.get(cut, k) for k in (1, 2, 3))
    psm, spm = F.concat(first, middle, second), F.concat(second, middle, first)
    return rows.withColumn("restored", F.when(F.col("form") == "plain", F.col("output")).when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS h FROM documents),
n AS (SELECT *, length(t)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, substr(t, 1, lo) AS pre, substr(t, lo + 1, hi - lo) AS mid, substr(t, hi + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars, CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
