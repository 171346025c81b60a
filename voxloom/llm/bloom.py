"""Bloom filters of 64-bit hashes with two levels: seen once, and seen twice.

A filter is an array of 64-bit words; a hash sets three bits of one word.  Tasks mark their hashes in sparse
blocks, and blocks merge by number: ``twice = twice | twice' | once & once'``, so no hash of two tasks is missed.
The size follows the number of hashes up to a bound, which is what is broadcast; fuller filters suspect more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batched, rows_of

#: 64-bit words of a block, bits for each hash, most bytes of a filter, hashes marked at once.
BLOCK, BITS, MAX_BYTES, FLUSH = 8192, 16, 64 << 20, 400_000
MARKS = "block long, at binary, once binary, twice binary"
_MARKS = pa.schema([("block", pa.int64()), ("at", pa.binary()), ("once", pa.binary()), ("twice", pa.binary())])


def words_for(n: int, max_bytes: int = MAX_BYTES) -> int:
    """The number of words for ``n`` hashes: whole blocks."""
    return -(-max(1, min(max_bytes // 8, n * BITS // 64)) // BLOCK) * BLOCK


def places(h: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The word of each hash and the three bits in it."""
    one = np.uint64(1)
    mask = (one << (h & np.uint64(63))) | (one << ((h >> np.uint64(6)) & np.uint64(63))) | (one << ((h >> np.uint64(12)) & np.uint64(63)))
    return ((h >> np.uint64(24)) % np.uint64(words)).astype(np.int64), mask


def add(words: np.ndarray, h: np.ndarray) -> None:
    at, mask = places(h, len(words))
    np.bitwise_or.at(words, at, mask)


def contains(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    at, mask = places(h, len(words))
    return (words[at] & mask) == mask


def _marks(hashes: np.ndarray, words: int, all_twice: bool) -> Iterator[tuple]:
    h, n = np.unique(hashes, return_counts=True)
    at, mask = places(h, words)
    order = np.argsort(at, kind="stable")
    at, mask, n = at[order], mask[order], n[order]
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    once = np.bitwise_or.reduceat(mask, starts)
    twice = once if all_twice else np.bitwise_or.reduceat(np.where(n > 1, mask, np.uint64(0)), starts)
    at = at[starts]
    cuts = np.flatnonzero(np.r_[True, at[1:] // BLOCK != at[:-1] // BLOCK, True])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(at[a] // BLOCK), (at[a:b] % BLOCK).astype(np.uint16).tobytes(), once[a:b].tobytes(), twice[a:b].tobytes()


def marked(hashes: Iterator[np.ndarray], words: int, all_twice: bool = False) -> Iterator[pa.RecordBatch]:
    """The marks of one task's hashes; ``all_twice``: once is enough for the merged filter."""

    def found() -> Iterator[tuple]:
        held: list[np.ndarray] = []
        n = 0
        for h in hashes:
            held.append(h)
            n += len(h)
            if n >= FLUSH:
                yield from _marks(np.concatenate(held), words, all_twice)
                held, n = [], 0
        if n:
            yield from _marks(np.concatenate(held), words, all_twice)

    yield from batched(found(), _MARKS, 64)


def merged(marks: DataFrame, words: int) -> np.ndarray:
    """The filter of what was marked twice; blocks merge on the executors, the driver gets the whole."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> Iterator[tuple]:
            now, once, twice = None, np.zeros(BLOCK, np.uint64), np.zeros(BLOCK, np.uint64)
            for block, at, o, t in rows_of(batches, "block", "at", "once", "twice"):
                if block != now:
                    if now is not None:
                        yield now, twice.tobytes()
                    now, once, twice = block, np.zeros(BLOCK, np.uint64), np.zeros(BLOCK, np.uint64)
                i, o, t = np.frombuffer(at, np.uint16), np.frombuffer(o, np.uint64), np.frombuffer(t, np.uint64)
                twice[i] |= t | (once[i] & o)
                once[i] |= o
            if now is not None:
                yield now, twice.tobytes()

        yield from batched(out(), pa.schema([("block", pa.int64()), ("twice", pa.binary())]), 16)

    whole = np.zeros(words, np.uint64)
    for block, t in marks.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block long, twice binary").collect():
        whole[block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(t, np.uint64)
    return whole


def filter_of(rows: DataFrame, n: int, all_twice: bool, max_bytes: int = MAX_BYTES) -> np.ndarray:
    """The filter of the long column ``h`` of ``rows``, which has about ``n`` rows."""
    words = words_for(n, max_bytes)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from marked((b.column("h").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for b in batches), words, all_twice)

    return merged(rows.select("h").mapInArrow(mark, MARKS), words)
