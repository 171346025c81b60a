r"""Periodic runs of words: all maximal stretches that repeat with a period of q words, ``min_exponent`` times or more.

The method is that of longest previous factors.  A batch of documents is one array of word numbers in which the words of
different documents differ.  Its suffix order and common prefixes give, at every place, the longest factor that occurs
earlier too, and where: the nearest smaller positions before and after in suffix order are the two candidates.  Taking such
factors greedily gives LZ blocks; factors under ``MIN_BLOCK`` words are single words.

A run that touches the edge of a block is found there by Main's extensions: for each period that the block allows, the
common prefix and suffix of the edge and of the place one period away say how far the period holds.  A run that lies
strictly inside a block is a copy of an earlier one: the runs found so far are kept in buckets by their first word, and each
block, from left to right, copies what its source holds.  Of the periods found for one stretch the smallest is its own.

Blocks of under three words have nothing to extend for runs of six words and four periods: a run with first edge e after its
first period either goes on for two periods (and three words) after e, so the block at e is as long, or reaches three words
(two periods) or more back from e into the block before it.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CLASS, rows_of, text_of
from .suffix import SuffixRanks

MIN_WORDS, MIN_EXPONENT = 6, 4
MIN_BLOCK = 3
#: Words in one suffix array, unless a single document has more; pairs of an edge and a period that are extended at once.
BATCH_WORDS, PAIRS = 150_000, 1 << 20


def lz_blocks(ranks: SuffixRanks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, length and source of the LZ blocks of ``MIN_BLOCK`` words or more."""
    order = ranks.order((MIN_BLOCK - 1).bit_length() - 1)
    before, after, open_ = [-1] * len(order), [-1] * len(order), []
    places = order.tolist()
    for r, at in enumerate(places):
        while open_ and places[open_[-1]] > at:
            after[open_.pop()] = at
        if open_:
            before[r] = places[open_[-1]]
        open_.append(r)
    found = []
    for source in (before, after):
        source = np.asarray(source, np.int64)
        has = source >= 0
        length = np.zeros(len(order), np.int64)
        length[has] = ranks.common_prefix(order[has], source[has])
        found.append((length, source))
    first = found[0][0] >= found[1][0]
    length, source = np.where(first, found[0][0], found[1][0]), np.where(first, found[0][1], found[1][1])
    long = np.flatnonzero(length >= MIN_BLOCK)
    long = long[np.argsort(order[long], kind="stable")]
    taken, end = [], 0
    for k, at, n in zip(long.tolist(), order[long].tolist(), length[long].tolist(), strict=True):
        if at >= end:
            taken.append(k)
            end = at + n
    return order[taken], length[taken], source[taken]


def edge_runs(ranks: SuffixRanks, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Rows of start, end and period of the stretches that Main's extensions find at the edges of blocks."""
    # at the first edge the root lies to the right, within the block; at the last one to the left, twice within it
    edge, roots = np.r_[begin, begin + length], np.r_[length - 1, length // 2]
    right = np.arange(len(edge)) < len(begin)
    found = [np.zeros((0, 3), np.int64)]
    at, upto = 0, np.cumsum(roots)
    while at < len(edge):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, side="right")))
        n = roots[at:to]
        which = np.repeat(np.arange(at, to), n)
        q = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + 1
        low = np.where(right[which], edge[which], edge[which] - q)
        keep = low + q <= ranks.n
        low, q = low[keep], q[keep]
        start, end = low - ranks.common_suffix(low, low + q), low + q + ranks.common_prefix(low, low + q)
        good = end - start >= np.maximum(MIN_WORDS, MIN_EXPONENT * q)
        found.append(np.c_[start, end, q][good])
        at = to
    return np.concatenate(found)


def all_runs(symbols: np.ndarray) -> np.ndarray:
    """Rows of start, end and period of every run, by start, then period."""
    if not len(symbols):
        return np.zeros((0, 3), np.int64)
    ranks = SuffixRanks(symbols)
    begin, length, source = lz_blocks(ranks)
    runs = edge_runs(ranks, begin, length)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if not len(runs):
        return runs
    # one stretch has one period of its own: the smallest
    runs = runs[np.r_[True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1)]]
    buckets: dict[int, dict[int, int]] = {}
    for start, end, q in runs.tolist():
        buckets.setdefault(start, {})[end] = q
    starts = sorted(buckets)
    for b, n, p in zip(begin.tolist(), length.tolist(), source.tolist(), strict=True):
        if n < MIN_WORDS + 2:
            continue
        # a copied run may itself lie in the source of a later one: the list of starts grows ahead of this loop
        k = bisect.bisect_left(starts, p + 1)
        while k < len(starts) and starts[k] < p + n:
            for end, q in buckets[starts[k]].items():
                if end < p + n:
                    start = starts[k] + b - p
                    if start not in buckets:
                        buckets[start] = {}
                        bisect.insort(starts, start)
                    buckets[start].setdefault(end + b - p, q)
            k += 1
    return np.array([(s, e, q) for s in starts for q, e in sorted((q, e) for e, q in buckets[s].items())], np.int64)


def measure(texts: list[bytes]) -> tuple[list[int], list[np.ndarray], list[bytes]]:
    """Words, runs (start, length, period) and collapsed text of each text."""
    symbols: list[int] = []
    words = [t.split() for t in texts]
    base = 0
    for w in words:
        own: dict[bytes, int] = {}
        symbols.extend([base + own.setdefault(x, len(own)) for x in w])
        base += len(own)
    found = all_runs(np.asarray(symbols, np.int64))
    ends = np.cumsum([0, *map(len, words)])
    cut = np.searchsorted(found[:, 0], ends)
    runs, texts_out = [], []
    for k, w in enumerate(words):
        own_runs = found[cut[k] : cut[k + 1]] - np.array([ends[k], ends[k], 0])
        if len(own_runs):
            # a word goes if any run holds it after that run's first period
            edge = np.zeros(len(w) + 1, np.int64)
            np.add.at(edge, own_runs[:, 0] + own_runs[:, 2], 1)
            np.subtract.at(edge, own_runs[:, 1], 1)
            w = [x for x, gone in zip(w, np.cumsum(edge[:-1]).tolist(), strict=True) if not gone]
            own_runs[:, 1] -= own_runs[:, 0]
        runs.append(own_runs)
        texts_out.append(b" ".join(w))
    return np.diff(ends).tolist(), runs, texts_out


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _batch(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
    n, runs, out = measure(texts)
    flat = np.concatenate([np.zeros((0, 3), np.int64), *runs])
    offsets = np.cumsum([0, *map(len, runs)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(c) for c in np.ascontiguousarray(flat.T)], fields=list(_RUN)))
    return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), lists, pa.array(out, pa.binary())], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (array of start, length, period by start, then period) and collapsed (kept words joined by one space).

    Words are maximal runs of non-space characters.  Null and empty texts have no words and no runs; repeated rows are measured
    each; very long texts are measured whole, in an array of their own; an empty table gives an empty result; further columns
    are not read.  No shuffle: a row depends on its own text alone.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).cast("binary").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some: list[bytes] = []
            size = at = 0
            for (text,) in rows_of(iter([batch]), "text"):
                some.append(text)
                size += len(text)
                if size >= 6 * BATCH_WORDS:
                    yield _batch(batch.column("doc_id").slice(at, len(some)), some)
                    at += len(some)
                    some, size = [], 0
            if some:
                yield _batch(batch.column("doc_id").slice(at, len(some)), some)

    made = rows.mapInArrow(run, f"doc_id {id_type}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary")
    return made.withColumn("collapsed", F.col("collapsed").cast("string"))


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text, one text in ten made periodic from a place on: with h the CRC-32 of the id, g = h / 10 and n words, where
    h % 10 = 0 the words from a = g % n on repeat the first 1 + (n - a) / (3 + g % 8) of them.

    A null id plants nothing; a null text is empty; all other texts stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    whole = text_of(text_col)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = F.when(n > 0, g % n).otherwise(0).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        root = F.slice(words, a + 1, p)
        times = F.floor((n - a) / p).cast("int")
        periodic = F.concat(F.slice(words, F.lit(1), a), F.flatten(F.array_repeat(root, times)), F.slice(root, F.lit(1), (n - a) % p))
        return F.when(n > 0, F.array_join(periodic, " "))

    # the words are the variable of a function, so a text is cut once, however often they are named
    words = F.array(F.array_remove(F.split(whole, f"{WS_CLASS}+"), ""))
    text = F.when(h % 10 == 0, F.coalesce(F.get(F.transform(words, repeated), F.lit(0)), whole)).otherwise(whole)
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))


def greatest(runs: Column) -> Column:
    """The run with the greatest exact length by period of an array in order of start, then period; the first of equals, null of none."""
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, r: F.when(better(best, r), r).otherwise(best))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period and exponent_milli of the greatest run, runs_sha256, collapsed_sha256."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    best = found.withColumn("best", greatest(F.col("runs")))
    milli = F.expr("1000 * best.length div best.period")
    return best.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", milli.alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
