"""Quality classifier: a factorisation machine over hashed words, structure statistics and text metadata.

The score of a document with features x is sigmoid(b + w.x + sum over pairs <v_i, v_j> x_i x_j).  The pair term is
computed in linear time as half of sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).  Words are hashed into
``2**HASH_BITS`` features with length-normalised logarithmic counts; structure statistics are standardised.

The model is fitted on the driver from at most ``max_rows`` labelled rows (the only sampling here: the rows with
the smallest hashes of their ids), whose features, not texts, are collected.  Scoring is a map without a shuffle.
Labels, language, source and ids are no inputs of a score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WS, rows_of, text_of, written

HASH_BITS = 16
FACTORS = 8
#: Passes over the rows, and steps at least (few rows take more passes).
EPOCHS, STEPS = 12, 400
MAX_ROWS = 8_000
#: Bytes of features that the driver takes at most; later rows of the sample are left out.
MAX_FEATURE_BYTES = 256 << 20
THRESHOLD = 0.7
SEED = 7
N_STATS = 16
#: Word features scored by one set of array operations, unless one text has more.
SCORED_AT_ONCE = 50_000
_CACHE, _CACHED_CHARS = 300_000, 40
_PUNCTUATION = ".,;:!?\"'()-"
_MARKS = "#*$%&|<>@^~=_+{}[]\\/"
_DIGITS = re.compile(r"[0-9]")
_UPPER = re.compile(r"[A-Z]")
_hashes: dict[bytes, int] = {}


def _hash(word: bytes) -> int:
    h = zlib.crc32(word) >> (32 - HASH_BITS)
    if len(word) <= _CACHED_CHARS:
        if len(_hashes) >= _CACHE:
            _hashes.clear()
        _hashes[word] = h
    return h


def features(text: str, meta: tuple = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed word features (places and values) of a whole text, and its structure statistics with the logarithms of ``meta``."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    get = _hashes.get
    places, counts = np.unique(np.array([h if (h := get(w)) is not None else _hash(w) for w in words], np.int64), return_counts=True)
    values = 1 + np.log(counts)
    values /= max(1e-9, math.sqrt(float(values @ values)))
    n, w = max(1, len(text)), max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip(WS)]
    marks, spaces = sum(map(text.count, _MARKS)), sum(map(text.count, WS))
    own = set(words)
    stats = np.array(
        [
            math.log1p(len(text)),
            math.log1p(len(words)),
            (n - spaces) / w,
            marks / n,
            min(1.0, marks / w),
            sum(map(text.count, _PUNCTUATION)) / n,
            len(_DIGITS.findall(text)) / n,
            len(_UPPER.findall(text)) / n,
            (len(raw) - len(text)) / n,
            len(own) / w,
            1 - len(set(lines)) / max(1, len(lines)),
            math.log1p(n / max(1, len(lines))),
            float(counts.max()) / w if len(words) else 0.0,
            math.log1p(max(map(len, own), default=0)),
            spaces / n,
            text.count(".") / w,
            *(math.nan if m is None else math.log1p(max(0.0, m)) for m in meta),
        ]
    )
    return places, values, stats


@dataclass
class Model:
    bias: float
    w: np.ndarray  # of words, then of statistics
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def dense(self, stats: np.ndarray) -> np.ndarray:
        """Standardised statistics, from -1 to 1; a missing one is the mean."""
        return np.nan_to_num(np.clip((stats - self.mean) / self.scale, -4, 4) / 4)

    def score_all(self, rows: list[tuple]) -> np.ndarray:
        """The scores of rows (places, values, statistics), all of them by one set of array operations."""
        if not rows:
            return np.zeros(0)
        tail = np.arange(len(self.mean)) + (1 << HASH_BITS)
        dense = self.dense(np.array([r[2] for r in rows]))
        at = np.concatenate([x for r in rows for x in (r[0], tail)])
        x = np.concatenate([v for r, d in zip(rows, dense, strict=True) for v in (r[1], d)])
        starts = np.cumsum([0, *(len(r[0]) + len(tail) for r in rows[:-1])])
        vx = self.v[at] * x[:, None]
        total = np.add.reduceat(vx, starts)
        z = self.bias + np.add.reduceat(self.w[at] * x, starts) + 0.5 * ((total * total).sum(1) - np.add.reduceat((vx * vx).sum(1), starts))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def score(self, text: str, meta: tuple = ()) -> float:
        return float(self.score_all([features(text, meta)])[0])


def fit(rows: list[tuple], factors: int = FACTORS, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.01, decay: float = 1e-5, seed: int = SEED) -> Model:
    """The model of rows (places, values, stats, label), by Adam on the logistic loss."""
    n = len(rows[0][2]) if rows else N_STATS
    size = (1 << HASH_BITS) + n
    rng = np.random.default_rng(seed)
    w, v, bias = np.zeros(size), rng.normal(0, 0.02, (size, factors)), 0.0
    if not rows:
        return Model(0.0, w, v * 0, np.zeros(n), np.ones(n))
    stats = np.array([r[2] for r in rows], float)
    known = ~np.isnan(stats)
    many = np.maximum(known.sum(0), 1)
    mean = np.where(known, stats, 0).sum(0) / many
    scale = np.sqrt((np.where(known, stats - mean, 0) ** 2).sum(0) / many) + 1e-6
    model = Model(0.0, w, v, mean, scale)
    dense = model.dense(stats)
    tail = np.arange(n) + (1 << HASH_BITS)
    at = [np.r_[np.asarray(r[0], np.int64), tail] for r in rows]
    xs = [np.r_[np.asarray(r[1], float), d] for r, d in zip(rows, dense, strict=True)]
    y = np.array([r[3] for r in rows], float)
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    bias = math.log(share / (1 - share))
    mw, sw, mv, sv = np.zeros(size), np.zeros(size), np.zeros((size, factors)), np.zeros((size, factors))
    mb = sb = 0.0
    t = 0
    for _ in range(max(epochs, -(-STEPS * batch // len(rows)))):
        order = rng.permutation(len(rows))
        for k in range(0, len(rows), batch):
            some = order[k : k + batch]
            i, x = np.concatenate([at[j] for j in some]), np.concatenate([xs[j] for j in some])
            starts = np.cumsum([0, *(len(at[j]) for j in some)])[:-1]
            doc = np.repeat(np.arange(len(some)), np.diff(np.r_[starts, len(i)]))
            vx = v[i] * x[:, None]
            total = np.add.reduceat(vx, starts)
            z = bias + np.add.reduceat(w[i] * x, starts) + 0.5 * ((total * total).sum(1) - np.add.reduceat((vx * vx).sum(1), starts))
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[some]) / len(some)
            used, inv = np.unique(i, return_inverse=True)
            gx = g[doc] * x
            gw = np.bincount(inv, gx, len(used)) + decay * w[used]
            gv = np.stack([np.bincount(inv, gx * (total[doc, f] - vx[:, f]), len(used)) for f in range(factors)], 1) + decay * v[used]
            t += 1
            fix = math.sqrt(1 - 0.999**t) / (1 - 0.9**t)
            for value, m, s, grad in ((w, mw, sw, gw), (v, mv, sv, gv)):
                m[used] = 0.9 * m[used] + 0.1 * grad
                s[used] = 0.999 * s[used] + 0.001 * grad * grad
                value[used] -= rate * fix * m[used] / (np.sqrt(s[used]) + 1e-8)
            gb = float(g.sum())
            mb, sb = 0.9 * mb + 0.1 * gb, 0.999 * sb + 0.001 * gb * gb
            bias -= rate * fix * mb / (math.sqrt(sb) + 1e-8)
    return Model(bias, w, v, mean, scale)


def _meta(columns: tuple[str, ...]) -> Column:
    """Numeric metadata columns as an array of doubles."""
    return F.array(*(F.col(c).cast("double") for c in columns)).cast("array<double>").alias("meta")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row's label is never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = MAX_ROWS, max_bytes: int = MAX_FEATURE_BYTES, id_col: str = "doc_id", text_col: str = "text", meta_cols: tuple[str, ...] = ()) -> Model:
    """Fits the model on at most ``max_rows`` labelled ids that aren't held out, and ``max_bytes`` of their features.

    A null id, label or text is not learnt from.  Of repeated labels of an id the larger counts, of repeated documents one;
    texts are read whole.  Without a labelled row (an empty table) the model scores every text 0.5.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
    # at most max_rows rows of two numbers: a proven size for the broadcast
    drawn = F.broadcast(known.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(max_rows))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), _meta(meta_cols)).where(F.col("text").isNotNull()).join(drawn, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(doc_id, label, *features(t, tuple(meta))) for doc_id, label, t, meta in rows_of(iter([batch]), "doc_id", "label", "text", "meta")]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([str(r[0]) for r in found]), pa.array([r[1] for r in found], pa.int32()), *(pa.array([r[k].astype(f).tobytes() for r in found], pa.binary()) for k, f in ((2, "<i4"), (3, "<f4"), (4, "<f8")))],
                    names=["doc_id", "label", "places", "values", "stats"],
                )

    found = rows.mapInArrow(run, "doc_id string, label int, places binary, values binary, stats binary")
    # one row of each id, whatever the partitions, written once: at most max_rows rows, of which a prefix by hash fits the bytes
    one = written(found.groupBy("doc_id").agg(F.min(F.struct("places", "values", "stats", "label")).alias("x")).select("doc_id", "x.*"), "labelled-features")
    size = F.octet_length("places") + F.octet_length("values") + F.octet_length("stats")
    order = [F.xxhash64("doc_id", F.lit(SEED)), F.col("doc_id")]
    sizes = one.select("doc_id", F.sum(size).over(Window.orderBy(*order)).alias("so_far"))
    got = one.join(sizes.where(F.col("so_far") <= max_bytes).select("doc_id"), "doc_id").toLocalIterator()
    read = [(r.doc_id, r.label, np.frombuffer(r.places, "<i4"), np.frombuffer(r["values"], "<f4"), np.frombuffer(r.stats, "<f8")) for r in got]
    # the order of rows decides the batches, so it must not depend on the partitions
    read.sort(key=lambda r: r[0])
    return fit([(p, v, s, 1 if label >= 1 else 0) for _, label, p, v, s in read])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", meta_cols: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; ``meta_cols`` are those that the model was trained with.

    Null metadata count as average; null texts are scored as empty ones; repeated rows are scored each and alike; very long texts are read whole;
    an empty table gives an empty result; further columns are not read.
    """
    if len(model.mean) != N_STATS + len(meta_cols):
        raise ValueError("the model was trained with other metadata columns")
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), _meta(meta_cols))
    held = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores: list[np.ndarray] = []
            some, n = [], 0
            for t, meta in rows_of(iter([batch]), "text", "meta"):
                some.append(features(t, tuple(meta)))
                n += len(some[-1][0])
                if n >= SCORED_AT_ONCE:
                    scores.append(held.value.score_all(some))
                    some, n = [], 0
            scores.append(held.value.score_all(some))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(scores), pa.float64())], names=["doc_id", "score"])

    scored = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
