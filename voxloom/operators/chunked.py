"""Signals in chunks: rows (key, chunk, samples), ``size`` samples each but the last.

A long signal is many rows, dealt out by (key, chunk), so no task or row holds all of it.  What an operator needs beyond a
chunk's borders comes in one of three ways: as a *halo* (neighbours send their edges), as an *entry state* (a linear
recursion's state at a chunk's begin is a sum of few small vectors of the chunks before), or as sums by key.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Samples of a chunk, where nothing asks for more.
SIZE = 1 << 14
#: What a state may still weigh where it is left out.
NEGLIGIBLE = 1e-17


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``; where it is not set and all runs in one process (tests), a temporary one."""
    context = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at and not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="voxloom-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(at)
    return (at or context.getCheckpointDir()).rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """``df`` by a reliable checkpoint in the shared folder: computed once for all that reads it, safe from lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def chunks_of(signal: DataFrame, key: str, size: int = SIZE) -> DataFrame:
    """(key, chunk, samples) of a signal in long form (key, idx, value), whose places are 0, 1, 2, ..."""
    at = F.floor(F.col("idx") / size).cast("long").alias("chunk")
    pairs = F.sort_array(F.collect_list(F.struct(F.col("idx").cast("long").alias("idx"), F.col("value").cast("double").alias("value"))))
    return signal.groupBy(key, at).agg(pairs.alias("s")).select(key, "chunk", F.col("s.value").alias("samples"))


def long_of(chunks: DataFrame, key: str, size: int = SIZE, *own: str) -> DataFrame:
    """(key, idx, value), and the chunks' columns ``own``."""
    rows = chunks.select(key, "chunk", *own, F.posexplode("samples").alias("nth", "value"))
    return rows.select(key, (F.col("chunk") * size + F.col("nth")).alias("idx"), "value", *own)


def lengths(chunks: DataFrame, key: str) -> DataFrame:
    """(key, n): the samples of each signal."""
    return chunks.groupBy(key).agg(F.sum(F.size("samples")).cast("long").alias("n"))


def with_halo(chunks: DataFrame, key: str, left: int, right: int, size: int = SIZE) -> DataFrame:
    """``chunks`` with ``before`` and ``after``: at most ``left`` and ``right`` samples beyond the borders, fewer at a signal's ends.

    Every chunk sends its edges to the chunks that need them; one shuffle by (key, chunk), a few rows for each chunk.
    """
    n = F.size("samples")
    parts = [F.struct(F.col("chunk").alias("to"), F.lit(0).alias("from"), F.col("samples").alias("part"))]
    for k in range(1, -(-left // size) + 1):
        # the last of the left samples lie in the k-th chunk before
        some = min(size, left - (k - 1) * size)
        parts.append(F.struct((F.col("chunk") + k).alias("to"), F.lit(-k).alias("from"), F.slice("samples", F.greatest(n - some + 1, F.lit(1)), some).alias("part")))
    for k in range(1, -(-right // size) + 1):
        parts.append(F.struct((F.col("chunk") - k).alias("to"), F.lit(k).alias("from"), F.slice("samples", 1, min(size, right - (k - 1) * size)).alias("part")))
    sent = chunks.select(key, F.explode(F.array(*parts)).alias("x")).select(key, "x.*")
    met = sent.groupBy(key, F.col("to").alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("from", "part"))).alias("p"))
    own = lambda test: F.flatten(F.transform(F.filter("p", lambda x: test(x["from"])), lambda x: x["part"]))
    rows = met.where(F.exists("p", lambda x: x["from"] == 0))
    return rows.select(key, "chunk", own(lambda f: f == 0).alias("samples"), own(lambda f: f < 0).alias("before"), own(lambda f: f > 0).alias("after"))


#: Rows whose results a task holds in Python at a time; a batch that comes may have 10,000.
PIECE = 256


def mapped(rows: DataFrame, f: Callable, out: str, kind: str, *columns: str) -> DataFrame:
    """``rows`` with ``out`` = f of the columns, row by row in Arrow batches; arrays are numpy arrays there."""

    @F.pandas_udf(kind)
    def run(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for part in parts:
            # a single column comes by itself
            series = part if len(columns) > 1 else (part,)
            for at in range(0, len(series[0]), PIECE):
                yield pd.Series([f(*x) for x in zip(*(s.iloc[at : at + PIECE] for s in series), strict=True)], dtype=object)

    return rows.withColumn(out, run(*columns))


def grouped(chunks: DataFrame, key: str, k: int) -> DataFrame:
    """Chunks of ``k`` neighbours each."""
    if k == 1:
        return chunks
    met = chunks.groupBy(key, F.floor(F.col("chunk") / k).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct(F.col("chunk").alias("at"), "samples"))).alias("c"))
    return met.select(key, "chunk", F.flatten(F.col("c.samples")).alias("samples"))


def ungrouped(chunks: DataFrame, key: str, k: int, size: int) -> DataFrame:
    """Chunks of ``size`` samples again."""
    if k == 1:
        return chunks
    first = F.sequence(F.lit(0), F.greatest(F.ceil(F.size("samples") / size).cast("int") - 1, F.lit(0)))
    # cut before they are dealt out: a row of its own has its part, not a copy of the whole
    cut = F.transform(first, lambda i: F.struct((F.col("chunk") * k + i).alias("chunk"), F.slice("samples", i * size + 1, F.lit(size)).alias("samples")))
    return chunks.select(key, F.explode(cut).alias("x")).select(key, "x.*")


def convolved(chunks: DataFrame, key: str, response: np.ndarray, size: int = SIZE) -> DataFrame:
    """Every signal filtered by a finite response, over its own length."""
    n = len(response)
    if not n:
        return chunks

    def one(x: np.ndarray, before: np.ndarray) -> np.ndarray:
        return np.convolve(np.concatenate([before, x]), response)[len(before) : len(before) + len(x)]

    return mapped(with_halo(chunks, key, n - 1, 0, size), one, "samples", "array<double>", "samples", "before").select(key, "chunk", "samples")


# -- linear recursions --------------------------------------------------------------------------------------


class Recursion:
    """Second-order sections ((b, a), a[0] as a divisor) in a row, as one linear system: s' = A s + B x, y = C s + D x."""

    #: Samples that are run one after the other; stretches of so many run side by side.
    STRETCH = 128

    def __init__(self, sections: list[tuple[tuple, tuple]]):
        n = 2 * len(sections)
        self.a, self.b = np.zeros((n, n)), np.zeros(n)
        # y of the sections so far, as a row over the state and a factor of x
        c, d = np.zeros(n), 1.0
        for k, (b, a) in enumerate(sections):
            b, a = np.asarray(b, float) / a[0], np.asarray(a, float) / a[0]
            i = 2 * k
            into, into_x = c, d
            c, d = b[0] * into, b[0] * into_x
            c[i] += 1
            self.a[i], self.b[i] = b[1] * into - a[1] * c, b[1] * into_x - a[1] * d
            self.a[i, i + 1] += 1
            self.a[i + 1], self.b[i + 1] = b[2] * into - a[2] * c, b[2] * into_x - a[2] * d
        self.c, self.d, self.n = c, d, n
        rows, power = [], np.eye(n)
        for _ in range(self.STRETCH):
            rows.append(c @ power)
            power = self.a @ power
        self.ring, self.step = np.array(rows).T, power

    def power(self, k: int) -> np.ndarray:
        return np.linalg.matrix_power(self.a, k)

    def run(self, x: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The output from state ``entry`` on, and the state after it."""
        m = self.STRETCH
        lanes = max(1, -(-len(x) // m))
        u = np.zeros(lanes * m)
        u[: len(x)] = x
        u = u.reshape(lanes, m)
        # all stretches from rest, then what their true entry states add
        state, out = np.zeros((self.n, lanes)), np.empty((lanes, m))
        last = len(x) - (lanes - 1) * m
        for k in range(m):
            out[:, k] = self.c @ state + self.d * u[:, k]
            state = self.a @ state + np.outer(self.b, u[:, k])
            if k == last - 1:
                rest = state[:, -1].copy()
        entries = np.empty((lanes, self.n))
        for k in range(lanes):
            entries[k] = entry
            entry = self.step @ entry + state[:, k]
        out += entries @ self.ring
        end = self.power(last) @ entries[-1] + rest if len(x) else entries[-1]
        return out.ravel()[: len(x)], end


def filtered(chunks: DataFrame, key: str, sections: list[tuple[tuple, tuple]], size: int = SIZE) -> DataFrame:
    """Every signal through second-order sections, the recursion itself, chunk by chunk.

    Each chunk is run from rest for its end state alone.  The entry state of a chunk is the sum of the end states of those before,
    each carried over the chunks between; as states fade, few of them count, and they come by an equi-join of small rows.
    """
    system = Recursion(sections)
    rest = np.zeros(system.n)
    carried = [np.eye(system.n)]
    while np.abs(nxt := carried[-1] @ system.power(size)).max() > NEGLIGIBLE:
        carried.append(nxt)
    ends = mapped(chunks, lambda x: system.run(x, rest)[1], "end", "array<double>", "samples").select(key, "chunk", "end")
    entry = lambda e: np.concatenate([m @ e for m in carried])
    told = mapped(ends, entry, "told", "array<double>", "end").select(key, "chunk", "told")
    n = system.n
    each = F.array(*(F.struct((F.col("chunk") + k + 1).alias("to"), *(F.get("told", F.lit(k * n + i)).alias(f"s{i}") for i in range(n))) for k in range(len(carried))))
    entries = told.select(key, F.explode(each).alias("x")).select(key, "x.*").groupBy(key, F.col("to").alias("chunk")).agg(F.array(*(F.sum(f"s{i}") for i in range(n))).alias("entry"))
    rows = chunks.join(entries, [key, "chunk"], "left").withColumn("entry", F.coalesce("entry", F.array(*[F.lit(0.0)] * n)))
    return mapped(rows, lambda x, e: system.run(x, e)[0], "samples", "array<double>", "samples", "entry").select(key, "chunk", "samples")


def follow(level: np.ndarray, up: float, down: float, start: float = 0.0) -> np.ndarray:
    """A value that goes a part of the way to each of ``level``: ``1 - up`` of it upwards, ``1 - down`` downwards."""
    out, now = [], start
    for v in level.tolist():
        now = v + (up if v > now else down) * (now - v)
        out.append(now)
    return np.array(out)


def followed(chunks: DataFrame, key: str, rate: int, attack_ms: float, release_ms: float, size: int = SIZE) -> DataFrame:
    """The level of every signal: its magnitude, followed within ``attack_ms`` upwards and ``release_ms`` downwards (to 1/e).

    Two followers that start apart come together by the slower of the two factors at every sample; so a chunk follows the halo
    after which nothing of the start is left, and no state goes from chunk to chunk.  Chunks are grouped until they are as long
    as that halo (40 times the release: 32 seconds for 800 ms), so each is sent to one neighbour.
    """
    up, down = (float(np.exp(-1000 / (rate * ms))) for ms in (attack_ms, release_ms))
    halo = int(np.ceil(np.log(NEGLIGIBLE) / np.log(max(up, down))))
    k = -(-halo // size)
    one = lambda x, before: follow(np.abs(np.concatenate([before, x])), up, down)[len(before) :]
    rows = mapped(with_halo(grouped(chunks, key, k), key, halo, 0, k * size), one, "samples", "array<double>", "samples", "before")
    return ungrouped(rows.select(key, "chunk", "samples"), key, k, size)


def with_values(chunks: DataFrame, values: DataFrame, key: str, f: Callable, *columns: str) -> DataFrame:
    """``chunks`` with samples = f(samples, columns ...), the columns by key of the small table ``values`` (a row for each signal)."""
    return mapped(chunks.join(values, key), f, "samples", "array<double>", "samples", *columns).select(key, "chunk", "samples")


def paired(a: DataFrame, b: DataFrame, key: str, f: Callable) -> DataFrame:
    """Chunks of f(samples of a, samples of b) where both signals have a chunk."""
    other = b.select(key, "chunk", F.col("samples").alias("other"))
    return mapped(a.join(other, [key, "chunk"]), f, "samples", "array<double>", "samples", "other").select(key, "chunk", "samples")


# -- loudness -----------------------------------------------------------------------------------------------

#: Fixed values of the loudness standard: seconds of a block and of the steps between blocks, the absolute gate and the
#: relative one below the mean, what is added to the decibels; the two filters' frequencies, gain and quality.
BLOCK_S, STEP_S, ABSOLUTE, RELATIVE, OFFSET = 0.4, 0.1, -70.0, -10.0, -0.691
SHELF_HZ, SHELF_DB, SHELF_Q, HIGH_PASS_HZ, HIGH_PASS_Q = 1500.0, 4.0, 1 / np.sqrt(2), 38.0, 0.5
#: Fixed values of the loudness range: seconds of a window, the relative gate, and the part of the windows below and above.
RANGE_S, RANGE_RELATIVE, RANGE_LOW, RANGE_HIGH = 3.0, -20.0, 0.10, 0.95


def shelf(rate: int, hz: float, db: float, q: float, high: bool = True) -> tuple[tuple, tuple]:
    """A second-order shelf."""
    g, w = 10 ** (db / 40), 2 * np.pi * hz / rate
    c, r, s = np.cos(w), np.sqrt(g) * np.sin(w) / q, -1 if high else 1
    b = (g * ((g + 1) - s * (g - 1) * c + r), s * 2 * g * ((g - 1) - s * (g + 1) * c), g * ((g + 1) - s * (g - 1) * c - r))
    return b, ((g + 1) + s * (g - 1) * c + r, -s * 2 * ((g - 1) + s * (g + 1) * c), (g + 1) + s * (g - 1) * c - r)


def high_pass(rate: int, hz: float, q: float) -> tuple[tuple, tuple]:
    """A second-order high pass."""
    w = 2 * np.pi * hz / rate
    c, r = np.cos(w), np.sin(w) / (2 * q)
    return ((1 + c) / 2, -(1 + c), (1 + c) / 2), (1 + r, -2 * c, 1 - r)


def k_weights(rate: int) -> list[tuple[tuple, tuple]]:
    return [shelf(rate, SHELF_HZ, SHELF_DB, SHELF_Q), high_pass(rate, HIGH_PASS_HZ, HIGH_PASS_Q)]


def step_energies(chunks: DataFrame, key: str, rate: int, size: int = SIZE) -> DataFrame:
    """(key, step, energy): the sum of squares of the K-weighted signal in each tenth of a second."""

    def one(chunk: int, x: np.ndarray) -> list[tuple[int, float]]:
        step = ((chunk * size + np.arange(len(x))) / (STEP_S * rate) + 1e-9).astype(np.int64)
        first = int(step[0]) if len(x) else 0
        return [(first + k, float(e)) for k, e in enumerate(np.bincount(step - first, x * x))]

    rows = mapped(filtered(chunks, key, k_weights(rate), size), one, "e", "array<struct<step:bigint,energy:double>>", "chunk", "samples")
    return rows.select(key, F.explode("e").alias("e")).groupBy(key, "e.step").agg(F.sum("e.energy").alias("energy"))


def _windows(steps: DataFrame, key: str, n: DataFrame, rate: int, seconds: float) -> DataFrame:
    """(key, block, z): the mean square of each window of ``seconds``, a step apart; the last may end up to half a step after the signal."""
    k = round(seconds / STEP_S)
    spread = steps.select(key, F.explode(F.sequence(F.col("step") - (k - 1), F.col("step"))).alias("block"), "energy").where("block >= 0")
    blocks = F.rint((F.col("n") / rate - seconds) / STEP_S) + 1
    sums = spread.groupBy(key, "block").agg((F.sum("energy") / (seconds * rate)).alias("z"))
    return sums.join(n, key).where((F.col("n") >= seconds * rate) & (F.col("block") < blocks)).select(key, "block", "z")


def _db(z: Column) -> Column:
    return OFFSET + 10 * F.log10(z)


def integrated(chunks: DataFrame, key: str, rate: int, size: int = SIZE) -> DataFrame:
    """(key, lufs): integrated loudness with both gates; -70 where no block is louder, null for signals under a block.

    Squares are summed by tenths of a second, map-side; blocks, the two gates and their means are aggregations over those rows.
    """
    return _integrated(settled(step_energies(chunks, key, rate, size)), lengths(chunks, key), key, rate)


def _integrated(steps: DataFrame, n: DataFrame, key: str, rate: int) -> DataFrame:
    blocks = _windows(steps, key, n, rate, BLOCK_S).where((F.col("z") > 0) & (_db(F.col("z")) >= ABSOLUTE))
    gate = blocks.groupBy(key).agg((_db(F.avg("z")) + RELATIVE).alias("gate"))
    loud = blocks.join(gate, key).where((_db(F.col("z")) > F.col("gate")) & (_db(F.col("z")) > ABSOLUTE)).groupBy(key).agg(_db(F.avg("z")).alias("lufs"))
    return n.join(loud, key, "left").select(key, F.when(F.col("n") >= BLOCK_S * rate, F.coalesce("lufs", F.lit(ABSOLUTE))).alias("lufs"))


def short_terms(steps: DataFrame, n: DataFrame, key: str, rate: int) -> DataFrame:
    """(key, block, loudness) of windows of three seconds, a tenth of a second apart, from ``step_energies`` and ``lengths``."""
    return _windows(steps, key, n, rate, RANGE_S).where("z > 0").select(key, "block", _db(F.col("z")).alias("loudness"))


def loudness_range(windows: DataFrame, key: str) -> DataFrame:
    """(key, low, high, lra) of short-term loudnesses: between the 10th and the 95th of a hundred of the gated windows."""
    z = F.pow(10.0, (F.col("loudness") - OFFSET) / 10)
    rows = windows.where(F.col("loudness") >= ABSOLUTE)
    gate = rows.groupBy(key).agg((_db(F.avg(z)) + RANGE_RELATIVE).alias("gate"))
    edges = rows.join(gate, key).where(F.col("loudness") >= F.col("gate")).groupBy(key).agg(F.percentile("loudness", F.array(F.lit(RANGE_LOW), F.lit(RANGE_HIGH))).alias("p"))
    return edges.select(key, F.col("p")[0].alias("low"), F.col("p")[1].alias("high"), (F.col("p")[1] - F.col("p")[0]).alias("lra"))


#: Points between samples at which peaks are looked for, and samples on each side that make one.
OVERSAMPLING, TAPS = 4, 16


def _between() -> np.ndarray:
    """For each point between two samples, the weights of the samples around it: windowed sinc."""
    at = np.arange(-TAPS + 1, TAPS + 1)
    shifts = np.arange(OVERSAMPLING)[:, None] / OVERSAMPLING
    weights = np.sinc(at - shifts) * (0.5 + 0.5 * np.cos(np.pi * (at - shifts) / TAPS))
    return weights


def peaks(x: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """For each sample, the largest magnitude there and at the points up to the next."""
    padded = np.concatenate([np.zeros(TAPS - len(before)), before, x, after, np.zeros(TAPS - len(after))])
    around = np.lib.stride_tricks.sliding_window_view(padded, 2 * TAPS)[1 : len(x) + 1]
    return np.abs(around @ _between().T).max(1) if len(x) else np.zeros(0)


def true_peaks(chunks: DataFrame, key: str, size: int = SIZE) -> DataFrame:
    """(key, true_peak) with points between the samples."""
    rows = with_halo(chunks, key, TAPS, TAPS, size)
    top = lambda x, b, a: float(peaks(x, b, a).max())
    return mapped(rows, top, "top", "double", "samples", "before", "after").groupBy(key).agg(F.max("top").alias("true_peak"))


def limited(chunks: DataFrame, key: str, rate: int, top: float, size: int = SIZE, look_ms: float = 5.0) -> DataFrame:
    """Every signal with true peaks of at most ``top``: the gain falls in the ``look_ms`` before a peak and rises in those after.

    The gain a sample needs is held for ``look_ms`` around it (a running minimum), then averaged over as long, so it is
    smooth, and at the sample itself no more than what is needed.
    """
    w = max(1, int(rate * look_ms / 1000))
    halo = 2 * w + TAPS

    def one(x: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        whole = np.concatenate([before, x, after])
        need = np.minimum(1.0, top / np.maximum(peaks(whole, np.zeros(0), np.zeros(0)), 1e-12))
        # a point between two samples binds both
        need[1:] = np.minimum(need[1:], need[:-1])
        held = np.lib.stride_tricks.sliding_window_view(np.pad(need, w, constant_values=1.0), 2 * w + 1).min(1)
        sums = np.concatenate([[0.0], np.cumsum(np.pad(held, (w, w), mode="edge"))])
        gain = (sums[2 * w + 1 :] - sums[: -2 * w - 1]) / (2 * w + 1)
        return (whole * gain)[len(before) : len(before) + len(x)]

    return mapped(with_halo(chunks, key, halo, halo, size), one, "samples", "array<double>", "samples", "before", "after").select(key, "chunk", "samples")


def loudness_normalized(chunks: DataFrame, key: str, rate: int, target: float = -16.0, peak_db: float = -1.5, most_range: float = 11.0, size: int = SIZE, passes: int = 2) -> DataFrame:
    """Every signal at an integrated loudness of ``target``, a loudness range of ``most_range`` and true peaks of ``peak_db``, at most.

    Each pass measures loudness, range and the loudness of blocks.  Where the range is too wide, the gain follows the blocks (between
    the edges of the range, straight from block to block) so that what is above or below the mean shrinks in proportion; what
    a pass leaves of it the next one takes.  Then what the loudness lacks is
    added, and peaks are limited with look-ahead.  The loudness holds to 0.1 where no peak is limited, the range to 1, peaks to
    0.1 dB.  Signals under a block, and silent ones, stay as they are but for the limit.
    """
    now = chunks
    for _ in range(passes):
        now = settled(_toward(now, key, rate, target, most_range, size))
    more = lambda x, lufs: x if _unmeasured(lufs) else x * 10 ** ((target - lufs) / 20)
    return limited(with_values(now, integrated(now, key, rate, size), key, more, "lufs"), key, rate, float(10 ** (peak_db / 20)), size)


def _unmeasured(lufs: float | None) -> bool:
    return lufs is None or lufs != lufs or lufs <= ABSOLUTE


def _toward(chunks: DataFrame, key: str, rate: int, target: float, most_range: float, size: int) -> DataFrame:
    """One pass of ``loudness_normalized``."""
    steps, n = settled(step_energies(chunks, key, rate, size)), lengths(chunks, key)
    known = _integrated(steps, n, key, rate).join(loudness_range(short_terms(steps, n, key, rate), key), key, "left")
    # what a chunk's gain is made of: the blocks whose middles lie in it or next to it
    blocks = _windows(steps, key, n, rate, BLOCK_S).where("z > 0").select(key, "block", _db(F.col("z")).alias("loudness"))
    middle = (F.col("block") * STEP_S + BLOCK_S / 2) * rate
    at = F.floor(middle / size).cast("long")
    reach = int(np.ceil(STEP_S * rate / size))
    told = blocks.select(key, middle.alias("at"), "loudness", F.explode(F.sequence(at - reach, at + reach)).alias("chunk"))
    points = told.groupBy(key, "chunk").agg(F.array_sort(F.collect_list(F.struct("at", "loudness"))).alias("w")).select(key, "chunk", F.col("w.at").alias("at"), F.col("w.loudness").alias("loudness"))

    def gained(x: np.ndarray, chunk: int, lufs: float | None, lra: float | None, low: float | None, high: float | None, at: np.ndarray | None, loudness: np.ndarray | None) -> np.ndarray:
        if _unmeasured(lufs):
            return x
        gain = target - lufs
        if at is not None and lra is not None and lra > most_range:
            level = np.interp(chunk * size + np.arange(len(x)), at, np.clip(loudness, low, high))
            gain = gain + (most_range / lra - 1) * (level - lufs)
        return x * 10 ** (gain / 20)

    rows = chunks.join(known, key).join(points, [key, "chunk"], "left")
    return mapped(rows, gained, "samples", "array<double>", "samples", "chunk", "lufs", "lra", "low", "high", "at", "loudness").select(key, "chunk", "samples")


# -- frames -------------------------------------------------------------------------------------------------

#: Seconds of a frame and of a step for the pitch, its bounds in Hz, the least share of the energy that repeats;
#: samples of a frame and of a step for the spectrum; the magnitude under which a frame is silent.
PITCH_S, PITCH_STEP_S, LOW_HZ, HIGH_HZ, VOICED, SPECTRUM, SPECTRUM_STEP, SILENT = 0.03, 0.01, 50, 500, 0.3, 2048, 512, 0.01


def framed(chunks: DataFrame, key: str, frame: int, step: int, f: Callable[[np.ndarray], np.ndarray], size: int = SIZE) -> DataFrame:
    """(key, frame, value) of f, which takes frames as rows of an array and gives a value or NaN for each, NaN left out.

    Frames begin at multiples of ``step`` and end before the signal's last sample; silent ones are left out.  A frame belongs to the
    chunk that it begins in and takes what is missing from the halo.
    """

    def one(chunk: int, x: np.ndarray, after: np.ndarray) -> list[tuple[int, float]]:
        whole = np.concatenate([x, after])
        first = -(chunk * size) % step
        starts = np.arange(first, min(len(x), len(whole) - frame), step)
        if not len(starts):
            return []
        rows = np.lib.stride_tricks.sliding_window_view(whole, frame)[starts]
        loud = np.abs(rows).max(1) >= SILENT
        numbers = (chunk * size + starts[loud]) // step
        return [(k, float(v)) for k, v in zip(numbers.tolist(), f(rows[loud]), strict=True) if v == v] if loud.any() else []

    rows = mapped(with_halo(chunks, key, 0, frame, size), one, "f", "array<struct<frame:bigint,value:double>>", "chunk", "samples", "after")
    return rows.select(key, F.explode("f").alias("f")).select(key, "f.*")


def pitches(chunks: DataFrame, key: str, rate: int, size: int = SIZE) -> DataFrame:
    """(key, frame, value), the pitch of voiced frames: the lag with the largest autocorrelation."""
    frame, first, last = int(rate * PITCH_S), int(rate / HIGH_HZ), int(rate / LOW_HZ)

    def f(rows: np.ndarray) -> np.ndarray:
        if last > frame or first >= last:
            return np.full(len(rows), np.nan)
        x = rows - rows.mean(1, keepdims=True)
        n = 1 << (2 * frame - 1).bit_length()
        c = np.fft.irfft(np.abs(np.fft.rfft(x, n)) ** 2, n)[:, :frame]
        c = c / np.where(c[:, :1] > 0, c[:, :1], 1)
        lag, top = first + c[:, first:last].argmax(1), c[:, first:last].max(1)
        return np.where((top > VOICED) & (lag > 0), rate / np.maximum(lag, 1), np.nan)

    return framed(chunks, key, frame, int(rate * PITCH_STEP_S), f, size)


def centroids(chunks: DataFrame, key: str, rate: int, size: int = SIZE) -> DataFrame:
    """(key, frame, value), the mean frequency of each frame's spectrum."""
    window, hz = np.hanning(SPECTRUM), np.fft.rfftfreq(SPECTRUM, 1 / rate)

    def f(rows: np.ndarray) -> np.ndarray:
        s = np.abs(np.fft.rfft(rows * window))
        total = s.sum(1)
        return np.where(total > 0, (s @ hz) / np.where(total > 0, total, 1), np.nan)

    return framed(chunks, key, SPECTRUM, SPECTRUM_STEP, f, size)


def voices(chunks: DataFrame, key: str, rate: int, size: int = SIZE, decimals: int | None = 1) -> DataFrame:
    """(key, duration, f0, centroid): the median pitch of voiced frames and the mean centroid, null without any.

    With ``decimals`` None nothing is rounded, for callers that round in their own way: rounding twice is not rounding once.
    """
    told = lambda x: x if decimals is None else F.bround(x, decimals)
    f0 = pitches(chunks, key, rate, size).groupBy(key).agg(told(F.median("value")).alias("f0"))
    mean = centroids(chunks, key, rate, size).groupBy(key).agg(told(F.avg("value")).alias("centroid"))
    duration = lengths(chunks, key).select(key, told(F.col("n") / rate).alias("duration"))
    return duration.join(f0, key, "left").join(mean, key, "left")


# -- repairs ------------------------------------------------------------------------------------------------

#: Fixed value: samples on each side of a jump that its line spans.
REPAIR = 3
#: Jumps after which nothing of a line's left end is left: each keeps five sixths of it at most.
FADED = int(np.ceil(np.log(NEGLIGIBLE) / np.log(5 / 6)))


def repair(x: np.ndarray, threshold: float) -> np.ndarray:
    """Each jump of more than ``threshold``, in order, makes a straight line of what lies within three samples of it.

    The line's right end is still as it was given; its left end is as given too unless the jump before lies within five samples,
    whose line then holds it.  So the left ends of a run of close jumps are a first-order recursion, and every sample lies on
    the line of the last jump near it.
    """
    n = len(x)
    hits = np.flatnonzero(np.abs(np.diff(x)) > threshold)
    if not len(hits) or n < 2:
        return x.copy()
    first, last = np.maximum(hits - REPAIR, 0), np.minimum(hits + REPAIR, n - 1)
    right = x[last]
    left = x[first].tolist()
    steps = ((first[1:] - first[:-1]) / np.maximum(last[:-1] - first[:-1], 1)).tolist()
    # the left end lies strictly inside the line before
    inside = ((first[1:] > first[:-1]) & (first[1:] < last[:-1])).tolist()
    r = right.tolist()
    for k in range(1, len(left)):
        if inside[k - 1]:
            left[k] = left[k - 1] + steps[k - 1] * (r[k - 1] - left[k - 1])
    left = np.array(left)
    # the line of a sample is that of the last jump which has it strictly inside
    owner = np.full(n, -1)
    for d in range(-REPAIR + 1, REPAIR):
        at = hits + d
        ok = (at > first) & (at < last)
        np.maximum.at(owner, at[ok], np.flatnonzero(ok))
    at = np.flatnonzero(owner >= 0)
    k = owner[at]
    out = x.copy()
    out[at] = left[k] + (at - first[k]) / (last[k] - first[k]) * (right[k] - left[k])
    return out


def repaired(chunks: DataFrame, key: str, threshold: float = 0.15, size: int = SIZE) -> DataFrame:
    """W19 in chunks: each takes as much from the chunk before as a run of jumps can still be felt over.

    Chunks are grouped until they are as long as that halo, so each is sent to one neighbour on each side, however short it is.
    """
    halo = (2 * REPAIR - 1) * FADED
    k = -(-halo // size)
    one = lambda x, b, a: repair(np.concatenate([b, x, a]), threshold)[len(b) : len(b) + len(x)]
    rows = with_halo(grouped(chunks, key, k), key, halo, 2 * REPAIR + 2, k * size)
    return ungrouped(mapped(rows, one, "samples", "array<double>", "samples", "before", "after").select(key, "chunk", "samples"), key, k, size)
