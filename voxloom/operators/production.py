"""Cleaning, preparing, mixing and mastering of signals in long form (key, idx, value) and in chunks; no signal is one row or one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import chunked as C
from . import signal as G
from .timeline import overlay

#: Early reflections of a room (milliseconds, gain), and how often its noise falls by a factor of e.
REFLECTIONS, DECAY = ((5, 0.4), (12, 0.25), (20, 0.15), (35, 0.1)), 6
#: Fixed values of the music's compressor: level, ratio, attack and release; the bed at full volume is so many times louder, at most so loud.
DUCK_LEVEL, DUCK_RATIO, DUCK_ATTACK_MS, DUCK_RELEASE_MS, FULL, FULL_MOST = 0.02, 8.0, 10.0, 800.0, 3, 0.4


def split(signals: DataFrame, key: str, size: int = C.SIZE) -> DataFrame:
    """Chunks of ``signals`` (key, samples, ...), whole signals as they come from files; a null or empty one has none."""
    last = F.ceil(F.size("samples") / size) - 1
    rows = signals.where(F.size("samples") > 0).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return rows.select(key, "chunk", F.slice("samples", (F.col("chunk") * size + 1).cast("int"), F.lit(size)).cast("array<double>").alias("samples"))


def _lengths(signal: DataFrame, key: str, name: str = "n") -> DataFrame:
    return signal.groupBy(key).agg((F.max("idx") + 1).cast("long").alias(name))


# -- cleaning -----------------------------------------------------------------------------------------------


def clean(signal: DataFrame, key: str, rate: int, threshold: float = 0.15, fade_ms: int = 8, trim: bool = True, dry_run: bool = False, size: int = C.SIZE) -> tuple[DataFrame, DataFrame]:
    """The cleaned signal, and (key, clicks, original_duration, cleaned_duration, trimmed_ms).

    Clicks are repaired, silent ends cut, ends faded.  A dry run tells what would be cut of the signal as it is, and leaves it.
    """
    chunks = None if dry_run else C.repaired(C.chunks_of(signal, key, size), key, threshold, size)
    if trim and not dry_run:
        # the bounds are made of the same chunks that they cut
        chunks = C.settled(chunks)
    if trim:
        bounds = G.trim_bounds(signal if dry_run else C.long_of(chunks, key, size), key, rate, float(10 ** (-35 / 20)))
    else:
        n = _lengths(signal, key)
        bounds = n.select(key, "n", F.lit(0).cast("long").alias("lead"), F.col("n").alias("trail"))
    count = G.clicks(signal, key, rate, threshold).groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("clicks"))
    kept = F.col("n") if dry_run else F.col("trail") - F.col("lead")
    report = bounds.join(count, key, "left").select(
        key,
        F.coalesce("clicks", F.lit(0)).alias("clicks"),
        F.round(F.col("n") / rate, 3).alias("original_duration"),
        F.round(kept / rate, 3).alias("cleaned_duration"),
        F.round((F.col("n") - F.col("trail") + F.col("lead")) * 1000 / rate, 1).alias("trimmed_ms"),
    )
    if dry_run:
        return signal, report
    rows = C.long_of(chunks.join(bounds.drop("n"), key), key, size, "lead", "trail").where((F.col("idx") >= F.col("lead")) & (F.col("idx") < F.col("trail")))
    cut = rows.select(key, (F.col("idx") - F.col("lead")).alias("idx"), "value", (F.col("trail") - F.col("lead")).alias("n"))
    return G.fades(cut, key, rate, fade_ms), report


# -- preparing ----------------------------------------------------------------------------------------------


def counter_noise(n: int, seed: int) -> np.ndarray:
    """Normal numbers, the i-th a function of (seed, i) alone: a mixed counter gives two uniform numbers."""
    with np.errstate(over="ignore"):
        h = (np.arange(2 * n, dtype=np.uint64) + np.uint64(seed << 40)) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    u = ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return np.sqrt(-2 * np.log1p(-u[:n])) * np.cos(2 * np.pi * u[n:])


def room_response(rate: int, decay: float = 0.15, seed: int = 42) -> np.ndarray:
    """D3: the early reflections as taps, on noise that decays; its peak is 1."""
    n = int(rate * decay)
    if not n:
        return np.zeros(0)
    places = np.array([int(rate * ms / 1000) for ms, _ in REFLECTIONS])
    gains = np.array([g for _, g in REFLECTIONS])
    taps = np.bincount(places[places < n], gains[places < n], n)
    out = taps + counter_noise(n, seed) * np.exp(-DECAY * np.arange(n) / max(1, n - 1))
    return out / np.abs(out).max()


def reverb(chunks: DataFrame, key: str, rate: int, mix: float = 0.02, size: int = C.SIZE) -> DataFrame:
    """The direct sound's share plus the room's, as one finite response over chunks with halos."""
    response = room_response(rate) * mix
    if not mix or not len(response):
        return chunks
    response[0] += 1 - mix
    return C.convolved(chunks, key, response, size)


def resampled(signal: DataFrame, key: str, rate: int, to: int) -> DataFrame:
    """SC7: linear interpolation over equal steps from the first sample to the last.

    Every sample gives the points between it and the next: an equi-join of neighbours, no window.
    """
    if rate == to:
        return signal
    n = _lengths(signal, key).withColumn("m", F.floor(F.col("n") * to / rate))
    nxt = signal.select(key, (F.col("idx") - 1).alias("idx"), F.col("value").alias("next"))
    rows = signal.join(nxt, [key, "idx"], "left").join(n, key).where("m > 0")
    # point j lies at j * (n - 1) / (m - 1); a single point lies at the first sample, and all points of a single sample there
    ratio = lambda i: F.when(F.col("m") == 1, i).when(F.col("n") > 1, i * (F.col("m") - 1) / (F.col("n") - 1)).otherwise(0)
    first, last = F.ceil(ratio(F.col("idx")) - 1e-9), F.least(F.ceil(ratio(F.col("idx") + 1) - 1e-9), F.col("m")) - 1
    last = F.when(F.col("next").isNull(), F.col("m") - 1).otherwise(last)
    points = rows.where(first <= last).withColumn("j", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    at = F.when(F.col("m") > 1, F.col("j") * (F.col("n") - 1) / (F.col("m") - 1)).otherwise(0) - F.col("idx")
    return points.select(key, F.col("j").alias("idx"), (F.col("value") + F.coalesce(F.greatest(at, F.lit(0.0)) * (F.col("next") - F.col("value")), F.lit(0.0))).alias("value"))


def prepared(signal: DataFrame, key: str, rate: int, to: int = 24_000, db: Column | float = 0.0, mix: float = 0.02, fade_ms: int = 20, size: int = C.SIZE) -> DataFrame:
    """Every signal resampled, normalised, at its speaker's volume (``db``: a number, or an expression of ``key``), with reverb and fades."""
    rows = G.rms_normalized(resampled(signal, key, rate, to), key)
    rows = G.scaled(rows, key, F.lit(float(db)) if isinstance(db, (int, float)) else db)
    return G.fades(C.long_of(reverb(C.chunks_of(rows, key, size), key, to, mix, size), key, size), key, to, fade_ms)


# -- mixing -------------------------------------------------------------------------------------------------


def crossfaded(first: DataFrame, second: DataFrame, key: str, n: int) -> DataFrame:
    """``second`` after ``first``, over the last ``n`` samples of it (as many as both have), by straight ramps."""
    sizes = _lengths(first, key, "na").join(_lengths(second, key, "nb"), key, "full").na.fill(0, ["na", "nb"])
    sizes = sizes.withColumn("d", F.least(F.lit(n), "na", "nb"))
    ramp = lambda i: F.when(F.col("d") > 1, i / (F.col("d") - 1)).otherwise(0.0)
    out = first.join(sizes, key)
    place = F.col("idx") - (F.col("na") - F.col("d"))
    out = out.select(key, F.lit(0).alias("pos"), F.col("idx").alias("nth"), (F.col("value") * F.when(place >= 0, 1 - ramp(place)).otherwise(1.0)).alias("value"))
    into = second.join(sizes, key).select(key, (F.col("na") - F.col("d")).alias("pos"), F.col("idx").alias("nth"), (F.col("value") * F.when(F.col("idx") < F.col("d"), ramp(F.col("idx"))).otherwise(1.0)).alias("value"))
    return overlay(out.unionByName(into), key, float("inf"))


def looped(music: DataFrame, key: str, sizes: DataFrame) -> DataFrame:
    """(key, idx, value): ``music`` again and again, for the ``total`` samples of ``sizes`` (key, total, and what else is kept)."""
    rows = music.join(_lengths(music, key, "period"), key).join(sizes, key).where(F.col("idx") < F.col("total"))
    places = F.explode(F.sequence(F.col("idx").cast("long"), F.col("total") - 1, F.col("period")))
    return rows.select(key, places.alias("at"), "value", *(c for c in sizes.columns if c != key)).withColumnRenamed("at", "idx")


def faded_bed(bed: DataFrame, rate: int, volume: float, fade_in: float, falls_at: Column, fade_out: float) -> DataFrame:
    """``bed`` (idx, value, ...) at ``volume``, with ramps from its begin and from the sample ``falls_at`` on."""
    rise, fall = int(rate * fade_in), int(rate * fade_out)
    gain = F.least(F.lit(1.0), F.col("idx") / rise) if rise else F.lit(1.0)
    if fall:
        gain = gain * F.greatest(F.lit(0.0), F.least(F.lit(1.0), (falls_at + fall - F.col("idx")) / fall))
    return bed.withColumn("value", F.col("value") * gain * volume)


def _duck(level: np.ndarray, bed: np.ndarray) -> np.ndarray:
    return bed * (np.maximum(level, DUCK_LEVEL) / DUCK_LEVEL) ** (1 / DUCK_RATIO - 1)


def ducked(bed: DataFrame, speech: DataFrame, key: str, rate: int, size: int = C.SIZE) -> DataFrame:
    """Chunks of ``bed`` lowered by the level of ``speech``, which has as many samples: a compressor that listens to another signal."""
    level = C.followed(speech, key, rate, DUCK_ATTACK_MS, DUCK_RELEASE_MS, size)
    return C.paired(level, bed, key, _duck)


def _mixed(a: DataFrame, b: DataFrame, key: str, limit: float = 1.0) -> DataFrame:
    rows = a.select(key, F.lit(0).alias("pos"), F.col("idx").alias("nth"), "value").unionByName(b.select(key, F.lit(0).alias("pos"), F.col("idx").alias("nth"), "value"))
    return overlay(rows, key, limit)


def music_bed(speech: DataFrame, music: DataFrame, key: str, rate: int, volume: float = 0.12, fade_in: float = 3.0, fade_out: float = 5.0, size: int = C.SIZE) -> DataFrame:
    """Music looped to the speech's length, with fades, lowered where the speech is loud.  Speech without music stays."""
    sizes = _lengths(speech, key, "total")
    bed = faded_bed(looped(music, key, sizes), rate, volume, fade_in, F.greatest(F.lit(0), F.col("total") - int(rate * fade_out)), fade_out)
    low = ducked(C.chunks_of(bed, key, size), C.chunks_of(speech, key, size), key, rate, size)
    return _mixed(speech, C.long_of(low, key, size), key)


def sting(main: DataFrame, sound: DataFrame, key: str, rate: int, overlap: float = 3.0, volume: float = 0.35, rise: float = 0.5) -> DataFrame:
    """A sound, rising over ``rise`` seconds, mixed in from ``overlap`` seconds before the end."""
    up = int(rate * rise)
    gain = F.least(F.lit(1.0), F.col("idx") / up) if up else F.lit(1.0)
    at = _lengths(main, key).select(key, F.greatest(F.lit(0), F.col("n") - int(rate * overlap)).alias("pos"))
    added = sound.join(at, key).select(key, "pos", F.col("idx").alias("nth"), (F.col("value") * gain * volume).alias("value"))
    return overlay(main.select(key, F.lit(0).alias("pos"), F.col("idx").alias("nth"), "value").unionByName(added), key, float("inf"))


def bed_with_bleed(speech: DataFrame, music: DataFrame, key: str, rate: int, volume: float = 0.12, post: float = 5.0, bleed: float = 8.0, fade_in: float = 2.0, size: int = C.SIZE) -> DataFrame:
    """The bed at full volume, lowered under the speech; it plays on for ``post`` seconds after it and falls for ``bleed`` more."""
    n = _lengths(speech, key)
    sizes = n.select(key, "n", (F.col("n") + int(rate * post) + int(rate * bleed)).alias("total"))
    bed = faded_bed(looped(music, key, sizes), rate, min(FULL * volume, FULL_MOST), fade_in, F.col("n") + int(rate * post), bleed)
    silence = sizes.where("total > n").select(key, F.explode(F.sequence(F.col("n"), F.col("total") - 1)).alias("idx"), F.lit(0.0).alias("value"))
    padded = speech.select(key, F.col("idx").cast("long").alias("idx"), F.col("value").cast("double").alias("value")).unionByName(silence)
    low = ducked(C.chunks_of(bed, key, size), C.chunks_of(padded, key, size), key, rate, size)
    return _mixed(padded, C.long_of(low, key, size), key)


def place_clips(signal: DataFrame, placements: DataFrame, clips: DataFrame, key: str, db: float = -3.0) -> tuple[DataFrame, DataFrame]:
    """``signal`` with the clips of ``placements`` (key, pos, clip) added at ``db``, clamped; and (key, placed), how many were.

    ``clips`` (clip, idx, value).  A clip that begins at or before the first sample, or ends at or after the last, is left out; which
    clip a later placement has is not changed by that.  Clips are small next to signals, their lengths one row each.
    """
    n, size = _lengths(signal, key), _lengths(clips, "clip", "length")
    inside = placements.join(size, "clip").join(n, key).where((F.col("pos") > 0) & (F.col("pos") + F.col("length") < F.col("n"))).select(key, "pos", "clip")
    added = inside.join(clips, "clip").select(key, "pos", F.col("idx").alias("nth"), (F.col("value") * float(10 ** (db / 20))).alias("value"))
    out = overlay(signal.select(key, F.lit(0).alias("pos"), F.col("idx").alias("nth"), "value").unionByName(added), key)
    counts = n.join(inside.groupBy(key).agg(F.count(F.lit(1)).alias("placed")), key, "left").select(key, F.coalesce("placed", F.lit(0)).alias("placed"))
    return out, counts


def stems(timeline: DataFrame, audio: DataFrame, key: str, size: int = C.SIZE) -> DataFrame:
    """(key, speaker, chunk, samples) of every speaker, all as long as the episode and silent where others talk.

    ``timeline`` (key, index, speaker, pos, n) as W10 gives it, ``audio`` (key, index, idx, value).  The chunks of a stem come from the
    episode's length, so silence is there too; the samples of a chunk meet in one row.  Samples are many where files are small (a
    line's are made of its text, say), so their size can't be told before: no join is left to broadcast them.
    """
    total = timeline.groupBy(key).agg(F.max(F.col("pos") + F.col("n")).cast("long").alias("total"))
    grid = timeline.select(key, "speaker").distinct().join(total.where("total > 0"), key)
    grid = grid.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / size))))
    at = F.col("pos") + F.col("idx")
    parts = audio.join(timeline.select(key, "index", "speaker", "pos").hint("shuffle_hash"), [key, "index"]).select(key, "speaker", F.floor(at / size).alias("chunk"), (at % size).cast("int").alias("nth"), "value")
    parts = parts.groupBy(key, "speaker", "chunk").agg(F.collect_list(F.struct("nth", "value")).alias("p"))
    rows = grid.join(parts.hint("merge"), [key, "speaker", "chunk"], "left").select(key, "speaker", "chunk", F.least(F.lit(size), F.col("total") - F.col("chunk") * size).alias("n"), F.col("p.nth").alias("nth"), F.col("p.value").alias("value"))

    def fill(n: int, nth: np.ndarray | None, value: np.ndarray | None) -> np.ndarray:
        out = np.zeros(n)
        if nth is not None:
            ok = nth < n
            out[nth[ok]] = value[ok]
        return out

    return C.mapped(rows, fill, "samples", "array<double>", "n", "nth", "value").select(key, "speaker", "chunk", "samples")


# -- mastering ----------------------------------------------------------------------------------------------

#: Fixed values of the chain: high pass, shelves (Hz, dB), compressor (dB, ratio, attack, release), gate (dB, attack, release), limit.
HIGH_PASS_HZ, LOW_SHELF, HIGH_SHELF, COMPRESSOR, GATE, LIMIT_DB = 80.0, (300.0, -2.0), (3000.0, 1.5), (-18.0, 3.0, 5.0, 150.0), (-40.0, 1.0, 100.0), -1.0
#: What of the chain is off.
PLAIN_CHAIN = {"highpass_hz": 0.0, "shelve": False, "gate": False}
_FLAT = float(np.sqrt(0.5))


def _db(level: np.ndarray) -> np.ndarray:
    return 20 * np.log10(np.maximum(level, 1e-10))


def _clamped(x: np.ndarray) -> np.ndarray:
    return np.clip(x, -(10 ** (LIMIT_DB / 20)), 10 ** (LIMIT_DB / 20))


def master_chain(chunks: DataFrame, key: str, rate: int, highpass_hz: float = HIGH_PASS_HZ, shelve: bool = True, compress: bool = True, gate: bool = True, size: int = C.SIZE) -> DataFrame:
    """High pass, shelves, compressor, gate and limit, each over chunks: recursions by entry states, followers by halos."""
    sections = [C.high_pass(rate, highpass_hz, _FLAT)] if highpass_hz else []
    if shelve:
        sections += [C.shelf(rate, *LOW_SHELF, _FLAT, high=False), *([C.shelf(rate, *HIGH_SHELF, _FLAT)] if rate > 2 * HIGH_SHELF[0] else [])]
    # a follower and what it governs read the same chunks
    out = C.settled(C.filtered(chunks, key, sections, size)) if sections else chunks
    if compress:
        db, ratio, attack, release = COMPRESSOR
        out = C.paired(C.followed(out, key, rate, attack, release, size), out, key, lambda level, x: x * 10 ** (-np.maximum(_db(level) - db, 0) * (1 - 1 / ratio) / 20))
        out = C.settled(out)
    if gate:
        db, attack, release = GATE
        out = C.paired(C.followed(out, key, rate, attack, release, size), out, key, lambda level, x: x * (_db(level) > db))
    return C.mapped(out, _clamped, "samples", "array<double>", "samples").select(key, "chunk", "samples")


def master(chunks: DataFrame, key: str, rate: int, target: float = -16.0, size: int = C.SIZE, **chain) -> tuple[DataFrame, DataFrame]:
    """The mastered chunks at the target loudness, and (key, input_lufs, output_lufs) by the meter, one decimal.

    Signals without a loudness (under a block, or silent) get no gain.
    """
    out = C.settled(master_chain(chunks, key, rate, size=size, **chain))
    gain = lambda x, lufs: x if lufs is None or lufs != lufs or lufs <= C.ABSOLUTE else _clamped(x * 10 ** ((target - lufs) / 20))
    mastered = C.settled(C.with_values(out, C.integrated(out, key, rate, size), key, gain, "lufs"))
    told = lambda rows, name: C.integrated(rows, key, rate, size).select(key, F.round("lufs", 1).alias(name))
    return mastered, told(chunks, "input_lufs").join(told(mastered, "output_lufs"), key)


def loudness_master(chunks: DataFrame, key: str, rate: int, target: float = -16.0, size: int = C.SIZE) -> DataFrame:
    """A compressor alone, then D12's normalisation."""
    return C.loudness_normalized(C.settled(master_chain(chunks, key, rate, size=size, **PLAIN_CHAIN)), key, rate, target, size=size)
