"""Signals in long form (key, idx, value).

Sums fold map-side by (key, bucket); windows see a stretch of a signal, not all of it, and what they find meets over the
borders.  ``chunked`` has what needs a signal's neighbourhood or past output, ``production`` the jobs made of both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import db_to_linear


#: Samples of a stretch that one window sees.
SIZE = 1 << 16


def silences(signal: DataFrame, key: str, rate: int, noise_db: float = -40.0, min_seconds: float = 0.3, size: int = SIZE) -> DataFrame:
    """(key, start, end, duration) in seconds of runs below the threshold.

    Runs are found in stretches of ``size`` samples; those that are long enough, or touch a border, meet over the borders.
    """
    rows = signal.where(F.abs(F.col("value")) <= float(10 ** (noise_db / 20))).select(key, "idx", F.floor(F.col("idx") / size).alias("part"))
    # samples of one run keep their distance to their number
    island = F.col("idx") - F.row_number().over(Window.partitionBy(key, "part").orderBy("idx"))
    runs = rows.withColumn("island", island).groupBy(key, "part", "island").agg(F.min("idx").alias("a"), (F.max("idx") + 1).alias("b"))
    least = int(rate * min_seconds)
    runs = runs.where((F.col("b") - F.col("a") >= least) | (F.col("a") % size == 0) | (F.col("b") % size == 0))
    window = Window.partitionBy(key).orderBy("a")
    runs = runs.withColumn("run", F.sum(F.when(F.col("a") == F.lag("b").over(window), 0).otherwise(1)).over(window))
    runs = runs.groupBy(key, "run").agg(F.min("a").alias("a"), F.max("b").alias("b")).where(F.col("b") - F.col("a") >= least)
    return runs.select(key, (F.col("a") / rate).alias("start"), (F.col("b") / rate).alias("end"), ((F.col("b") - F.col("a")) / rate).alias("duration"))


def clicks(signal: DataFrame, key: str, rate: int, threshold: float, size: int = SIZE) -> DataFrame:
    """(key, first, samples, severity) of groups of jumps less than 5 ms apart.

    Jumps and their groups are found in stretches of ``size`` samples, each with the first of the next; groups of neighbouring
    stretches meet last, a few rows for each stretch.
    """
    near = max(1, int(rate * 0.005))
    at = F.floor(F.col("idx") / size)
    # a stretch's first sample is the last of the one before too
    rows = signal.select(key, "idx", "value", F.explode(F.when(F.col("idx") % size == 0, F.array(at - 1, at)).otherwise(F.array(at))).alias("part"))
    inner = rows.withColumn("next", F.lead("value").over(Window.partitionBy(key, "part").orderBy("idx")))
    hits = inner.select(key, "part", "idx", F.abs(F.col("next") - F.col("value")).alias("jump")).where(F.col("jump") > threshold)
    within = Window.partitionBy(key, "part").orderBy("idx")
    marked = hits.withColumn("group", F.sum(F.when(F.col("idx") - F.lag("idx").over(within) < near, 0).otherwise(1)).over(within))
    groups = marked.groupBy(key, "part", "group").agg(F.min("idx").alias("first"), F.max("idx").alias("last"), F.count(F.lit(1)).alias("samples"), F.max("jump").alias("severity"))
    over = Window.partitionBy(key).orderBy("first")
    groups = groups.withColumn("run", F.sum(F.when(F.col("first") - F.lag("last").over(over) < near, 0).otherwise(1)).over(over))
    return groups.groupBy(key, "run").agg(F.min("first").alias("first"), F.sum("samples").alias("samples"), F.max("severity").alias("severity")).drop("run")


def trim_bounds(signal: DataFrame, key: str, rate: int, threshold: float) -> DataFrame:
    """(key, n, lead, trail): the first and the end sample kept.

    Windows of 10 ms from the front, and from the end backwards; 5 ms stay before the first loud one, 20 ms after
    the last.  Without a loud window all stays.
    """
    w, keep, tail = max(1, int(rate * 0.01)), int(rate * 0.005), int(rate * 0.02)
    loud = F.when(F.abs(F.col("value")) > threshold, F.col("idx"))
    rows = signal.groupBy(key).agg((F.max("idx") + 1).alias("n"), F.min(loud).alias("first"), F.max(loud).alias("last"))
    # the first and the last loud sample lie in the first and the last loud window
    front = F.floor(F.col("first") / w) * w
    back = F.col("n") - w - F.floor((F.col("n") - 1 - F.col("last")) / w) * w
    rows = rows.select(key, "n", F.when(front < F.col("n") - w, front).alias("f"), F.when(back > 0, back).alias("b"))
    return rows.select(key, "n", F.coalesce(F.greatest(F.lit(0), F.col("f") - keep), F.lit(0)).cast("long").alias("lead"), F.coalesce(F.least(F.col("n"), F.col("b") + w + tail), F.col("n")).cast("long").alias("trail"))


def fades(signal: DataFrame, key: str, rate: int, fade_ms: int) -> DataFrame:
    """Linear fades at both ends, if the signal is longer than two of them.  Rows that bring ``n``, their signal's length, are not counted."""
    f = int(rate * fade_ms / 1000)
    rows = signal if "n" in signal.columns else signal.join(signal.groupBy(key).agg((F.max("idx") + 1).alias("n")), key)
    ramp = F.when(F.col("idx") < f, F.col("idx") / max(1, f - 1)).when(F.col("idx") >= F.col("n") - f, (F.col("n") - 1 - F.col("idx")) / max(1, f - 1)).otherwise(1.0)
    return rows.select(key, "idx", F.when(F.col("n") > 2 * f, F.col("value") * ramp).otherwise(F.col("value")).alias("value"))


def levels(signal: DataFrame, key: str) -> DataFrame:
    """(key, rms, peak, rms_db, peak_db, crest_db, lufs): the loudness by the RMS rule, -70 for silence."""
    db = lambda x: 20 * F.log10(F.greatest(x, F.lit(1e-10)))
    rows = signal.groupBy(key).agg(F.sqrt(F.avg(F.col("value") * F.col("value"))).alias("rms"), F.max(F.abs("value")).alias("peak"))
    lufs = F.when(F.col("rms") < 1e-10, -70.0).otherwise(20 * F.log10(F.col("rms")) - 0.691)
    return rows.select(key, "rms", "peak", db(F.col("rms")).alias("rms_db"), db(F.col("peak")).alias("peak_db"), (db(F.col("peak")) - db(F.col("rms"))).alias("crest_db"), lufs.alias("lufs"))


def rms_normalized(signal: DataFrame, key: str, target: float = 0.1) -> DataFrame:
    """D1; a silent signal stays."""
    rms = signal.groupBy(key).agg(F.sqrt(F.avg(F.col("value") * F.col("value"))).alias("rms"))
    return signal.join(rms, key).select(key, "idx", F.when(F.col("rms") > 0, F.col("value") * (target / F.col("rms"))).otherwise(F.col("value")).alias("value"))


def scaled(signal: DataFrame, key: str, db: Column) -> DataFrame:
    """D2."""
    return signal.select(key, "idx", (F.col("value") * db_to_linear(db)).alias("value"))


def level_gain(measured: DataFrame, target: float = -16.0) -> DataFrame:
    """``measured`` (lufs, ...) with gain_db; null where it is less than a tenth."""
    gain = F.lit(target) - F.col("lufs")
    return measured.withColumn("gain_db", F.when(F.abs(gain) >= 0.1, gain))


def separation(voices: DataFrame, least: float = 80.0, group: list[str] | None = None) -> DataFrame:
    """(file, f0, next_file, next_f0, gap) of neighbours in pitch that are too close; null pitches are skipped.

    Voices meet in bands ``least`` wide, and the last of a band meets the first of the next, so no window sees the whole table.
    """
    keys = [*(group or []), "band"]
    window = Window.partitionBy(*keys).orderBy("f0", "file")
    rows = voices.where(F.col("f0").isNotNull()).withColumn("band", F.floor(F.col("f0") / least))
    inner = rows.withColumn("next", F.lead(F.struct("f0", "file")).over(window))
    heads = rows.groupBy(*keys).agg(F.min(F.struct("f0", "file")).alias("head")).withColumn("band", F.col("band") - 1)
    pairs = inner.join(heads, keys, "left").withColumn("next", F.coalesce("next", "head"))
    found = pairs.withColumn("next_file", F.col("next.file")).withColumn("next_f0", F.col("next.f0")).withColumn("gap", F.col("next_f0") - F.col("f0"))
    return found.where(F.col("gap") < least).drop("band", "next", "head")


def by_pitch(voices: DataFrame) -> DataFrame:
    """Null as 0."""
    return voices.orderBy(F.coalesce("f0", F.lit(0.0)), "file")
