"""Timelines: turns from silences, exclusive running sums, word-proportional subtitles, chapters.

Times are whole milliseconds or samples inside; a running sum of integers has no drift and the same value in every
engine.  Windows go by episode or signal, which bounds what a task sorts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import shorten, srt_time, word_count


def before(value: Column | str, key: list[str], order: list[str]) -> Column:
    """The sum of all earlier rows' values; 0 for the first."""
    window = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def split_turns(silences: DataFrame, totals: DataFrame, key: str) -> DataFrame:
    """(key, turn, start, end, duration, gap_after) from silences (key, start, end, duration) and (key, total).

    A turn needs 10 ms before a silence; what follows the last silence is a turn if it is longer than 50 ms.
    """
    window = Window.partitionBy(key).orderBy("start")
    rows = silences.withColumn("from", F.lag("end", 1, 0.0).over(window))
    turns = rows.where(F.col("start") >= F.col("from") + 0.01).select(key, F.col("from").alias("start"), F.col("start").alias("end"), (F.col("start") - F.col("from")).alias("duration"), F.col("duration").alias("gap_after"))
    last = silences.groupBy(key).agg(F.max_by("end", "start").alias("from"))
    tail = totals.join(last, key, "left").withColumn("from", F.coalesce("from", F.lit(0.0)))
    tail = tail.where(F.col("from") < F.col("total") - 0.05).select(key, F.col("from").alias("start"), F.col("total").alias("end"), (F.col("total") - F.col("from")).alias("duration"), F.lit(0.0).alias("gap_after"))
    return turns.unionByName(tail).withColumn("turn", F.row_number().over(window) - 1)


def trim_plan(silences: DataFrame, totals: DataFrame, key: str, max_pause: float) -> DataFrame:
    """(key, seg, kind, start, end, at): what is kept, and where it lands; long silences are cut to ``max_pause``."""
    window = Window.partitionBy(key).orderBy("start")
    rows = silences.withColumn("from", F.lag("end", 1, 0.0).over(window))
    piece = lambda kind, a, b: F.struct(F.lit(kind).alias("kind"), a.alias("start"), b.alias("end"))
    end = F.when(F.col("duration") > max_pause, F.col("start") + max_pause).otherwise(F.col("end"))
    both = rows.select(key, F.explode(F.array_compact(F.array(F.when(F.col("start") > F.col("from"), piece("speech", F.col("from"), F.col("start"))), piece("silence", F.col("start"), end)))).alias("p")).select(key, "p.*")
    last = silences.groupBy(key).agg(F.max_by("end", "start").alias("from"))
    tail = totals.join(last, key, "left").withColumn("from", F.coalesce("from", F.lit(0.0)))
    tail = tail.where(F.col("from") < F.col("total")).select(key, F.lit("speech").alias("kind"), F.col("from").alias("start"), F.col("total").alias("end"))
    whole = both.unionByName(tail)
    order = ["start", "end"]
    return whole.withColumn("seg", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1).withColumn("at", before(F.col("end") - F.col("start"), [key], order))


def chapters(sections: DataFrame, key: str, offset_ms: Column | int = 0) -> DataFrame:
    """(key, index, name, start_ms) of sections (key, index, name, duration_ms)."""
    offset = F.lit(offset_ms) if isinstance(offset_ms, int) else offset_ms
    return sections.select(key, "index", "name", (offset + before("duration_ms", [key], ["index"])).alias("start_ms"))


def intro_offset_ms(intro_ms: Column, crossfade_ms: int = 2000) -> Column:
    """W5."""
    return F.greatest(F.lit(0), intro_ms - crossfade_ms)


def word_timeline(lines: DataFrame, sections: DataFrame, key: list[str], order: list[str], text: str = "text") -> DataFrame:
    """``lines`` with start_ms, end_ms: a section's time (key, section_start_ms, section_ms) shared by words.

    Without any words all lines share alike; sections without time have no lines.  The last line ends exactly
    with its section.
    """
    rows = lines.join(sections, key).where(F.col("section_ms") > 0).withColumn("__w", word_count(F.col(text)).cast("long"))
    whole = Window.partitionBy(*key)
    rows = rows.withColumn("__w", F.when(F.sum("__w").over(whole) == 0, F.lit(1).cast("long")).otherwise(F.col("__w")))
    rows = rows.withColumn("__b", before("__w", key, order)).withColumn("__n", F.sum("__w").over(whole))
    at = lambda w: F.col("section_start_ms") + F.floor((w * F.col("section_ms") * 2 + F.col("__n")) / (2 * F.col("__n"))).cast("long")
    return rows.select(*lines.columns, at(F.col("__b")).alias("start_ms"), at(F.col("__b") + F.col("__w")).alias("end_ms"))


def srt(entries: DataFrame, key: str, order: list[str]) -> DataFrame:
    """(key, srt) of entries (key, start_ms, end_ms, speaker, text)."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    block = F.concat(nth.cast("string"), F.lit("\n"), srt_time(F.col("start_ms")), F.lit(" --> "), srt_time(F.col("end_ms")), F.lit("\n["), F.col("speaker"), F.lit("] "), F.col("text"))
    blocks = entries.select(key, nth.alias("nth"), block.alias("block")).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("nth", "block"))).alias("b"))
    return blocks.select(key, F.concat(F.concat_ws("\n\n", F.col("b.block")), F.lit("\n")).alias("srt"))


def chapters_json(rows: DataFrame, key: str) -> DataFrame:
    """SK2: (key, json) of chapters (key, index, name, start_ms); starts in seconds to one place."""
    entry = F.struct("index", F.struct((F.floor((F.col("start_ms") + 50) / 100) / 10).alias("startTime"), F.col("name").alias("title")).alias("c"))
    all_ = rows.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("c"))
    return all_.select(key, F.to_json(F.struct(F.lit("1.2.0").alias("version"), F.col("c.c").alias("chapters"))).alias("json"))


def show_notes(sections: DataFrame, first_lines: DataFrame, speakers: DataFrame, key: str) -> DataFrame:
    """(key, notes): title, sorted speakers, sections with their first line as a hint.

    ``sections`` (key, title, section, name), ``first_lines`` (key, section, text), ``speakers`` (key, speaker).
    """
    hint = F.when(F.col("text").isNotNull(), F.concat(F.lit(" -- "), shorten(F.col("text")))).otherwise("")
    line = F.concat(F.lit("- **"), F.col("name"), F.lit("**"), hint)
    parts = sections.join(first_lines, [key, "section"], "left").groupBy(key).agg(F.max("title").alias("title"), F.array_sort(F.collect_list(F.struct("section", line.alias("line")))).alias("s"))
    who = speakers.select(key, "speaker").distinct().groupBy(key).agg(F.array_sort(F.collect_list("speaker")).alias("who"))
    named = F.concat(F.lit("# "), F.col("title"), F.lit("\n"))
    cast = F.concat(F.lit("## Speakers\n\n"), F.concat_ws("\n", F.transform("who", lambda w: F.concat(F.lit("- "), w))), F.lit("\n"))
    listed = F.concat(F.lit("## Sections\n\n"), F.concat_ws("\n", F.col("s.line")), F.lit("\n"))
    return parts.join(who, key, "left").select(key, F.concat_ws("\n", F.when(F.coalesce("title", F.lit("")) != "", named), cast, listed).alias("notes"))


def stem_timeline(lines: DataFrame, key: str, rate: int = 24_000, same: float = 0.08, change: float = 0.15) -> DataFrame:
    """``lines`` (key, index, speaker, n samples or null if the file is missing) with pos; missing lines take no part."""
    window = Window.partitionBy(key).orderBy("index")
    rows = lines.where(F.col("n").isNotNull()).withColumn("__p", F.lag("speaker").over(window))
    pause = F.when(F.col("__p").isNull(), 0).when(F.col("__p") != F.col("speaker"), int(rate * change)).otherwise(int(rate * same))
    rows = rows.withColumn("__pause", pause)
    own = F.sum("__pause").over(window.rowsBetween(Window.unboundedPreceding, 0))
    return rows.select(*lines.columns, (own + before("n", [key], ["index"])).alias("pos"))


def placement_timeline(lines: DataFrame, key: str, rate: int = 24_000, pause: float = 0.15, default: float = 2.0) -> DataFrame:
    """``lines`` (key, index, duration seconds or null) with pos in samples."""
    step = (F.coalesce("duration", F.lit(default)) * rate).cast("long") + int(rate * pause)
    return lines.withColumn("pos", before(step, [key], ["index"]))


def gap_after() -> Column:
    """W16's gap in ms after a turn that isn't the last: overlap shortens it and jitter moves it, to 50 at least; gaps up to 10 close."""
    return (
        F.when(F.col("action") == "overlap", F.greatest(F.lit(50), F.col("gap_ms") - F.col("overlap_ms")))
        .when(F.col("jitter_ms") != 0, F.greatest(F.lit(50), F.col("gap_ms") + F.col("jitter_ms")))
        .when(F.col("gap_ms") > 10, F.col("gap_ms"))
        .otherwise(0)
    )


def planned_timeline(turns: DataFrame, key: str) -> DataFrame:
    """Turns (key, turn, duration_ms, gap_ms, action, overlap_ms, jitter_ms) with start_ms after the plan; the last has no gap."""
    last = F.lead("turn").over(Window.partitionBy(key).orderBy("turn")).isNull()
    rows = turns.withColumn("__step", F.col("duration_ms") + F.when(last, 0).otherwise(gap_after()))
    return rows.select(*turns.columns, before("__step", [key], ["turn"]).alias("start_ms"))


def overlay(clips: DataFrame, key: str, limit: float = 1.0) -> DataFrame:
    """(key, idx, value) of clips (key, pos, nth, value) added where they meet, clamped to the limit.

    The long form: sums fold map-side and no signal is gathered in one place.
    """
    total = F.sum("value")
    return clips.select(key, (F.col("pos") + F.col("nth")).alias("idx"), "value").groupBy(key, "idx").agg(F.greatest(F.lit(-limit), F.least(F.lit(limit), total)).alias("value"))


def concat_segments(segments: DataFrame, key: str, rate: int) -> DataFrame:
    """(key, idx, value) of segments (key, seg, pause seconds, nth, value): one after another with their pauses."""
    sizes = segments.groupBy(key, "seg").agg((F.max("nth") + 1).alias("n"), F.max("pause").alias("pause"))
    starts = sizes.select(key, "seg", before(F.col("n") + (F.coalesce("pause", F.lit(0.0)) * rate).cast("long"), [key], ["seg"]).alias("at"))
    return segments.join(starts, [key, "seg"]).select(key, (F.col("at") + F.col("nth")).alias("idx"), "value")
