"""Whole jobs composed of operators: publishing an episode, validating a manifest, adding realism, preparing and placing audio."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import calibrated_rate, path_rejected, title_from_stem
from ..operators import chunked, compare, lookup, parse, plan, production, timeline


def publish(scripts: DataFrame, files: DataFrame, intro_ms: int | None = None) -> dict[str, DataFrame]:
    """Chapters, transcript, subtitles and notes of scripts (episode_id, content) and files (episode_id, index, duration_ms).

    A script without sections is one chapter under its title, without a transcript.
    """
    key = "episode_id"
    names = parse.find_sections(scripts, key).select(key, F.col("section").alias("index"), "name")
    titles = scripts.select(key, title_from_stem(F.col(key)).alias("title"))
    named = lookup.padded_names(names, files, titles, key)
    offset = F.lit(0) if intro_ms is None else timeline.intro_offset_ms(F.lit(intro_ms))
    chapters = timeline.chapters(named, key, offset)
    starts = chapters.join(files, [key, "index"]).select(key, "name", F.col("index").alias("section"), F.col("start_ms").alias("section_start_ms"), F.col("duration_ms").alias("section_ms"))
    bodies = parse.section_bodies(scripts, key).select(key, "name", F.col("body").alias("content"))
    keyed = starts.join(bodies, [key, "name"]).withColumn("part", F.concat_ws("\u0001", key, F.col("section").cast("string")))
    lines = parse.dialogue(keyed, "part").join(keyed.select("part", key, "section"), "part")
    times = keyed.select("part", "section_start_ms", "section_ms")
    transcript = timeline.word_timeline(lines, times, ["part"], ["index"]).select(key, "section", "index", "speaker", "text", "start_ms", "end_ms")
    first = lines.where("index = 0").select(key, "section", "text")
    notes = timeline.show_notes(named.select(key, F.col("index").alias("section"), "name").join(titles, key), first, parse.dialogue(scripts, key), key)
    return {"chapters": timeline.chapters_json(chapters, key), "transcript": transcript, "srt": timeline.srt(transcript, key, ["section", "index"]), "notes": notes}


def validate_manifest(manifest: DataFrame, previous: DataFrame | None, transcribe: Callable[[DataFrame], DataFrame], references: DataFrame | None = None) -> DataFrame:
    """(nth, file, status, issues) of a manifest (nth, file, exists, duration, language, expected, mos, similarity, language_match, ref_audio, ref_text).

    Rejected paths are errors; files that passed before are carried over; what a duration alone shows is never transcribed;
    ``transcribe`` adds the column ``transcription`` to the rest.  ``references`` (file, duration) are the lengths of voice samples: an
    entry's own ``ref_audio``, unless its path is rejected, and its words calibrate the seconds a word may take (F6).  ``nth`` is the
    manifest's order, in which the result is to be read; an entry without a sample, or with fewer than three words, has the default.
    """
    rated = manifest
    if references is not None:
        lengths = references.select(F.col("file").alias("ref_audio"), F.col("duration").alias("ref_duration"))
        rate = F.when(~path_rejected(F.col("ref_audio")), calibrated_rate(F.col("ref_duration"), compare.word_count(F.col("ref_text"))))
        rated = manifest.join(lengths, "ref_audio", "left").withColumn("seconds_per_word", rate).drop("ref_duration")
    elif "seconds_per_word" not in manifest.columns:
        rated = manifest.withColumn("seconds_per_word", F.lit(None).cast("double"))
    rejected = rated.where(path_rejected(F.col("file"))).select("nth", "file", F.lit("ERROR").alias("status"), F.array(F.lit("REJECTED_PATH")).alias("issues"))
    rest = rated.where(~path_rejected(F.col("file")))
    out = rejected
    if previous is not None:
        carried, rest = lookup.revalidation(rest, previous)
        out = out.unionByName(carried.join(rated.select("nth", "file"), "file").select("nth", "file", "status", "issues"))
    early = compare.duration_flag(F.col("duration"), compare.word_count(F.col("expected")), F.col("seconds_per_word"))
    cheap = (~F.col("exists")) | early.isNotNull()
    silent = rest.where(cheap).withColumn("transcription", F.lit(None).cast("string"))
    heard = transcribe(rest.where(~F.coalesce(cheap, F.lit(False))))
    return out.unionByName(compare.validate(silent.unionByName(heard, allowMissingColumns=True)).select("nth", "file", "status", "issues"))


def realism(silences: DataFrame, totals: DataFrame, lines: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Turns with their effects and new start times; episodes of fewer than two turns are left out, as nothing changes."""
    ms = lambda c: F.floor(F.col(c) * 1000 + 0.5).cast("int")
    turns = timeline.split_turns(silences, totals, key).select(key, F.col("turn").cast("int").alias("turn"), ms("duration").alias("duration_ms"), ms("gap_after").alias("gap_ms"))
    talk = lines.select(key, F.col("index").alias("turn"), "emotion", "text")
    several = turns.groupBy(key).count().where("count > 1").select(key)
    return timeline.planned_timeline(plan.realism_plan(turns.join(several, key, "left_semi").join(talk, [key, "turn"], "left"), key, seed), key)


def each_rate(signals: DataFrame, f: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """f of the signals of each sampling rate (``sr``; a handful in any collection), together."""
    rates = sorted(r.sr for r in signals.select("sr").distinct().collect())
    parts = [f(signals.where(F.col("sr") == rate), rate) for rate in rates] or [f(signals, 1)]
    return reduce(DataFrame.unionByName, parts)


def prepare_folder(manifest: DataFrame, signals: DataFrame, volumes: DataFrame, rate: int = 24_000, dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """(file, status): REJECTED paths, MISSING files, DRY ones of a dry run, OK; and the prepared lines (file, idx, value).

    ``manifest`` (file, speaker), ``signals`` (file, samples, sr), ``volumes`` (speaker, db).
    """
    rows = lookup.speaker_default(manifest, volumes, "db", 0.0).join(signals.select("file", F.lit(True).alias("there")), "file", "left")
    status = F.when(path_rejected(F.col("file")), "REJECTED").when(F.col("there").isNull(), "MISSING").otherwise("DRY" if dry_run else "OK")
    rows = rows.select("file", "db", status.alias("status"))
    chosen = signals.join(rows.where("status = 'OK'").select("file", "db"), "file")
    ready = each_rate(chosen, lambda some, sr: production.prepared(chunked.long_of(production.split(some, "file"), "file"), "file", sr, rate))
    # a gain commutes with reverb and fades
    scaled = ready.join(rows.select("file", "db"), "file").select("file", "idx", (F.col("value") * F.pow(F.lit(10.0), F.col("db") / 20)).alias("value"))
    return rows.select("file", "status"), scaled
