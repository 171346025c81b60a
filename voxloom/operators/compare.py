"""Expected against transcribed text: what was inserted, lost or drifted.  Row-local array functions throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text import DEFAULT_SECONDS_PER_WORD, duration_ratio, max_duration, word_count

#: The limits of each flag.
MIN_OVERLAP, LONG_RATIO, SHORT_RATIO, DURATION_RATIO, SILENT_SECONDS, MIN_MOS, MIN_SIMILARITY = 0.7, 1.4, 0.5, 2.0, 0.5, 3.5, 0.75
assert DEFAULT_SECONDS_PER_WORD > 0


def normal_words(text: Column) -> Column:
    return T.normal_words(F.coalesce(text, F.lit("")))


def extra_at_start(expected: Column, actual: Column) -> Column:
    """Words before the first expected word; 0 unless the actual text is longer."""
    first = F.coalesce(F.get(expected, F.lit(0)), F.lit(""))
    at = F.array_position(actual, first)
    return F.when(F.size(actual) > F.size(expected), F.when(at == 0, F.size(actual)).otherwise(at - 1)).otherwise(0).cast("int")


def extra_at_end(expected: Column, actual: Column) -> Column:
    """Words after the last expected word, at its place nearest to where it should be (the earlier of two)."""
    last, at = F.get(expected, F.size(expected) - 1), F.greatest(F.size(expected), F.lit(1))  # from 1
    ahead = F.array_position(F.slice(actual, at, F.size(actual)), last) - 1
    back = F.array_position(F.reverse(F.slice(actual, F.lit(1), at)), last) - 1
    nearest = lambda x: F.when((x["back"] >= 0) & ((x["ahead"] < 0) | (x["back"] <= x["ahead"])), at - x["back"]).when(x["ahead"] >= 0, at + x["ahead"])
    # the two searches are an element, so each is made once
    found = F.transform(F.array(F.struct(back.alias("back"), ahead.alias("ahead"))), nearest)
    place = F.when(F.get(actual, at - 1) == last, at).otherwise(F.get(found, F.lit(0)))
    return F.when(F.size(actual) > F.size(expected) + 3, F.coalesce(F.size(actual) - place, F.lit(0))).otherwise(0).cast("int")


def overlap_share(expected: Column, actual: Column) -> Column:
    """Share of the distinct expected words that occur; null without any.

    Where the expected words stand in the actual text as they are, all of them occur, and nothing is hashed; else the set is
    made of the shorter of the two.
    """
    n = F.size(expected)
    whole = (n > 0) & (F.slice(actual, extra_at_start(expected, actual) + 1, n) == expected)
    both = F.when(F.size(actual) < n, F.array_intersect(expected, actual)).otherwise(F.array_intersect(actual, expected))
    return F.when(whole, 1.0).otherwise(F.try_divide(F.size(both), F.size(F.array_distinct(expected))))


def length_ratio(expected: Column, actual: Column) -> Column:
    """C4."""
    return F.size(actual) / F.greatest(F.size(expected), F.lit(1))


def measure_flags(extra_start: Column, extra_end: Column, share: Column, ratio: Column) -> Column:
    """The names of the flags, in their order, of the four measures."""
    return F.array_compact(
        F.array(
            F.when(extra_start > 1, "HALLUCINATION_START"),
            F.when(extra_end > 0, "HALLUCINATION_END"),
            F.when(share < MIN_OVERLAP, "LOW_OVERLAP"),
            F.when(ratio > LONG_RATIO, "TOO_LONG").when(ratio < SHORT_RATIO, "TOO_SHORT"),
        )
    )


def compare_words(pairs: DataFrame, expected: str = "expected_words", actual: str = "actual_words") -> DataFrame:
    """``pairs`` of word arrays (F1's) with the measures of C1 to C4, flags and ok; the arrays go."""
    e, t = F.col(expected), F.col(actual)
    kept = [c for c in pairs.columns if c not in (expected, actual)]
    rows = pairs.select(*kept, extra_at_start(e, t).alias("extra_start"), extra_at_end(e, t).alias("extra_end"), overlap_share(e, t).alias("overlap"), length_ratio(e, t).alias("ratio"))
    return rows.withColumn("flags", measure_flags(F.col("extra_start"), F.col("extra_end"), F.col("overlap"), F.col("ratio"))).withColumn("ok", F.size("flags") == 0)


def compare(pairs: DataFrame, expected: str = "expected", actual: str = "actual") -> DataFrame:
    """``pairs`` with the measures of C1 to C4, flags and ok; null texts are empty."""
    return compare_words(pairs.withColumn("__e", normal_words(F.col(expected))).withColumn("__t", normal_words(F.col(actual))), "__e", "__t")


def duration_flag(duration: Column, words: Column, seconds_per_word: Column) -> Column:
    """What a duration alone shows; such rows never reach transcription."""
    return F.when(duration < SILENT_SECONDS, "SILENT").when((words > 0) & (duration > max_duration(words, seconds_per_word)), "DURATION_ANOMALY")


def slow_flag(duration: Column, words: Column, language: Column) -> Column:
    """C7."""
    return F.when(duration_ratio(duration, words, language) > DURATION_RATIO, "DURATION")


def quality_flags(mos: Column, similarity: Column, language_match: Column) -> Column:
    """A missing measure flags nothing."""
    return F.array_compact(F.array(F.when(mos < MIN_MOS, "LOW_MOS"), F.when(similarity < MIN_SIMILARITY, "VOICE_DRIFT"), F.when(~language_match, "WRONG_LANGUAGE")))


def status(exists: Column, early: Column, transcription: Column, flags: Column) -> Column:
    """A missing file, then the duration, then a failed transcription, then the flags decide."""
    return F.when(~exists, "ERROR").when(early.isNotNull(), "FLAGGED").when(transcription.isNull(), "ERROR").when(F.size(flags) > 0, "FLAGGED").otherwise("OK")


def validate(rows: DataFrame) -> DataFrame:
    """C9 for rows (exists, duration, language, expected, transcription, seconds_per_word, mos, similarity, language_match).

    Adds status and issues.  Rows that a missing file or the cheap duration flag settles have their texts cut to nothing
    before the comparison, so nothing of them is normalised.  Rows that bring ``expected_words`` and ``actual_words`` (F1's
    words) and ``words`` (F2) instead of the two texts are not normalised again.
    """
    given = "expected_words" in rows.columns
    words = F.col("words") if given else word_count(F.col("expected"))
    early = rows.withColumn("__words", words).withColumn("__early", duration_flag(F.col("duration"), F.col("__words"), F.col("seconds_per_word")))
    e, t = ("expected_words", "actual_words") if given else ("expected", "transcription")
    heard = F.col(t).isNotNull()
    asked = F.col("exists") & F.col("__early").isNull() & heard
    sides = [F.when(asked, F.col(x) if given else normal_words(F.col(x))) for x in (e, t)]
    # measures in columns of their own: each is computed once
    marked = early.select("*", asked.alias("__asked"), heard.alias("__heard"), *(x.alias(k) for x, k in zip(sides, ("__e", "__t"), strict=True)))
    a, b = F.col("__e"), F.col("__t")
    marked = marked.select("*", extra_at_start(a, b).alias("__start"), extra_at_end(a, b).alias("__end"), overlap_share(a, b).alias("__share"), length_ratio(a, b).alias("__ratio"))
    late = F.concat(
        measure_flags(F.col("__start"), F.col("__end"), F.col("__share"), F.col("__ratio")),
        F.array_compact(F.array(slow_flag(F.col("duration"), F.col("__words"), F.col("language")))),
        quality_flags(F.col("mos"), F.col("similarity"), F.col("language_match")),
    )
    marked = marked.withColumn("__late", late)
    kind = status(F.col("exists"), F.col("__early"), F.when(F.col("__heard"), F.lit("")), F.col("__late"))
    issues = (
        F.when(~F.col("exists"), F.array(F.lit("FILE_NOT_FOUND")))
        .when(F.col("__early").isNotNull(), F.array("__early"))
        .when(~F.col("__heard"), F.array(F.lit("TRANSCRIPTION_FAILED")))
        .otherwise(F.col("__late"))
    )
    return marked.select(*rows.columns, kind.alias("status"), issues.alias("issues"))
