"""Roll-ups of statuses, reviews and reports: single-pass conditional aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def report_summary(results: DataFrame, key: list[str]) -> DataFrame:
    """A1, A2: totals by status; ``touched`` counts flagged rows and rejected paths, but no other errors."""
    s = F.col("status")
    return results.groupBy(*key).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s == "OK").alias("ok"),
        F.count_if(s == "FLAGGED").alias("flagged"),
        F.count_if(s == "ERROR").alias("errors"),
        F.count_if((s == "FLAGGED") | ((s == "ERROR") & F.col("rejected"))).alias("touched"),
    )


def gate(episodes: DataFrame, summaries: DataFrame, key: str) -> DataFrame:
    """A3: (key, passes): no flags and no errors; without a report it passes."""
    return episodes.select(key).join(summaries, key, "left").select(key, F.coalesce(F.col("flagged") + F.col("errors") == 0, F.lit(True)).alias("passes"))


def silence_stats(silences: DataFrame, key: str, max_pause: Column) -> DataFrame:
    """A4: total, kept and saved time."""
    kept = F.sum(F.least("duration", max_pause))
    return silences.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum("duration").alias("total"), kept.alias("kept"), (F.sum("duration") - kept).alias("saved"))


def clean_totals(reports: DataFrame) -> DataFrame:
    """A5, SK7: files, clicks, trimmed time."""
    return reports.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("clicks"), F.lit(0)).alias("clicks"), F.coalesce(F.sum("trimmed_ms"), F.lit(0.0)).alias("trimmed_ms"))


def clean_report(reports: DataFrame, key: str) -> DataFrame:
    """SK7: (key, report): the JSON of a folder of cleaned files (key, file, clicks, trimmed_ms, original_duration, cleaned_duration)."""
    entry = F.struct("file", F.col("clicks").alias("clicks_detected"), F.col("clicks").alias("clicks_repaired"), "trimmed_ms", "original_duration", "cleaned_duration")
    report = F.struct(
        F.count(F.lit(1)).alias("total_files"), F.sum("clicks").alias("total_clicks_repaired"), F.round(F.sum("trimmed_ms")).cast("long").alias("total_trimmed_ms"), F.array_sort(F.collect_list(entry)).alias("results")
    )
    return reports.groupBy(key).agg(F.to_json(report).alias("report"))


def speakers(lines: DataFrame, key: str) -> DataFrame:
    """(key, speakers) sorted."""
    return lines.groupBy(key).agg(F.array_sort(F.collect_set("speaker")).alias("speakers"))


def speaking_share(lines: DataFrame, key: str) -> DataFrame:
    """(key, speaker, words, share) of lines (key, speaker, words)."""
    rows = lines.groupBy(key, "speaker").agg(F.sum("words").alias("words"))
    return rows.withColumn("share", F.try_divide("words", F.sum("words").over(Window.partitionBy(key))))


def severity_counts(issues: DataFrame, key: str) -> DataFrame:
    """A9."""
    s = F.col("severity")
    return issues.groupBy(key).agg(F.count_if(s == "HIGH").alias("high"), F.count_if(s == "MEDIUM").alias("medium"), F.count_if(~F.coalesce(s.isin("HIGH", "MEDIUM"), F.lit(False))).alias("low"))


def score_counts(scores: DataFrame, key: str) -> DataFrame:
    """A10."""
    s = F.col("score")
    return scores.groupBy(key).agg(*(F.count_if(s == x).alias(x.lower()) for x in ("PASS", "PARTIAL", "FAIL")))


def needs_revision(issues: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """A10: any HIGH issue or FAIL score."""
    rows = severity_counts(issues, key).join(score_counts(scores, key), key, "full")
    return rows.select(key, ((F.coalesce("high", F.lit(0)) > 0) | (F.coalesce("fail", F.lit(0)) > 0)).alias("revise"))


def status_counts(rows: DataFrame) -> DataFrame:
    """A16, A18."""
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def review_digest(issues: DataFrame, notes: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """C11: (key, digest) of the lines a reader needs first.

    ``issues`` (key, nth, severity, type, explanation), ``notes`` (key, nth, type, note), ``scores`` (key, nth, item, score, evidence).
    HIGH then MEDIUM issues, five notes, every FAIL, three PARTIAL; long texts are cut.
    """

    def top(rows: DataFrame, rank: int, line: Column, most: int | None = None) -> DataFrame:
        out = rows.select(key, F.lit(rank).alias("rank"), "nth", line.alias("line"))
        if most is None:
            return out
        return out.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy("nth"))).where(F.col("__n") <= most).drop("__n")

    issue = F.format_string("  [%s] %s: %s", "severity", "type", F.left(F.coalesce("explanation", F.lit("")), F.lit(100)))
    score = lambda s: F.format_string(f"  {s}: %s - %s", "item", F.left(F.coalesce("evidence", F.lit("")), F.lit(80)))
    lines = (
        top(issues.where("severity = 'HIGH'"), 0, issue)
        .unionByName(top(issues.where("severity = 'MEDIUM'"), 1, issue))
        .unionByName(top(notes, 2, F.format_string("  [%s] %s", "type", F.left(F.coalesce("note", F.lit("")), F.lit(100))), 5))
        .unionByName(top(scores.where("score = 'FAIL'"), 3, score("FAIL")))
        .unionByName(top(scores.where("score = 'PARTIAL'"), 4, score("PARTIAL"), 3))
    )
    rows = lines.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", "nth", "line"))).alias("l"))
    return rows.select(key, F.concat_ws("\n", F.col("l.line")).alias("digest"))


def report_generations(reports: DataFrame, key: str, keep: int = 2) -> DataFrame:
    """SK1: of each key's reports (key, version) the newest and the one before it."""
    return reports.withColumn("generation", F.row_number().over(Window.partitionBy(key).orderBy(F.col("version").desc())) - 1).where(F.col("generation") < keep)
