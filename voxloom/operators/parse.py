r"""Script text to rows.  The line and section grammars differ from each other on purpose; each has its own name.

Every parser is a projection and an ``explode`` of its own row, so nothing is shuffled but where kept lines are
numbered, which goes by script.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import SPACES, WORD, line_key, strip, word_count

_S, _W = f"[{SPACES}]", f"[{WORD}]"
#: The line grammars.
TAGGED = rf"^({_W}+):{_S}*\[({_W}+(?:{_S}+{_W}+)*)\]{_S}*(.*)"
BRACKETED = rf"^\[({_W}+)\]:{_S}*(?:\[([{WORD}{SPACES}]+)\]{_S}*)?(.+)$"
UPPER_NAME = rf"^([A-Z_]+):{_S}*(?:\[([{WORD}{SPACES}]+)\]{_S}*)?(.+)$"
REALISM = rf"^([A-Za-z_]+):{_S}*\[({_W}[{WORD}{SPACES}]*)\]{_S}*(.+)$"
TIMING = rf"^(.+?):{_S}*(?:\[([^\]]*)\]{_S}*)?(.*)"
HEADING = rf"^[A-Z][A-Z{SPACES}':,\-]+$"
CHECKED = rf"^[A-Za-z_]+:{_S}*\[[{WORD}{SPACES}]+\]{_S}*.+$"
SECTION = rf"={{20,}}{_S}*\n([^\n=]+){_S}*\n={{20,}}"
HEADER_AND_BODY = rf"(?s)={{20,}}{_S}*\n([^\n=]+)\n={{20,}}{_S}*\n(.*?)(?=={{20,}}{_S}*\n[^\n=]+\n={{20,}}|\z)"
LEADING_EMOTION = rf"^\[([^\]]+)\]{_S}*(?s:(.*))$"


def part(text: Column, pattern: str, group: int) -> Column:
    """A group of a match; null where there is no match."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def lines(scripts: DataFrame, key: str = "episode_id", content: str = "content") -> DataFrame:
    """(key, line, raw): the trimmed physical lines, numbered from 0."""
    return scripts.select(key, F.posexplode(F.split(F.col(content), "\n")).alias("line", "raw")).withColumn("raw", strip(F.col("raw")))


def _numbered(kept: DataFrame, key: str) -> DataFrame:
    return kept.withColumn("index", F.row_number().over(Window.partitionBy(key).orderBy("line")) - 1)


def tagged_line(line: Column) -> tuple[Column, Column, Column]:
    """Speaker, emotion, text; the emotion is required; all null without a match."""
    raw = strip(line)
    return F.lower(part(raw, TAGGED, 1)), F.lower(part(raw, TAGGED, 2)), strip(part(raw, TAGGED, 3))


def dialogue(scripts: DataFrame, key: str = "episode_id", content: str = "content") -> DataFrame:
    """(key, line, index, speaker, emotion, text); upper-case or bracketed names only, the emotion may be missing."""
    rows = lines(scripts, key, content).where((F.col("raw") != "") & ~F.col("raw").startswith("#") & ~F.col("raw").startswith("=="))
    raw = F.col("raw")
    pick = lambda k: F.coalesce(part(raw, BRACKETED, k), part(raw, UPPER_NAME, k))
    kept = rows.where(raw.rlike(BRACKETED) | raw.rlike(UPPER_NAME)).select(
        key, "line", F.upper(pick(1)).alias("speaker"), F.lower(strip(F.coalesce(F.nullif(pick(2), F.lit("")), F.lit("default")))).alias("emotion"), strip(pick(3)).alias("text")
    )
    return _numbered(kept, key)


def realism_lines(scripts: DataFrame, key: str = "episode_id", content: str = "content") -> DataFrame:
    """(key, line, index, speaker, emotion, text); the speaker's case is kept."""
    raw = F.col("raw")
    kept = lines(scripts, key, content).where(raw.rlike(REALISM)).select(key, "line", part(raw, REALISM, 1).alias("speaker"), F.lower(part(raw, REALISM, 2)).alias("emotion"), part(raw, REALISM, 3).alias("text"))
    return _numbered(kept, key)


def timing_lines(scripts: DataFrame, key: str = "episode_id", content: str = "content") -> DataFrame:
    """(key, line, index, speaker, text); headings and stage directions are skipped, kept lines numbered."""
    raw = F.col("raw")
    rows = lines(scripts, key, content).where((raw != "") & ~raw.startswith("=") & ~raw.startswith("#") & ~raw.rlike(HEADING) & ~raw.rlike(r"^\[.*\]$"))
    kept = rows.select(key, "line", F.lower(strip(part(raw, TIMING, 1))).alias("speaker"), strip(part(raw, TIMING, 3)).alias("text")).where(F.coalesce(F.col("text"), F.lit("")) != "")
    return _numbered(kept, key)


def intro_lines(scripts: DataFrame, key: str = "episode_id", content: str = "content") -> DataFrame:
    """P5: as P4 without the skips; the index is the physical line's."""
    raw = F.col("raw")
    rows = lines(scripts, key, content).select(key, F.col("line").alias("index"), F.lower(strip(part(raw, TIMING, 1))).alias("speaker"), strip(part(raw, TIMING, 3)).alias("text"))
    return rows.where(F.coalesce(F.col("text"), F.lit("")) != "")


def format_warnings(scripts: DataFrame, key: str = "episode_id", content: str = "content") -> DataFrame:
    """(key, line from 1, text cut at 80) of lines that break the format."""
    raw = F.col("raw")
    return lines(scripts, key, content).where((raw != "") & ~raw.rlike(CHECKED)).select(key, (F.col("line") + 1).alias("line"), F.left(raw, F.lit(80)).alias("text"))


def find_sections(scripts: DataFrame, key: str = "episode_id", content: str = "content") -> DataFrame:
    """(key, section, name) in document order."""
    found = scripts.select(key, F.filter(F.transform(F.regexp_extract_all(F.col(content), F.lit(SECTION), F.lit(1)), lambda x: strip(x)), lambda x: x != "").alias("names"))
    return found.select(key, F.posexplode("names").alias("section", "name"))


def section_bodies(scripts: DataFrame, key: str = "episode_id", content: str = "content", fold_case: bool = False) -> DataFrame:
    """P8 (P9 with ``fold_case``): (key, name, body); of a repeated name the first body."""
    names = F.regexp_extract_all(F.col(content), F.lit(HEADER_AND_BODY), F.lit(1))
    bodies = F.regexp_extract_all(F.col(content), F.lit(HEADER_AND_BODY), F.lit(2))
    rows = scripts.select(key, F.posexplode(F.arrays_zip(names.alias("name"), bodies.alias("body"))).alias("section", "s"))
    name = strip(F.col("s.name"))
    rows = rows.select(key, (F.lower(name) if fold_case else name).alias("name"), "section", strip(F.col("s.body")).alias("body"))
    return rows.groupBy(key, "name").agg(F.min_by("body", "section").alias("body"), F.min("section").alias("section"))


def section_text(scripts: DataFrame, asked: DataFrame, key: str = "episode_id", content: str = "content", fold_case: bool = False) -> DataFrame:
    """The body of each asked (key, name); empty where it is missing."""
    bodies = section_bodies(scripts, key, content, fold_case).select(key, F.col("name").alias("__name"), "body")
    name = F.lower("name") if fold_case else F.col("name")
    return asked.withColumn("__name", name).join(bodies, [key, "__name"], "left").select(key, "name", F.coalesce("body", F.lit("")).alias("body"))


def emotion_prefix(text: Column) -> tuple[Column, Column]:
    """A leading emotion and the rest, or ``default`` and the whole."""
    has = text.rlike(LEADING_EMOTION)
    return F.when(has, F.regexp_extract(text, LEADING_EMOTION, 1)).otherwise("default"), F.when(has, F.regexp_extract(text, LEADING_EMOTION, 2)).otherwise(text)


def parse_range(text: Column) -> Column:
    """struct(low, high) of ``lo-hi`` or ``n``; null unless both are whole numbers and low <= high."""
    low = F.try_to_number(F.split_part(text, F.lit("-"), F.lit(1)), F.lit("999999999")).cast("int")
    high = F.when(text.contains("-"), F.try_to_number(F.split_part(text, F.lit("-"), F.lit(2)), F.lit("999999999")).cast("int")).otherwise(low)
    return F.when(text.rlike(r"^\d+(-\d+)?$") & (low <= high), F.struct(low.alias("low"), high.alias("high")))


def silence_log(logs: DataFrame, key: str = "id", log: str = "log") -> DataFrame:
    """(key, nth, start, end, duration): the n-th start of a log belongs to its n-th end."""
    times = lambda what: F.regexp_extract_all(F.col(log), F.lit(rf"silence_{what}: ([0-9.]+)"), F.lit(1))
    pairs = logs.select(key, F.posexplode(F.arrays_zip(times("start").alias("s"), times("end").alias("e"))).alias("nth", "p"))
    rows = pairs.select(key, "nth", F.col("p.s").cast("double").alias("start"), F.col("p.e").cast("double").alias("end")).where(F.col("start").isNotNull() & F.col("end").isNotNull())
    return rows.withColumn("duration", F.col("end") - F.col("start"))


def loudness_log(log: Column) -> Column:
    """The input loudness of a report in a log."""
    return F.get_json_object(F.regexp_extract(log, r'(?s)(\{[^{}]*"input_i"[^{}]*\})', 1), "$.input_i").cast("double")


def fenced_json(text: Column) -> Column:
    """The text inside a code fence."""
    out = strip(text)
    out = F.when(out.startswith("```"), F.regexp_replace(out, r"(?s)^[^\n]*\n", "")).otherwise(out)
    return strip(F.when(out.endswith("```"), F.regexp_replace(out, r"(?s)```[^`]*$", "")).otherwise(out))


def parse_response(text: Column) -> Column:
    """struct(value VARIANT, raw, parse_error)."""
    bare = fenced_json(text)
    value = F.try_parse_json(bare)
    return F.struct(value.alias("value"), F.when(value.isNull(), bare).alias("raw"), value.isNull().alias("parse_error"))


def long_lines(scripts: DataFrame, min_words: int = 35, key: str = "episode_id", content: str = "content") -> DataFrame:
    """(key, line_key, text) of tagged lines with many words; parsed lines only are counted."""
    speaker, _, text = tagged_line(F.col("raw"))
    kept = lines(scripts, key, content).select(key, "line", speaker.alias("speaker"), text.alias("text")).where(F.coalesce(F.col("text"), F.lit("")) != "")
    numbered = _numbered(kept, key)
    return numbered.where(word_count(F.col("text")) >= min_words).select(key, line_key(F.col("index")).alias("line_key"), "text")
