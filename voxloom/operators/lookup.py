"""Lookups with fallbacks, positional joins and plans of clips.

The dimensions are fixed literals of at most a hundred rows or a map expression: they ride along in the plan or are
broadcast behind that bound.  Joins between tables are plain equi-joins, whose strategy adaptive execution picks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import CLIP_WORDS

#: Stability and style by speaker and emotion.
VOICE_SETTINGS = {
    "emma": {
        "default": (0.4, 0.4), "enthusiastic": (0.35, 0.5), "excited": (0.3, 0.55), "curious": (0.38, 0.45), "thoughtful": (0.5, 0.3), "calm": (0.55, 0.25), "warm": (0.45, 0.35),
        "surprised": (0.3, 0.5), "amused": (0.35, 0.45), "listening": (0.45, 0.2), "understanding": (0.42, 0.38), "realizing": (0.38, 0.45), "fascinated": (0.33, 0.48), "agreeing": (0.4, 0.4),
        "interested": (0.38, 0.42), "hesitant": (0.48, 0.25), "laughing": (0.3, 0.55), "moved": (0.5, 0.35), "practical": (0.4, 0.35), "confused": (0.35, 0.4), "amazed": (0.32, 0.5),
        "processing": (0.45, 0.35), "impressed": (0.38, 0.45), "philosophical": (0.5, 0.3), "observant": (0.42, 0.38), "descriptive": (0.4, 0.4), "questioning": (0.38, 0.42),
        "insightful": (0.38, 0.45), "connecting": (0.4, 0.42), "intrigued": (0.35, 0.48), "anticipating": (0.38, 0.45),
    },
    "lucas": {
        "default": (0.35, 0.4), "warm": (0.4, 0.35), "enthusiastic": (0.3, 0.5), "thoughtful": (0.45, 0.3), "calm": (0.5, 0.25), "confident": (0.38, 0.45), "amused": (0.32, 0.48),
        "explanatory": (0.38, 0.42), "confirming": (0.37, 0.4), "mysterious": (0.35, 0.5), "revealing": (0.33, 0.48), "excited": (0.3, 0.52), "proud": (0.38, 0.42), "meaningful": (0.42, 0.38),
        "passionate": (0.32, 0.52), "emphatic": (0.35, 0.48), "agreeing": (0.37, 0.4), "encouraging": (0.38, 0.42), "friendly": (0.4, 0.38), "curious": (0.35, 0.45), "surprised": (0.28, 0.52),
        "listening": (0.45, 0.25), "informative": (0.4, 0.38), "dramatic": (0.32, 0.5), "descriptive": (0.38, 0.4), "admiring": (0.4, 0.4), "genuinely interested": (0.38, 0.42),
    },
    "piet": {"default": (0.5, 0.3), "thoughtful": (0.6, 0.2), "passionate": (0.4, 0.5), "determined": (0.45, 0.4)},
}
GLOBAL_SETTINGS = (0.4, 0.4)

#: The prosody category of each emotion.
PROSODY = {
    "excited": ("excited", "enthusiastic", "passionate", "fascinated", "surprised", "amazed", "impressed", "realizing"),
    "calm": ("calm", "warm", "neutral", "casual", "quiet", "default", "friendly"),
    "emphatic": ("emphatic", "building", "confident", "explaining", "dramatic", "determined"),
    "contemplative": ("contemplative", "thoughtful", "curious", "reflective", "philosophical", "hesitant", "processing"),
    "urgent": ("urgent", "serious", "skeptical", "concerned", "rushed"),
}
DEFAULT_PROSODY = "calm"


def settings_table(spark: SparkSession) -> DataFrame:
    """(speaker, emotion, stability, style); 62 rows."""
    return spark.createDataFrame([(s, e, *v) for s, by in VOICE_SETTINGS.items() for e, v in by.items()], "speaker string, emotion string, stability double, style double")


def voice_settings(lines: DataFrame, offset: float = -0.10, least: float = 0.15, similarity: float = 0.95) -> DataFrame:
    """J1 (J2 with no offset, no least and similarity 0.8): ``lines`` (speaker, emotion, ...) with stability, style, similarity.

    The speaker's setting of the emotion, else the speaker's default, else the global one.
    """
    table = settings_table(lines.sparkSession)
    exact = F.broadcast(table.select(F.col("speaker").alias("__s"), F.col("emotion").alias("__e"), F.struct("stability", "style").alias("__exact")))
    default = F.broadcast(table.where("emotion = 'default'").select(F.col("speaker").alias("__d"), F.struct("stability", "style").alias("__default")))
    rows = lines.join(exact, (F.col("speaker") == F.col("__s")) & (F.col("emotion") == F.col("__e")), "left").join(default, F.col("speaker") == F.col("__d"), "left")
    found = F.coalesce("__exact", "__default", F.struct(F.lit(GLOBAL_SETTINGS[0]).alias("stability"), F.lit(GLOBAL_SETTINGS[1]).alias("style")))
    return rows.select(*lines.columns, F.greatest(F.lit(least), found["stability"] + offset).alias("stability"), found["style"].alias("style"), F.lit(similarity).alias("similarity"))


def prosody_category(emotion: Column) -> Column:
    known = F.create_map(*(F.lit(x) for c, es in PROSODY.items() for e in es for x in (e, c)))
    return F.coalesce(F.try_element_at(known, F.lower(emotion)), F.lit(DEFAULT_PROSODY))


def select_prosody(asked: DataFrame, refs: DataFrame) -> DataFrame:
    """``asked`` (voice, emotion, ...) with file and ref_text from ``refs`` (voice, ordinal, category, file, text).

    The category of the emotion, else the default category, else the voice's first; null for an unknown voice.
    """
    entry = F.struct("file", "text")
    by_category = refs.select(F.lower("voice").alias("__v"), F.col("category").alias("__c"), entry.alias("__exact"))
    by_voice = refs.groupBy(F.lower("voice").alias("__w")).agg(F.max(F.when(F.col("category") == DEFAULT_PROSODY, entry)).alias("__default"), F.min_by(entry, "ordinal").alias("__first"))
    rows = asked.withColumn("__k", F.lower("voice")).withColumn("__p", prosody_category(F.col("emotion")))
    rows = rows.join(by_category, (F.col("__k") == F.col("__v")) & (F.col("__p") == F.col("__c")), "left").join(by_voice, F.col("__k") == F.col("__w"), "left")
    found = F.coalesce("__exact", "__default", "__first")
    return rows.select(*asked.columns, found["file"].alias("file"), found["text"].alias("ref_text"))


def with_overrides(lines: DataFrame, overrides: DataFrame, key: list[str]) -> DataFrame:
    """``lines`` (key, index, text) with the text of an override (key, line_key, text) where there is one."""
    found = overrides.select(*key, F.col("line_key").alias("__k"), F.col("text").alias("__override"))
    rows = lines.withColumn("__k", F.format_string("%03d", F.col("index"))).join(found, [*key, "__k"], "left")
    return rows.select(*(c for c in lines.columns if c != "text"), F.coalesce("__override", "text").alias("text"), F.col("__override").isNotNull().alias("overridden"))


def by_position(left: DataFrame, right: DataFrame, key: list[str], index: str, how: str = "inner") -> DataFrame:
    """Rows with the same key and place; J7 drops the longer side's tail, J6 (``left``) keeps the left side's."""
    return left.join(right, [*key, index], how)


def padded_names(names: DataFrame, files: DataFrame, titles: DataFrame, key: str) -> DataFrame:
    """A name for every file (key, index): the section's, the title if there are no sections, else a number."""
    some = names.groupBy(key).agg(F.lit(True).alias("__some"))
    rows = files.join(names, [key, "index"], "left").join(some, key, "left").join(titles, key, "left")
    name = F.coalesce("name", F.when(F.col("__some").isNull() & (F.col("index") == 0), F.col("title")), F.concat(F.lit("Section "), F.col("index") + 1))
    return rows.select(*files.columns, name.alias("name"))


def revalidation(manifest: DataFrame, previous: DataFrame, key: str = "file") -> tuple[DataFrame, DataFrame]:
    """Previous rows that passed and are carried over, and manifest rows to do again."""
    passed = previous.where(F.col("status") == "OK")
    return passed.join(manifest.select(key), key, "left_semi"), manifest.join(passed.select(key), key, "left_anti")


def with_files(entries: DataFrame, listing: DataFrame, key: str) -> DataFrame:
    """``entries`` (key, index, file) with the file found: by name, else the first whose name begins with the index."""
    # names of their own: entries and listing may come from one table
    exact = listing.select(F.col(key).alias("__k"), F.col("file").alias("__exact"))
    prefix = listing.select(key, "file", F.regexp_extract("file", r"^(\d{3,})_", 1).alias("__p")).where("__p <> ''").groupBy(key, "__p").agg(F.min("file").alias("__first"))
    rows = entries.withColumn("__p", F.format_string("%03d", F.col("index")))
    rows = rows.join(exact, (F.col(key) == F.col("__k")) & (F.col("file") == F.col("__exact")), "left").drop("__k")
    rows = rows.join(prefix, [key, "__p"], "left")
    found = F.coalesce("__exact", "__first")
    return rows.select(*entries.columns, found.alias("found"), F.when(found.isNull(), "MISSING").otherwise("OK").alias("status"))


def third_speakers(speakers: Column, previous: Column, current: Column) -> Column:
    """Who neither spoke nor speaks."""
    return F.array_except(speakers, F.array(previous, current))


def voice_ids(lines: DataFrame, voices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines with a voice id, and the speakers that have none."""
    return lines.join(voices, "speaker"), lines.join(voices, "speaker", "left_anti").select("speaker").distinct()


def speaker_default(lines: DataFrame, table: DataFrame, value: str, default: float) -> DataFrame:
    """A speaker's value (volume, pause), or the default."""
    return lines.join(table.select("speaker", F.col(value).alias("__v")), "speaker", "left").select(*lines.columns, F.coalesce("__v", F.lit(default)).alias(value))


def clip_plan(voices: DataFrame) -> DataFrame:
    """(speaker, nth, word, file) of every named voice and word; the words are a literal array."""
    words = sorted({w for ws in CLIP_WORDS.values() for w in ws})
    rows = voices.where(F.coalesce("speaker", F.lit("")) != "").select("speaker", F.posexplode(F.array(*map(F.lit, words))).alias("nth", "word"))
    return rows.withColumn("file", F.format_string("bc_%s_%02d.wav", F.col("speaker"), F.col("nth")))


def api_method(speaker: Column, asked: Column, methods: dict[str, str], default: str = "dialogue") -> Column:
    """What was asked for, else the speaker's method, else the default."""
    known = F.create_map(*(F.lit(x) for kv in methods.items() for x in kv)) if methods else F.expr("map('', '')")
    return F.coalesce(asked, F.try_element_at(known, speaker), F.lit(default))


def env_voices(pairs: DataFrame, suffix: str = "") -> DataFrame:
    """SC17: (speaker, voice_id) of settings ``VOICE_<NAME><suffix>`` that aren't empty."""
    rows = pairs.where(F.col("name").startswith("VOICE_") & F.col("name").endswith(suffix) & (F.coalesce("value", F.lit("")) != ""))
    bare = F.expr(f"substring(name, 7, length(name) - 6 - {len(suffix)})")
    return rows.select(bare.alias("speaker"), F.col("value").alias("voice_id"))


def clip_library(files: DataFrame) -> DataFrame:
    """SC14, SC15: (speaker, clips, files) by the second part of names ``bc_<speaker>_<nn>.wav``."""
    rows = files.where(F.col("file").rlike(r"^bc_.*\.wav$")).select(F.get(F.split("file", "_"), F.lit(1)).alias("speaker"), "file")
    return rows.groupBy("speaker").agg(F.count(F.lit(1)).alias("clips"), F.array_sort(F.collect_list("file")).alias("files"))


def order_by_name_number(files: DataFrame, exclude: str) -> DataFrame:
    """SC9: section files (file, nth): the number in the name first, work files and the output left out."""
    name = F.col("file")
    kept = files.where(name.endswith(".mp3") & (name != exclude) & ~name.rlike(r"(\.work\.mp3|\.leveled\.mp3|\.bak|\.concat\.txt)$"))
    number = F.nullif(F.regexp_extract(name, r"_(\d+)_", 1), F.lit("")).cast("long")
    return kept.withColumn("number", number).withColumn("nth", F.row_number().over(Window.partitionBy(*(c for c in files.columns if c != "file")).orderBy(number.isNull(), number, name)) - 1)
