"""Planners: greedy constrained picks and seeded realism effects.

Random numbers are hashes of (seed, episode, place, effect): the same plan whatever the partitions, retries or
engine.  The greedy pick folds one episode's array, whose length is its number of lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import REACTIONS, backchannel_type, between, chance, uniform_bits
from .lookup import third_speakers


def backchannel_plan(lines: DataFrame, key: str, seed: int = 42, max_count: int = 12, min_gap: int = 5, min_turn_ms: int = 6000, lead: int = 2400) -> DataFrame:
    """(key, after, position, reactor) from lines (key, index, pos, speaker, duration_ms).

    A pick follows a long turn, a change of speaker and ``min_gap`` lines since the last pick; a third speaker reacts.
    """
    entry = F.struct("index", "pos", "speaker", "duration_ms")
    episodes = lines.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("l"), F.array_sort(F.collect_set("speaker")).alias("who"))
    start = F.expr(f"struct(cast({-min_gap} as int) as last, cast(array() as array<struct<after:int,position:bigint,reactor:string>>) as picks)")

    def step(acc: Column, i: Column) -> Column:
        prev, curr = F.get(F.col("l"), i - 1), F.get(F.col("l"), i)
        others = third_speakers(F.col("who"), prev["speaker"], curr["speaker"])
        draw = uniform_bits(seed, F.col(key), i, "reactor")
        ok = (F.size(acc["picks"]) < max_count) & (prev["speaker"] != curr["speaker"]) & (prev["duration_ms"] >= min_turn_ms) & (i - acc["last"] >= min_gap) & (F.size(others) > 0)
        pick = F.struct((i - 1).cast("int").alias("after"), (curr["pos"] - lead).cast("long").alias("position"), F.get(others, (draw % F.greatest(F.size(others), F.lit(1))).cast("int")).alias("reactor"))
        return F.struct(F.when(ok, i).otherwise(acc["last"]).cast("int").alias("last"), F.when(ok, F.concat(acc["picks"], F.array(pick))).otherwise(acc["picks"]).alias("picks"))

    places = F.when(F.size("l") > 1, F.sequence(F.lit(1), F.size("l") - 1)).otherwise(F.expr("cast(array() as array<int>)"))
    picks = episodes.select(key, F.aggregate(places, start, step, lambda acc: acc["picks"]).alias("picks"))
    return picks.select(key, F.explode("picks").alias("p")).select(key, "p.after", "p.position", "p.reactor")


def realism_plan(turns: DataFrame, key: str, seed: int = 42, overlap: float = 0.25, overlap_ms: tuple[int, int] = (80, 250), jitter: int = 120, filler: float = 0.15, breath: float = 0.3) -> DataFrame:
    """Turns (key, turn, duration_ms, gap_ms, emotion, text) with action, overlap_ms, jitter_ms, reaction, word, breath.

    The last turn stays as it is.  Overlaps take at most 80 % of a gap; jitter keeps 50 ms.
    """
    window = Window.partitionBy(key).orderBy("turn")
    draw = lambda effect: uniform_bits(seed, F.col(key), F.col("turn"), effect)
    rows = turns.withColumn("__next", F.lead("duration_ms").over(window))
    inner, gap = F.col("__next").isNotNull(), F.col("gap_ms")
    high = F.least(F.lit(overlap_ms[1]), F.floor(gap * 8 / 10).cast("int"))
    low = F.least(F.lit(overlap_ms[0]), high)
    overlaps = inner & (gap > 200) & chance(draw("overlap"), overlap) & (low < high)
    shift = between(draw("jitter"), F.lit(-jitter), F.lit(jitter))
    rows = rows.withColumn("action", F.when(overlaps, "overlap").otherwise("normal")).withColumn("overlap_ms", F.when(overlaps, between(draw("overlap_ms"), low, high)).otherwise(0).cast("int"))
    rows = rows.withColumn("jitter_ms", F.when(inner & (F.col("action") == "normal") & (gap > 100) & (gap + shift > 50), shift).otherwise(0).cast("int"))
    reaction = F.when(inner & (F.col("duration_ms") > 3000) & chance(draw("filler"), filler), backchannel_type(F.col("text"), F.col("emotion")))
    words = F.create_map(*(x for k, ws in REACTIONS.items() for x in (F.lit(k), F.array(*map(F.lit, ws)))))
    rows = rows.withColumn("reaction", reaction).withColumn("word", F.get(F.try_element_at(words, F.col("reaction")), (draw("word") % 3).cast("int")))
    breathes = inner & (gap > 300) & (F.col("action") != "overlap") & chance(draw("breath"), breath)
    rows = rows.withColumn("breath", F.when(breathes, F.when(F.col("__next") > 2000, "inhale").otherwise("exhale")))
    return rows.drop("__next")


def effect_places(planned: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """(key, turn, effect, at_ms) of reactions at 30 to 70 % of their turn and breaths half a second before the next.

    ``planned``: turns with start_ms, duration_ms, reaction, breath.
    """
    planned = planned.withColumn("__next", F.lead("start_ms").over(Window.partitionBy(key).orderBy("turn")))
    at = F.col("start_ms") + F.floor(F.col("duration_ms") * (300 + uniform_bits(seed, F.col(key), F.col("turn"), "filler_at") % 401) / 1000).cast("long")
    breath = F.greatest(F.lit(0), F.coalesce(F.col("__next") - 500, F.col("start_ms") + F.col("duration_ms"))).cast("long")
    both = planned.select(key, "turn", F.explode(F.array(F.struct(F.col("reaction").alias("effect"), at.alias("at_ms")), F.struct(F.col("breath").alias("effect"), breath.alias("at_ms")))).alias("e"))
    return both.where(F.col("e.effect").isNotNull()).select(key, "turn", "e.effect", "e.at_ms")


def effect_counts(planned: DataFrame, key: str) -> DataFrame:
    """A8."""
    return planned.groupBy(key).agg(
        F.count_if(F.col("action") == "overlap").alias("overlaps"), F.count_if(F.col("jitter_ms") != 0).alias("jitters"), F.count_if(F.col("breath").isNotNull()).alias("breaths"), F.count_if(F.col("reaction").isNotNull()).alias("reactions")
    )


def random_pauses(lines: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Lines (key, index, speaker) with pause_ms: 150 to 450 at a change of speaker, else 100 to 300."""
    change = F.lag("speaker").over(Window.partitionBy(key).orderBy("index")) != F.col("speaker")
    draw = uniform_bits(seed, F.col(key), F.col("index"), "pause")
    return lines.withColumn("pause_ms", F.when(change, 150 + draw % 301).otherwise(100 + draw % 201).cast("int"))


def clip_choices(placements: DataFrame, clips: DataFrame, key: str, seed: int = 42, rate_db: float = -3.0) -> DataFrame:
    """Placements (key, after, position, reactor) with the clip (file) of each, never the speaker's last one again.

    ``clips`` (speaker, clips, files).  The choice depends on the last, so each speaker's picks fold in order; there
    are at most a dozen in an episode.
    """
    rows = placements.join(clips, F.col("reactor") == F.col("speaker"))
    picks = rows.groupBy(key, "reactor").agg(F.array_sort(F.collect_list(F.struct("after", "position"))).alias("p"), F.first("files").alias("files"))
    start = F.expr("struct(cast(null as int) as last, cast(array() as array<int>) as chosen)")

    def step(acc: Column, p: Column) -> Column:
        n, draw = F.size("files"), uniform_bits(seed, F.col(key), p["after"], "clip")
        free = F.when(acc["last"].isNull() | (n <= 1), draw % F.greatest(n, F.lit(1))).otherwise((acc["last"] + 1 + draw % F.greatest(n - 1, F.lit(1))) % n).cast("int")
        return F.struct(free.alias("last"), F.concat(acc["chosen"], F.array(free)).alias("chosen"))

    chosen = picks.withColumn("c", F.aggregate("p", start, step, lambda acc: acc["chosen"]))
    flat = chosen.select(key, "reactor", "files", F.explode(F.arrays_zip("p", "c")).alias("x"))
    return flat.select(key, "reactor", F.col("x.p.after").alias("after"), F.col("x.p.position").alias("position"), F.get(F.col("files"), F.col("x.c")).alias("file"), F.pow(F.lit(10.0), F.lit(rate_db / 20)).alias("gain"))
