"""The text of an audio filter graph for each episode, from its planned turns.

Every turn gives its nodes as rows with an order; an ordered aggregation joins them.  A node's pads follow from its row alone, but for
the chain of mixes, where each takes the output of the one before: its number in the episode's list of effects tells which.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import between, uniform_bits
from .timeline import gap_after

#: Fixed values, the graph's own syntax: sound levels, bands (Hz), lengths (ms) and levels (millionths) of synthetic breaths.
FILLER_VOLUME, TONE_AMPLITUDE, TONE_WEIGHT, TONE_VOLUME = "0.3", "0.002", "0.12", 0.08
BREATHS = {"inhale": (800, 3500, 400, 600, 15_000, 25_000), "exhale": (600, 2500, 300, 500, 10_000, 20_000)}


def seconds(ms: Column) -> Column:
    """Milliseconds as seconds with six decimals."""
    return F.format_string("%.6f", ms / 1000)


def _cat(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _breath(rate: int, seed: int, key: str) -> Column:
    """The two filters of a turn's breath: noise in a band, rising and falling."""
    draw = lambda what: uniform_bits(seed, F.col(key), F.col("turn"), what)
    out = F.lit(None).cast("string")
    for kind, (low, high, short, long, soft, loud) in BREATHS.items():
        ms, level = between(draw("breath_ms"), F.lit(short), F.lit(long)), between(draw("breath_level"), F.lit(soft), F.lit(loud))
        # whole milliseconds, halves up
        part = lambda tenths, ms=ms: F.format_string("%.3f", F.floor((ms * tenths + 5) / 10) / 1000)
        text = _cat(
            f"anoisesrc=color=pink:sample_rate={rate}:amplitude=", F.format_string("%.6f", level / 1_000_000), ":duration=", part(10), "[bnoise_breath", F.col("turn"), "];",
            "[bnoise_breath", F.col("turn"), f"]bandpass=frequency={(low + high) // 2}:width_type=h:width={high - low},afade=t=in:d=", part(3), ",afade=t=out:st=", part(6), ":d=", part(4), "[breath", F.col("turn"), "]",
        )
        out = F.when(F.col("breath") == kind, text).otherwise(out)
    return out


def filter_graph(planned: DataFrame, places: DataFrame, key: str, rate: int, tone: str | None = None, tone_volume: float = TONE_VOLUME, no_tone: bool = False, seed: int = 42) -> DataFrame:
    """(key, graph, out_label, inputs): a graph's text, the label of its output, and the files it reads after the episode itself.

    ``planned`` (key, turn, from_ms in the source, duration_ms, gap_ms, action, overlap_ms, jitter_ms, breath, filler: a file or null,
    start_ms in the result), ``places`` (key, turn, effect, at_ms) of W17.  ``tone`` is a file under all, without it soft noise is,
    with ``no_tone`` nothing.  The longest episode's turns meet in one row, as its text does.
    """
    last = F.lead("turn").over(Window.partitionBy(key).orderBy("turn")).isNull()
    rows = planned.withColumn("pad", F.when(last, F.lit(0)).otherwise(gap_after()))
    pad = _cat(f"anullsrc=r={rate}:cl=mono[null_pad", F.col("turn"), "];[null_pad", F.col("turn"), "]atrim=duration=", seconds(F.col("pad")), "[pad", F.col("turn"), "]")
    cut = _cat("[inmono]atrim=", seconds(F.col("from_ms")), ":", seconds(F.col("from_ms") + F.col("duration_ms")), ",asetpts=N/SR/TB[s", F.col("turn"), "]")
    nodes = F.concat_ws(";", cut, F.when(F.col("pad") > 0, pad))
    labels = F.concat(_cat("[s", F.col("turn"), "]"), F.when(F.col("pad") > 0, _cat("[pad", F.col("turn"), "]")).otherwise(""))
    turn = F.struct("turn", nodes.alias("nodes"), labels.alias("labels"), F.when(F.col("pad") > 0, 2).otherwise(1).alias("n"), _breath(rate, seed, key).alias("breath"), (F.col("duration_ms") + F.col("pad")).alias("ms"))
    body = rows.groupBy(key).agg(F.array_sort(F.collect_list(turn)).alias("t"))
    # effects in the order of their mixes: fillers, then breaths
    kind = F.when(F.col("effect").isin(*BREATHS), 1).otherwise(0)
    effects = places.join(planned.select(key, "turn", "filler"), [key, "turn"]).where((kind == 1) | F.col("filler").isNotNull())
    effects = effects.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(kind.alias("kind"), "turn", "at_ms", F.when(kind == 0, F.col("filler")).alias("file")))).alias("e"))
    whole = body.join(effects, key, "left").withColumn("e", F.coalesce("e", F.expr("cast(array() as array<struct<kind:int,turn:int,at_ms:bigint,file:string>>)")))
    first = 1 + (tone is not None and not no_tone)
    mix = lambda e: _cat(F.when(e["kind"] == 0, "fmix").otherwise("bmix"), e["turn"])
    source = lambda i: F.when(i == 0, F.lit("joined")).otherwise(mix(F.get("e", i - 1)))

    def effect(e: Column, i: Column) -> Column:
        delay = _cat("adelay=", e["at_ms"], "|", e["at_ms"])
        into = F.when(e["kind"] == 0, _cat("filler", e["turn"])).otherwise(_cat("bd", e["turn"]))
        # fillers come first, so a filler's number is that of its input
        load = _cat("[", i + first, f":a]aformat=channel_layouts=mono,volume={FILLER_VOLUME},", delay, "[", into, "]")
        late = _cat("[breath", e["turn"], "]", delay, "[", into, "]")
        return F.concat(F.when(e["kind"] == 0, load).otherwise(late), _cat(";[", source(i), "][", into, "]amix=inputs=2:duration=first[", mix(e), "]"))

    mixed = F.when(F.size("e") > 0, mix(F.get("e", F.size("e") - 1))).otherwise(F.lit("joined"))
    total = seconds(F.aggregate("t", F.lit(0).cast("long"), lambda a, t: a + t["ms"]))
    if no_tone:
        under = F.lit(None).cast("string")
    elif tone is not None:
        under = _cat("[1:a]aformat=channel_layouts=mono,aloop=loop=-1:size=2000000000,atrim=duration=", total, f",volume={tone_volume}[roomvol];[", mixed, f"][roomvol]amix=inputs=2:weights=1|{tone_volume}:duration=first[roomed]")
    else:
        under = _cat(f"anoisesrc=color=pink:sample_rate={rate}:amplitude={TONE_AMPLITUDE}:duration=", total, "[roomnoise];[", mixed, f"][roomnoise]amix=inputs=2:weights=1|{TONE_WEIGHT}:duration=first[roomed]")
    count = F.aggregate("t", F.lit(0), lambda a, t: a + t["n"])
    joined = _cat(F.array_join(F.transform("t", lambda t: t["labels"]), ""), "concat=n=", count, ":v=0:a=1[joined]")
    breaths = F.filter(F.transform("t", lambda t: t["breath"]), lambda b: b.isNotNull())
    parts = F.concat(
        F.array(F.lit("[0:a]aformat=channel_layouts=mono[inmono]")), F.transform("t", lambda t: t["nodes"]), F.array(joined), breaths, F.transform("e", effect), F.array_compact(F.array(under))
    )
    files = F.concat(F.array(F.lit(tone)) if first == 2 else F.expr("cast(array() as array<string>)"), F.transform(F.filter("e", lambda e: e["kind"] == 0), lambda e: e["file"]))
    return whole.select(key, F.array_join(parts, ";").alias("graph"), F.when(F.lit(no_tone), mixed).otherwise(F.lit("roomed")).alias("out_label"), files.alias("inputs"))
