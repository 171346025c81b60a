"""Exact-value cases of the script, comparison, timeline, plan and signal operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.operators import compare as C
from voxloom.operators import lookup as L
from voxloom.operators import nested as N
from voxloom.operators import parse as P
from voxloom.operators import plan as Q
from voxloom.operators import rollup as R
from voxloom.operators import timeline as M
from voxloom.sources import files as S
from voxloom.streaming import streams

BAR = "=" * 24
SCRIPT = f"""{BAR}
OPENING
{BAR}
EMMA: [warm] Hello there.
LUCAS: [curious] What is this about?

{BAR}
CLOSING
{BAR}
EMMA: Bye now.
# a note
Lisa: [calm] lost line
"""


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def one(spark, column, **inputs):
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in inputs.items()))
    return row.select(column.alias("x")).first().x


@pytest.fixture(scope="module")
def script(spark):
    return spark.createDataFrame([("e", SCRIPT)], "episode_id string, content string")


def test_voice_sample_estimates(spark):
    assert one(spark, T.sample_minutes(T.word_count(F.col("t"))), t=" some words here " * 75) == 1.5
    assert one(spark, T.sample_seconds(F.lit(1_000_000))) == 62.5
    assert one(spark, T.sample_seconds(F.lit(None).cast("long"))) is None


def test_text_functions(spark):
    assert one(spark, T.normalize_text(F.col("t")), t="It's a beautiful day, isn't it?") == "its a beautiful day isnt it"
    assert one(spark, T.normalize_text(F.col("t")), t="  hello   world  ") == "hello world"
    assert one(spark, T.word_count(F.col("t")), t="") == 0
    assert one(spark, T.srt_time(F.lit(3_661_500))) == "01:01:01,500"
    assert one(spark, T.srt_time(F.lit(360_000_001))) == "100:00:00,001"
    assert one(spark, T.shorten(F.col("t")), t="word " * 30) == ("word " * 15).strip() + "..."
    assert one(spark, T.max_duration(F.lit(50), F.lit(0.4))) == 50.0
    assert one(spark, T.max_duration(F.lit(50), F.lit(None).cast("double"))) == 40.0
    assert one(spark, T.calibrated_rate(F.lit(5.0), F.lit(10))) == 0.5
    assert one(spark, T.calibrated_rate(F.lit(5.0), F.lit(1))) is None
    assert one(spark, T.path_rejected(F.lit("../../etc/passwd"))) and not one(spark, T.path_rejected(F.lit("a/b..c.wav")))
    assert one(spark, T.backchannel_type(F.lit("Really? "), F.lit("calm"))) == "agreement"
    assert one(spark, T.backchannel_type(F.lit("Wow."), F.lit("excited"))) == "surprise"
    assert one(spark, T.backchannel_type(F.lit("A. B. C. D."), F.lit("calm"))) == "tracking"
    assert one(spark, T.backchannel_type(F.lit("Okay."), F.lit("calm"))) is None
    assert [tuple(x) for x in one(spark, T.cast_roles(F.lit("anna, ben ,zoe")))] == [("Anna", "host"), ("Ben", "expert"), ("Zoe", "source voice")]
    assert one(spark, T.cast_roles(F.lit("anna"))) is None


def test_line_grammars(spark, script):
    s, e, t = P.tagged_line(F.col("x"))
    row = spark.createDataFrame([("  Emma:  [calm]  Some spaced text  ",), ("Emma: no tag",), ("Emma: [very calm] x",)], "x string").select(s.alias("s"), e.alias("e"), t.alias("t"))
    assert values(row, "s", "e", "t") == [("emma", "calm", "Some spaced text"), (None, None, None), ("emma", "very calm", "x")]
    assert values(P.dialogue(script).orderBy("line"), "index", "speaker", "emotion", "text") == [(0, "EMMA", "warm", "Hello there."), (1, "LUCAS", "curious", "What is this about?"), (2, "EMMA", "default", "Bye now.")]
    assert values(P.realism_lines(script).orderBy("line"), "index", "speaker") == [(0, "EMMA"), (1, "LUCAS"), (2, "Lisa")]
    assert values(P.timing_lines(script).orderBy("line"), "index", "speaker") == [(0, "emma"), (1, "lucas"), (2, "emma"), (3, "lisa")]
    assert len(values(P.format_warnings(script), "line")) == 8


def test_sections(spark, script):
    assert values(P.find_sections(script).orderBy("section"), "name") == [("OPENING",), ("CLOSING",)]
    asked = spark.createDataFrame([("e", "OPENING"), ("e", "opening"), ("e", "NONE")], "episode_id string, name string")
    got = dict(values(P.section_text(script, asked), "name", "body"))
    assert got["OPENING"].startswith("EMMA: [warm]") and got["OPENING"].endswith("about?") and got["opening"] == "" and got["NONE"] == ""
    assert dict(values(P.section_text(script, asked, fold_case=True), "name", "body"))["opening"] == got["OPENING"]


@pytest.mark.parametrize(
    "expected,actual,flags",
    [
        ("The cat sat on the mat", "Welcome to our show today The cat sat on the mat", ["HALLUCINATION_START", "TOO_LONG"]),
        ("one two three four five six", "one two three four five six seven eight nine ten extra", ["HALLUCINATION_END", "TOO_LONG"]),
        ("the quick brown fox", "some other words entirely", ["LOW_OVERLAP"]),
        ("a b c d e f g h i j", "short", ["LOW_OVERLAP", "TOO_SHORT"]),
        ("some words", "", ["LOW_OVERLAP", "TOO_SHORT"]),
        ("", "", ["TOO_SHORT"]),
        ("same words here", "Same words, here!", []),
        ("a b", "a x b y b z w q", ["HALLUCINATION_END", "TOO_LONG"]),
    ],
)
def test_compare(spark, expected, actual, flags):
    assert C.compare(spark.createDataFrame([(expected, actual)], "expected string, actual string")).first().flags == flags


def test_turns_and_chapters(spark):
    silences = spark.createDataFrame([("a", 1.0, 1.5, 0.5), ("a", 3.0, 3.8, 0.8)], "k string, start double, end double, duration double")
    turns = M.split_turns(silences, spark.createDataFrame([("a", 5.0), ("b", 2.0)], "k string, total double"), "k").orderBy("k", "turn")
    assert [(k, round(s, 3), round(g, 3)) for k, s, g in values(turns, "k", "start", "gap_after")] == [("a", 0.0, 0.5), ("a", 1.5, 0.8), ("a", 3.8, 0.0), ("b", 0.0, 0.0)]
    sections = spark.createDataFrame([("e", k, f"s{k}", d) for k, d in enumerate((30_000, 120_000, 45_000))], "k string, index int, name string, duration_ms long")
    assert values(M.chapters(sections, "k").orderBy("index"), "start_ms") == [(0,), (30_000,), (150_000,)]
    lines = spark.createDataFrame([("e", 0, "a b c"), ("e", 1, "a b c d e f")], "k string, index int, text string")
    section = spark.createDataFrame([("e", 10_000, 9_000)], "k string, section_start_ms long, section_ms long")
    assert values(M.word_timeline(lines, section, ["k"], ["index"]).orderBy("index"), "start_ms", "end_ms") == [(10_000, 13_000), (13_000, 19_000)]


def test_plans(spark):
    names = ["alex", "morgan", "zara"]
    rows = [("e", i, i * 50_000, names[i % 3], 8000 if i % 5 == 0 else 2000) for i in range(30)]
    lines = spark.createDataFrame(rows, "k string, index int, pos long, speaker string, duration_ms int")
    picks = sorted(values(Q.backchannel_plan(lines, "k"), "after", "position", "reactor"))
    assert picks == sorted(values(Q.backchannel_plan(lines.repartition(5), "k"), "after", "position", "reactor")) and 0 < len(picks) <= 12
    for after, position, reactor in picks:
        assert rows[after][4] >= 6000 and position == rows[after + 1][2] - 2400 and reactor not in (rows[after][3], rows[after + 1][3])
    assert all(b[0] - a[0] >= 5 for a, b in zip(picks, picks[1:]))
    turns = spark.createDataFrame([("e", i, 4000, 150 * i, "calm", "words " * 20) for i in range(12)], "k string, turn int, duration_ms int, gap_ms int, emotion string, text string")
    plan = Q.realism_plan(turns, "k", overlap=1.0).orderBy("turn").collect()
    assert plan[-1].action == "normal" and plan[-1].jitter_ms == 0 and plan[-1].breath is None
    assert all(r.overlap_ms <= 0.8 * r.gap_ms for r in plan) and any(r.action == "overlap" for r in plan)
    assert all(r.action == "normal" for r in Q.realism_plan(turns, "k", overlap=0.0).collect())


def test_lookups(spark):
    lines = spark.createDataFrame([("emma", "excited"), ("emma", "odd"), ("who", "calm")], "speaker string, emotion string")
    got = {(r.speaker, r.emotion): (round(r.stability, 3), r.style) for r in L.voice_settings(lines).collect()}
    assert got == {("emma", "excited"): (0.2, 0.55), ("emma", "odd"): (0.3, 0.4), ("who", "calm"): (0.3, 0.4)}
    refs = spark.createDataFrame([("emma", 0, "excited", "x.wav", "t"), ("emma", 1, "calm", "c.wav", "u"), ("felix", 0, "urgent", "f.wav", "v")], "voice string, ordinal int, category string, file string, text string")
    asked = spark.createDataFrame([("EMMA", "Fascinated"), ("emma", "odd"), ("felix", "emphatic"), ("nobody", "calm")], "voice string, emotion string")
    assert dict(values(L.select_prosody(asked, refs), "emotion", "file")) == {"Fascinated": "x.wav", "odd": "c.wav", "emphatic": "f.wav", "calm": None}


def test_wave_files():
    x = (0.1 * np.sin(2 * np.pi * 440 * np.arange(12_000) / 24_000)).astype(np.float32)
    samples, out_rate = S.decode_wav(S.encode_wav(x, 24_000))
    assert out_rate == 24_000 and np.allclose(samples, x, atol=1e-4)


def test_nested_json(spark):
    files = spark.createDataFrame([("a", '{"overrides": {"015": "plain", "031": [{"text": "x", "pause_after": 0.5}, {"text": "y"}]}}'), ("b", "{}")], "k string, json string")
    assert sorted(values(N.overrides(files, "k"), "line_key", "seg", "text", "pause_after")) == [("015", 0, "plain", 0.0), ("031", 0, "x", 0.5), ("031", 1, "y", 0.0)]
    manifests = spark.createDataFrame([("a", '[{"file": "1.wav"}]'), ("b", '{"main": [{"file": "2.wav"}], "intro": [{"file": "3.wav"}]}')], "k string, json string")
    assert sorted(values(N.manifest_entries(manifests, "k"), "k", "nth", "file")) == [("a", 0, "1.wav"), ("b", 0, "2.wav"), ("b", 1, "3.wav")]
    text = spark.createDataFrame([('```json\n{"a": 1}\n```',), ("oops",)], "t string").select(P.parse_response(F.col("t")).alias("r")).select("r.parse_error", "r.raw")
    assert values(text, "parse_error", "raw") == [(False, None), (True, "oops")]


def test_rollups(spark):
    results = spark.createDataFrame([("e", "OK", False), ("e", "FLAGGED", False), ("e", "ERROR", True), ("f", "OK", False)], "k string, status string, rejected boolean")
    summary = R.report_summary(results, ["k"])
    assert sorted(values(summary, "k", "total", "ok", "flagged", "errors", "touched")) == [("e", 3, 1, 1, 1, 2), ("f", 1, 1, 0, 0, 0)]
    episodes = spark.createDataFrame([("e",), ("f",), ("none",)], "k string")
    assert dict(values(R.gate(episodes, summary, "k"), "k", "passes")) == {"e": False, "f": True, "none": True}


def test_streams(spark, tmp_path):
    columns = "file string, exists boolean, duration double, language string, expected string, transcription string, seconds_per_word double, mos double, similarity double, language_match boolean"
    rows = spark.createDataFrame([("a.wav", True, 1.0, "en", "two words here", "two words here", None, None, None, None), ("b.wav", True, 0.1, "en", "x", "x", None, None, None, None)], columns)
    rows.write.parquet(str(tmp_path / "in"))
    for n in (2, 3):  # the second run sees the same rows as new and validates only what hasn't passed
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        streams.revalidate_stream(stream, str(tmp_path / "out"), str(tmp_path / f"check{n}")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == n
    heard = streams.transcribed(rows.select("file"), lambda: lambda f: f.upper() if f[0] == "a" else 1 / 0)
    assert sorted((r.file, r.transcription, bool(r.error)) for r in heard.collect()) == [("a.wav", "A.WAV", False), ("b.wav", None, True)]
