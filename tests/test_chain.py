"""The chain of passes with its ledger, the watched model, the filter graph, and sessions on a stream with late rows."""

import datetime
import json
import re

from pyspark.sql import functions as F

from voxloom.operators import graph, plan, timeline
from voxloom.plans.lookup_queries import _writer
from voxloom.streaming import chain, streams


def counted(folder):
    """The stand-in model, which leaves a line for each call in a file of its own."""

    def load():
        import uuid

        answer, at = _writer(), f"{folder}/{uuid.uuid4().hex}"

        def call(prompt):
            with open(at, "a") as f:
                f.write(prompt.split("\n")[0].split()[0] + "\n")
            return answer(prompt)

        return call

    return load


def calls(folder):
    return sorted(x for p in folder.iterdir() for x in p.read_text().split())


def episodes(spark, sources):
    rows = [(k, s, None, ["EMMA", "LUCAS"], "en", 10) for k, s in sources.items()]
    return spark.createDataFrame(rows, "episode_id string, source string, topic string, cast array<string>, language string, minutes int")


def test_chain_never_asks_twice(spark, tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    c = chain.Chain(spark, str(tmp_path / "ledger"), counted(folder))
    sources = {"a": "some words", "b": "some words and more", "twin": "some words"}
    out = chain.write_scripts(episodes(spark, sources), c)
    scripts = {r.episode_id: r for r in out["scripts"].collect()}
    cut = {r.episode_id: json.loads(r.json)["overrides"] for r in out["overrides"].collect()}
    assert scripts["a"].script == scripts["twin"].script and "brief of" in scripts["b"].script
    assert all(scripts[k].revise == ("revised" in scripts[k].script) for k in sources)
    assert set(cut) == {k for k in sources if scripts[k].script.count("word ") > 30}
    for segments in cut.values():
        assert [len(x["text"].split()) for x in segments["000"]] == [18, 18] and segments["000"][0]["pause_after"] == 0.25
    first = calls(folder)
    # equal requests are one: two different sources, so at most two calls of each pass
    assert max(first.count(x) for x in first) <= 2 and len(set(first)) >= 7
    again = chain.write_scripts(episodes(spark, sources), c)
    assert {r.episode_id: r.script for r in again["scripts"].collect()} == {k: r.script for k, r in scripts.items()} and calls(folder) == first
    # a new source asks for its own passes only
    chain.write_scripts(episodes(spark, sources | {"c": "another source here"}), c)["scripts"].collect()
    assert len(calls(folder)) <= len(first) + 9 and calls(folder).count("Read") == first.count("Read") + 1


def test_chain_goes_on_after_failures(spark, tmp_path):
    def broken():
        answer = _writer()
        return lambda prompt: 1 / 0 if prompt.startswith("Make") else answer(prompt)

    path = str(tmp_path / "ledger")
    rows = episodes(spark, {"a": "some words", "none": None})
    out = chain.write_scripts(rows, chain.Chain(spark, path, broken))
    assert [r.script for r in out["scripts"].collect()] == [None, None] and out["overrides"].count() == 0
    kept = spark.read.parquet(path).where("digest is not null")
    assert sorted(r["pass"] for r in kept.collect()) == ["draft", "extract"]
    out = chain.write_scripts(rows, chain.Chain(spark, path, _writer))
    assert {r.episode_id: r.script is None for r in out["scripts"].collect()} == {"a": False, "none": True}
    unread = chain.write_scripts(rows, chain.Chain(spark, str(tmp_path / "other"), lambda: lambda prompt: "no json"))
    assert [r.script for r in unread["scripts"].collect()] == [None, None]


def test_a_hanging_model_costs_its_limit(spark):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(["a", "hang", "b", "die", "c", "fail"])], "k int, file string").coalesce(1)

    def load():
        import os
        import time

        def model(x):
            if x == "hang":
                time.sleep(600)
            if x == "die":
                os._exit(1)
            return x.upper() if x != "fail" else 1 / 0

        return model

    import time

    began = time.monotonic()
    got = {r.file: (r.transcription, r.error) for r in streams.transcribed(rows, load, seconds=1.0).collect()}
    assert time.monotonic() - began < 60
    assert {k: t for k, (t, _) in got.items()} == {"a": "A", "b": "B", "c": "C", "hang": None, "die": None, "fail": None}
    assert "no answer in 1 s" in got["hang"][1] and "ended" in got["die"][1] and "division" in got["fail"][1] and got["c"][1] is None


def planned(spark, n=6):
    turns = spark.createDataFrame([("e", i, 4000 + 100 * i, 350 + 10 * i, "warm", "Really? That is wonderful.") for i in range(n)], "k string, turn int, duration_ms int, gap_ms int, emotion string, text string")
    rows = timeline.planned_timeline(plan.realism_plan(turns, "k", overlap=0.5, filler=1.0, breath=1.0), "k")
    return rows.withColumn("from_ms", timeline.before(F.col("duration_ms") + F.col("gap_ms"), ["k"], ["turn"])).withColumn("filler", F.concat("word", F.lit(".wav")))


def test_graph_wires_every_label_once(spark):
    rows = planned(spark)
    places = plan.effect_places(rows, "k")
    for options in ({}, {"tone": "room.wav"}, {"no_tone": True}):
        r = graph.filter_graph(rows, places, "k", 24_000, **options).first()
        made, used = [], []
        for node in r.graph.split(";"):
            head, tail = re.match(r"^((?:\[[^\]]+\])*)", node)[1], re.search(r"((?:\[[^\]]+\])*)$", node)[1]
            used += re.findall(r"\[([^\]]+)\]", head)
            made += re.findall(r"\[([^\]]+)\]", tail)
        assert len(made) == len(set(made))
        inner = [x for x in used if not re.match(r"\d+:a$", x)]
        assert set(inner) <= set(made) and all(inner.count(x) == 1 for x in set(inner) - {"inmono"})
        assert set(made) - set(inner) == {r.out_label}
        files = [int(x[:-2]) for x in used if x.endswith(":a")]
        assert sorted(files) == list(range(len(r.inputs) + 1))
        assert r.out_label == ("roomed" if not options.get("no_tone") else r.out_label) and ("room.wav" in r.inputs) == ("tone" in options)
        assert r.inputs.count("room.wav") <= 1 and r.graph.count("concat=") == 1


def test_graph_without_effects(spark):
    rows = planned(spark, 2).withColumn("breath", F.lit(None).cast("string")).withColumn("filler", F.lit(None).cast("string")).withColumn("action", F.lit("normal")).withColumn("jitter_ms", F.lit(0)).withColumn("gap_ms", F.lit(5))
    r = graph.filter_graph(rows, plan.effect_places(rows, "k"), "k", 8000, no_tone=True).first()
    assert r.graph == "[0:a]aformat=channel_layouts=mono[inmono];[inmono]atrim=0.000000:4.000000,asetpts=N/SR/TB[s0];[inmono]atrim=4.350000:8.450000,asetpts=N/SR/TB[s1];[s0][s1]concat=n=2:v=0:a=1[joined]"
    assert r.out_label == "joined" and r.inputs == []


def test_sessions_of_a_stream_with_late_rows(spark, tmp_path):
    """Rows later than the watermark are dropped; those within it still join their session."""
    day = datetime.datetime(2024, 1, 1)
    at = lambda h: day + datetime.timedelta(hours=h)
    batches = [[(1, at(0)), (1, at(2)), (2, at(1))], [(1, at(40)), (2, at(41))], [(1, at(1)), (1, at(38)), (2, at(90))], [(9, at(200))]]
    folder, out = tmp_path / "in", tmp_path / "out"
    folder.mkdir()
    schema = "user_id long, ts timestamp"
    for k, rows in enumerate(batches):
        # one file a batch, each read by a run of its own that goes on from the checkpoint
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / f"b{k}"))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "*"))
        found = streams.talk_sessions(stream, "user_id", "ts")
        found.writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / "check")).option("path", str(out)).trigger(availableNow=True).start().awaitTermination()
    got = sorted((r.user_id, r.start, r.events) for r in spark.read.parquet(str(out)).collect())
    # the row of hour 1 comes after the watermark of hour 17 has closed its session; that of hour 38 joins its own
    assert got == [(1, at(0), 2), (1, at(38), 2), (2, at(1), 1), (2, at(41), 1), (2, at(90), 1)]
