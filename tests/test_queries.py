"""Every query that has SQL gives the SQL's rows at the smallest scale; the others run."""

import math

import duckdb
import pytest

from voxloom.plans import catalog, pipelines

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return repr(round(float(v), 6)) if isinstance(v, float) and not math.isnan(v) else repr(v)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in catalog.SQL:
        assert got
        return
    want = duck.sql(catalog.SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[k]) for k in at) for r in want.fetchall())


def test_publish(spark):
    bar = "=" * 20
    script = f"{bar}\nONE\n{bar}\nEMMA: [warm] Three words here.\nLUCAS: And six more of the words.\n{bar}\nTWO\n{bar}\nEMMA: Bye."
    scripts = spark.createDataFrame([("my_show", script), ("bare", "EMMA: hello")], "episode_id string, content string")
    files = spark.createDataFrame([("my_show", 0, 9000), ("my_show", 1, 2000), ("my_show", 2, 500), ("bare", 0, 1000)], "episode_id string, index int, duration_ms long")
    out = pipelines.publish(scripts, files, 10_000)
    chapters = {r.episode_id: r.json for r in out["chapters"].collect()}
    assert '"startTime":17.0,"title":"TWO"' in chapters["my_show"] and '"title":"Section 3"' in chapters["my_show"] and '"title":"Bare"' in chapters["bare"]
    lines = [(r.text, r.start_ms, r.end_ms) for r in out["transcript"].orderBy("start_ms").collect()]
    assert lines == [("Three words here.", 8000, 11_000), ("And six more of the words.", 11_000, 17_000), ("Bye.", 17_000, 19_000)]
    assert "- **ONE** -- Three words here." in {r.episode_id: r.notes for r in out["notes"].collect()}["my_show"]


def test_validate_manifest(spark):
    columns = "nth int, file string, exists boolean, duration double, language string, expected string, mos double, similarity double, language_match boolean, ref_audio string, ref_text string"
    words = "three plain words"
    row = lambda n, f, e=True, d=1.0, ref=None, text=None: (n, f, e, d, "en", words, None, None, None, ref, text)
    slow = "one two three four"
    rows = [
        row(0, "/abs"),
        row(1, "ok"),
        row(2, "old"),
        row(3, "gone", False),
        row(4, "short", True, 0.1),
        row(5, "bad"),
        # eight seconds for three words: too long by the default, not by a voice of four seconds a word
        row(6, "long", True, 8.0),
        row(7, "slow", True, 8.0, "ref.wav", slow),
        row(8, "unsafe", True, 8.0, "../ref.wav", slow),
        row(9, "few", True, 8.0, "ref.wav", "two words"),
    ]
    manifest = spark.createDataFrame(rows, columns)
    previous = spark.createDataFrame([("old", "OK", []), ("ok", "FLAGGED", [])], "file string, status string, issues array<string>")
    references = spark.createDataFrame([("ref.wav", 16.0), ("../ref.wav", 16.0)], "file string, duration double")
    heard = []

    def transcribe(rows):
        from pyspark.sql import functions as F

        heard.extend(r.file for r in rows.collect())
        return rows.withColumn("transcription", F.when(F.col("file") == "bad", "nothing like it at all").otherwise(F.col("expected")))

    found = pipelines.validate_manifest(manifest, previous, transcribe, references).orderBy("nth").collect()
    assert [r.nth for r in found] == list(range(10))
    got = {r.file: (r.status, r.issues) for r in found}
    assert sorted(heard) == ["bad", "ok", "slow"]
    assert got["/abs"] == ("ERROR", ["REJECTED_PATH"]) and got["ok"] == ("OK", []) and got["old"] == ("OK", []) and got["gone"] == ("ERROR", ["FILE_NOT_FOUND"]) and got["short"] == ("FLAGGED", ["SILENT"]) and got["bad"][0] == "FLAGGED"
    assert got["long"] == got["unsafe"] == got["few"] == ("FLAGGED", ["DURATION_ANOMALY"]) and "DURATION_ANOMALY" not in got["slow"][1]
    plain = {r.file: r.status for r in pipelines.validate_manifest(manifest, None, transcribe).collect()}
    assert plain["slow"] == "FLAGGED" and plain["ok"] == "OK"
