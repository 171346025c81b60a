"""Signals against plain loops, mixing, preparation, and the files they come from."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.plans import pipelines
from voxloom.sources import files as S

RATE = 8000


def tone(seconds=0.5, hz=200, level=0.3, rate=RATE):
    return (level * np.sin(2 * np.pi * hz * np.arange(int(rate * seconds)) / rate)).astype(np.float32)


def framed(x, lead=0.2, trail=0.3, rate=RATE):
    return np.concatenate([np.zeros(int(rate * lead)), x, np.zeros(int(rate * trail))]).astype(np.float32)


def table(spark, signals):
    return spark.createDataFrame([(f"{k}.wav", [float(v) for v in x], RATE) for k, x in enumerate(signals)], "file string, samples array<float>, sr int")


def test_injected_calls(spark):
    from voxloom.streaming import streams

    rows = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "fail")], "k int, x string")

    def load():
        def call(prompt):
            if "fail" in prompt:
                raise RuntimeError("no answer")
            return '{"n": %d}' % len(prompt)

        return call

    got = {r.k: r for r in streams.answered(rows, F.concat(F.lit("Read: "), "x"), load).select("k", "prompt", "error", F.try_variant_get("parsed.value", "$.n", "int").alias("n")).collect()}
    assert [got[k].n for k in (1, 2, 3)] == [7, 8, None] and got[1].error is None and "no answer" in got[3].error
    sized = streams.measured(rows, {"mos": ("double", lambda: lambda x: 1.0 / (4 - len(x))), "language_match": ("boolean", lambda: lambda x: x == "a")}, ["x"])
    assert [(r.mos, r.language_match) for r in sized.orderBy("k").collect()] == [(1 / 3, True), (0.5, False), (None, False)]
    assert streams.measured(rows, {}, ["x"]).columns == rows.columns


def test_realism_job(spark):
    silences = spark.createDataFrame([("a", 2.0, 2.5), ("a", 5.0, 5.6)], "k string, start double, end double").withColumn("duration", F.col("end") - F.col("start"))
    totals = spark.createDataFrame([("a", 9.0), ("quiet", 4.0)], "k string, total double")
    lines = spark.createDataFrame([("a", 0, "warm", "Hello you."), ("a", 1, "excited", "Oh really?")], "k string, index int, emotion string, text string")
    rows = pipelines.realism(silences, totals, lines, "k").orderBy("turn").collect()
    assert [r.k for r in rows] == ["a"] * 3 and rows[0].start_ms == 0 and [r.duration_ms for r in rows] == [2000, 2500, 3400]
    assert all(b.start_ms >= a.start_ms + a.duration_ms for a, b in zip(rows[:-1], rows[1:])) and rows[2].text is None


def test_pages_are_downloaded(spark):
    """A server of this test: a page, one in another encoding, one that is missing, one that never answers in time."""
    import http.server
    import threading
    import time

    class Pages(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            if self.path == "/slow":
                time.sleep(3)
            if self.path == "/gone":
                return self.send_error(404)
            kind, data = ("text/html; charset=latin-1", "<p>caf\u00e9</p>".encode("latin-1")) if self.path == "/latin" else ("text/html", b"<html><script>no</script><p>Some &amp; words</p></html>")
            self.send_response(200)
            self.send_header("Content-Type", kind)
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    at = f"http://127.0.0.1:{server.server_port}"
    try:
        urls = spark.createDataFrame([(1, f"{at}/a"), (2, f"{at}/latin"), (3, f"{at}/gone"), (4, f"{at}/slow"), (5, None), (6, "nonsense"), (7, f"{at}/a")], "id int, url string")
        got = {r.id: r for r in S.fetch_pages(urls, seconds=1.0).collect()}
        assert got[1].html == got[7].html and "words" in got[1].html and got[1].error is None and got[2].html == "<p>caf\u00e9</p>"
        assert "404" in got[3].error and "timed out" in got[4].error and got[6].error and (got[5].html, got[5].error) == (None, None)
        assert "ERROR: more than 5 bytes" == S.fetch_pages(urls.where("id = 1"), most_bytes=5).first().error
        assert S.ingest(spark, [f"{at}/a", f"{at}/latin"]).first().content == "Some & words\n\n---\n\ncaf\u00e9"
        with pytest.raises(ValueError, match="404"):
            S.ingest(spark, [f"{at}/gone"])
    finally:
        server.shutdown()


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in (("b.md", "second"), ("a.txt", "first"), ("c.pdf", "no")):
        (tmp_path / "in" / name).write_text(text)
    assert S.ingest(spark, [f"{tmp_path}/in", f"{tmp_path}/in/b.md"]).first().content == "--- a.txt ---\nfirst\n\n--- b.md ---\nsecond\n\n---\n\nsecond"
    with pytest.raises(ValueError, match="no reader"):
        S.ingest(spark, [f"{tmp_path}/in/c.pdf"])
    page = spark.createDataFrame([("page",)], "content string")
    assert S.ingest(spark, ["https://example.org/x", f"{tmp_path}/in/a.txt"], {"url": lambda u: page}).first().content == "page\n\n---\n\nfirst"
    long = spark.createDataFrame([("k", f"{i:03d}", "x" * 50) for i in range(200)], "key string, name string, content string")
    whole = "\n\n".join(f"--- {i:03d} ---\n" + "x" * 50 for i in range(200))
    assert S.joined_sources(long, "key", limit=1000).first().content == whole[:1000] and S.joined_sources(long, "key").first().content == whole
    (tmp_path / "a.wav").write_bytes(S.encode_wav(tone(), RATE))
    (tmp_path / "bad.wav").write_bytes(b"not a wave")
    signals = S.read_signals(spark, str(tmp_path))
    assert {r.file: r.duration for r in S.durations(signals).collect()} == {"a.wav": 0.5, "bad.wav": None}
    report = spark.createDataFrame([("a.wav", "OK")], "file string, status string")
    S.save_report(report, f"{tmp_path}/report", 1)
    assert S.read_report(spark, f"{tmp_path}/report/version=1", "file string, status string").collect() == report.collect()
    assert S.read_report(spark, f"{tmp_path}/none", "file string, status string").count() == 0
    S.save_texts(spark.createDataFrame([("1\n00:00",)], "srt string").coalesce(1), "srt", f"{tmp_path}/srt")
    assert spark.read.text(f"{tmp_path}/srt", wholetext=True).where("value <> ''").first().value == "1\n00:00\n"
