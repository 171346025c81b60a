"""Queries of files that are written and read back, and of whole jobs, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import production as A
from ..operators import rollup as R
from ..operators.chunked import shared_folder
from ..sources import files as S
from . import bindings as B
from . import pipelines
from .signal_queries import TAPS
from .text_queries import _dialogue_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _signals(spark: SparkSession, d: str) -> DataFrame:
    rows = B.signal(spark, d).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("s"))
    return rows.select("user_id", F.format_string("%d.wav", "user_id").alias("file"), F.col("s.value").alias("samples"), F.lit(1000).alias("sr"))


@query(f"WITH {B.SIGNAL} SELECT user_id || '.wav' AS file, count(*)::INT AS n, count(*) / 1000.0::DOUBLE AS duration, sum(round_even(value * 32767, 0) * (idx + 1))::BIGINT AS weighted FROM signal GROUP BY user_id")
def wave_files(spark: SparkSession, d: str) -> DataFrame:
    """SK5, SC7, SC10: every signal written as a WAV file and read back; its samples as whole numbers, weighted by place."""
    folder = _fresh(spark, "waves")
    S.save_signals(_signals(spark, d), folder).write.format("noop").mode("overwrite").save()
    signals = S.read_signals(spark, folder)
    weighted = F.aggregate(F.transform("samples", lambda x, i: (x * 32768).cast("long") * (i + 1)), F.lit(0).cast("long"), lambda a, x: a + x)
    return S.durations(signals).join(signals, "file").select("file", F.size("samples").alias("n"), "duration", weighted.alias("weighted"))


@query(f"WITH {B.SCRIPTS} SELECT line, count(*) AS n FROM (SELECT unnest(string_split(content, chr(10))) AS line FROM scripts) WHERE line <> '' GROUP BY line")
def saved_texts(spark: SparkSession, d: str) -> DataFrame:
    """SK10, SC1: all scripts saved, the files read whole, their lines counted."""
    folder = _fresh(spark, "scripts")
    S.save_texts(B.scripts(spark, d), "content", folder)
    lines = S.read_texts(spark, folder).select(F.explode(F.split("content", "\n")).alias("line")).where("line <> ''")
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, event_type || ' ' || user_id AS status, value FROM events UNION ALL SELECT -1, 'no report', NULL")
def saved_report(spark: SparkSession, d: str) -> DataFrame:
    """SK9, SC13: a report saved as JSON and read back; a folder without one has no rows, which one row says."""
    folder, schema = _fresh(spark, "report"), "event_id long, status string, value double"
    rows = B.table(spark, d, "events").select("event_id", F.concat_ws(" ", "event_type", F.col("user_id").cast("string")).alias("status"), "value")
    S.save_report(rows, folder, 1)
    none = S.read_report(spark, f"{folder}-none", schema).agg(F.count(F.lit(1)).alias("n")).where("n = 0")
    return S.read_report(spark, f"{folder}/version=1", schema).unionByName(none.select(F.lit(-1).cast("long").alias("event_id"), F.lit("no report").alias("status"), F.lit(None).cast("double").alias("value")))


@query(f"""WITH {B.SIGNAL}, j AS (SELECT user_id, idx, abs(lead(value) OVER (PARTITION BY user_id ORDER BY idx) - value) AS jump FROM signal),
h AS (SELECT user_id, CASE WHEN idx - lag(idx) OVER (PARTITION BY user_id ORDER BY idx) < 5 THEN 0 ELSE 1 END AS first FROM j WHERE jump > 0.3),
c AS (SELECT user_id, sum(first) AS clicks FROM h GROUP BY 1), n AS (SELECT user_id, count(*) AS n FROM signal GROUP BY 1)
SELECT user_id % 5 AS folder, count(*) AS files, coalesce(sum(clicks), 0)::BIGINT AS clicks, sum(n)::BIGINT AS samples, min(user_id || '.wav') AS first FROM n LEFT JOIN c USING (user_id) GROUP BY 1""")
def clean_report(spark: SparkSession, d: str) -> DataFrame:
    """SK7: the JSON report of each folder of signals, read again."""
    _, report = A.clean(B.signal(spark, d), "user_id", 1000, 0.3, trim=False, size=16)
    rows = report.select((F.col("user_id") % 5).alias("folder"), F.format_string("%d.wav", "user_id").alias("file"), "clicks", "original_duration", "cleaned_duration", "trimmed_ms")
    kind = "total_files long, total_clicks_repaired long, total_trimmed_ms long, results array<struct<file:string,clicks_repaired:long,original_duration:double>>"
    read = R.clean_report(rows, "folder").select("folder", F.from_json("report", kind).alias("r"))
    total = F.aggregate("r.results", F.lit(0).cast("long"), lambda a, x: a + F.round(x["original_duration"] * 1000).cast("long"))
    return read.select("folder", F.col("r.total_files").alias("files"), F.col("r.total_clicks_repaired").alias("clicks"), total.alias("samples"), F.col("r.results")[0]["file"].alias("first"))


@query(f"""WITH {B.SIGNAL}, sz AS (SELECT user_id, count(*) AS n FROM signal GROUP BY 1), taps(k, g) AS (VALUES {TAPS}),
m AS (SELECT user_id, n, CASE user_id % 6 WHEN 0 THEN '/' || user_id || '.wav' WHEN 1 THEN '../' || user_id || '.wav' ELSE user_id || '.wav' END AS file, user_id % 6 AS k FROM sz),
p AS (SELECT user_id, n, j, j * (n - 1) / (2 * n - 1) AS t FROM (SELECT user_id, n, unnest(range(0, 2 * n)) AS j FROM m WHERE k > 2)),
u AS (SELECT p.user_id, p.n, j, a.value + (t - floor(t)) * (coalesce(b.value, a.value) - a.value) AS x FROM p JOIN signal a ON a.user_id = p.user_id AND a.idx = floor(t) LEFT JOIN signal b ON b.user_id = p.user_id AND b.idx = floor(t) + 1),
l AS (SELECT user_id, sqrt(avg(x * x)) AS rms FROM u GROUP BY 1),
s AS (SELECT user_id, n, j, CASE WHEN rms > 0 THEN x * (0.1 / rms) ELSE x END * CASE WHEN user_id % 2 = 0 THEN pow(10.0, -6 / 20) ELSE 1 END AS x FROM u JOIN l USING (user_id)),
w AS (SELECT a.user_id, a.j, sum(b.x * g) AS wet FROM s a JOIN taps ON k <= a.j JOIN s b ON b.user_id = a.user_id AND b.j = a.j - k GROUP BY ALL),
y AS (SELECT s.user_id, 2 * n AS m, s.j, 0.98 * x + 0.02 * wet AS y FROM s JOIN w ON w.user_id = s.user_id AND w.j = s.j),
z AS (SELECT user_id, floor(sum(y * (j + 1) * CASE WHEN m > 80 THEN CASE WHEN j < 40 THEN j / 39 WHEN j >= m - 40 THEN (m - 1 - j) / 39 ELSE 1 END ELSE 1 END) * 1000 + 0.31003)::BIGINT AS weighted_e3 FROM y GROUP BY 1)
SELECT file, CASE WHEN k < 2 THEN 'REJECTED' WHEN k = 2 THEN 'MISSING' ELSE 'OK' END AS status, weighted_e3 FROM m LEFT JOIN z USING (user_id)""")
def prepared_folder(spark: SparkSession, d: str) -> DataFrame:
    """The manifest of a folder: rejected paths, missing files, and prepared lines at their speakers' volumes."""
    signals = _signals(spark, d)
    k = F.col("user_id") % 6
    file = F.when(k == 0, F.concat(F.lit("/"), "file")).when(k == 1, F.concat(F.lit("../"), "file")).otherwise(F.col("file"))
    manifest = signals.select(file.alias("file"), F.when(F.col("user_id") % 2 == 0, "emma").otherwise("lucas").alias("speaker"))
    volumes = manifest.where("speaker = 'emma'").select("speaker", F.lit(-6.0).alias("db")).distinct()
    status, ready = pipelines.prepare_folder(manifest, signals.where(k > 2).select("file", "samples", "sr"), volumes, 2000)
    sums = ready.groupBy("file").agg(F.floor(F.sum(F.col("value") * (F.col("idx") + 1)) * 1000 + 0.31003).alias("weighted_e3"))
    return status.join(sums, "file", "left")


@query(f"""WITH {B.SCRIPTS}, {_dialogue_sql()}, heads AS (SELECT conv_id, line, regexp_extract(raw, '^SECTION ([0-9]+)$', 1)::INT AS section FROM raws WHERE regexp_matches(raw, '^SECTION [0-9]+$')),
d AS (SELECT d.*, h.section, len(regexp_extract_all(d.text, '{B.NS}+')) AS words FROM dialogue d ASOF JOIN heads h ON d.conv_id = h.conv_id AND d.line >= h.line),
f AS (SELECT conv_id, idx // 2 AS section, sum(duration_ms) AS ms FROM lines GROUP BY ALL),
s AS (SELECT *, coalesce(sum(ms) OVER (PARTITION BY conv_id ORDER BY section ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_ms FROM f),
t AS (SELECT d.conv_id, d.section, row_number() OVER p - 1 AS index, speaker, text, ms, at_ms, words, coalesce(sum(words) OVER (PARTITION BY d.conv_id, d.section ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b, sum(words) OVER (PARTITION BY d.conv_id, d.section) AS n
  FROM d JOIN s ON s.conv_id = d.conv_id AND s.section = d.section WHERE ms > 0 WINDOW p AS (PARTITION BY d.conv_id, d.section ORDER BY line))
SELECT conv_id::VARCHAR AS episode_id, section, index::INT AS index, speaker, text, (at_ms + (b * ms * 2 + n) // (2 * n))::BIGINT AS start_ms, (at_ms + ((b + words) * ms * 2 + n) // (2 * n))::BIGINT AS end_ms FROM t WHERE n > 0""")
def published_transcript(spark: SparkSession, d: str) -> DataFrame:
    """Scripts cut into sections, their dialogue timed by words within each section's file, over a running start."""
    scripts = B.scripts(spark, d).select(F.col("conv_id").cast("string").alias("episode_id"), "content")
    files = B.lines(spark, d).groupBy(F.col("conv_id").cast("string").alias("episode_id"), F.floor(F.col("index") / 2).cast("int").alias("index")).agg(F.sum("duration_ms").cast("long").alias("duration_ms"))
    rows = pipelines.publish(scripts, files)["transcript"]
    return rows.select("episode_id", F.col("section").cast("int").alias("section"), F.col("index").cast("int").alias("index"), "speaker", "text", "start_ms", "end_ms")
