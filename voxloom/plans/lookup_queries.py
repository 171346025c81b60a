"""Queries of lookups with fallbacks, small argument rules, joined sources, voice clips and injected models, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import lookup as L
from ..operators import parse as P
from ..operators import plan as Q
from ..operators import signal as G
from ..operators import timeline as M
from ..operators.chunked import shared_folder
from ..sources import files as S
from ..streaming import chain as K
from ..streaming import streams as U
from . import bindings as B

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


# -- sources ------------------------------------------------------------------------------------------------


@query(f"SELECT source, left(string_agg('--- ' || doc_id || ' ---' || chr(10) || text, chr(10) || chr(10) ORDER BY doc_id), {S.SOURCE_CHARS}) AS text FROM documents GROUP BY source")
def ingest_concat(spark: SparkSession, d: str) -> DataFrame:
    """SC4, SC6: the texts of a source, named and in order, up to what a script takes."""
    files = B.table(spark, d, "documents").select("source", F.col("doc_id").alias("nth"), F.col("doc_id").cast("string").alias("name"), F.col("text").alias("content"))
    return S.joined_sources(files, "source", "nth").withColumnRenamed("content", "text")


@query(f"SELECT conv_id, left(string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY turn), {S.SOURCE_CHARS}) AS text FROM conversations GROUP BY conv_id")
def ingest_arguments(spark: SparkSession, d: str) -> DataFrame:
    """SC5: several sources in the order they were given."""
    given = B.table(spark, d, "conversations").select("conv_id", "turn", F.col("text").alias("content"))
    return S.joined_arguments(given, "conv_id", "turn").withColumnRenamed("content", "text")


@query(f"WITH {B.LINES} SELECT conv_id, string_agg('file \"' || speaker || '.wav\" offset 0.0', chr(10) ORDER BY speaker) AS lof FROM (SELECT DISTINCT conv_id, speaker FROM lines) GROUP BY conv_id")
def stem_labels(spark: SparkSession, d: str) -> DataFrame:
    """SK8."""
    stems = B.lines(spark, d).select("conv_id", "speaker", F.concat("speaker", F.lit(".wav")).alias("file")).distinct()
    return S.label_lines(stems, "conv_id")


# -- lookups ------------------------------------------------------------------------------------------------

SPEAKERS = "speakers AS (SELECT c_custkey, c_mktsegment, n_nationkey, n_name AS speaker FROM customer JOIN nation ON c_nationkey = n_nationkey)"


def _speakers(spark: SparkSession, d: str) -> DataFrame:
    nations = B.table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("speaker"))
    return B.table(spark, d, "customer").join(nations, "c_nationkey").select("c_custkey", "c_mktsegment", "speaker")


def _voices(spark: SparkSession, d: str) -> DataFrame:
    rows = B.table(spark, d, "nation").where("n_nationkey % 3 <> 0")
    return rows.select(F.col("n_name").alias("speaker"), F.concat(F.lit("v"), F.col("n_nationkey").cast("string")).alias("voice_id"), (F.col("n_nationkey") / 8 - 1).alias("db"))


@query(f"WITH {B.LINES} SELECT t.conv_id, t.idx AS index, t.duration_ms, l.text FROM lines t LEFT JOIN (SELECT conv_id, idx, text FROM lines WHERE words % 3 <> 0) l ON t.conv_id = l.conv_id AND t.idx = l.idx")
def turns_with_lines(spark: SparkSession, d: str) -> DataFrame:
    """Every turn with the script line of its place, where there is one."""
    lines = B.lines(spark, d)
    return L.by_position(lines.select("conv_id", "index", "duration_ms"), lines.where("words % 3 <> 0").select("conv_id", "index", "text"), ["conv_id"], "index", "left")


LISTING = "CASE WHEN idx % 3 = 0 THEN format('{:03d}_{}.wav', idx, speaker) ELSE format('{:03d}_take.wav', idx) END"


@query(f"""WITH {B.LINES}, listing AS (SELECT conv_id, {LISTING} AS file FROM lines WHERE idx % 4 <> 3),
e AS (SELECT conv_id, idx, format('{{:03d}}_{{}}.wav', idx, speaker) AS file FROM lines)
SELECT e.conv_id, e.idx AS index, e.file, coalesce(x.file, p.file) AS found, CASE WHEN coalesce(x.file, p.file) IS NULL THEN 'MISSING' ELSE 'OK' END AS status
FROM e LEFT JOIN listing x ON x.conv_id = e.conv_id AND x.file = e.file
LEFT JOIN (SELECT conv_id, left(file, 3) AS k, min(file) AS file FROM listing GROUP BY ALL) p ON p.conv_id = e.conv_id AND p.k = left(e.file, 3)""")
def entries_found(spark: SparkSession, d: str) -> DataFrame:
    """By name, else by number, else missing."""
    lines = B.lines(spark, d)
    own = F.format_string("%03d_%s.wav", F.col("index"), F.col("speaker"))
    listing = lines.where("index % 4 <> 3").select("conv_id", F.when(F.col("index") % 3 == 0, own).otherwise(F.format_string("%03d_take.wav", F.col("index"))).alias("file"))
    return L.with_files(lines.select("conv_id", "index", own.alias("file")), listing, "conv_id")


@query(f"WITH {SPEAKERS} SELECT c_custkey, speaker, 'v' || n_nationkey AS voice_id FROM speakers WHERE n_nationkey % 3 <> 0 UNION ALL SELECT DISTINCT NULL, speaker, NULL FROM speakers WHERE n_nationkey % 3 = 0")
def voiced_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines with a voice, then the speakers that have none."""
    voiced, missing = L.voice_ids(_speakers(spark, d).select("c_custkey", "speaker"), _voices(spark, d).select("speaker", "voice_id"))
    return voiced.select("c_custkey", "speaker", "voice_id").unionByName(missing, allowMissingColumns=True)


@query(f"WITH {SPEAKERS} SELECT c_custkey, speaker, floor(CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey / 8.0::DOUBLE - 1 ELSE 0.15::DOUBLE END * 1000 + 0.5)::BIGINT AS db_e3 FROM speakers")
def speaker_volumes(spark: SparkSession, d: str) -> DataFrame:
    """J13."""
    rows = L.speaker_default(_speakers(spark, d).select("c_custkey", "speaker"), _voices(spark, d), "db", 0.15)
    return rows.select("c_custkey", "speaker", F.floor(F.col("db") * 1000 + 0.5).alias("db_e3"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'single' WHEN c_mktsegment = 'BUILDING' THEN 'speech' WHEN c_mktsegment = 'MACHINERY' THEN 'stream' ELSE 'dialogue' END AS method FROM customer")
def api_methods(spark: SparkSession, d: str) -> DataFrame:
    """J15."""
    asked = F.when(F.col("c_custkey") % 5 == 0, "single")
    return B.table(spark, d, "customer").select("c_custkey", L.api_method(F.col("c_mktsegment"), asked, {"BUILDING": "speech", "MACHINERY": "stream"}).alias("method"))


@query("""SELECT speaker, voice_id FROM (SELECT regexp_extract(name, '^VOICE_(.*)_DE$', 1) AS speaker, value AS voice_id, name FROM (
  SELECT CASE s_suppkey % 3 WHEN 0 THEN 'VOICE_' || s_suppkey || '_DE' WHEN 1 THEN 'VOICE_' || s_suppkey ELSE 'PATH_' || s_suppkey || '_DE' END AS name, CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE s_name END AS value FROM supplier))
WHERE regexp_matches(name, '^VOICE_.*_DE$') AND voice_id <> ''""")
def env_voices(spark: SparkSession, d: str) -> DataFrame:
    """SC17."""
    k, key = F.col("s_suppkey") % 3, F.col("s_suppkey").cast("string")
    name = F.when(k == 0, F.concat(F.lit("VOICE_"), key, F.lit("_DE"))).when(k == 1, F.concat(F.lit("VOICE_"), key)).otherwise(F.concat(F.lit("PATH_"), key, F.lit("_DE")))
    pairs = B.table(spark, d, "supplier").select(name.alias("name"), F.when(F.col("s_suppkey") % 4 == 0, "").otherwise(F.col("s_name")).alias("value"))
    return L.env_voices(pairs, "_DE")


# -- arguments ----------------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, low, high FROM (SELECT o_orderkey, TRY_CAST(regexp_extract(t, '^([0-9]+)', 1) AS INT) AS low, TRY_CAST(coalesce(nullif(regexp_extract(t, '-([0-9]+)$', 1), ''), regexp_extract(t, '^([0-9]+)', 1)) AS INT) AS high FROM (
  SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN '5-10' WHEN 1 THEN (o_orderkey % 90)::VARCHAR WHEN 2 THEN '9-3' WHEN 3 THEN 'x' WHEN 4 THEN '-4' WHEN 5 THEN '3-' ELSE (o_orderkey % 50) || '-' || (o_orderkey % 70) END AS t FROM orders) WHERE regexp_matches(t, '^[0-9]+(-[0-9]+)?$')) WHERE low <= high""")
def range_arguments(spark: SparkSession, d: str) -> DataFrame:
    """The ranges that hold."""
    k = F.col("o_orderkey")
    text = lambda n: (k % n).cast("string")
    t = F.when(k % 7 == 0, "5-10").when(k % 7 == 1, text(90)).when(k % 7 == 2, "9-3").when(k % 7 == 3, "x").when(k % 7 == 4, "-4").when(k % 7 == 5, "3-").otherwise(F.concat(text(50), F.lit("-"), text(70)))
    return B.table(spark, d, "orders").select("o_orderkey", P.parse_range(t).alias("r")).where("r is not null").select("o_orderkey", "r.low", "r.high")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN -(o_orderkey % 4000)::BIGINT END AS lufs_e2 FROM orders")
def loudness_logs(spark: SparkSession, d: str) -> DataFrame:
    """The loudness inside a tool's report, null without one."""
    k = F.col("o_orderkey") % 4000
    report = F.format_string('[out] parsed\n{\n\t"input_i" : "-%d.%02d",\n\t"input_tp" : "-1.0"\n}\nend {', F.floor(k / 100), k % 100)
    log = F.when(F.col("o_orderkey") % 7 != 0, report).otherwise("no report {}")
    return B.table(spark, d, "orders").select("o_orderkey", F.round(P.loudness_log(log) * 100).cast("long").alias("lufs_e2"))


CAST = "CASE c_custkey % 5 WHEN 0 THEN 'anna' WHEN 1 THEN ' aNNa, BOB ' WHEN 2 THEN 'x,,y, zed' WHEN 3 THEN 'a,b,c,d' ELSE c_name || ',' || c_mktsegment END"


@query(f"""SELECT c_custkey, CASE WHEN len(n) BETWEEN 2 AND 3 THEN array_to_string(list_transform(n, lambda x, i: upper(x[1]) || lower(x[2:]) || '=' || ['host', 'expert', 'source voice'][i]), ';') END AS roles FROM (
  SELECT c_custkey, list_filter(list_transform(string_split({CAST}, ','), lambda x: trim(x)), lambda x: x <> '') AS n FROM customer)""")
def cast_roles(spark: SparkSession, d: str) -> DataFrame:
    """F18."""
    k = F.col("c_custkey") % 5
    cast = F.when(k == 0, "anna").when(k == 1, " aNNa, BOB ").when(k == 2, "x,,y, zed").when(k == 3, "a,b,c,d").otherwise(F.concat("c_name", F.lit(","), "c_mktsegment"))
    rows = B.table(spark, d, "customer").select("c_custkey", T.cast_roles(cast).alias("r"))
    return rows.select("c_custkey", F.when(F.col("r").isNotNull(), F.concat_ws(";", F.transform("r", lambda x: F.concat(x["name"], F.lit("="), x["role"])))).alias("roles"))


@query(f"SELECT doc_id, floor(len(regexp_extract_all(text, '{B.NS}+')) / 150.0::DOUBLE * 1000 + 0.5)::BIGINT AS minutes_e3, floor(n_chars / 16000.0::DOUBLE * 1000 + 0.5)::BIGINT AS seconds_e3 FROM documents")
def sample_estimates(spark: SparkSession, d: str) -> DataFrame:
    """F20."""
    e3 = lambda x: F.floor(x * 1000 + 0.5)
    return B.table(spark, d, "documents").select("doc_id", e3(T.sample_minutes(T.word_count(F.col("text")))).alias("minutes_e3"), e3(T.sample_seconds(F.col("n_chars"))).alias("seconds_e3"))


@query("SELECT o_orderkey, CASE WHEN NOT (20 - o_orderkey % 150 BETWEEN -100 AND 0) THEN 'noise_db' WHEN NOT (o_orderkey % 130 / 10.0::DOUBLE BETWEEN 0.01 AND 10) THEN 'min_duration' WHEN NOT (o_orderkey % 80 - 40 BETWEEN -30 AND 30) THEN 'speaker_db' END AS issue FROM orders")
def argument_issues(spark: SparkSession, d: str) -> DataFrame:
    """F24."""
    k = F.col("o_orderkey")
    return B.table(spark, d, "orders").select("o_orderkey", T.argument_issue(20 - k % 150, k % 130 / 10, k % 80 - 40).alias("issue"))


# -- clips and voices ---------------------------------------------------------------------------------------


@query(f"""WITH RECURSIVE {B.LINES}, p AS (
  SELECT conv_id, speaker, idx, row_number() OVER (PARTITION BY conv_id, speaker ORDER BY idx) AS i, {B.bits_sql("'42'", "conv_id", "idx", "'clip'")} AS draw FROM lines),
c AS (
  SELECT conv_id, speaker, idx, i, (draw % 3)::INT AS chosen FROM p WHERE i = 1
  UNION ALL SELECT p.conv_id, p.speaker, p.idx, p.i, ((c.chosen + 1 + p.draw % 2) % 3)::INT FROM p JOIN c ON p.conv_id = c.conv_id AND p.speaker = c.speaker AND p.i = c.i + 1)
SELECT conv_id, speaker AS reactor, idx AS after, 'bc_' || speaker || '_0' || chosen || '.wav' AS file FROM c""")
def clip_choices(spark: SparkSession, d: str) -> DataFrame:
    """Three clips a speaker, never the last one again."""
    lines = B.lines(spark, d)
    placements = lines.select("conv_id", F.col("index").alias("after"), F.col("duration_ms").cast("long").alias("position"), F.col("speaker").alias("reactor"))
    files = lines.select("speaker").distinct().select(F.explode(F.array(*(F.format_string(f"bc_%s_{k:02d}.wav", F.col("speaker")) for k in range(3)))).alias("file"))
    return Q.clip_choices(placements, L.clip_library(files), "conv_id").select("conv_id", "reactor", "after", "file")


@query("SELECT s_name AS file, CASE WHEN s_suppkey % 9 <> 0 THEN s_acctbal END AS f0 FROM supplier")
def voices_by_pitch(spark: SparkSession, d: str) -> DataFrame:
    """W29."""
    return G.by_pitch(B.table(spark, d, "supplier").select(F.col("s_name").alias("file"), F.when(F.col("s_suppkey") % 9 != 0, F.col("s_acctbal")).alias("f0")))


@query(f"""WITH {B.SIGNAL}, s AS (SELECT user_id, idx // 10 AS seg, idx % 10 AS nth, value FROM signal),
n AS (SELECT user_id, seg, max(nth) + 1 + (seg % 3) * 5 AS n FROM s GROUP BY user_id, seg),
b AS (SELECT user_id, seg, coalesce(sum(n) OVER (PARTITION BY user_id ORDER BY seg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a0 FROM n)
SELECT user_id, (a0 + nth)::BIGINT AS idx, floor(value * 10000 + 0.5)::BIGINT AS value_e4 FROM s JOIN b USING (user_id, seg)""")
def segments_joined(spark: SparkSession, d: str) -> DataFrame:
    """Segments of ten samples with pauses of 0, 5 or 10."""
    seg = F.floor(F.col("idx") / 10)
    rows = B.signal(spark, d).select("user_id", seg.alias("seg"), (F.col("idx") % 10).alias("nth"), (seg % 3 * 0.05).alias("pause"), "value")
    return M.concat_segments(rows, "user_id", 100).select("user_id", F.col("idx").cast("long").alias("idx"), F.floor(F.col("value") * 10_000 + 0.5).alias("value_e4"))


# -- streams and injected models ------------------------------------------------------------------------------


@query("""WITH e AS (SELECT user_id, epoch_us(ts) AS t FROM events),
s AS (SELECT user_id, t, sum(CASE WHEN t - p < 21600000000 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM (SELECT user_id, t, lag(t) OVER (PARTITION BY user_id ORDER BY t) AS p FROM e))
SELECT user_id, min(t) AS start_us, max(t) + 21600000000 AS end_us, count(*) AS events FROM s GROUP BY user_id, n""")
def talk_sessions(spark: SparkSession, d: str) -> DataFrame:
    """W2 as session windows, here over a whole table."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    rows = B.table(spark, d, "events").select("user_id", F.timestamp_micros(micros).alias("t"))
    return U.talk_sessions(rows, "user_id", "t").select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "events")


def _reader():
    """A model's stand-in: tells how long a text is, and fails where that is a multiple of five."""

    def read(text: str) -> str:
        if len(text) % 5 == 0:
            raise ValueError("nothing heard")
        return f"{len(text)} letters"

    return read


@query("SELECT conv_id, turn, CASE WHEN length(text) % 5 <> 0 THEN length(text) || ' letters' END AS transcription, CASE WHEN length(text) % 5 = 0 THEN 'ERROR: nothing heard' END AS error FROM conversations")
def transcriptions(spark: SparkSession, d: str) -> DataFrame:
    """An injected model; its failures are rows."""
    return U.transcribed(B.table(spark, d, "conversations").select("conv_id", "turn", "text"), _reader, "text").drop("text")


@query("SELECT conv_id, turn, length(text) % 50 + 1.0::DOUBLE AS mos, CASE WHEN length(text) % 3 <> 0 THEN length(text) % 2 = 0 END AS language_match FROM conversations")
def injected_measures(spark: SparkSession, d: str) -> DataFrame:
    """Two measures, of which one fails for some rows."""
    checks = {"mos": ("double", lambda: lambda text: len(text) % 50 + 1.0), "language_match": ("boolean", lambda: lambda text: 1 / (len(text) % 3) > 0 and len(text) % 2 == 0)}
    return U.measured(B.table(spark, d, "conversations").select("conv_id", "turn", "text"), checks, ["text"]).drop("text")


def _reviewer():
    """A review's stand-in: a fenced JSON answer with the length of what it was asked."""
    return lambda prompt: '```json\n{"length": %d}\n```' % len(prompt)


@query("SELECT conv_id, turn, length(role) + 2 + length(text) AS length FROM conversations")
def injected_review(spark: SparkSession, d: str) -> DataFrame:
    """One pass of a chain around an injected call, its answer read as JSON."""
    rows = B.table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    found = U.answered(rows, F.concat("role", F.lit(": "), "text"), _reviewer)
    return found.select("conv_id", "turn", F.try_variant_get("parsed.value", "$.length", "long").alias("length"))


# -- the chain of passes ------------------------------------------------------------------------------------


def _writer():
    """A model's stand-in, told by what its prompt begins with: every answer follows from the prompt alone."""
    import json

    def answer(prompt: str) -> str:
        task, rest = prompt.split("\n\n", 1)
        name = next(k for k, v in K.INSTRUCTIONS.items() if task.split()[0] == v.split()[0])
        script = rest.rpartition("SCRIPT:\n")[2]
        if name == "extract":
            return "```json\n" + json.dumps({"chars": len(prompt)}) + "\n```"
        if name == "draft":
            n = json.loads(rest.rpartition("BRIEF:\n")[2])["chars"]
            return "EMMA: [warm] " + " ".join(["word"] * (36 if n % 2 else 5)) + f"\nLUCAS: [calm] brief of {n}"
        if name == "fidelity":
            return json.dumps({"issues": [{"severity": "HIGH" if len(prompt) % 3 == 0 else "LOW", "type": "t", "explanation": "e"}]})
        if name == "listener":
            return json.dumps({"notes": [{"type": "t", "note": "n"}]})
        if name == "narrative":
            return json.dumps({"scores": [{"item": "i", "score": "PASS", "evidence": "e"}]})
        if name == "segment":
            words = rest.rpartition("LINE:\n")[2].split()
            return json.dumps([{"text": " ".join(words[:18]), "pause_after": 0.25}, {"text": " ".join(words[18:]), "pause_after": 0.0}])
        return script + ("\nEMMA: [warm] and revised" if name == "revise" else "")

    return answer


_EXTRACT = len(K.INSTRUCTIONS["extract"]) + 2 + len("SOURCES:\n\n")
_FIDELITY = len(K.INSTRUCTIONS["fidelity"].replace("{{", "{").replace("}}", "}")) + 2 + len("SOURCES:\n\n") + len("\n\nSCRIPT:\n")


@query(f"""WITH s AS (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS source FROM conversations GROUP BY conv_id),
d AS (SELECT conv_id, length(source) + {_EXTRACT} AS n, length(source) AS m FROM s),
t AS (SELECT conv_id, n, m, 'EMMA: [warm] ' || array_to_string(list_transform(range(CASE WHEN n % 2 = 1 THEN 36 ELSE 5 END), lambda x: 'word'), ' ') || chr(10) || 'LUCAS: [calm] brief of ' || n AS script FROM d),
r AS (SELECT *, (least(m, 50000) + length(script) + {_FIDELITY}) % 3 = 0 AS revise FROM t)
SELECT conv_id, script || CASE WHEN revise THEN chr(10) || 'EMMA: [warm] and revised' ELSE '' END AS script, revise, CASE WHEN n % 2 = 1 THEN 2 ELSE 0 END AS segments, CASE WHEN n % 2 = 1 THEN 18 * 5 - 1 END AS first_length FROM r""")
def script_chain(spark: SparkSession, d: str) -> DataFrame:
    """Every conversation through all passes around a stand-in; revised only where its review asks for it."""
    talk = B.table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    lit = F.lit
    episodes = talk.select("conv_id", F.concat_ws("\n", F.col("t.text")).alias("source"), lit(None).cast("string").alias("topic"), F.array(lit("EMMA"), lit("LUCAS")).alias("cast"), lit("en").alias("language"), lit(10).alias("minutes"))
    chain = K.Chain(spark, f"{shared_folder(spark)}/chain-{uuid.uuid4().hex}", _writer)
    out = K.write_scripts(episodes, chain, "conv_id")
    cut = K.segments_of(out["overrides"], "conv_id").groupBy("conv_id").agg(F.count(lit(1)).alias("segments"), F.max(F.when(F.col("seg") == 0, F.length("text"))).alias("first_length"))
    rows = out["scripts"].join(cut, "conv_id", "left")
    return rows.select("conv_id", "script", "revise", F.coalesce("segments", lit(0)).alias("segments"), "first_length")
