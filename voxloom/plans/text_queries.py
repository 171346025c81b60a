"""Queries of the text operators, parsers and comparisons, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import compare as C
from ..operators import parse as P
from . import bindings as B

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


S, NS = B.S, B.NS
W = T.WORD
COUNT = lambda x: f"len(regexp_extract_all({x}, '{NS}+'))"


@query(f"SELECT 'd' AS source, doc_id AS id, {B.norm_sql('text')} AS normal FROM documents UNION ALL SELECT 'c', conv_id * 100 + turn, {B.norm_sql('text')} FROM conversations")
def normalize_text(spark: SparkSession, d: str) -> DataFrame:
    normal = T.normalize_text(F.col("text")).alias("normal")
    talk = B.table(spark, d, "conversations").select(F.lit("c").alias("source"), (F.col("conv_id") * 100 + F.col("turn")).alias("id"), normal)
    return B.spread(B.table(spark, d, "documents").select("doc_id", "text")).select(F.lit("d").alias("source"), F.col("doc_id").alias("id"), normal).unionByName(talk)


@query(f"SELECT doc_id, {COUNT('text')}::INT AS words, len(regexp_extract_all(text, '[.!?]+'))::INT AS sentences FROM documents")
def word_and_sentence_count(spark: SparkSession, d: str) -> DataFrame:
    return B.table(spark, d, "documents").select("doc_id", T.word_count(F.col("text")).alias("words"), T.sentence_count(F.col("text")).alias("sentences"))


REACTION = f"""CASE WHEN suffix(regexp_replace(text, '{S}+$', ''), '?') THEN 'agreement'
  WHEN emotion IN ('surprised', 'excited', 'passionate', 'emphatic', 'fascinated') THEN 'surprise'
  WHEN len(regexp_extract_all(text, '[.!?]+')) >= 3 THEN 'tracking'
  WHEN emotion IN ('warm', 'calm', 'thoughtful', 'explaining', 'building') AND {COUNT('text')} > 15 THEN 'agreement' END"""


@query(f"WITH {B.LINES} SELECT conv_id, idx AS index, {REACTION} AS reaction FROM lines")
def backchannel_type(spark: SparkSession, d: str) -> DataFrame:
    return B.lines(spark, d).select("conv_id", "index", T.backchannel_type(F.col("text"), F.col("emotion")).alias("reaction"))


@query(f"""SELECT doc_id, floor(coalesce(w * CASE WHEN n >= 3 THEN s / n END * 2.5, w * 0.8) * 1000 + 0.5)::BIGINT AS max_ms, CASE WHEN n >= 3 THEN floor(s / n * 1000000 + 0.5)::BIGINT END AS rate_us,
  floor(s / greatest(w * CASE lang WHEN 'en' THEN 0.35::DOUBLE WHEN 'de' THEN 0.45::DOUBLE ELSE 0.35::DOUBLE END, 0.1::DOUBLE) * 1000 + 0.5)::BIGINT AS ratio_permille
FROM (SELECT doc_id, lang, {COUNT('text')}::DOUBLE AS w, {COUNT('left(text, 40)')}::DOUBLE AS n, n_chars / 16.0::DOUBLE AS s FROM documents)""")
def durations(spark: SparkSession, d: str) -> DataFrame:
    """the first forty characters are the reference."""
    w, n, s = T.word_count(F.col("text")).cast("double"), T.word_count(F.left("text", F.lit(40))).cast("double"), F.col("n_chars") / 16
    rate = T.calibrated_rate(s, n)
    return B.table(spark, d, "documents").select("doc_id", T.ms(T.max_duration(w, rate)).alias("max_ms"), F.floor(rate * 1_000_000 + 0.5).alias("rate_us"), T.ms(T.duration_ratio(s, w, F.col("lang"))).alias("ratio_permille"))


@query("""SELECT event_id, lpad((t // 3600000)::VARCHAR, greatest(2, length((t // 3600000)::VARCHAR))::INT, '0') || ':' || lpad((t % 3600000 // 60000)::VARCHAR, 2, '0') || ':' || lpad((t % 60000 // 1000)::VARCHAR, 2, '0') || ',' || lpad((t % 1000)::VARCHAR, 3, '0') AS srt
FROM (SELECT event_id, floor(value * event_id * 1000 + 0.5)::BIGINT AS t FROM events)""")
def srt_time(spark: SparkSession, d: str) -> DataFrame:
    return B.table(spark, d, "events").select("event_id", T.srt_time(T.ms(F.col("value") * F.col("event_id"))).alias("srt"))


@query(rf"""SELECT doc_id, CASE WHEN length(f) <= 80 THEN f ELSE regexp_replace(regexp_extract(f, '^(.{{0,77}})(?: |$)', 1), ' +$', '') || '...' END AS short,
  CASE WHEN length(text) > 80 THEN left(text, 80) || '...' ELSE text END AS preview, left(text, 100000) AS head
FROM (SELECT doc_id, text, regexp_replace(regexp_replace(text, '{S}+', ' ', 'g'), '^{S}+|{S}+$', '', 'g') AS f FROM documents)""")
def shorten(spark: SparkSession, d: str) -> DataFrame:
    """F12, SK11, SC6."""
    return B.table(spark, d, "documents").select("doc_id", T.shorten(F.col("text")).alias("short"), T.preview(F.col("text")).alias("preview"), F.left("text", F.lit(100_000)).alias("head"))


@query(rf"""SELECT p_partkey, coalesce(nullif(regexp_replace(lower(replace(p_name, ' ', '_')), '[^a-z0-9_\-]', '', 'g'), ''), 'section') AS slug, regexp_replace(p_name || '/' || p_type, '[^{W}]', '_', 'g') AS safe,
  format('{{:03d}}', p_size) AS key, CASE WHEN p_retailprice < 165 THEN 'Low' WHEN p_retailprice < 255 THEN 'Mid' ELSE 'High' END AS register, floor(pow(10.0, (p_size - 25) / 20.0) * 1e6 + 0.5)::BIGINT AS linear_millionths,
  trunc(p_retailprice * 24000)::BIGINT AS samples, p_size * 150 AS word_target, floor(least(3 * (p_size / 100.0), 0.4) * 1000 + 0.5)::BIGINT AS full_permille, floor(greatest(0.0, p_size - 20.0) * 1000)::BIGINT AS fade_ms, floor((-16.0 - p_size) * 10)::BIGINT AS gain_tenths
FROM part""")
def scalar_rules(spark: SparkSession, d: str) -> DataFrame:
    """P10, P11, F9, F10, F11, F14, F17, F19, F26."""
    size = F.col("p_size")
    return B.table(spark, d, "part").select(
        "p_partkey", T.slug(F.col("p_name")).alias("slug"), T.safe_filename(F.concat("p_name", F.lit("/"), "p_type")).alias("safe"), T.line_key(size).alias("key"), T.voice_register(F.col("p_retailprice")).alias("register"),
        F.floor(T.db_to_linear((size - 25).cast("double")) * 1e6 + 0.5).cast("long").alias("linear_millionths"), T.to_samples(F.col("p_retailprice"), 24_000).alias("samples"), T.word_target(size).alias("word_target"),
        T.ms(T.full_volume(size / 100)).alias("full_permille"), F.floor(T.fade_start(size.cast("double"), F.lit(20.0)) * 1000).cast("long").alias("fade_ms"), F.floor(T.gain_db(size, -16.0) * 10).cast("long").alias("gain_tenths"),
    )


@query(r"""SELECT page_id, starts_with(p, '/') OR list_contains(string_split(p, '/'), '..') AS rejected FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN '/' ELSE '' END || replace(regexp_replace(url, '^https?://', ''), '?', CASE page_id % 3 WHEN 0 THEN '/../' ELSE '..' END) AS p FROM pages)""")
def path_guard(spark: SparkSession, d: str) -> DataFrame:
    """F16."""
    path = F.concat(F.when(F.col("page_id") % 4 == 0, "/").otherwise(""), F.replace(F.regexp_replace("url", "^https?://", ""), F.lit("?"), F.when(F.col("page_id") % 3 == 0, "/../").otherwise("..")))
    return B.table(spark, d, "pages").select("page_id", T.path_rejected(path).alias("rejected"))


def _html_sql() -> str:
    out = r"regexp_replace(html, '(?is)<(?:script|style|nav|head)\b.*?</(?:script|style|nav|head)>', ' ', 'g')"
    out = rf"regexp_replace(regexp_replace({out}, '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g')"
    for entity, letter in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{letter}')"
    return f"regexp_replace(regexp_replace({out}, '{S}+', ' ', 'g'), '^{S}+|{S}+$', '', 'g')"


@query(f"SELECT page_id, {_html_sql()} AS text FROM pages")
def html_extract(spark: SparkSession, d: str) -> DataFrame:
    """SC3."""
    return B.table(spark, d, "pages").select("page_id", T.html_text(F.col("html")).alias("text"))


def _part(rule: str, k: int, x: str = "raw") -> str:
    return f"CASE WHEN regexp_matches({x}, $r${rule}$r$) THEN regexp_extract({x}, $r${rule}$r$, {k}) END"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{S}+|{S}+$', '', 'g')"


@query(f"WITH {B.SCRIPTS} SELECT conv_id, line, lower({_part(P.TAGGED, 1)}) AS speaker, lower({_part(P.TAGGED, 2)}) AS emotion, {_strip(_part(P.TAGGED, 3))} AS text FROM raws")
def parse_line(spark: SparkSession, d: str) -> DataFrame:
    """P1."""
    speaker, emotion, text = P.tagged_line(F.col("raw"))
    return P.lines(B.scripts(spark, d), "conv_id").select("conv_id", "line", speaker.alias("speaker"), emotion.alias("emotion"), text.alias("text"))


def _dialogue_sql() -> str:
    pick = lambda k: f"coalesce({_part(P.BRACKETED, k)}, {_part(P.UPPER_NAME, k)})"
    return f"""dialogue AS (SELECT conv_id, line, row_number() OVER (PARTITION BY conv_id ORDER BY line) - 1 AS index, upper({pick(1)}) AS speaker,
      lower({_strip(f"coalesce(nullif({pick(2)}, ''), 'default')")}) AS emotion, {_strip(pick(3))} AS text
    FROM raws WHERE raw <> '' AND NOT starts_with(raw, '#') AND NOT starts_with(raw, '==') AND (regexp_matches(raw, $r${P.BRACKETED}$r$) OR regexp_matches(raw, $r${P.UPPER_NAME}$r$)))"""


@query(f"WITH {B.SCRIPTS}, {_dialogue_sql()} SELECT * FROM dialogue")
def parse_dialogue(spark: SparkSession, d: str) -> DataFrame:
    """P2, P18, SC18."""
    return P.dialogue(B.scripts(spark, d), "conv_id")


@query(f"WITH {B.SCRIPTS} SELECT conv_id, line, row_number() OVER (PARTITION BY conv_id ORDER BY line) - 1 AS index, {_part(P.REALISM, 1)} AS speaker, lower({_part(P.REALISM, 2)}) AS emotion, {_part(P.REALISM, 3)} AS text FROM raws WHERE regexp_matches(raw, $r${P.REALISM}$r$)")
def parse_realism_lines(spark: SparkSession, d: str) -> DataFrame:
    """P3."""
    return P.realism_lines(B.scripts(spark, d), "conv_id")


@query(f"""WITH {B.SCRIPTS}, t AS (SELECT conv_id, line, lower({_strip(_part(P.TIMING, 1))}) AS speaker, {_strip(_part(P.TIMING, 3))} AS text FROM raws
  WHERE raw <> '' AND NOT starts_with(raw, '=') AND NOT starts_with(raw, '#') AND NOT regexp_matches(raw, $r${P.HEADING}$r$) AND NOT regexp_matches(raw, '^\\[.*\\]$'))
SELECT conv_id, line, row_number() OVER (PARTITION BY conv_id ORDER BY line) - 1 AS index, speaker, text FROM t WHERE coalesce(text, '') <> ''""")
def parse_timing_lines(spark: SparkSession, d: str) -> DataFrame:
    """P4."""
    return P.timing_lines(B.scripts(spark, d), "conv_id")


@query(f"WITH {B.SCRIPTS} SELECT * FROM (SELECT conv_id, line AS index, lower({_strip(_part(P.TIMING, 1))}) AS speaker, {_strip(_part(P.TIMING, 3))} AS text FROM raws) WHERE coalesce(text, '') <> ''")
def parse_intro_lines(spark: SparkSession, d: str) -> DataFrame:
    """P5."""
    return P.intro_lines(B.scripts(spark, d), "conv_id")


@query(f"WITH {B.SCRIPTS} SELECT conv_id, line + 1 AS line, left(raw, 80) AS text FROM raws WHERE raw <> '' AND NOT regexp_matches(raw, $r${P.CHECKED}$r$)")
def script_format_warnings(spark: SparkSession, d: str) -> DataFrame:
    """P6."""
    return P.format_warnings(B.scripts(spark, d), "conv_id")


NAMES = f"list_filter(list_transform(regexp_extract_all(content, $r${P.SECTION}$r$, 1), lambda x: {_strip('x')}), lambda x: x <> '')"
SECTIONS = f"sections AS (SELECT conv_id, generate_subscripts(n, 1)::INT - 1 AS section, unnest(n) AS name FROM (SELECT conv_id, {NAMES} AS n FROM scripts))"
HEADER = rf"={{20,}}{S}*\n[^\n=]+\n={{20,}}{S}*\n"
BODIES = f"bodies AS (SELECT conv_id, generate_subscripts(n, 1)::INT - 1 AS section, unnest(n) AS name, {_strip('unnest(b[2:])')} AS body FROM (SELECT conv_id, {NAMES} AS n, string_split_regex(content, $r${HEADER}$r$) AS b FROM scripts))"


@query(f"WITH {B.SCRIPTS}, {SECTIONS} SELECT * FROM sections")
def find_sections(spark: SparkSession, d: str) -> DataFrame:
    """P7."""
    return P.find_sections(B.scripts(spark, d), "conv_id")


@query(f"WITH {B.SCRIPTS}, {BODIES} SELECT conv_id, name, section, body FROM bodies")
def section_body(spark: SparkSession, d: str) -> DataFrame:
    """P8."""
    return P.section_bodies(B.scripts(spark, d), "conv_id")


@query(f"WITH {B.SCRIPTS}, {BODIES}, asked AS (SELECT DISTINCT conv_id, 'Section ' || (conv_id % 5)::VARCHAR AS name FROM conversations) SELECT a.conv_id, a.name, coalesce(b.body, '') AS body FROM asked a LEFT JOIN bodies b ON a.conv_id = b.conv_id AND lower(a.name) = lower(b.name)")
def section_body_any_case(spark: SparkSession, d: str) -> DataFrame:
    """A section that may be missing, asked for in another case."""
    asked = B.scripts(spark, d).select("conv_id", F.concat(F.lit("Section "), (F.col("conv_id") % 5).cast("string")).alias("name"))
    return P.section_text(B.scripts(spark, d), asked, "conv_id", fold_case=True)


@query(f"WITH {B.LINES} SELECT conv_id, idx AS index, CASE WHEN idx % 2 = 0 THEN emotion ELSE 'default' END AS emotion, text FROM lines")
def emotion_prefix(spark: SparkSession, d: str) -> DataFrame:
    """P12."""
    tagged = F.when(F.col("index") % 2 == 0, F.concat(F.lit("["), "emotion", F.lit("] "), "text")).otherwise(F.col("text"))
    emotion, text = P.emotion_prefix(tagged)
    return B.lines(spark, d).select("conv_id", "index", emotion.alias("emotion"), text.alias("text"))


@query(f"""WITH {B.SCRIPTS}, t AS (SELECT conv_id, line, {_strip(_part(P.TAGGED, 3))} AS text FROM raws), k AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY line) - 1 AS i FROM t WHERE coalesce(text, '') <> '')
SELECT conv_id, format('{{:03d}}', i) AS line_key, text FROM k WHERE {COUNT('text')} >= 35""")
def long_line_segments(spark: SparkSession, d: str) -> DataFrame:
    """W28."""
    return P.long_lines(B.scripts(spark, d), 35, "conv_id")


@query(f"""WITH {B.PAUSES} SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY start_) - 1 AS nth, floor(start_ * 1000 + 0.5)::BIGINT AS start_ms, floor(end_ * 1000 + 0.5)::BIGINT AS end_ms FROM (
  SELECT user_id, floor(start_ * 1000 + 0.5) / 1000 AS start_, floor(end_ * 1000 + 0.5) / 1000 AS end_ FROM pauses)""")
def silence_log(spark: SparkSession, d: str) -> DataFrame:
    """Pauses through the text of a log and back."""
    rows = B.pauses(spark, d).select("user_id", "start", F.format_string("silence_start: %d.%03d\nsilence_end: %d.%03d | silence_duration: 1\n", *(x for c in ("start", "end") for x in (F.floor(T.ms(F.col(c)) / 1000), T.ms(F.col(c)) % 1000))).alias("l"))
    logs = rows.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("start", "l"))).alias("l")).select("user_id", F.concat_ws("", F.col("l.l")).alias("log"))
    return P.silence_log(logs, "user_id").select("user_id", F.col("nth").cast("long").alias("nth"), T.ms(F.col("start")).alias("start_ms"), T.ms(F.col("end")).alias("end_ms"))


MEASURES = f"""{B.WORDS_OF_PAIRS}, m AS (
  SELECT doc_id, kind, words, CASE WHEN nt > ne THEN coalesce(list_position(t, coalesce(e[1], '')) - 1, nt) ELSE 0 END::INT AS extra_start,
    CASE WHEN nt > ne + 3 THEN coalesce(nt - list_min(list_transform(t, lambda x, i: CASE WHEN x = last THEN abs(i - ne) * 1000000 + i END)) % 1000000, 0) ELSE 0 END::INT AS extra_end,
    CASE WHEN ne > 0 THEN len(list_intersect(list_distinct(e), list_distinct(t)))::DOUBLE / len(list_distinct(e)) END AS share, nt::DOUBLE / greatest(ne, 1) AS ratio FROM w),
f AS MATERIALIZED (SELECT *, list_filter([CASE WHEN extra_start > 1 THEN 'HALLUCINATION_START' END, CASE WHEN extra_end > 0 THEN 'HALLUCINATION_END' END, CASE WHEN share < 0.7 THEN 'LOW_OVERLAP' END, CASE WHEN ratio > 1.4 THEN 'TOO_LONG' WHEN ratio < 0.5 THEN 'TOO_SHORT' END], lambda x: x IS NOT NULL) AS flags FROM m)"""


@query(f"WITH {MEASURES} SELECT doc_id, kind, extra_start, extra_end, floor(share * 1000000 + 0.5)::BIGINT AS overlap_millionths, floor(ratio * 1000000 + 0.5)::BIGINT AS ratio_millionths, array_to_string(flags, ',') AS flags, len(flags) = 0 AS ok FROM f")
def hallucination_flags(spark: SparkSession, d: str) -> DataFrame:
    """C1 to C5."""
    rows = C.compare_words(B.word_pairs(spark, d, counted=False))
    return rows.select("doc_id", "kind", "extra_start", "extra_end", F.floor(F.col("overlap") * 1_000_000 + 0.5).alias("overlap_millionths"), F.floor(F.col("ratio") * 1_000_000 + 0.5).alias("ratio_millionths"), F.concat_ws(",", "flags").alias("flags"), "ok")


@query(f"""WITH {MEASURES}, v AS (
  SELECT f.doc_id, f.kind, f.flags, d.lang, f.words, d.doc_id % 11 <> 0 AS ok_file, d.doc_id % 13 <> 0 AS ok_asr, (d.n_chars % 600) / 4.0::DOUBLE AS s, l.quality, l.toxic
  FROM f JOIN documents d ON d.doc_id = f.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id),
x AS (SELECT *, CASE WHEN s < 0.5 THEN 'SILENT' WHEN words > 0 AND s > words * 0.8::DOUBLE THEN 'DURATION_ANOMALY' END AS early,
  flags || list_filter([CASE WHEN s / greatest(words * CASE lang WHEN 'de' THEN 0.45::DOUBLE ELSE 0.35::DOUBLE END, 0.1::DOUBLE) > 2 THEN 'DURATION' END, CASE WHEN 4.0 - 2 * (1 - quality) < 3.5 THEN 'LOW_MOS' END, CASE WHEN 0.9 - 0.5 * toxic < 0.75 THEN 'VOICE_DRIFT' END, CASE WHEN lang <> 'en' THEN 'WRONG_LANGUAGE' END], lambda z: z IS NOT NULL) AS late FROM v)
SELECT doc_id, kind, CASE WHEN NOT ok_file THEN 'ERROR' WHEN early IS NOT NULL THEN 'FLAGGED' WHEN NOT ok_asr THEN 'ERROR' WHEN len(late) > 0 THEN 'FLAGGED' ELSE 'OK' END AS status,
  CASE WHEN NOT ok_file THEN 'FILE_NOT_FOUND' WHEN early IS NOT NULL THEN early WHEN NOT ok_asr THEN 'TRANSCRIPTION_FAILED' ELSE array_to_string(late, ',') END AS issues FROM x""")
def validate_batch(spark: SparkSession, d: str) -> DataFrame:
    """C6 to C9."""
    rows = B.word_pairs(spark, d, B.table(spark, d, "labels").select("doc_id", "quality", "toxic"), "lang", "n_chars")
    rows = rows.select(
        "doc_id", "kind", F.col("lang").alias("language"), "expected_words", F.when(F.col("doc_id") % 13 != 0, F.col("actual_words")).alias("actual_words"), "words", (F.col("doc_id") % 11 != 0).alias("exists"), (F.col("n_chars") % 600 / 4).alias("duration"),
        F.lit(None).cast("double").alias("seconds_per_word"), (4.0 - 2 * (1 - F.col("quality"))).alias("mos"), (0.9 - 0.5 * F.col("toxic")).alias("similarity"), (F.col("lang") == "en").alias("language_match"),
    )
    return C.validate(rows).select("doc_id", "kind", "status", F.concat_ws(",", "issues").alias("issues"))


@query("SELECT doc_id, lower(left(upper(lang), 2)) = CASE doc_id % 2 WHEN 0 THEN 'en' ELSE 'de' END AS language_match, coalesce(CASE lang WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French' WHEN 'es' THEN 'Spanish' WHEN 'nl' THEN 'Dutch' END, lang) AS name FROM documents")
def language_check(spark: SparkSession, d: str) -> DataFrame:
    """F21, F22."""
    want = F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de")
    return B.table(spark, d, "documents").select("doc_id", T.language_matches(F.upper("lang"), want).alias("language_match"), T.language_name(F.col("lang")).alias("name"))


@query("""WITH r AS (SELECT label, min(vec_id) AS ref_id FROM embeddings GROUP BY label)
SELECT e.vec_id, r.ref_id, floor(coalesce(list_cosine_similarity(e.embedding::DOUBLE[], f.embedding::DOUBLE[]), 0) * 10000 + 0.5)::BIGINT AS cosine_e4 FROM embeddings e JOIN r ON e.label = r.label JOIN embeddings f ON f.vec_id = r.ref_id""")
def cosine_pairs(spark: SparkSession, d: str) -> DataFrame:
    """every vector against the first of its label."""
    e = B.table(spark, d, "embeddings")
    ref = e.groupBy("label").agg(F.min("vec_id").alias("ref_id"), F.min_by("embedding", "vec_id").alias("ref"))
    return e.join(ref, "label").select("vec_id", "ref_id", F.floor(T.cosine(F.col("embedding"), F.col("ref")) * 10_000 + 0.5).alias("cosine_e4"))
