"""How the operators' inputs come from the given tables, as DataFrames and, word for word the same, as SQL.

``conversations`` are episodes (role: speaker, turn: line), ``events`` are signals (one for each user) and pauses,
``documents`` and ``benchmark`` are texts to compare, ``embeddings`` are voices, ``orders`` and ``lineitem`` are
manifests and their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import SPACES, normal_words, word_count

EMOTIONS = ("warm", "curious", "excited", "thoughtful", "calm", "explaining", "surprised", "default", "building", "unlisted")
BAR = "=" * 20
#: Words and white space in DuckDB's regular expressions.
S, NS = f"[{SPACES}]", f"[^{SPACES}]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, index, speaker, emotion, text, words, duration_ms."""
    emotion = F.element_at(F.array(*map(F.lit, EMOTIONS)), ((F.col("conv_id") * 7 + F.col("turn") * 3) % len(EMOTIONS)).cast("int") + 1)
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("int").alias("index"), F.col("role").alias("speaker"), emotion.alias("emotion"), "text", word_count(F.col("text")).alias("words"))
    return rows.withColumn("duration_ms", F.col("words") * 350)


LINES = f"""lines AS (
  SELECT conv_id, turn::INT AS idx, role AS speaker,
         list_extract([{", ".join(f"'{e}'" for e in EMOTIONS)}], ((conv_id * 7 + turn * 3) % {len(EMOTIONS)})::INT + 1) AS emotion,
         text, len(regexp_extract_all(text, '{NS}+'))::INT AS words, (len(regexp_extract_all(text, '{NS}+')) * 350)::INT AS duration_ms
  FROM conversations)"""


def scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, content: a section of every two lines."""
    head = F.when(F.col("index") % 2 == 0, F.concat(F.lit(f"{BAR}\nSECTION "), (F.col("index") / 2).cast("int").cast("string"), F.lit(f"\n{BAR}\n"))).otherwise("")
    line = F.concat(head, F.upper("speaker"), F.lit(": ["), F.col("emotion"), F.lit("] "), F.col("text"))
    rows = lines(spark, sf_dir).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("index", line.alias("line")))).alias("l"))
    return rows.select("conv_id", F.concat_ws("\n", F.col("l.line")).alias("content"))


SCRIPTS = f"""{LINES}, scripts AS (
  SELECT conv_id, string_agg(CASE WHEN idx % 2 = 0 THEN '{BAR}' || chr(10) || 'SECTION ' || (idx // 2)::VARCHAR || chr(10) || '{BAR}' || chr(10) ELSE '' END
         || upper(speaker) || ': [' || emotion || '] ' || text, chr(10) ORDER BY idx) AS content
  FROM lines GROUP BY conv_id),
raws AS (SELECT conv_id, generate_subscripts(p, 1)::INT - 1 AS line, regexp_replace(unnest(p), '^{S}+|{S}+$', '', 'g') AS raw FROM (SELECT conv_id, string_split(content, chr(10)) AS p FROM scripts))"""


def signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, idx, value from -1 to 1."""
    nth = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    return table(spark, sf_dir, "events").select("user_id", nth.alias("idx"), (F.col("value") / 500).alias("value"))


SIGNAL = "signal AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS idx, value / 500 AS value FROM events)"


def pauses(spark: SparkSession, sf_dir: str, hours: int = 6) -> DataFrame:
    """user_id, start, end, duration in seconds since the user's first event: pauses of some hours."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    window = Window.partitionBy("user_id").orderBy("t", "event_id")
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", micros.alias("t"))
    rows = rows.withColumn("e", F.lead("t").over(window)).withColumn("f", F.min("t").over(Window.partitionBy("user_id")))
    rows = rows.where(F.col("e") - F.col("t") >= hours * 3_600_000_000)
    return rows.select("user_id", ((F.col("t") - F.col("f")) / 1e6).alias("start"), ((F.col("e") - F.col("f")) / 1e6).alias("end"), ((F.col("e") - F.col("t")) / 1e6).alias("duration"))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, total in seconds: to a second after the user's last event."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return table(spark, sf_dir, "events").select("user_id", micros.alias("t")).groupBy("user_id").agg(((F.max("t") - F.min("t") + 1_000_000) / 1e6).alias("total"))


PAUSES = """pauses AS (
  SELECT user_id, (t - f) / 1e6 AS start_, (e - f) / 1e6 AS end_, (e - t) / 1e6 AS duration FROM (
    SELECT user_id, epoch_us(ts) AS t, lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS e, min(epoch_us(ts)) OVER (PARTITION BY user_id) AS f FROM events)
  WHERE e - t >= 6 * 3600000000),
totals AS (SELECT user_id, (max(epoch_us(ts)) - min(epoch_us(ts)) + 1000000) / 1e6 AS total FROM events GROUP BY user_id)"""


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than cores, dealt to all of them before costly projections; larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df


def word_pairs(spark: SparkSession, sf_dir: str, also: DataFrame | None = None, *own: str, counted: bool = True) -> DataFrame:
    """doc_id, kind, expected_words, actual_words, words (F2 of the expected text, if ``counted``): a benchmark passage against a document, and documents against changed ones.

    Every text is normalised once; what is set before or after it has its words set before or after.  Every pair has its document's
    columns ``own``, and those of its row of ``also`` (doc_id, ...), which meets the text, once: a pair of word arrays is never shuffled.
    """
    docs, items = table(spark, sf_dir, "documents").select("doc_id", "text", *own), table(spark, sf_dir, "benchmark")
    if also is None:
        docs = spread(docs)
    else:
        # as many parts as the scan or twice the cores: what is made of a part is many times as large, so parts don't grow together
        parts = max(2 * spark.sparkContext.defaultParallelism, docs.rdd.getNumPartitions())
        docs = docs.where("doc_id is not null").repartition(parts, "doc_id").join(also, "doc_id", "left")
    kept = [c for c in docs.columns if c != "text"]
    n = items.count()
    text, words = F.col("text"), F.col("w")
    docs = docs.select(*kept, normal_words(text).alias("w"), normal_words(F.left(text, (F.length(text) / 2).cast("int"))).alias("half"), word_count(text).alias("words"))
    passages = items.select(F.col("item_id"), normal_words(F.col("text")).alias("p"), word_count(F.col("text")).alias("passage_words"))
    both = docs.withColumn("item_id", F.col("doc_id") % n).join(passages, "item_id", "left")
    said = lambda x: F.array(*map(F.lit, x.split()))
    kinds = (("same", words), ("led", F.concat(said("welcome back again"), words)), ("cut", F.col("half")), ("tail", F.concat(words, said("and so on and on"))))
    # a field that nobody asks for would be computed all the same
    one = lambda kind, e, t, k: F.struct(F.lit(kind).alias("kind"), e.alias("expected_words"), t.alias("actual_words"), *([k.alias("words")] if counted else []))
    each = [one("passage", F.col("p"), words, F.col("passage_words")), *(one(k, words, t, F.col("words")) for k, t in kinds)]
    rows = both.select(*kept, F.explode(F.array(*each)).alias("x")).select(*kept, "x.*")
    return rows.where((F.col("kind") != "passage") | F.col("expected_words").isNotNull())


TEXT_PAIRS = """pairs AS (
  SELECT doc_id, 'passage' AS kind, b.text AS expected, d.text AS actual FROM documents d JOIN benchmark b ON d.doc_id % (SELECT count(*) FROM benchmark) = b.item_id
  UNION ALL SELECT doc_id, 'same', text, text FROM documents
  UNION ALL SELECT doc_id, 'led', text, 'welcome back again ' || text FROM documents
  UNION ALL SELECT doc_id, 'cut', text, left(text, (length(text) // 2)) FROM documents
  UNION ALL SELECT doc_id, 'tail', text, text || ' and so on and on' FROM documents)"""


def norm_sql(x: str) -> str:
    """F1 in SQL."""
    return rf"regexp_replace(regexp_replace(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_{SPACES}]', '', 'g'), '{S}+', ' ', 'g'), '^{S}+|{S}+$', '', 'g')"


WORDS_OF_PAIRS = f"""{TEXT_PAIRS}, w AS MATERIALIZED (
  SELECT doc_id, kind, e, t, words, e[len(e)] AS last, len(e) AS ne, len(t) AS nt FROM (
    SELECT doc_id, kind, regexp_extract_all({norm_sql("expected")}, '{NS}+') AS e, regexp_extract_all({norm_sql("actual")}, '{NS}+') AS t, len(regexp_extract_all(expected, '{NS}+'))::DOUBLE AS words FROM pairs))"""


def bits_sql(*parts: str) -> str:
    """The counter-based random number in SQL."""
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8))::BIGINT"


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, turn, duration_ms, gap_ms, emotion, text, speaker."""
    gap = (F.col("conv_id") * 13 + F.col("index") * 101) % 900
    return lines(spark, sf_dir).select("conv_id", F.col("index").alias("turn"), "duration_ms", gap.cast("int").alias("gap_ms"), "emotion", "text", "speaker")


TURNS = f"{LINES}, turns AS (SELECT conv_id, idx AS turn, duration_ms, ((conv_id * 13 + idx * 101) % 900)::INT AS gap_ms, emotion, text, speaker FROM lines)"
