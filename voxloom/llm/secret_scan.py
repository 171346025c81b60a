r"""Secret scan with an incremental blob ledger, in DataFrame operations only.

Every historical version of every path is addressed by the SHA-256 of its content.  The ledger is a table of
(blob_id, rule_version, spans) for every blob that a rule version has scanned, blobs without findings included;
a run scans only the (blob, rule version) pairs that the ledger lacks, appends them, and joins the ledger back
to all paths that hold the blob.  A rule version is a digest of the rules themselves.  Copies are scanned once and an unchanged corpus is not scanned again.

Spans are found without a UDF: ``split`` gives the gaps between the matches of a pattern and
``regexp_extract_all`` the matches, so a running sum of their lengths gives every match's place.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_name, fresh_path, text_of, written


@dataclass(frozen=True)
class Rule:
    """A kind of secret.  A match stays if ``counted`` (a group of the pattern) has ``least`` code points or more."""

    kind: str
    pattern: str
    counted: int
    least: int


#: The kinds, in the order that breaks ties.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
LEDGER_SCHEMA = "blob_id string, rule_version string, spans array<struct<start:long,rank:int,kind:string,end:long>>"
MASK = "[SECRET]"


def _hits(text: Column, rank: int, rule: Rule) -> Column:
    """array<struct<rank, i, gap, len, ok>>: the gap before each match, its length, and whether it stays."""
    gaps = F.split(text, rule.pattern, -1)
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    counted = found if rule.counted == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.counted))
    each = F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("found"), counted.alias("counted")),
        lambda x, i: F.struct(F.lit(rank).alias("rank"), i.alias("i"), F.length(x["gap"]).alias("gap"), F.length(x["found"]).alias("len"), (F.length(x["counted"]) >= rule.least).alias("ok")),
    )
    none = F.expr("cast(array() as array<struct<rank:int,i:int,gap:int,len:int,ok:boolean>>)")
    return F.when(text.rlike(rule.pattern), each).otherwise(none)


def find_spans(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """blob_id, spans (by start, then kind) of every row (blob_id, text); blob ids are unique."""
    rows = blobs.select("blob_id", F.explode_outer(F.flatten(F.array(*(_hits(F.col("text"), k, r) for k, r in enumerate(rules))))).alias("h")).select("blob_id", "h.*")
    before = Window.partitionBy("blob_id", "rank").orderBy("i")
    ends = rows.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(before))
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    span = F.struct((F.col("end") - F.col("len")).alias("start"), "rank", F.get(kinds, F.col("rank")).alias("kind"), "end")
    return ends.groupBy("blob_id").agg(F.array_sort(F.collect_list(F.when(F.col("ok"), span))).alias("spans"))


def version_of(rules: tuple[Rule, ...]) -> str:
    """The version of a set of rules: a digest of all that decides their spans, so changed rules never meet old findings."""
    return hashlib.sha256(repr([(r.kind, r.pattern, r.counted, r.least) for r in rules]).encode()).hexdigest()[:16]


def blob_id(text: Column) -> Column:
    """The address of a content; null is empty."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def read_ledger(spark: SparkSession, path: str, rule_version: str) -> DataFrame:
    """(blob_id, spans) of a rule version, each blob once, also where two runs that met wrote it twice."""
    return spark.read.schema(LEDGER_SCHEMA).parquet(path).where(F.col("rule_version") == rule_version).groupBy("blob_id").agg(F.max("spans").alias("spans"))


def update_ledger(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """Scans the blobs of ``versions`` that the ledger at ``path`` lacks for these rules; returns (blob_id, spans) of the ledger.

    Digests are compared before any text moves: where the ledger knows some blobs, only rows of unknown ones go on.  Equal
    blobs merge map-side first, so a blob that a third of all paths hold costs a row of each task.  The ledger is made
    where it is missing, also for an empty table.
    """
    spark, version = versions.sparkSession, version_of(rules)
    text = text_of(text_col)
    blobs = versions.select(blob_id(text).alias("blob_id"), text.alias("text"))
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("append").parquet(path)
    seen = spark.read.schema(LEDGER_SCHEMA).parquet(path).where(F.col("rule_version") == version).select("blob_id")
    if not seen.isEmpty():
        unseen = blobs.select("blob_id").distinct().join(seen, "blob_id", "left_anti")
        blobs = blobs.join(unseen, "blob_id", "left_semi")
    new = find_spans(blobs.distinct(), rules)
    new.select("blob_id", F.lit(version).alias("rule_version"), "spans").write.mode("append").parquet(path)
    return read_ledger(spark, path, version)


def findings(ledger: DataFrame) -> DataFrame:
    """The rows of a ledger that have spans, few of them, written: so the join to all paths that hold a blob is of plain scans, which
    adaptive execution may broadcast or split where one blob has very many paths."""
    return written(ledger.where(F.size("spans") > 0), "findings")


def scan(docs: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``also`` (a path and a version, say), blob_id, spans for every row of ``docs``.

    Every row is a version of its path.  With ``ledger_path`` only blobs that no run with these rules has seen are scanned;
    without, a new ledger is begun in the shared folder.  Null texts are empty and have no spans; repeated rows each get
    their row; ids may repeat or be null; an empty table gives an empty result; columns not named are not read.  A column of
    ``also`` that has the name of another one of the result comes with an underscore behind it.
    """
    ledger = update_ledger(docs, ledger_path or fresh_path(docs.sparkSession, "ledger"), rules, text_col)
    taken, names = {"doc_id", "blob_id", "spans"}, []
    for name in also:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        names.append(name)
    rows = docs.select(F.col(id_col).alias("doc_id"), *(F.col(c).alias(n) for c, n in zip(also, names, strict=True)), blob_id(F.col(text_col)).alias("blob_id"))
    # after the update every blob is in the ledger, so one that isn't among the findings has none
    none = F.expr("cast(array() as array<struct<start:bigint,rank:int,kind:string,end:bigint>>)")
    return rows.join(findings(ledger), "blob_id", "left").select("doc_id", *names, "blob_id", F.coalesce("spans", none).alias("spans"))


def masked(text: Column, spans: Column, mask: str = MASK) -> Column:
    """``text`` with a mask for every span of ``spans`` (ordered by start); overlapping spans make one."""
    # runs of spans that overlap: small structs only, the text is cut once for each run
    empty = F.expr("cast(array() as array<struct<start:long,end:long>>)")

    def step(runs: Column, s: Column) -> Column:
        last = F.get(runs, F.size(runs) - 1)
        inside = F.coalesce(s["start"] < last["end"], F.lit(False))
        longer = F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when(inside, longer).otherwise(F.concat(runs, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))

    runs = F.aggregate(spans, empty, step)
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform(runs, lambda r: r["end"]))
    gap = lambda r, i: F.substring(text, (F.get(ends, i) + 1).cast("int"), (r["start"] - F.get(ends, i)).cast("int"))
    return F.concat(F.concat_ws("", F.transform(runs, lambda r, i: F.concat(gap(r, i), F.lit(mask)))), F.substring(text, (F.get(ends, F.size(runs)) + 1).cast("int"), F.length(text)))


def redact(docs: DataFrame, ledger_path: str | None = None, rules: tuple[Rule, ...] = RULES, text_col: str = "text", mask: str = MASK) -> DataFrame:
    """``docs``, all columns and rows, with every span of ``text_col`` replaced by ``mask``; overlapping spans make one mask.

    A text without spans stays as it is, null and empty ones too; repeated rows stay repeated; ids play no part; an
    empty table gives an empty result; no name of a column is taken.
    """
    ledger = findings(update_ledger(docs, ledger_path or fresh_path(docs.sparkSession, "ledger"), rules, text_col))
    blob, spans = free_name(docs, "blob_id"), free_name(docs, "spans")
    rows = docs.withColumn(blob, blob_id(F.col(text_col))).join(ledger.select(F.col("blob_id").alias(blob), F.col("spans").alias(spans)), blob, "left")
    clean = F.when(F.col(spans).isNotNull(), masked(F.col(text_col).cast("string"), F.col(spans), mask)).otherwise(F.col(text_col))
    return rows.withColumn(text_col, clean).select(*docs.columns)


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns of ``scan``'s result."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    return scanned.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


def _oracle() -> str:
    """DuckDB SQL for ``digest(scan(documents))``."""
    kinds = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS rank, '{r.kind}' AS kind, {r.least} AS least, string_split_regex(t, $re${r.pattern}$re$) AS gaps, "
        f"regexp_extract_all(t, $re${r.pattern}$re$, 0) AS found, regexp_extract_all(t, $re${r.pattern}$re$, {r.counted}) AS counted FROM d"
        for k, r in enumerate(RULES)
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({kinds}),
i AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m),
s AS (
  SELECT doc_id, rank, kind, list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) AS start_, length(found[i]) AS n
  FROM i WHERE length(counted[i]) >= least
),
g AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k, count(*) FILTER (kind = 'hex') AS h,
         string_agg(kind || ':' || start_::BIGINT || ':' || (start_ + n)::BIGINT, ',' ORDER BY start_, rank) AS spans
  FROM s GROUP BY doc_id
)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


ORACLE_SQL = _oracle()
