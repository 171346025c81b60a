"""Exact deduplication by skew-safe combining, in DataFrame operations only.

Three stages, each of which compares the whole normalised text and not only its digest:

1. *local*: Spark's map-side partial aggregation folds the equal texts of a task into one row;
2. *salted*: those rows meet by (digest, salt, text), so that a group that holds a third of the table is
   merged by ``salts`` tasks and not by one;
3. *global*: at most ``salts`` winners of each group are combined by (digest, text).

The aggregation buffers are a decimal and a long, which keeps all three stages on hash aggregation.  The
decisions go back to the rows by a join on the digest, which adaptive execution splits where it is skewed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WS_CLASS, free_name, text_of

#: More than any tie value below.
_BASE = str(2**65)


def normalised(text: Column) -> Column:
    """The text without white space; equal results are equal texts."""
    return F.regexp_replace(text, WS_CLASS, "")


def _rank(n_chars: Column, doc_id: Column) -> Column:
    """Larger is better: most code points first, then the smallest id; a null id comes last."""
    tie = F.coalesce(F.lit(str(2**63)).cast("decimal(20,0)") - doc_id.cast("decimal(19,0)"), F.lit(0).cast("decimal(21,0)"))
    return (n_chars.cast("decimal(12,0)") * F.lit(_BASE).cast("decimal(20,0)") + tie).cast("decimal(38,0)")


def _winner(rank: Column) -> Column:
    tie = rank % F.lit(_BASE).cast("decimal(38,0)")
    return F.when(tie > 0, (F.lit(str(2**63)).cast("decimal(38,0)") - tie).cast("long"))


def winners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 8) -> DataFrame:
    """One row per group of equal texts: digest, keep_id, group_size."""
    text = text_of(text_col)
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(salts)).alias("salt"),
        _rank(F.length(text), F.col(id_col)).alias("rank"),
        normalised(text).alias("norm"),
    ).withColumn("digest", F.sha2("norm", 256))
    salted = rows.groupBy("digest", "salt", "norm").agg(F.max("rank").alias("rank"), F.count(F.lit(1)).alias("n"))
    whole = salted.groupBy("digest", "norm").agg(F.max("rank").alias("rank"), F.sum("n").alias("n"))
    # different texts of one digest never merge above; the join back goes by digest, so it must be unique
    return (
        whole.groupBy("digest")
        .agg(F.max("rank").alias("rank"), F.max("n").alias("group_size"), F.count(F.lit(1)).alias("texts"))
        .select(
            F.when(F.col("texts") == 1, F.col("digest")).otherwise(F.raise_error(F.lit("two texts have one SHA-256 digest"))).alias("digest"),
            _winner(F.col("rank")).alias("keep_id"),
            "group_size",
        )
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 8) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts are empty texts and form one group with texts of white space only.  Ties go to the smallest id,
    a null id loses to any other.  Rows that repeat an id and a text are counted each in ``group_size`` and
    share the verdict, so ids should be unique.  An empty table gives an empty result; further columns of the
    input are not read, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.sha2(normalised(text_of(text_col)), 256).alias("digest"))
    return rows.join(winners(docs, id_col, text_col, salts), "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 8) -> DataFrame:
    """One row of each group, with all columns of ``docs``: that which stays.

    Null texts form one group with empty ones and those of white space only.  Of rows that repeat the id that stays, one
    with the longest text stays.  An empty table gives an empty result; no name of a column is taken.
    """
    digest, number, null, nth = (free_name(docs, x) for x in ("digest", "number", "null", "nth"))
    # joined by digest and id at once: the rows of a large group spread over all tasks, and the same keys serve the window
    key = lambda x: (F.coalesce(x, F.lit(0)).alias(number), x.isNull().alias(null))
    won = winners(docs, id_col, text_col, salts).select(F.col("digest").alias(digest), *key(F.col("keep_id")))
    rows = docs.select("*", F.sha2(normalised(text_of(text_col)), 256).alias(digest), *key(F.col(id_col).cast("long")))
    at = [digest, number, null]
    one = F.row_number().over(Window.partitionBy(*at).orderBy(F.length(text_of(text_col)).desc(), text_of(text_col)))
    return rows.join(won, at).withColumn(nth, one).where(F.col(nth) == 1).select(*docs.columns)


ORACLE_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id IS NOT DISTINCT FROM first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) AS kept,
       sha256(norm) AS text_sha256
FROM t
"""
