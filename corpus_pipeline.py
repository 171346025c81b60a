"""The corpus pipeline: quality rules, exact deduplication, near duplicates, secrets, packing.

Each stage reads the documents that the one before it kept, drops or changes rows, and returns the columns of
``documents``; the last returns the packed pieces.  ``run`` writes every stage as Parquet in the shared folder and
reads it again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import exact_dedup, packing, quality_rules, secret_scan, set_join
from voxloom.llm.common import free_name, read_table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; rejected ones go.

    Null and empty texts have too few words and go; repeated rows stay or go together; an empty table stays empty.
    """
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space: the longest, then that with the smallest id.

    Null texts are empty and one group with them; a null id comes last; of rows that repeat id and text one stays; different
    texts that share an id all stay; an empty table stays empty.
    """
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: that with the smallest id; a null id comes last, equal ids go by text.

    Rows are told apart by numbers of their own, so a row goes only for a copy of its own text, however ids repeat.  Texts without
    words (null, empty) are linked with nothing and stay; of rows that repeat id and text one stays; an empty table stays
    empty; no name of a column is taken.
    """
    row = free_name(docs, "row")
    # the numbers are the same in every read once they are written
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "near-rows")
    first = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", F.xxhash64("text").alias("hash"), F.col(row).alias("row"))
    groups = set_join.ngram_jaccard_groups(rows, id_col=row).select(F.col("doc_id").alias("row"), "component_id")
    numbered = rows.select(F.col(row).alias("row"), first.alias("first"))
    kept = groups.join(numbered, "row").groupBy("component_id").agg(F.min("first").alias("first")).select("first.row")
    dropped = written(numbered.select("row").join(kept, "row", "left_anti"), "near-copies")
    return rows.join(dropped.withColumnRenamed("row", row), row, "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mask; ``n_chars`` follows the text.

    Null and empty texts stay as they are; repeated rows stay; an empty table stays empty.
    """
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence.

    A null or empty text is one piece of the end id; repeated rows are packed each; an empty table gives no piece.
    """
    return packing.pack_documents(docs, packing.read_spec(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("secrets", secrets), ("packing", packed)]

#: Tokens, suffix arrays and components have no SQL form; the test holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
