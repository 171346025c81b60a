"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import classifier, exact_dedup, fill_middle, id_files, line_dedup, packing, periodic_runs, pieces, quality_rules, secret_scan, set_join, sharding, warc
from .common import read_table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.line_dedup(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.ngram_jaccard_groups(read_table(spark, sf_dir, "documents"))


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.read_model(spark, public_tokenizers.path("piece_bpe_32k.model"))
    decoded = pieces.decode(pieces.encode(read_table(spark, sf_dir, "documents"), model), model)
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_records(warc.write_archives(read_table(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op7_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, meta = read_table(spark, sf_dir, "documents"), ("n_chars",)
    return classifier.score(docs, classifier.train(docs, read_table(spark, sf_dir, "labels"), meta_cols=meta), meta_cols=meta)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = packing.read_spec(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), spec)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(read_table(spark, sf_dir, "documents")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.restored(fill_middle.fill_middle(read_table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op12_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = packing.read_spec(public_tokenizers.path("word_bpe_49k.json"))
    found = id_files.read_ids(id_files.write_ids(read_table(spark, sf_dir, "documents"), spec))
    return found.select("doc_id", "start", F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.planted(read_table(spark, sf_dir, "documents"))))


_ALL = (op1_line_dedup, op2_set_join, op3_pieces, op4_warc, op5_sharding, op6_exact_dedup, op7_classifier, op8_packing, op9_secret_scan, op10_quality_rules, op11_fill_middle, op12_id_files, op13_periodic_runs)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _ALL}

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": line_dedup.ORACLE_SQL,
    "op2_set_join": set_join.ORACLE_SQL,
    "op4_warc": warc.ORACLE_SQL,
    "op6_exact_dedup": exact_dedup.ORACLE_SQL,
    "op9_secret_scan": secret_scan.ORACLE_SQL,
    "op11_fill_middle": fill_middle.ORACLE_SQL,
}
