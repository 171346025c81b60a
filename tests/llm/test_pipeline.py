"""The pipeline against plain versions of its stages."""

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer
import zlib

SF = "/root/testdata/sf0.001"


def test_stages_are_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        pairs = list(rows.items())
        if name == "quality":
            rows = {i: t for i, t in pairs if brute.quality(t)[-1]}
        elif name == "exact":
            kept = brute.exact(pairs)
            rows = {i: t for i, t in pairs if kept[i][2]}
        elif name == "near":
            groups = brute.components(pairs)
            rows = {i: t for i, t in pairs if groups[i][1] == i}
        else:
            rows = {i: brute.redacted(t) for i, t in pairs}
        got = {r.doc_id: r for r in docs.collect()}
        assert {i: r.text for i, r in got.items()} == rows, name
        assert all(r.n_chars == len(r.text) for r in got.values()), name
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for i, t in rows.items():
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4")
        want |= {(i, k, a, len(ids[a : a + 4096]), zlib.crc32(ids[a : a + 4096].tobytes())) for k, a in enumerate(range(0, len(ids), 4096))}
    packed = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed} == want and len(packed) == len(want)
    for s in {r.sequence_id for r in packed}:
        own = sorted((r.offset, r.length) for r in packed if r.sequence_id == s)
        assert [a for a, _ in own] == list(np.r_[0, np.cumsum([n for _, n in own])[:-1]]) and sum(n for _, n in own) <= 4096


def test_odd_rows_pass(spark, docs):
    from pyspark.sql import functions as F

    rows = docs.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        rows = stage(spark, rows, SF)
    assert rows.where("doc_id = 42").first().text.count("[SECRET]") >= 2
    assert {r.doc_id for r in rows.collect()} >= {5, 7, 40, 41, 44, 70, 71, 72}


def test_near_keeps_one_of_each_component(spark):
    """Ids that repeat or are null: a clean text stays whatever its id, and one row of each component stays."""
    text = lambda name, k=None: " ".join([*(f"{name}{i}" for i in range(100)), *([] if k is None else [f"own{k}"])])
    rows = [
        (1, text("a", 0)), (5, text("a", 1)), (None, text("a", 2)), (5, text("b")),
        (7, text("c", 0)), (7, text("c", 1)), (8, text("c", 2)),
        (None, text("d", 0)), (None, text("d", 1)), (None, text("e")), (None, None), (9, ""),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    want = [{(1, rows[0][1])}, {(5, rows[3][1])}, {(7, rows[4][1]), (7, rows[5][1])}, {(None, rows[7][1]), (None, rows[8][1])}, {(None, rows[9][1])}, {(None, None)}, {(9, "")}]
    kept = []
    for parts in (1, 5):
        got = corpus_pipeline.near(spark, docs.repartition(parts), SF)
        assert got.columns == docs.columns
        kept.append({(r.doc_id, r.text) for r in got.collect()})
        assert got.count() == len(want) and all(len(kept[-1] & one) == 1 for one in want)
    assert kept[0] == kept[1]


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_stages_of_odd_rows(spark):
    """Nulls in every column, empty and repeated rows, a clashing name."""
    words = " ".join(f"w{i}" for i in range(80))
    rows = [(1, words, None, None, None, 7), (1, words, None, None, None, 7), (None, words + " x", "en", "s", 1, 8), (2, None, None, "s", None, 9), (3, "", "en", None, 0, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row int")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept[name] = sorted(str((r.doc_id, None if r.text is None else len(r.text), r.row)) for r in stage(spark, docs, SF).collect())
    two, more = str((1, len(words), 7)), str((None, len(words) + 2, 8))
    nothing = [str((2, None, 9)), str((3, 0, 9))]
    assert kept["quality"] == sorted([two, two, more])
    assert kept["exact"] == sorted([two, more, nothing[0]])
    assert kept["near"] == sorted([two, *nothing])
    assert kept["secrets"] == sorted([two, two, more, *nothing])
    packed = corpus_pipeline.packed(spark, docs, SF)
    assert packed.count() == 5
