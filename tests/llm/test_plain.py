"""Base columns, scores and shards against SQL and plain loops on the whole small corpus."""

import math
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np

from voxloom.llm import classifier, queries, sharding

SF = "/root/testdata/sf0.001"

BASE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, t FROM t),
p AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) > 2),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM p),
r AS (SELECT doc_id, count(DISTINCT at_) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS at_ FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS k FROM g) WHERE k > 1) GROUP BY 1),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM t) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
       coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(w) < 50 OR 100 * coalesce(r.n, 0) > 50 * len(w) AS base_failed
FROM w LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)
"""


def test_base_quality_columns_are_the_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(BASE)
    got = queries.QUERIES["op10_quality_rules"](spark, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_scores_are_the_double_loop(spark):
    """The linear-time pair term, on real rows, is the sum over all pairs of features."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = classifier.train(docs, labels, meta_cols=("n_chars",))
    got = {r.doc_id: r.score for r in classifier.score(docs, model, meta_cols=("n_chars",)).collect()}
    short = docs.where("length(text) between 1 and 500").select("doc_id", "text", "n_chars").collect()
    assert len(short) >= 5
    for r in short:
        counts = Counter(zlib.crc32(w) >> 16 for w in "".join(c.lower() if c.isascii() else c for c in r.text).encode().split())
        values = {k: 1 + math.log(c) for k, c in counts.items()}
        norm = math.sqrt(sum(v * v for v in values.values()))
        x = {k: v / norm for k, v in values.items()}
        dense = model.dense(np.array([classifier.features(r.text, (float(r.n_chars),))[2]]))[0]
        x |= {(1 << classifier.HASH_BITS) + k: float(v) for k, v in enumerate(dense)}
        z, items = model.bias + sum(model.w[k] * v for k, v in x.items()), list(x.items())
        for a, (i, u) in enumerate(items):
            for j, v in items[a + 1 :]:
                z += float(model.v[i] @ model.v[j]) * u * v
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-z))) < 1e-9


def test_shards_hold_the_law(spark):
    """Sizes and sums by one machine: every row once, slots from 0 without a gap, shards within a group's size of the mean."""
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sharding.shard(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    plain = {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in rows}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == plain and len(got) == len(rows)
    total, slots, groups = defaultdict(int), defaultdict(list), defaultdict(int)
    for r in got:
        total[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    for i, t in rows:
        groups[t] += plain[i][0]
    mean = sum(total.values()) / 16
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(total) == set(range(16))
    assert max(total.values()) <= mean + max(groups.values())
