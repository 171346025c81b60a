"""Queries on rows that only larger tables have, against their SQL."""

import datetime
import math

import duckdb
import pytest

from voxloom.plans import catalog

KEYS = {"events": "event_id long, ts timestamp, user_id long, value double", "supplier": "s_suppkey long, s_nationkey int", "conversations": "conv_id long, turn long, role string, text string"}


@pytest.fixture
def same(spark, tmp_path):
    """Runs a query and its SQL over the rows of one table; the query's rows if both are the same."""

    def check(name, table, rows):
        spark.createDataFrame(rows, KEYS[table]).repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
        con = duckdb.connect()
        con.sql("SET TimeZone = 'UTC'")
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
        want = con.sql(catalog.SQL[name])
        columns = want.columns
        got = sorted(tuple(r) for r in catalog.QUERIES[name](spark, str(tmp_path)).select(*columns).collect())
        assert got == sorted(want.fetchall())
        return got

    return check


def test_clip_library(same):
    rows = same("clip_library", "supplier", [(k, k % 3) for k in (1, 7, 10, 99, 100, 101, 999, 1000, 23_456)])
    assert sum(r[1] for r in rows) == 9


def _events(values, users=1):
    began = datetime.datetime(2024, 1, 1)
    return [(k, began + datetime.timedelta(seconds=k), k % users, float(v)) for k, v in enumerate(values)]


def test_wave_files_beyond_full_scale(same):
    values = [500 * math.sin(k) for k in range(200)]
    values[40], values[81], values[120], values[161] = 560.21, 499.99, -777.7, 100_000.0
    rows = same("wave_files", "events", _events(values, 4))
    assert [r[1] for r in rows] == [50] * 4


def test_voice_analysis_rounds_once(same):
    # a pulse every 37 samples is a pitch of 86.486, which a first decimal would make 86.5
    rows = same("voice_analysis", "events", _events([0 if k % 37 else 200 for k in range(2200)]))
    assert rows[0][2] == 86


def test_stems_broadcasts_no_samples(spark):
    plan = catalog.QUERIES["stems"](spark, "/root/testdata/sf0.1")._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: next(i for i, c in enumerate(line) if c.isalpha() or c == "*")
    plan = [x for x in plan if any(c.isalpha() for c in x)]
    for at, line in enumerate(plan):
        if "BroadcastExchange" in line:
            below = plan[at + 1 :]
            end = next((i for i, x in enumerate(below) if depth(x) <= depth(line)), len(below))
            assert not any("posexplode" in x for x in below[:end])
    assert any("posexplode" in x for x in plan)


def test_validate_batch_shuffles_texts_not_pairs(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        plan = catalog.QUERIES["validate_batch"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the pairs are made of what was shuffled: no exchange of the documents' side stands above the explode
    assert "Generate explode" in plan and not [x for x in plan[: plan.index("Generate explode")].split("\n") if "Exchange hashpartitioning" in x]


def test_a_model_is_begun_before_a_batch_is_read(spark):
    from voxloom.streaming import streams

    begun = []
    watched, streams.Watched.begin = streams.Watched.begin, lambda self: begun.append(True)
    try:
        kept = []
        rows = type("Rows", (), {"schema": spark.range(1).selectExpr("'a' as file").schema, "mapInPandas": lambda self, run, schema: kept.append(run)})()
        streams.transcribed(rows, lambda: str)

        def parts():
            assert begun
            yield from ()

        assert list(kept[0](parts())) == [] and begun
    finally:
        streams.Watched.begin = watched


def test_results_leave_python_in_pieces(spark):
    from voxloom.operators import chunked as C

    n = 3 * C.PIECE + 5
    rows = spark.range(n).selectExpr("id", "array(cast(id as double), 1D) as a").coalesce(1)
    one = C.mapped(rows, lambda a: float(a[0]) + 1, "b", "double", "a")
    two = C.mapped(one, lambda a, b: a * b, "c", "array<double>", "a", "b")
    assert [(r.b, r.c) for r in two.orderBy("id").collect()] == [(k + 1.0, [k * (k + 1.0), k + 1.0]) for k in range(n)]


def test_repairs_send_each_chunk_to_one_neighbour(spark, monkeypatch):
    from voxloom.operators import chunked as C

    asked, halo = [], C.with_halo
    monkeypatch.setattr(C, "with_halo", lambda chunks, key, left, right, size=C.SIZE: asked.append((left, right, size)) or halo(chunks, key, left, right, size))
    C.repaired(spark.createDataFrame([], "k int, chunk long, samples array<double>"), "k", 0.3, 16)
    assert [(left <= size, right <= size, size % 16) for left, right, size in asked] == [(True, True, 0)]


def test_clean_signals_of_many_chunks(same):
    # jumps without a pause, so what a line's left end was is carried over the borders of chunks and of their groups
    noise = [480 * math.sin(k * k % 977) for k in range(2600)]
    quiet = [0.0] * 70
    rows = same("clean_signals", "events", _events(quiet + noise + quiet))
    assert rows[0][1:4] == (1, 2.74, 2.635)


def test_clean_repairs_once(spark):
    plan = catalog.QUERIES["clean_signals"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan


def test_hallucination_flags_counts_no_words_and_searches_once(spark):
    plan = catalog.QUERIES["hallucination_flags"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "passage_words" not in plan and "regexp_count" not in plan
    # the line of the measures: the searches of C2 are made once, and equal texts are known without a set
    line = next(x for x in plan.split("\n") if "AS extra_end" in x)
    assert line[: line.index("AS extra_end")].count("reverse(") == 1


def test_words_and_measures_of_odd_texts(spark):
    import random
    import re

    from voxloom.functions import text as T
    from voxloom.operators import compare

    draw = random.Random(5)
    texts = ["", " ", "\x1c　", "...", "a", "É é!", " x y z\u0085", "ΟΔΟΣ ΟΔΟΣ.", "a_b c-d “q”", "\x07a\x00b", None]
    for _ in range(120):
        texts.append("".join(draw.choice(["a", "b", "B", "c", "ü", " ", " ", "\t", " ", "!", "—"]) for _ in range(draw.randrange(40))))
    words = lambda s: [w for w in re.sub("[^\\w\\s]", "", (s or "").lower()).split()]

    def measures(e, t):
        start = 0 if len(t) <= len(e) else next((k for k, w in enumerate(t) if w == (e or [""])[0]), len(t))
        end = 0
        if len(t) > len(e) + 3 and e:
            places = sorted((abs(k - len(e)), k) for k, w in enumerate(t, 1) if w == e[-1])
            end = len(t) - places[0][1] if places else 0
        return start, end, len(set(e) & set(t)) / len(set(e)) if e else None, len(t) / max(len(e), 1)

    pairs = [(k, a, b) for k, (a, b) in enumerate((a, draw.choice([b, (b or "") + " " + (a or ""), (a or "") + " " + (b or "")])) for a in texts for b in draw.sample(texts, 6))]
    df = spark.createDataFrame(pairs, "k long, expected string, actual string")
    rows = compare.compare(df.withColumn("n", T.word_count(df.expected)).withColumn("w", T.normal_words(df.expected)), "expected", "actual").collect()
    assert len(rows) == len(pairs)
    for r in rows:
        a, b = r.expected, r.actual
        assert r.n == len((a or "").split()) and (r.w is None if a is None else r.w == words(a))
        assert (r.extra_start, r.extra_end, r.overlap, r.ratio) == measures(words(a), words(b)), (a, b)
