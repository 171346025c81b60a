"""Fill-in-the-middle, token-id files and periodic runs, on planted rows and a small corpus, against plain versions."""

import hashlib
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from voxloom.llm import fill_middle, id_files, packing, periodic_runs, queries, simple8b, suffix

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
SPEC = packing.read_spec(PATH)
RUN_DIGEST = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


@pytest.fixture(params=["docs", "corpus"])
def table(request):
    return request.getfixturevalue(request.param)


# fill-in-the-middle


@settings(deadline=None, max_examples=300)
@given(st.lists(st.text(st.sampled_from("aé日😀<PSM> \n\x00"), max_size=40), max_size=12))
def test_cuts_by_runs_are_those_of_code_points(texts):
    rows = [t.encode() for t in texts]
    h = [np.array([zlib.crc32(f"{k}:{i}".encode()) for i in range(len(rows))], np.int64) for k in range(4)]
    n, form, prefix, middle, out = fill_middle.transform_chunk(rows, h, 10, 20)
    for i, t in enumerate(texts):
        assert n[i] == len(t)
        if form[i] == "plain":
            assert out[i] == rows[i]
            continue
        a, b = sorted((int(h[0][i]) % (len(t) + 1), int(h[1][i]) % (len(t) + 1)))
        assert (prefix[i], middle[i]) == (a, b - a)
        parts = {"psm": f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}", "spm": f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"}
        assert out[i].decode() == parts[form[i]]


def test_class_runs_are_maximal():
    runs = fill_middle.ClassRuns(np.frombuffer("abcéé日x😀".encode(), np.uint8))
    assert runs.units.tolist() == [0, 3, 5, 6, 7, 8] and runs.bytes.tolist() == [0, 3, 7, 10, 11, 15]
    assert len(fill_middle.ClassRuns(np.frombuffer(b"long " * 10_000, np.uint8)).units) == 2


def test_fill_middle(table):
    found = fill_middle.restored(fill_middle.fill_middle(table))
    got = by_id(found, "n", "form", "prefix_chars", "middle_chars", "output")
    rows = pairs(table)
    assert got == {i: brute.filled(i, t) for i, t in rows}
    assert by_id(found, "restored") == {i: (t or "",) for i, t in rows}


def test_fill_middle_of_odd_rows(spark, empty):
    assert fill_middle.fill_middle(empty).count() == 0
    rows = [(None, "a b"), (None, "a b"), (1, "x<P>y"), (1, "<S>"), (2, "<M"), (2, "<P"), (3, "<" * 50), (4, "😀é" * 300_000), (4, "P>S>M>" * 9)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, output string, h1 int")
    for percents in ((10, 20), (0, 0), (0, 100)):
        got = fill_middle.restored(fill_middle.fill_middle(df, 1, *percents)).collect()
        assert sorted((str(r.doc_id), r.restored) for r in got) == sorted((str(i), t) for i, t in rows)
        forms = {(r.doc_id, r.restored): r.form for r in got}
        assert forms[1, "x<P>y"] == forms[1, "<S>"] == "plain"
        assert percents[0] or forms[3, "<" * 50] == ("spm" if percents[1] else "psm")


# token-id files


@settings(deadline=None, max_examples=200)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 40_000), st.sampled_from([0, 1, 2, 3, 62, 63, 32766, 32767, 1 << 20, (1 << 30) - 1, 1 << 30, (1 << 32) - 1])), max_size=1300), st.integers(1, 4))
def test_simple8b_round_trip(ids, times):
    ids = np.array(ids * times, "<u4")
    words, used, escapes, n_escapes = simple8b.encode(ids)
    assert used.sum() == len(words) and n_escapes.sum() == len(escapes)
    assert (simple8b.decode(words, used, escapes, len(ids)) == ids).all()


def test_simple8b_takes_the_cheapest_word():
    ids = np.array([7] * 20 + [40_000] + [7] * 20, "<u4")
    words, used, escapes, _ = simple8b.encode(ids)
    # one id that no narrow slot holds is an escape, not a word of its own
    assert escapes.tolist() == [40_000] and len(words) <= 4
    assert len(simple8b.encode(np.zeros(512, "<u4"))[0]) == 3


def want_files(rows, end=2):
    """doc_id -> sorted (start, n, crc) by the library."""
    t, out, at = Tokenizer.from_file(PATH), [], 0
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def files_found(df):
    return sorted((r.doc_id, r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in df.collect())


@pytest.mark.parametrize("file_ids", [1 << 26, 700])
def test_id_files(table, file_ids):
    manifest = id_files.write_ids(table, SPEC, file_ids=file_ids)
    want = want_files(sorted(pairs(table), key=lambda r: r[0]))
    assert files_found(id_files.read_ids(manifest)) == want
    ids = sorted(i for i, _ in pairs(table))
    low, high = ids[len(ids) // 3], ids[len(ids) // 2]
    assert files_found(id_files.read_ids(manifest, (low, high))) == [r for r in want if low <= r[0] <= high]
    rows = manifest.orderBy("part", "seq").collect()
    spans = [(r.first_doc, r.last_doc) for r in rows]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_id_files_read_blocks_only(spark, monkeypatch):
    """One document of a long file is read from the bytes of its blocks, not from all."""
    df = spark.createDataFrame([(i, f"number {i} " * 200) for i in range(40)], "doc_id long, text string").coalesce(1)
    row = id_files.with_starts(id_files.write_ids(df, SPEC)).orderBy("part").first()
    file = id_files.IdFile(row.file)
    read = []
    monkeypatch.setattr(file, "read", lambda at, n, f=file.read: read.append(n) or f(at, n))
    ((doc_id, _, ids),) = file.documents((row.first_doc + 1, row.first_doc + 1))
    assert doc_id == row.first_doc + 1 and len(ids) == len(Tokenizer.from_file(PATH).encode(f"number {doc_id} " * 200, add_special_tokens=False).ids) + 1
    assert sum(read) < file.tables_at / 4


def test_id_files_of_odd_rows(spark, empty):
    assert id_files.read_ids(id_files.write_ids(empty, SPEC)).count() == 0
    rows = [(None, "null id"), (None, None), (7, "tie"), (7, "tie"), (7, "other tie"), (-5, "below zero"), (-(2**63), "least"), (2**63 - 1, "")] + [(9, "same")] * 300
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, start int, ids string").repartition(4)
    got = id_files.read_ids(id_files.write_ids(df, SPEC, file_ids=40)).collect()
    t = Tokenizer.from_file(PATH)
    n = lambda text: len(t.encode(text or "", add_special_tokens=False).ids) + 1
    assert sorted((str(r.doc_id), len(r.ids) // 4) for r in got) == sorted((str(i), n(x)) for i, x in rows)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += len(r.ids) // 4
    order = [-(2**64) if r.doc_id is None else r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)


# periodic runs


def test_suffix_ranks():
    rng = np.random.default_rng(3)
    for _ in range(30):
        w = rng.integers(0, 3, int(rng.integers(1, 60)))
        ranks, n = suffix.SuffixRanks(w), len(w)
        a, b = (x.ravel() for x in np.meshgrid(np.arange(n + 1), np.arange(n + 1)))
        a, b = a[a != b], b[a != b]
        low = lambda x, y: next((k for k in range(n) if max(x, y) + k >= n or w[x + k] != w[y + k]), n)
        back = lambda x, y: next((k for k in range(n) if min(x, y) - k - 1 < 0 or w[x - k - 1] != w[y - k - 1]), n)
        assert ranks.common_prefix(a, b).tolist() == [low(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        assert ranks.common_suffix(a, b).tolist() == [back(x, y) for x, y in zip(a.tolist(), b.tolist(), strict=True)]


def test_runs_of_random_words():
    rng = np.random.default_rng(13)
    for _ in range(150):
        docs = []
        for _ in range(20):
            w, n, letters = [], int(rng.integers(0, 120)), int(rng.integers(1, 5))
            while len(w) < n:
                x = rng.random()
                if x < 0.3:
                    w += list(rng.integers(0, letters, int(rng.integers(1, 6))))
                elif x < 0.6:
                    w += list(rng.integers(0, letters, int(rng.integers(1, 6)))) * int(rng.integers(2, 9))
                elif w:
                    at = int(rng.integers(0, len(w)))
                    w += w[at : at + int(rng.integers(1, 50))]
            docs.append([f"w{x}" for x in w])
        _, runs, out = periodic_runs.measure([" ".join(w).encode() for w in docs])
        for w, r, text in zip(docs, runs, out, strict=True):
            want = brute.runs(w)
            assert [(s, s + n, q) for s, n, q in r.tolist()] == want
            gone = {i for s, e, q in want for i in range(s + q, e)}
            assert text.decode().split() == [x for i, x in enumerate(w) if i not in gone]


def test_periodic_runs(table):
    got = by_id(periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.planted(table))), *RUN_DIGEST)
    rows = [(i, t) for i, t in pairs(table) if len(t or "") < 60_000]
    assert {i: got[i] for i, _ in rows} == {i: brute.run_digest(i, t) for i, t in rows}
    assert len(got) == table.count()


def test_one_long_run(docs):
    """The longest planted row: one word 30,000 times."""
    (row,) = periodic_runs.periodic_runs(docs.where("doc_id = 40")).collect()
    assert (row.n_words, [tuple(r) for r in row.runs], row.collapsed) == (30_000, [(0, 30_000, 1)], "word")


def test_periodic_runs_of_odd_rows(spark, empty):
    assert periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.planted(empty))).count() == 0
    rows = [(None, None), (None, "a " * 6), (1, "b " * 5), (1, "a b a b a b a b x"), (1, "a b a b a b a b x"), (2, "\x0b \t\n"), (3, "a b a b a b a"), (4, ("x " * 8 + "y ") * 5)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, runs string, n_words int")
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(df).collect())
    eights = [(9 * k, 8, 1) for k in range(5)]
    want = [
        ("None", 0, [], ""),
        ("None", 6, [(0, 6, 1)], "a"),
        ("1", 5, [], "b b b b b"),
        *[("1", 9, [(0, 8, 2)], "a b x")] * 2,
        ("2", 0, [], ""),
        ("3", 7, [], "a b a b a b a"),
        ("4", 45, [(0, 8, 1), (0, 45, 9), *eights[1:]], "x y"),
    ]
    assert got == sorted(want)


@pytest.mark.parametrize("name", ["op11_fill_middle", "op12_id_files", "op13_periodic_runs"])
def test_queries(spark, name):
    got, rows = queries.QUERIES[name](spark, SF).collect(), pairs(spark.read.parquet(f"{SF}/documents.parquet"))
    if name == "op12_id_files":
        assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got) == want_files(sorted(rows))
    elif name == "op13_periodic_runs":
        assert {r.doc_id: tuple(r[c] for c in RUN_DIGEST) for r in got} == {i: brute.run_digest(i, t) for i, t in rows}
        assert sum(r.n_runs > 0 for r in got) >= 5
    else:
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want = {i: (*(f := brute.filled(i, t))[:4], sha(f[4]), sha(t or "")) for i, t in rows}
        assert {r.doc_id: tuple(r)[1:] for r in got} == want
