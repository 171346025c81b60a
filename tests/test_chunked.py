"""Signals in chunks against plain loops over whole arrays; chunks are small, so every signal spans many of them."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxloom.operators import chunked as C
from voxloom.operators import production as A
from voxloom.operators import rollup
from voxloom.operators import signal as G
from voxloom.plans import pipelines

RATE, SIZE = 4000, 512


def long(spark, **signals):
    rows = [(k, i, float(v)) for k, x in signals.items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "k string, idx long, value double").repartition(3)


def chunks(spark, size=SIZE, **signals):
    return C.settled(C.chunks_of(long(spark, **signals), "k", size))


def whole(df, size=SIZE):
    """Each key's signal; no place twice, none missing."""
    rows = df if "value" in df.columns else C.long_of(df, "k", size)
    out = {}
    for r in rows.collect():
        out.setdefault(r.k, {})[r.idx] = r.value
    for x in out.values():
        assert sorted(x) == list(range(len(x)))
    return {k: np.array([x[i] for i in range(len(x))]) for k, x in out.items()}


def noise(n, seed=0, level=0.2):
    return np.random.default_rng(seed).normal(0, level, n)


def tone(seconds, hz=200, level=0.3, rate=RATE):
    return level * np.sin(2 * np.pi * hz * np.arange(int(rate * seconds)) / rate)


# plain versions


def biquads(x, sections):
    for b, a in sections:
        out, x1, x2, y1, y2 = [], 0.0, 0.0, 0.0, 0.0
        for v in x:
            y = (b[0] * v + b[1] * x1 + b[2] * x2 - a[1] * y1 - a[2] * y2) / a[0]
            x1, x2, y1, y2 = v, x1, y, y1
            out.append(y)
        x = np.array(out)
    return x


def gated(x, rate):
    y, n = biquads(x, C.k_weights(rate)), len(x)
    if n < 0.4 * rate:
        return None
    z = []
    for j in range(int(np.round((n / rate - 0.4) / 0.1)) + 1):
        a, b = round(0.1 * j * rate), round((0.1 * j + 0.4) * rate)
        z.append(float((y[a:b] ** 2).sum()) / (0.4 * rate))
    db = lambda v: -0.691 + 10 * np.log10(v)
    z = [v for v in z if v > 0 and db(v) >= -70]
    if not z:
        return -70.0
    gate = db(np.mean(z)) - 10
    return db(np.mean([v for v in z if db(v) > gate]))


def jump_by_jump(x, threshold):
    x = x.copy()
    for i in np.flatnonzero(np.abs(np.diff(x)) > threshold):
        a, b = max(0, i - 3), min(len(x) - 1, i + 3)
        x[a : b + 1] = x[a] + (x[b] - x[a]) * np.arange(b - a + 1) / max(1, b - a)
    return x


# chunks


@pytest.mark.parametrize("left,right", [(0, 0), (3, 5), (16, 16), (40, 33)])
def test_halo(spark, left, right):
    x = {"a": np.arange(100.0), "b": np.arange(7.0)}
    for r in C.with_halo(chunks(spark, 16, **x), "k", left, right, 16).collect():
        a, b = 16 * r.chunk, 16 * r.chunk + len(r.samples)
        assert r.samples == x[r.k][a:b].tolist()
        assert r.before == x[r.k][max(0, a - left) : a].tolist() and r.after == x[r.k][b : b + right].tolist()


def test_splitting_and_grouping(spark):
    rows = spark.createDataFrame([("a", [float(i) for i in range(100)]), ("b", []), ("c", None)], "k string, samples array<float>")
    parts = A.split(rows, "k", 16)
    assert np.array_equal(whole(parts, 16)["a"], np.arange(100)) and set(whole(parts, 16)) == {"a"}
    again = C.ungrouped(C.grouped(parts, "k", 3), "k", 3, 16)
    assert sorted(map(tuple, again.select("k", "chunk", "samples").collect())) == sorted(map(tuple, parts.select("k", "chunk", "samples").collect()))


def test_recursion_is_the_plain_one(spark):
    x = {"a": noise(3000, 1), "b": noise(700, 2), "c": noise(1, 3), "d": tone(0.5)}
    sections = [*C.k_weights(RATE), C.shelf(RATE, 300.0, -2.0, 0.7, high=False)]
    # in chunks of 64 a state lasts over several
    for size in (64, SIZE):
        got = whole(C.filtered(chunks(spark, size, **x), "k", sections, size), size)
        for k in x:
            assert np.allclose(got[k], biquads(x[k], sections), atol=1e-12), (k, size)


def test_follower_is_the_plain_one(spark):
    x = {"a": noise(900, 4), "b": np.r_[np.zeros(50), np.ones(300), np.zeros(400)]}
    got = whole(C.followed(chunks(spark, 64, **x), "k", 1000, 5.0, 30.0, 64), 64)
    for k in x:
        now, want = 0.0, []
        for v in np.abs(x[k]):
            now = v + np.exp(-1 / (5 if v > now else 30)) * (now - v)
            want.append(now)
        assert np.allclose(got[k], want, atol=1e-14)


def test_convolution(spark):
    x, response = {"a": noise(1000, 5), "b": noise(20, 6)}, noise(150, 7)
    got = whole(C.convolved(chunks(spark, 64, **x), "k", response, 64), 64)
    for k in x:
        assert np.allclose(got[k], np.convolve(x[k], response)[: len(x[k])], atol=1e-12)


# loudness


def test_loudness(spark):
    x = {"tone": tone(1.5, 997), "loud_then_soft": np.r_[tone(1, 500, 0.5), tone(1, 500, 0.001)], "noise": noise(5000, 8), "zero": np.zeros(3000), "short": noise(1500, 9), "half_block": noise(RATE + 250, 10)}
    got = {r.k: r.lufs for r in C.integrated(chunks(spark, **x), "k", RATE, SIZE).collect()}
    for k in x:
        want = gated(x[k], RATE)
        assert got[k] is None if want is None else abs(got[k] - want) < 1e-9, k


def test_meter_of_a_full_scale_tone(spark):
    """A sine of 997 Hz at full scale has -3 by the standard; 0.1 for the filter's design."""
    x = np.sin(2 * np.pi * 997 * np.arange(48_000) / 48_000)
    (r,) = C.integrated(chunks(spark, 1 << 14, a=x), "k", 48_000, 1 << 14).collect()
    assert abs(r.lufs + 3.01) < 0.1


def test_loudness_range(spark):
    windows = spark.createDataFrame([("a", i, -30.0 + 0.1 * (i % 101)) for i in range(1010)] + [("a", 2000, -90.0)] + [("one", 0, -20.0)], "k string, block long, loudness double")
    got = {r.k: r.lra for r in C.loudness_range(windows, "k").collect()}
    assert abs(got["a"] - 8.5) < 0.11 and got["one"] == 0


def test_true_peaks(spark):
    """Samples of a sine of a quarter of the rate miss its top by 3 dB."""
    x = 0.5 * np.sin(np.pi / 2 * np.arange(2000) + np.pi / 4)
    rows = {r.k: r.true_peak for r in C.true_peaks(chunks(spark, a=x, b=np.zeros(10)), "k", SIZE).collect()}
    assert abs(rows["a"] - 0.5) < 0.03 and np.abs(x).max() < 0.36 and rows["b"] == 0


def test_limiter(spark):
    x = {"a": np.r_[tone(0.3, 300, 0.3), tone(0.1, 300, 1.6), tone(0.3, 300, 0.3)], "soft": tone(0.2, 300, 0.4)}
    out = C.settled(C.limited(chunks(spark, **x), "k", RATE, 0.8, SIZE))
    peaks = {r.k: r.true_peak for r in C.true_peaks(out, "k", SIZE).collect()}
    got = whole(out)
    assert peaks["a"] <= 0.8 * 10 ** (0.1 / 20) and np.allclose(got["soft"], x["soft"])
    assert np.allclose(got["a"][:1000], x["a"][:1000]) and np.abs(got["a"][1300:1500]).max() > 0.7


def test_loudness_normalized(spark):
    """Loudness to 0.1, the range to 1, true peaks to 0.1 dB."""
    steps = np.concatenate([tone(4, 400, level) for level in (0.02, 0.3, 0.02, 0.3)])
    x = {"even": tone(5, 300, 0.02), "steps": steps, "short": tone(0.2, 300, 0.05), "zero": np.zeros(4000)}
    out = C.settled(C.loudness_normalized(chunks(spark, 4096, **x), "k", RATE, target=-23.0, most_range=8.0, size=4096))
    lufs = {r.k: r.lufs for r in C.integrated(out, "k", RATE, 4096).collect()}
    assert abs(lufs["even"] + 23) < 0.1 and abs(lufs["steps"] + 23) < 0.1 and lufs["short"] is None and lufs["zero"] == -70
    windows = C.short_terms(C.settled(C.step_energies(out, "k", RATE, 4096)), C.lengths(out, "k"), "k", RATE)
    lra = {r.k: r.lra for r in C.loudness_range(windows, "k").collect()}
    assert lra["steps"] <= 9.0
    peaks = {r.k: r.true_peak for r in C.true_peaks(out, "k", 4096).collect()}
    assert all(20 * np.log10(max(p, 1e-9)) <= -1.4 for p in peaks.values())
    got = whole(out, 4096)
    assert np.allclose(got["short"], x["short"]) and {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in x.items()}


# repairs, cleaning


@settings(deadline=None, max_examples=400)
@given(st.lists(st.sampled_from([0.0, 0.1, 0.3, -0.4, 0.9]), max_size=60))
def test_repair_is_jump_by_jump(x):
    x = np.array(x, float)
    assert np.allclose(C.repair(x, 0.15), jump_by_jump(x, 0.15), atol=1e-14)


def test_repair_in_chunks(spark):
    """Bursts, dense noise and single clicks, over the borders of chunks of 16 samples."""
    clicks = np.zeros(300)
    clicks[[15, 16, 31, 47, 100, 101, 102, 103, 299, 0]] = 0.9
    x = {"dense": noise(2000, 11, 0.5), "clicks": clicks, "bursts": noise(500, 12, 0.3) * (np.arange(500) % 50 < 6), "one": np.array([0.5]), "two": np.array([0.0, 0.9])}
    got = whole(C.repaired(chunks(spark, 16, **x), "k", 0.15, 16), 16)
    for k in x:
        assert np.allclose(got[k], jump_by_jump(x[k], 0.15), atol=1e-12), k


def test_clicks_and_silences_of_stretches(spark):
    """Stretches of any size give the same groups and runs; one long signal is searched by several tasks."""
    x = {"a": np.where(np.arange(3000) % 700 < 400, 0.0, noise(3000, 13, 0.4)), "b": np.zeros(257), "c": noise(50, 14)}
    df = long(spark, **x)
    for f in (lambda size: G.clicks(df, "k", 1000, 0.3, size), lambda size: G.silences(df, "k", 1000, -40.0, 0.05, size)):
        want = sorted(map(tuple, f(1 << 16).collect()))
        assert want and all(sorted(map(tuple, f(size).collect())) == want for size in (7, 64, 256))
    plan = G.clicks(df, "k", 1000, 0.3, 64)._jdf.queryExecution().executedPlan().toString()
    assert "part" in plan
    quiet = [i for i, v in enumerate(x["a"]) if abs(v) <= 0.01]
    starts = sorted(r.start for r in G.silences(df, "k", 1000, -40.0, 0.05, 64).collect() if r.k == "a")
    assert len(starts) == 5 and all(int(s * 1000) in quiet for s in starts)


def test_clean(spark):
    clicked = np.concatenate([np.zeros(800), tone(0.5), np.zeros(1200)])
    clicked[[1200, 1700, 2200]] = 0.95
    df = long(spark, plain=tone(0.5), clicked=clicked)
    out, report = A.clean(df, "k", RATE, size=256)
    rows, got = {r.k: r for r in report.collect()}, whole(out)
    assert (rows["plain"].clicks, rows["clicked"].clicks, rows["clicked"].original_duration) == (0, 3, 1.0)
    fixed = jump_by_jump(clicked, 0.15)
    bounds = G.trim_bounds(long(spark, clicked=fixed), "k", RATE, 10 ** (-35 / 20)).first()
    want = fixed[bounds.lead : bounds.trail].copy()
    f = int(RATE * 0.008)
    want[:f] *= np.linspace(0, 1, f)
    want[-f:] *= np.linspace(1, 0, f)
    assert np.allclose(got["clicked"], want) and rows["clicked"].trimmed_ms == round((len(clicked) - len(want)) / RATE * 1000, 1)
    same, dry = A.clean(df, "k", RATE, dry_run=True)
    assert same is df and all(r.cleaned_duration == r.original_duration for r in dry.collect())
    whole_report = report.select(F.concat("k", F.lit(".wav")).alias("file"), F.lit("a").alias("folder"), *report.columns[1:])
    import json

    text = json.loads(rollup.clean_report(whole_report, "folder").first().report)
    assert (text["total_files"], text["total_clicks_repaired"]) == (2, 3) and text["total_trimmed_ms"] == round(sum(x["trimmed_ms"] for x in text["results"]))


# preparing


def test_room():
    room = A.room_response(24_000)
    assert len(room) == 3600 and np.isclose(np.abs(room).max(), 1) and np.array_equal(room, A.room_response(24_000)) and not np.array_equal(room, A.room_response(24_000, seed=1))
    sample = A.counter_noise(20_000, 3)
    assert abs(sample.mean()) < 0.03 and abs(sample.std() - 1) < 0.03


@pytest.mark.parametrize("to", [4000, 8000, 3000, 11_025])
def test_resampled(spark, to):
    x = {"a": noise(700, 15), "one": np.array([0.3]), "two": np.array([0.0, 1.0])}
    got = whole(A.resampled(long(spark, **x), "k", RATE, to))
    for k in x:
        n = int(len(x[k]) * to / RATE)
        if n:
            assert np.allclose(got[k], np.interp(np.linspace(0, len(x[k]) - 1, n), np.arange(len(x[k])), x[k]), atol=1e-9), k


def test_prepared(spark):
    x = noise(900, 16)
    got = whole(A.prepared(long(spark, a=x), "k", RATE, RATE, -6.0, size=128))["a"]
    y = x * 0.1 / np.sqrt((x**2).mean()) * 10 ** (-6 / 20)
    y = 0.98 * y + 0.02 * np.convolve(y, A.room_response(RATE))[: len(y)]
    y[:80] *= np.linspace(0, 1, 80)
    y[-80:] *= np.linspace(1, 0, 80)
    assert np.allclose(got, y, atol=1e-12)


def test_prepare_folder(spark):
    rows = [("0.wav", [float(v) for v in tone(0.5)], RATE), ("8k.wav", [float(v) for v in tone(0.5, rate=8000)], 8000)]
    signals = spark.createDataFrame(rows, "file string, samples array<float>, sr int")
    manifest = spark.createDataFrame([("0.wav", "emma"), ("8k.wav", "lucas"), ("gone.wav", "lucas"), ("/abs.wav", "emma"), ("../up.wav", "x")], "file string, speaker string")
    volumes = spark.createDataFrame([("emma", -6.0)], "speaker string, db double")
    status, ready = pipelines.prepare_folder(manifest, signals, volumes, RATE)
    assert {r.file: r.status for r in status.collect()} == {"0.wav": "OK", "8k.wav": "OK", "gone.wav": "MISSING", "/abs.wav": "REJECTED", "../up.wav": "REJECTED"}
    got = whole(ready.withColumnRenamed("file", "k"))
    assert {k: len(v) for k, v in got.items()} == {"0.wav": RATE // 2, "8k.wav": RATE // 2}
    assert 0.04 < np.sqrt((got["0.wav"] ** 2).mean()) < 0.06 and 0.08 < np.sqrt((got["8k.wav"] ** 2).mean()) < 0.11 and got["0.wav"][0] == 0
    status, ready = pipelines.prepare_folder(manifest, signals, volumes, RATE, dry_run=True)
    assert {r.file: r.status for r in status.collect()}["0.wav"] == "DRY" and ready.count() == 0


# mixing


def test_crossfaded(spark):
    a, b = long(spark, x=np.ones(10), y=np.ones(3), z=np.ones(4)), long(spark, x=np.zeros(6), y=np.ones(2))
    got = whole(A.crossfaded(a, b, "k", 4))
    assert np.allclose(got["x"], [*[1] * 7, 2 / 3, 1 / 3, 0, 0, 0]) and len(got["y"]) == 3 and np.allclose(got["y"], [1, 1, 1]) and np.allclose(got["z"], 1)
    assert np.allclose(whole(A.crossfaded(a, b, "k", 0))["x"], [*[1] * 10, *[0] * 6])


def test_music_under_speech(spark):
    speech = {"a": np.r_[np.zeros(2000), tone(0.5, level=0.8)], "bare": tone(0.1)}
    music = {"a": np.full(500, 0.5)}
    got = whole(A.music_bed(long(spark, **speech), long(spark, **music), "k", RATE, 0.12, 0.1, 0.1, size=256))
    bed = got["a"] - speech["a"]
    assert np.allclose(got["bare"], speech["bare"]) and np.isclose(bed[200], 0.03) and np.isclose(bed[1500], 0.06) and bed[0] == 0
    level = C.follow(np.abs(speech["a"]), np.exp(-1000 / (RATE * 10)), np.exp(-1000 / (RATE * 800)))
    assert np.isclose(bed[3500], 0.06 * (level[3500] / 0.02) ** (1 / 8 - 1)) and abs(bed[-1]) < 1e-3


def test_sting_and_bleed(spark):
    one = lambda n: long(spark, k=np.ones(n))
    got = whole(A.sting(one(RATE), one(RATE), "k", RATE, 0.25, 1.0, 0.0))["k"]
    assert len(got) == RATE + RATE * 3 // 4 and got[0] == 1 and got[RATE - 1] == 2 and got[-1] == 1
    assert len(whole(A.sting(one(10), one(20), "k", RATE, 9.0))["k"]) == 20
    tail = whole(A.bed_with_bleed(long(spark, k=np.zeros(RATE)), one(100), "k", RATE, 0.12, 0.5, 0.5, 0.0, size=512))["k"]
    assert len(tail) == 2 * RATE and np.isclose(tail[0], 0.36) and np.isclose(tail[int(1.2 * RATE)], 0.36) and tail[-1] < 1e-3


def test_place_clips(spark):
    signal = long(spark, a=np.full(100, 0.5), b=np.full(10, 0.9))
    clips = spark.createDataFrame([("s/0", i, 1.0) for i in range(10)] + [("s/1", i, -1.0) for i in range(20)], "clip string, idx long, value double")
    places = spark.createDataFrame([("a", 0, "s/0"), ("a", 1, "s/0"), ("a", 90, "s/0"), ("a", 89, "s/0"), ("a", 50, "s/1"), ("a", -3, "s/1"), ("b", 1, "s/0")], "k string, pos long, clip string")
    out, counts = A.place_clips(signal, places, clips, "k")
    got, add = whole(out), 10 ** (-3 / 20)
    want = np.full(100, 0.5)
    want[1:11] += add
    want[89:99] += add
    want[50:70] -= add
    assert np.allclose(got["a"], np.clip(want, -1, 1)) and np.allclose(got["b"], 0.9)
    assert {r.k: r.placed for r in counts.collect()} == {"a": 3, "b": 0}


def test_stems_sum_to_the_mix(spark):
    from voxloom.operators import timeline as M

    lines = spark.createDataFrame([("e", 0, "x", 100), ("e", 1, "y", 70), ("e", 2, "y", None), ("e", 3, "x", 33)], "k string, index int, speaker string, n int")
    audio = spark.createDataFrame([("e", i, j, float(i + 1)) for i, n in ((0, 100), (1, 70), (3, 33)) for j in range(n)], "k string, index int, idx long, value double")
    timeline = M.stem_timeline(lines, "k", 100)
    rows = A.stems(timeline, audio, "k", 64)
    stems = {s: whole(rows.where(F.col("speaker") == s), 64)["e"] for s in ("x", "y")}
    placed = {r["index"]: r.pos for r in timeline.collect()}
    total = max(placed[3] + 33, placed[1] + 70)
    assert {len(v) for v in stems.values()} == {total}
    mix = np.zeros(total)
    for i, n in ((0, 100), (1, 70), (3, 33)):
        mix[placed[i] : placed[i] + n] += i + 1
    assert np.allclose(stems["x"] + stems["y"], mix) and not (stems["x"] * stems["y"]).any()


# mastering, voices


def test_master(spark):
    x = {"soft": tone(1, level=0.05), "loud": tone(1, level=0.9), "zero": np.zeros(RATE)}
    out, levels = A.master(chunks(spark, **x), "k", RATE, size=SIZE)
    rows, got = {r.k: r for r in levels.collect()}, whole(out)
    assert rows["zero"].input_lufs == rows["zero"].output_lufs == -70
    assert all(abs(rows[k].output_lufs + 16) < 0.3 for k in ("soft", "loud")) and np.abs(got["loud"]).max() <= 10 ** (-1 / 20) + 1e-9


def test_master_chain_is_the_plain_one(spark):
    x = np.r_[tone(0.3, 200, 0.5), noise(1000, 17, 0.003), tone(0.2, 700, 0.2)]
    got = whole(A.master_chain(chunks(spark, 128, a=x), "k", RATE, size=128), 128)["a"]
    f = np.sqrt(0.5)
    y = biquads(x, [C.high_pass(RATE, 80.0, f), C.shelf(RATE, 300.0, -2.0, f, high=False)])
    follow = lambda v, a, r: C.follow(np.abs(v), np.exp(-1000 / (RATE * a)), np.exp(-1000 / (RATE * r)))
    y = y * 10 ** (-np.maximum(20 * np.log10(np.maximum(follow(y, 5, 150), 1e-10)) + 18, 0) * (2 / 3) / 20)
    y = y * (20 * np.log10(np.maximum(follow(y, 1, 100), 1e-10)) > -40)
    assert np.allclose(got, np.clip(y, -(10 ** (-1 / 20)), 10 ** (-1 / 20)), atol=1e-10) and (got == 0).any()


def test_loudness_master(spark):
    out = C.settled(A.loudness_master(chunks(spark, 4096, a=tone(4, level=0.4)), "k", RATE, size=4096))
    assert abs(C.integrated(out, "k", RATE, 4096).first().lufs + 16) < 0.5 and 20 * np.log10(C.true_peaks(out, "k", 4096).first().true_peak) <= -1.4


def plain_pitch(x, rate):
    found, n = [], int(rate * 0.03)
    for s in range(0, len(x) - n, int(rate * 0.01)):
        f = x[s : s + n]
        if np.abs(f).max() < 0.01:
            continue
        f = f - f.mean()
        c = np.correlate(f, f, "full")[n - 1 :]
        c = c / c[0]
        part = c[int(rate / 500) : int(rate / 50)]
        if part.max() > 0.3:
            found.append(rate / (int(rate / 500) + part.argmax()))
    return round(float(np.median(found)), 1) if found else None


def plain_centroid(x, rate):
    found = []
    for s in range(0, len(x) - 2048, 512):
        f = x[s : s + 2048]
        if np.abs(f).max() >= 0.01:
            m = np.abs(np.fft.rfft(f * np.hanning(2048)))
            found.append((m * np.fft.rfftfreq(2048, 1 / rate)).sum() / m.sum())
    return round(float(np.mean(found)), 1) if found else None


def test_voices(spark):
    x = {"v110": tone(1.2, 110) + noise(4800, 18, 0.02), "v240": tone(1.2, 240), "zero": np.zeros(4000), "short": tone(0.02), "noise": noise(5000, 19), "gap": np.r_[tone(0.3, 180), np.zeros(3000), tone(0.4, 180)]}
    got = {r.k: r for r in C.voices(chunks(spark, 300, **x), "k", RATE, 300).collect()}
    for k in x:
        assert got[k].f0 == plain_pitch(x[k], RATE), k
        want = plain_centroid(x[k], RATE)
        assert got[k].centroid is None if want is None else abs(got[k].centroid - want) <= 0.11, k
        assert got[k].duration == round(len(x[k]) / RATE, 1)
    assert round(got["v240"].f0 / 10) == 24
    ordered = G.by_pitch(C.voices(chunks(spark, 300, **x), "k", RATE, 300).withColumnRenamed("k", "file")).collect()
    assert [r.file for r in ordered][:3] == ["noise", "short", "zero"] and ordered[3].f0 <= ordered[-1].f0


def test_empty_signals(spark):
    none = chunks(spark, a=np.zeros(3)).where("false")
    for df in (C.filtered(none, "k", C.k_weights(RATE)), C.followed(none, "k", RATE, 5, 50), C.integrated(none, "k", RATE), C.repaired(none, "k"), C.voices(none, "k", RATE), A.master(none, "k", RATE)[1], C.loudness_normalized(none, "k", RATE)):
        assert df.count() == 0
