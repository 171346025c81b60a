"""Queries of signals, cleaning, mixing and mastering, with their SQL: recursions and sums sample by sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chunked as C
from ..operators import graph as H
from ..operators import plan as Q
from ..operators import production as A
from ..operators import rollup as R
from ..operators import timeline as M
from . import bindings as B
from .timeline_queries import REALISM, _draw

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: Samples of a track at most, its rate, and the samples of a chunk in these queries: small, so that given tables have several.
TRACK, RATE, SIZE = 20_000, 3200, 1024


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _track(spark: SparkSession, d: str) -> DataFrame:
    """track, idx, value: all events in order, cut into signals of 20,000 samples."""
    return B.table(spark, d, "events").select(F.expr(f"event_id div {TRACK}").alias("track"), (F.col("event_id") % TRACK).alias("idx"), (F.col("value") / 500).alias("value"))


def _track_chunks(spark: SparkSession, d: str) -> DataFrame:
    return C.chunks_of(_track(spark, d), "track", SIZE)


TRACKS = f"track AS (SELECT event_id // {TRACK} AS track, event_id % {TRACK} AS idx, value / 500 AS value FROM events), size AS (SELECT track, count(*) AS n FROM track GROUP BY 1)"


def _e(x, k: int):
    """A value as a whole number of tenths, hundredths ..."""
    return F.floor(x * 10**k + 0.5).cast("long")


# -- loudness in SQL ----------------------------------------------------------------------------------------


def _sections_sql(source: str, sections: list, x: str, name: str) -> tuple[str, list[str]]:
    """``source`` with y = x through the sections, and the next states; states are columns {name}{k}a, {name}{k}b of it."""
    states = []
    for k, (b, a) in enumerate(sections):
        b0, b1, b2, a1, a2 = (repr(float(v / a[0])) for v in (*b, *a[1:]))
        s, y = f"{name}{k}", f"{name}y{k}"
        source = f"(SELECT *, {b0} * {x} + {s}a AS {y} FROM {source})"
        states += [f"{b1} * {x} - {a1} * {y} + {s}b AS {s}a", f"{b2} * {x} - {a2} * {y} AS {s}b"]
        x = y
    return source, [x, *states]


def _zeros(name: str, n: int) -> str:
    return ", ".join(f"0.0::DOUBLE AS {name}{k}{c}" for k in range(n) for c in "ab")


def _weighted_sql(name: str, table: str) -> str:
    """CTE ``name`` (track, idx, y): the K-weighted values of ``table`` (track, idx, value)."""
    sections = C.k_weights(RATE)
    step, (y, *states) = _sections_sql(f"(SELECT r.*, t.value AS x FROM {name} r JOIN {table} t ON t.track = r.track AND t.idx = r.idx + 1)", sections, "x", "k")
    return f"{name} AS (SELECT track, -1::BIGINT AS idx, 0.0::DOUBLE AS y, {_zeros('k', 2)} FROM size UNION ALL SELECT track, idx + 1, {y}, {', '.join(states)} FROM {step} q)"


def _lufs_sql(name: str, weighted: str) -> str:
    """CTEs that end in ``name`` (track, lufs) of a K-weighted table."""
    return f"""{name}e AS (SELECT track, (idx * 10 // {RATE})::BIGINT AS step, sum(y * y) AS e FROM {weighted} WHERE idx >= 0 GROUP BY 1, 2),
{name}b AS (SELECT track, block, sum(e) / {0.4 * RATE} AS z FROM (SELECT track, e, unnest(range(step - 3, step + 1)) AS block FROM {name}e) JOIN size USING (track)
  WHERE block >= 0 AND n >= {int(0.4 * RATE)} AND block < round_even((n / {RATE} - 0.4) / 0.1, 0) + 1 GROUP BY track, block),
{name}g AS (SELECT *, -0.691 + 10 * log10(z) AS l FROM {name}b WHERE z > 0 AND -0.691 + 10 * log10(z) >= -70),
{name}r AS (SELECT track, -10.691 + 10 * log10(avg(z)) AS gate FROM {name}g GROUP BY 1),
{name}m AS (SELECT track, -0.691 + 10 * log10(avg(z)) AS l FROM {name}g JOIN {name}r USING (track) WHERE l > gate AND l > -70 GROUP BY 1),
{name} AS (SELECT track, CASE WHEN n >= {int(0.4 * RATE)} THEN coalesce(l, -70) END AS lufs FROM size LEFT JOIN {name}m USING (track))"""


@query(f"WITH RECURSIVE {TRACKS}, {_weighted_sql('w', 'track')}, {_lufs_sql('m', 'w')} SELECT track, floor(lufs * 100 + 0.5)::BIGINT AS lufs_e2 FROM m")
def loudness(spark: SparkSession, d: str) -> DataFrame:
    """Gated loudness of the K-weighted signal."""
    return C.integrated(_track_chunks(spark, d), "track", RATE, SIZE).select("track", _e(F.col("lufs"), 2).alias("lufs_e2"))


@query(f"""WITH RECURSIVE {TRACKS}, {_weighted_sql('w', 'track')}, {_lufs_sql('m', 'w')},
s AS (SELECT track, block, -0.691 + 10 * log10(sum(e) / {3 * RATE}) AS l FROM (SELECT track, e, unnest(range(step - 29, step + 1)) AS block FROM me) JOIN size USING (track)
  WHERE block >= 0 AND n >= {3 * RATE} AND block < round_even((n / {RATE} - 3.0) / 0.1, 0) + 1 GROUP BY track, block),
g AS (SELECT track, -20.691 + 10 * log10(avg(pow(10, (l + 0.691) / 10))) AS gate FROM s WHERE l >= -70 GROUP BY 1),
p AS (SELECT track, quantile_cont(l, 0.95) - quantile_cont(l, 0.1) AS lra FROM s JOIN g USING (track) WHERE l >= gate AND l >= -70 GROUP BY 1)
SELECT track, floor(lra * 100 + 0.5)::BIGINT AS lra_e2 FROM p""")
def loudness_range(spark: SparkSession, d: str) -> DataFrame:
    """The loudness range of the first pass."""
    chunks = _track_chunks(spark, d)
    windows = C.short_terms(C.settled(C.step_energies(chunks, "track", RATE, SIZE)), C.lengths(chunks, "track"), "track", RATE)
    return C.loudness_range(windows, "track").select("track", _e(F.col("lra"), 2).alias("lra_e2"))


@query(f"WITH {TRACKS} SELECT track, n, n >= {int(0.4 * RATE)} AS measured, true AS loud_enough, true AS peak_held FROM size")
def loudness_norm(spark: SparkSession, d: str) -> DataFrame:
    """Whether each track came to the target (-30 here, so that few peaks are limited) within 0.5, and its true peaks stay under -1.5 dB."""
    out = C.settled(C.loudness_normalized(C.settled(_track_chunks(spark, d)), "track", RATE, target=-30.0, size=SIZE))
    measured = C.integrated(out, "track", RATE, SIZE).join(C.true_peaks(out, "track", SIZE), "track").join(C.lengths(out, "track"), "track")
    held = F.coalesce(F.abs(F.col("lufs") + 30) <= 0.5, F.lit(True))
    return measured.select("track", "n", F.col("lufs").isNotNull().alias("measured"), held.alias("loud_enough"), (20 * F.log10("true_peak") <= -1.4).alias("peak_held"))


def _chain_sql() -> str:
    """CTE ``c`` (track, idx, x, z): every value through high pass, shelf, compressor, gate and limit."""
    sections = [C.high_pass(RATE, A.HIGH_PASS_HZ, 0.5**0.5), C.shelf(RATE, *A.LOW_SHELF, 0.5**0.5, high=False)]
    step, (y, *states) = _sections_sql("(SELECT c.*, t.value AS v FROM c JOIN track t ON t.track = c.track AND t.idx = c.idx + 1)", sections, "v", "f")
    up = lambda ms: repr(float(2.718281828459045 ** (-1000 / (RATE * ms))))
    (cdb, ratio, ca, cr), (gdb, ga, gr) = A.COMPRESSOR, A.GATE
    follow = lambda x, old, a, r: f"abs({x}) + CASE WHEN abs({x}) > {old} THEN {up(a)} ELSE {up(r)} END * ({old} - abs({x}))"
    step = f"(SELECT *, {follow(y, 'c1', ca, cr)} AS n1 FROM {step})"
    step = f"(SELECT *, {y} * pow(10.0, -greatest(20 * log10(greatest(n1, 1e-10)) - {cdb}, 0) * {1 - 1 / ratio} / 20) AS p FROM {step})"
    step = f"(SELECT *, {follow('p', 'c2', ga, gr)} AS n2 FROM {step})"
    top = repr(10 ** (A.LIMIT_DB / 20))
    out = f"greatest(-{top}, least({top}, CASE WHEN 20 * log10(greatest(n2, 1e-10)) > {gdb} THEN p ELSE 0 END))"
    return f"c AS (SELECT track, -1::BIGINT AS idx, 0.0::DOUBLE AS value, 0.0::DOUBLE AS c1, 0.0::DOUBLE AS c2, {_zeros('f', 2)} FROM size UNION ALL SELECT track, idx + 1, {out}, n1, n2, {', '.join(states)} FROM {step} q)"


@query(f"""WITH RECURSIVE {TRACKS}, {_chain_sql()}, {_weighted_sql('w', 'track')}, {_lufs_sql('a', 'w')}, {_weighted_sql('x', 'c')}, {_lufs_sql('b', 'x')},
o AS (SELECT track, idx, CASE WHEN lufs IS NULL OR lufs <= -70 THEN value ELSE greatest(-{10 ** (-1 / 20)!r}, least({10 ** (-1 / 20)!r}, value * pow(10.0, (-16 - lufs) / 20))) END AS value FROM c JOIN b USING (track) WHERE idx >= 0),
{_weighted_sql('y', 'o')}, {_lufs_sql('d', 'y')}
SELECT track, floor(a.lufs * 10 + 0.5)::BIGINT AS input_e1, floor(d.lufs * 10 + 0.5)::BIGINT AS output_e1 FROM a JOIN d USING (track)""")
def master_signals(spark: SparkSession, d: str) -> DataFrame:
    """The chain's recursions and followers over chunks, at the target by the meter."""
    _, levels = A.master(C.settled(_track_chunks(spark, d)), "track", RATE, size=SIZE)
    return levels.select("track", _e(F.col("input_lufs"), 1).alias("input_e1"), _e(F.col("output_lufs"), 1).alias("output_e1"))


# -- voices -------------------------------------------------------------------------------------------------


@query(f"""WITH {TRACKS}, starts AS (SELECT track, unnest(range(0, n - 96, 32)) AS s FROM size), fr AS (SELECT track, s, idx - s AS i, value FROM starts JOIN track USING (track) WHERE idx >= s AND idx < s + 96),
loud AS (SELECT track, s, avg(value) AS m FROM fr GROUP BY ALL HAVING max(abs(value)) >= 0.01), z AS (SELECT track, s, i, value - m AS v FROM fr JOIN loud USING (track, s)),
co AS (SELECT a.track, a.s, k, sum(a.v * b.v) AS c FROM z a, range(0, 64) t(k), z b WHERE b.track = a.track AND b.s = a.s AND b.i = a.i + k AND (k = 0 OR k >= 6) GROUP BY ALL),
n0 AS (SELECT track, s, c AS e FROM co WHERE k = 0), best AS (SELECT track, s, arg_max(k, c) AS k, max(c) AS c FROM co WHERE k >= 6 GROUP BY ALL),
f0 AS (SELECT track, median({RATE} / k) AS f0 FROM best JOIN n0 USING (track, s) WHERE c / CASE WHEN e > 0 THEN e ELSE 1 END > 0.3 GROUP BY track),
st2 AS (SELECT track, unnest(range(0, n - 2048, 512)) AS s FROM size), fr2 AS MATERIALIZED (SELECT track, s, idx - s AS i, value, value * (0.5 - 0.5 * cos(2 * pi() * (idx - s) / 2047)) AS v FROM st2 JOIN track USING (track) WHERE idx >= s AND idx < s + 2048),
ok AS (SELECT track, s FROM fr2 GROUP BY ALL HAVING max(abs(value)) >= 0.01),
ft AS (SELECT track, s, k, sqrt(pow(sum(v * cos(2 * pi() * (k * i % 2048) / 2048)), 2) + pow(sum(v * sin(2 * pi() * (k * i % 2048) / 2048)), 2)) AS m FROM fr2 JOIN ok USING (track, s), range(0, 1025) t(k) GROUP BY ALL),
ce AS (SELECT track, avg(c) AS c FROM (SELECT track, s, sum(m * k * {RATE} / 2048) / sum(m) AS c FROM ft GROUP BY ALL HAVING sum(m) > 0) GROUP BY track)
SELECT track, floor(round_even(n / {RATE}, 1) * 10 + 0.5)::BIGINT AS duration_e1, floor(f0 + 0.5)::BIGINT AS f0, floor(c + 0.5)::BIGINT AS centroid FROM size LEFT JOIN f0 USING (track) LEFT JOIN ce USING (track)""")
def voice_analysis(spark: SparkSession, d: str) -> DataFrame:
    """Frames of the tracks as rows, a frame over a chunk's border too."""
    rows = C.voices(_track_chunks(spark, d), "track", RATE, SIZE, decimals=None)
    return rows.select("track", _e(F.bround("duration", 1), 1).alias("duration_e1"), _e(F.col("f0"), 0).alias("f0"), _e(F.col("centroid"), 0).alias("centroid"))


# -- cleaning and preparing ---------------------------------------------------------------------------------

#: Every jump's line, in order: its left end is the given sample, or lies on the line before; the last line over a sample counts.
REPAIRED = f"""{B.SIGNAL}, sz AS (SELECT user_id, count(*) AS n FROM signal GROUP BY 1),
v AS (SELECT user_id, idx, value, lead(value) OVER (PARTITION BY user_id ORDER BY idx) AS after FROM signal),
h AS (SELECT user_id, idx, row_number() OVER (PARTITION BY user_id ORDER BY idx) AS k, greatest(0, idx - 3) AS a, least(n - 1, idx + 3) AS b FROM v JOIN sz USING (user_id) WHERE abs(after - value) > 0.3),
hv AS (SELECT h.*, x.value AS xa, y.value AS xb FROM h JOIN signal x ON x.user_id = h.user_id AND x.idx = h.a JOIN signal y ON y.user_id = h.user_id AND y.idx = h.b),
f AS (SELECT user_id, k, a, b, xa AS l, xb AS r FROM hv WHERE k = 1
  UNION ALL SELECT g.user_id, g.k, g.a, g.b, CASE WHEN g.a > f.a AND g.a < f.b THEN f.l + (g.a - f.a) / (f.b - f.a) * (f.r - f.l) ELSE g.xa END, g.xb FROM f JOIN hv g ON g.user_id = f.user_id AND g.k = f.k + 1),
own AS (SELECT user_id, idx, max(k) AS k FROM (SELECT user_id, k, unnest(range(a + 1, b)) AS idx FROM f) GROUP BY ALL),
repaired AS (SELECT s.user_id, s.idx, CASE WHEN own.k IS NULL THEN s.value ELSE f.l + (s.idx - f.a) / (f.b - f.a) * (f.r - f.l) END AS value
  FROM signal s LEFT JOIN own ON own.user_id = s.user_id AND own.idx = s.idx LEFT JOIN f ON f.user_id = own.user_id AND f.k = own.k)"""


@query(f"WITH RECURSIVE {REPAIRED} SELECT user_id, idx::BIGINT AS idx, floor(value * 10000 + 0.31003)::BIGINT AS value_e4 FROM repaired")
def repair_clicks(spark: SparkSession, d: str) -> DataFrame:
    """W19, jump after jump; the odd summand keeps straight lines between given values away from a rounding's edge."""
    rows = C.long_of(C.repaired(C.chunks_of(B.signal(spark, d), "user_id", 16), "user_id", 0.3, 16), "user_id", 16)
    return rows.select("user_id", F.col("idx").cast("long").alias("idx"), F.floor(F.col("value") * 10_000 + 0.31003).alias("value_e4"))


@query(f"""WITH RECURSIVE {REPAIRED},
j AS (SELECT user_id, idx, CASE WHEN idx - lag(idx) OVER (PARTITION BY user_id ORDER BY idx) < 5 THEN 0 ELSE 1 END AS first FROM v WHERE abs(after - value) > 0.3),
c AS (SELECT user_id, sum(first) AS clicks FROM j GROUP BY 1),
m AS (SELECT user_id, min(f) FILTER (f < n - 10) AS f, max(z) FILTER (z > 0) AS z FROM (
  SELECT user_id, n, (idx // 10) * 10 AS f, n - 10 - ((n - 1 - idx) // 10) * 10 AS z FROM repaired JOIN sz USING (user_id) WHERE abs(value) > pow(10.0, -1.75)) GROUP BY user_id),
t AS (SELECT user_id, n, coalesce(greatest(0, f - 5), 0) AS lead, coalesce(least(n, z + 30), n) AS trail FROM sz LEFT JOIN m USING (user_id)),
w AS (SELECT user_id, t.n, clicks, trail - lead AS kept, idx - lead AS i, value FROM t JOIN repaired USING (user_id) LEFT JOIN c USING (user_id) WHERE idx >= lead AND idx < trail)
SELECT user_id, coalesce(max(clicks), 0)::INT AS clicks, max(n) / 1000.0::DOUBLE AS original_duration, max(kept) / 1000.0::DOUBLE AS cleaned_duration, (max(n) - max(kept))::DOUBLE AS trimmed_ms,
       floor(sum(value * CASE WHEN kept > 16 THEN CASE WHEN i < 8 THEN i / 7 WHEN i >= kept - 8 THEN (kept - 1 - i) / 7 ELSE 1 END ELSE 1 END * (i + 1)) * 1000 + 0.31003)::BIGINT AS samples_e3
FROM w GROUP BY user_id""")
def clean_signals(spark: SparkSession, d: str) -> DataFrame:
    """The report of each signal, and a sum of its cleaned samples weighted by place."""
    cleaned, report = A.clean(B.signal(spark, d), "user_id", 1000, 0.3, size=16)
    sums = cleaned.groupBy("user_id").agg(F.floor(F.sum(F.col("value") * (F.col("idx") + 1)) * 1000 + 0.31003).alias("samples_e3"))
    return report.join(sums, "user_id")


TAPS = ", ".join(f"({k}, {v!r}::DOUBLE)" for k, v in enumerate(A.room_response(2000).tolist()))


@query(f"""WITH {B.SIGNAL}, sz AS (SELECT user_id, count(*) AS n FROM signal GROUP BY 1), taps(k, g) AS (VALUES {TAPS}),
p AS (SELECT user_id, n, j, j * (n - 1) / (2 * n - 1) AS t FROM (SELECT user_id, n, unnest(range(0, 2 * n)) AS j FROM sz)),
u AS (SELECT p.user_id, p.n, j, a.value + (t - floor(t)) * (coalesce(b.value, a.value) - a.value) AS x FROM p JOIN signal a ON a.user_id = p.user_id AND a.idx = floor(t) LEFT JOIN signal b ON b.user_id = p.user_id AND b.idx = floor(t) + 1),
l AS (SELECT user_id, sqrt(avg(x * x)) AS rms FROM u GROUP BY 1),
s AS (SELECT user_id, n, j, CASE WHEN rms > 0 THEN x * (0.1 / rms) ELSE x END * pow(10.0, (user_id % 7 - 3) / 20) AS x FROM u JOIN l USING (user_id)),
w AS (SELECT a.user_id, a.j, sum(b.x * g) AS wet FROM s a JOIN taps ON k <= a.j JOIN s b ON b.user_id = a.user_id AND b.j = a.j - k GROUP BY ALL),
y AS (SELECT s.user_id, 2 * n AS m, s.j, 0.98 * x + 0.02 * wet AS y FROM s JOIN w ON w.user_id = s.user_id AND w.j = s.j)
SELECT user_id, j AS idx, floor(y * CASE WHEN m > 80 THEN CASE WHEN j < 40 THEN j / 39 WHEN j >= m - 40 THEN (m - 1 - j) / 39 ELSE 1 END ELSE 1 END * 100000 + 0.31003)::BIGINT AS value_e5 FROM y""")
def prepared_lines(spark: SparkSession, d: str) -> DataFrame:
    """D3 to D5, SC7's resampling, D1, D2, W22: sample by sample against a convolution in SQL."""
    rows = A.prepared(B.signal(spark, d), "user_id", 1000, 2000, (F.col("user_id") % 7 - 3).cast("double"), size=64)
    return rows.select("user_id", F.col("idx").cast("long").alias("idx"), F.floor(F.col("value") * 100_000 + 0.31003).alias("value_e5"))


@query(f"""WITH {B.SIGNAL}, j AS (SELECT user_id, idx, abs(lead(value) OVER (PARTITION BY user_id ORDER BY idx) - value) AS jump FROM signal),
h AS (SELECT user_id, CASE WHEN idx - lag(idx) OVER (PARTITION BY user_id ORDER BY idx) < 5 THEN 0 ELSE 1 END AS first FROM j WHERE jump > 0.3)
SELECT count(DISTINCT user_id) AS files, (SELECT sum(first) FROM h)::BIGINT AS clicks, 0.0::DOUBLE AS trimmed_ms FROM signal""")
def clean_totals(spark: SparkSession, d: str) -> DataFrame:
    """A5: the totals of a run that repairs and cuts nothing."""
    return R.clean_totals(A.clean(B.signal(spark, d), "user_id", 1000, 0.3, trim=False, size=16)[1])


# -- mixing -------------------------------------------------------------------------------------------------


def _music(spark: SparkSession, d: str) -> DataFrame:
    """For each user a short piece: every third sample of the user's signal."""
    return B.signal(spark, d).where("idx % 3 = 0").select("user_id", F.expr("idx div 3").alias("idx"), F.col("value"))


MUSIC = f"{B.SIGNAL}, sz AS (SELECT user_id, count(*) AS n FROM signal GROUP BY 1), music AS (SELECT user_id, idx // 3 AS idx, value FROM signal WHERE idx % 3 = 0), mz AS (SELECT user_id, count(*) AS m FROM music GROUP BY 1)"


def _permille(rows: DataFrame, key: str = "user_id") -> DataFrame:
    return rows.select(key, F.col("idx").cast("long").alias("idx"), F.floor(F.col("value") * 10_000 + 0.31003).alias("value_e4"))


@query(f"""WITH {MUSIC}, c AS (SELECT user_id, n, m, least(12, n, m) AS d FROM sz JOIN mz USING (user_id)),
p AS (SELECT user_id, s.idx, value * CASE WHEN s.idx >= n - d THEN 1 - CASE WHEN d > 1 THEN (s.idx - n + d) / (d - 1) ELSE 0 END ELSE 1 END AS value FROM signal s JOIN c USING (user_id)
  UNION ALL SELECT user_id, n - d + s.idx, value * CASE WHEN s.idx < d THEN CASE WHEN d > 1 THEN s.idx / (d - 1) ELSE 0 END ELSE 1 END FROM music s JOIN c USING (user_id))
SELECT user_id, idx::BIGINT AS idx, floor(sum(value) * 10000 + 0.31003)::BIGINT AS value_e4 FROM p GROUP BY user_id, idx""")
def crossfade(spark: SparkSession, d: str) -> DataFrame:
    """Each user's signal, then its piece, over twelve samples."""
    return _permille(A.crossfaded(B.signal(spark, d), _music(spark, d), "user_id", 12))


def _follow_sql(source: str) -> str:
    """CTE ``lv`` (user_id, idx, level) of the magnitudes of ``source``."""
    up, down = (repr(float(2.718281828459045 ** (-1000 / (1000 * ms)))) for ms in (A.DUCK_ATTACK_MS, A.DUCK_RELEASE_MS))
    return f"""lv AS (SELECT user_id, -1::BIGINT AS idx, 0.0::DOUBLE AS level FROM sz
  UNION ALL SELECT lv.user_id, s.idx, abs(s.value) + CASE WHEN abs(s.value) > level THEN {up} ELSE {down} END * (level - abs(s.value)) FROM lv JOIN {source} s ON s.user_id = lv.user_id AND s.idx = lv.idx + 1)"""


DUCK = f"pow(greatest(level, {A.DUCK_LEVEL}) / {A.DUCK_LEVEL}, {1 / A.DUCK_RATIO - 1!r})"


@query(f"""WITH RECURSIVE {MUSIC}, {_follow_sql('signal')},
bed AS (SELECT user_id, s.idx, s.value AS speech, mu.value * least(1.0, s.idx / 10) * greatest(0.0, least(1.0, (greatest(0, n - 20) + 20 - s.idx) / 20)) * 0.5 AS bed FROM signal s JOIN sz USING (user_id) JOIN mz USING (user_id) JOIN music mu ON mu.user_id = s.user_id AND mu.idx = s.idx % m)
SELECT bed.user_id, bed.idx::BIGINT AS idx, floor(greatest(-1.0, least(1.0, speech + bed * {DUCK})) * 10000 + 0.31003)::BIGINT AS value_e4 FROM bed JOIN lv ON lv.user_id = bed.user_id AND lv.idx = bed.idx""")
def music_bed(spark: SparkSession, d: str) -> DataFrame:
    """The piece looped under the signal, lowered by a follower of it."""
    return _permille(A.music_bed(B.signal(spark, d), _music(spark, d), "user_id", 1000, 0.5, 0.01, 0.02, size=32))


@query(f"""WITH {MUSIC}, p AS (SELECT user_id, idx, value FROM signal UNION ALL SELECT user_id, greatest(0, n - 30) + s.idx, value * least(1.0, s.idx / 8) * 0.35 FROM music s JOIN sz USING (user_id))
SELECT user_id, idx::BIGINT AS idx, floor(sum(value) * 10000 + 0.31003)::BIGINT AS value_e4 FROM p GROUP BY user_id, idx""")
def sting(spark: SparkSession, d: str) -> DataFrame:
    """The piece rises over the last thirty samples."""
    return _permille(A.sting(B.signal(spark, d), _music(spark, d), "user_id", 1000, 0.03, rise=0.008))


@query(f"""WITH RECURSIVE {MUSIC}, padded AS (SELECT user_id, idx, value FROM signal UNION ALL SELECT user_id, unnest(range(n, n + 28)), 0 FROM sz), {_follow_sql('padded')},
bed AS (SELECT user_id, s.idx, s.value AS speech, mu.value * least(1.0, s.idx / 10) * greatest(0.0, least(1.0, (n + 12 + 16 - s.idx) / 16)) * 0.3 AS bed FROM padded s JOIN sz USING (user_id) JOIN mz USING (user_id) JOIN music mu ON mu.user_id = s.user_id AND mu.idx = s.idx % m)
SELECT bed.user_id, bed.idx::BIGINT AS idx, floor(greatest(-1.0, least(1.0, speech + bed * {DUCK})) * 10000 + 0.31003)::BIGINT AS value_e4 FROM bed JOIN lv ON lv.user_id = bed.user_id AND lv.idx = bed.idx""")
def bed_with_bleed(spark: SparkSession, d: str) -> DataFrame:
    """The piece under the signal, then alone, then falling."""
    return _permille(A.bed_with_bleed(B.signal(spark, d), _music(spark, d), "user_id", 1000, 0.1, 0.012, 0.016, 0.01, size=32))


@query(f"""WITH {B.SIGNAL}, sz AS (SELECT user_id, count(*) AS n FROM signal GROUP BY 1),
clips AS (SELECT n_regionkey AS clip, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS i, (n_nationkey - 12) / 20 AS value FROM nation),
cz AS (SELECT clip, count(*) AS len FROM clips GROUP BY 1),
pl AS (SELECT user_id, idx - 5 AS pos, (user_id + idx) % 5 AS clip FROM signal WHERE idx % 8 = 3),
ok AS (SELECT user_id, pos, clip FROM pl JOIN cz USING (clip) JOIN sz USING (user_id) WHERE pos > 0 AND pos + len < n),
c AS (SELECT user_id, count(*) AS placed FROM ok GROUP BY 1),
p AS (SELECT user_id, idx, value FROM signal UNION ALL SELECT user_id, pos + i, value * pow(10.0, -3 / 20) FROM ok JOIN clips USING (clip))
SELECT user_id, idx::BIGINT AS idx, floor(greatest(-1.0, least(1.0, sum(value))) * 10000 + 0.31003)::BIGINT AS value_e4, any_value(coalesce(placed, 0)) AS placed FROM p LEFT JOIN c USING (user_id) GROUP BY user_id, idx""")
def place_clips(spark: SparkSession, d: str) -> DataFrame:
    """Clips over the signals where they fit, and how many do."""
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")) - 1
    clips = B.table(spark, d, "nation").select(F.col("n_regionkey").alias("clip"), nth.alias("idx"), ((F.col("n_nationkey") - 12) / 20).alias("value"))
    signal = B.signal(spark, d)
    places = signal.where("idx % 8 = 3").select("user_id", (F.col("idx") - 5).alias("pos"), ((F.col("user_id") + F.col("idx")) % 5).alias("clip"))
    mixed, counts = A.place_clips(signal, places, clips, "user_id")
    return mixed.join(counts, "user_id").select("user_id", F.col("idx").cast("long").alias("idx"), F.floor(F.col("value") * 10_000 + 0.31003).alias("value_e4"), "placed")


@query(f"""WITH {B.LINES}, k AS (SELECT conv_id, idx, speaker, text, length(text) AS n, lag(speaker) OVER (PARTITION BY conv_id ORDER BY idx) AS p FROM lines WHERE length(text) > 0),
t AS (SELECT conv_id, idx, speaker, text, n, sum(CASE WHEN p IS NULL THEN 0 WHEN p <> speaker THEN 15 ELSE 8 END) OVER w + coalesce(sum(n) OVER (PARTITION BY conv_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM k WINDOW w AS (PARTITION BY conv_id ORDER BY idx)),
tot AS (SELECT conv_id, max(pos + n) AS total FROM t GROUP BY 1),
a AS (SELECT conv_id, speaker, pos + generate_subscripts(x, 1) - 1 AS spot, unnest(x) AS v FROM (SELECT *, list_transform(range(1, n + 1), lambda i: unicode(substr(text, i, 1)) % 97) AS x FROM t)),
g AS (SELECT conv_id, speaker, total, unnest(range(0, ((total - 1) // 256 + 1)::BIGINT)) AS chunk FROM (SELECT DISTINCT conv_id, speaker FROM t) JOIN tot USING (conv_id)),
s AS (SELECT conv_id, speaker, spot // 256 AS chunk, sum(v * (spot % 256 + 1))::BIGINT AS s FROM a GROUP BY ALL)
SELECT conv_id, speaker, chunk::BIGINT AS chunk, least(256, total - chunk * 256)::INT AS n, coalesce(s, 0)::BIGINT AS weighted FROM g LEFT JOIN s USING (conv_id, speaker, chunk)""")
def stems(spark: SparkSession, d: str) -> DataFrame:
    """A stem for each speaker; a line's samples are its characters.  Each chunk's length, and its sum weighted by place."""
    lines = B.lines(spark, d).where(F.length("text") > 0)
    timeline = M.stem_timeline(lines.select("conv_id", "index", "speaker", F.length("text").alias("n")), "conv_id", 100)
    letters = F.transform(F.sequence(F.lit(1), F.length("text")), lambda i: F.ascii(F.substring("text", i, F.lit(1))) % 97)
    audio = lines.select("conv_id", "index", F.posexplode(letters).alias("idx", "value")).withColumn("value", F.col("value").cast("double"))
    rows = A.stems(timeline, audio, "conv_id", 256)
    weighted = F.aggregate(F.transform("samples", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return rows.select("conv_id", "speaker", "chunk", F.size("samples").alias("n"), weighted.cast("long").alias("weighted"))


# -- the graph of an episode --------------------------------------------------------------------------------


def _ms6(x: str) -> str:
    return f"printf('%.6f', ({x}) / 1000)"


def _breath_sql() -> str:
    def one(low: int, high: int, short: int, long: int, soft: int, loud: int) -> str:
        part = lambda tenths: f"printf('%.3f', ((({short} + {ms} % {long - short + 1}) * {tenths} + 5) // 10) / 1000)"
        noise = f"'anoisesrc=color=pink:sample_rate=24000:amplitude=' || printf('%.6f', ({soft} + {level} % {loud - soft + 1}) / 1000000) || ':duration=' || {part(10)} || '[bnoise_breath' || turn || '];"
        band = f"[bnoise_breath' || turn || ']bandpass=frequency={(low + high) // 2}:width_type=h:width={high - low}"
        return f"{noise}{band},afade=t=in:d=' || {part(3)} || ',afade=t=out:st=' || {part(6)} || ':d=' || {part(4)} || '[breath' || turn || ']'"

    ms, level = (B.bits_sql("'42'", "conv_id::VARCHAR", "turn::VARCHAR", f"'{what}'") for what in ("breath_ms", "breath_level"))
    return "CASE breath " + " ".join(f"WHEN '{kind}' THEN {one(*x)}" for kind, x in H.BREATHS.items()) + " END"


@query(f"""WITH {REALISM}, src AS (SELECT *, coalesce(sum(duration_ms + gap_ms) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS from_ms, lead(start_ms) OVER (PARTITION BY conv_id ORDER BY turn) AS following,
  CASE WHEN nxt IS NULL THEN 0 WHEN action = 'overlap' THEN greatest(50, gap_ms - overlap_ms) WHEN jitter_ms <> 0 THEN greatest(50, gap_ms + jitter_ms) WHEN gap_ms > 10 THEN gap_ms ELSE 0 END AS pad,
  CASE reaction WHEN 'agreement' THEN list_extract(['mmhm', 'right', 'yeah'], w::INT + 1) WHEN 'surprise' THEN list_extract(['oh', 'huh', 'wow'], w::INT + 1) WHEN 'tracking' THEN list_extract(['right', 'mmhm', 'okay'], w::INT + 1) END || '.wav' AS filler FROM placed),
body AS (SELECT conv_id, string_agg('[inmono]atrim=' || {_ms6('from_ms')} || ':' || {_ms6('from_ms + duration_ms')} || ',asetpts=N/SR/TB[s' || turn || ']' || CASE WHEN pad > 0 THEN ';anullsrc=r=24000:cl=mono[null_pad' || turn || '];[null_pad' || turn || ']atrim=duration=' || {_ms6('pad')} || '[pad' || turn || ']' ELSE '' END, ';' ORDER BY turn) AS nodes,
  string_agg('[s' || turn || ']' || CASE WHEN pad > 0 THEN '[pad' || turn || ']' ELSE '' END, '' ORDER BY turn) AS labels, sum(CASE WHEN pad > 0 THEN 2 ELSE 1 END) AS n, string_agg({_breath_sql()}, ';' ORDER BY turn) AS breaths, sum(duration_ms + pad) AS total FROM src GROUP BY conv_id),
fx AS (SELECT conv_id, 0 AS kind, turn, start_ms + (duration_ms * (300 + {_draw("filler_at")} % 401)) // 1000 AS at_ms, filler FROM src WHERE reaction IS NOT NULL AND filler IS NOT NULL
  UNION ALL SELECT conv_id, 1, turn, greatest(0, coalesce(following - 500, start_ms + duration_ms)), NULL FROM src WHERE breath IS NOT NULL),
fy AS (SELECT *, row_number() OVER o AS k, CASE kind WHEN 0 THEN 'fmix' ELSE 'bmix' END || turn AS mix, coalesce(lag(CASE kind WHEN 0 THEN 'fmix' ELSE 'bmix' END || turn) OVER o, 'joined') AS src FROM fx WINDOW o AS (PARTITION BY conv_id ORDER BY kind, turn)),
fz AS (SELECT conv_id, string_agg(CASE kind WHEN 0 THEN '[' || k || ':a]aformat=channel_layouts=mono,volume=0.3,adelay=' || at_ms || '|' || at_ms || '[filler' || turn || '];[' || src || '][filler' || turn || ']' ELSE '[breath' || turn || ']adelay=' || at_ms || '|' || at_ms || '[bd' || turn || '];[' || src || '][bd' || turn || ']' END || 'amix=inputs=2:duration=first[' || mix || ']', ';' ORDER BY k) AS effects,
  arg_max(mix, k) AS mix, count(filler) AS n_inputs FROM fy GROUP BY conv_id)
SELECT conv_id, concat_ws(';', '[0:a]aformat=channel_layouts=mono[inmono]', nodes, labels || 'concat=n=' || n || ':v=0:a=1[joined]', breaths, effects, 'anoisesrc=color=pink:sample_rate=24000:amplitude=0.002:duration=' || {_ms6('total')} || '[roomnoise];[' || coalesce(mix, 'joined') || '][roomnoise]amix=inputs=2:weights=1|0.12:duration=first[roomed]') AS graph,
  'roomed' AS out_label, coalesce(n_inputs, 0)::INT AS n_inputs FROM body LEFT JOIN fz USING (conv_id)""")
def realism_graph(spark: SparkSession, d: str) -> DataFrame:
    """The filter graph of every conversation."""
    planned = M.planned_timeline(Q.realism_plan(B.turns(spark, d), "conv_id"), "conv_id")
    source = M.before(F.col("duration_ms") + F.col("gap_ms"), ["conv_id"], ["turn"])
    planned = planned.withColumn("from_ms", source).withColumn("filler", F.concat("word", F.lit(".wav")))
    rows = H.filter_graph(planned, Q.effect_places(planned, "conv_id"), "conv_id", 24_000)
    return rows.select("conv_id", "graph", "out_label", F.size("inputs").alias("n_inputs"))
