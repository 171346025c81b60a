r"""N-gram Jaccard join by set-relation skipping, and the groups of linked documents.

A document's set holds the 64-bit hashes of its distinct ``width``-word shingles.  Equal sets are one *class* from
the first step on.  The join is exact on the hashes:

1. *Relations.*  Sets that share a pair of min-hashes are compared with a few leaders of their key; those within the
   threshold of a leader make a *cluster* with it, and their distance to it stays.  (Only a short cut: sets that
   are missed here, also because a frequent key is dealt to several tasks, meet in the next step.)
2. *Index.*  Tokens are ordered rare first by a count sketch over the whole table; the first
   ``n - ceil(t n) + 1`` tokens of a set are its postings.  They meet by token once; those that no other set has end
   there.  The others fold, those of one cluster into one entry of the token's list, map-side first: however large a
   group of near copies is, it is one entry.  Lists are ordered by size in blocks that keep the largest size and the most
   tokens after a position; blocks and entries that can't reach the needed overlap are skipped by position.  A list of
   very many entries is cut by size into classes, of which only neighbours can link, and a class of very many into parts; only
   parts whose sizes can link meet, each pair of them in one task.
3. *Answers.*  For each pair of clusters from the lists, the leaders' overlap is computed (for two
   single sets only if their token histograms, which bound it, leave room).  If they link, the clusters
   do.  If not, the answers of the members derive from it, in rounds: a pair of clusters that links or edges have
   connected by then is answered, as only connection is asked, and leaves.  Jaccard distance is a metric, so clusters whose
   radii do not close the gap are done.  Of the others, each member is told once from the larger cluster's leader R: its
   overlap with it and its differences from it.  Two members' overlap is the sum of their overlaps with R, less the size
   of R, plus the differences they share, so a link needs a number of shared differences that splits into a term for each
   set; a prefix filter on differences, rare ones first, finds the few pairs that can have it.

Everything is a table keyed by a 128-bit digest of a row that stands for its class.  Sets are made anew from the
texts of such rows where two of them meet, as a text is smaller than its hashes.  The driver holds the sketch and a filter of
the rows asked for, both of a bounded size: a fuller filter lets more texts travel, at most all of them once a round,
and changes no answer.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import bloom
from .common import Scratch, batched, rows_of, small_batches, text_of
from .components import components

WIDTH, PERCENT = 5, 75
#: Cells of the count sketch and of its blocks.
CELLS, CELL_BLOCK = 1 << 21, 1 << 16
#: Leaders kept for each key, and sets of a key in one task.
LEADERS, KEY_SETS = 8, 300
#: Entries of a part of a list (two parts meet in a task) and of a block; tokens of the sets that a task keeps.
LIST_ENTRIES, LIST_BLOCK, CACHE_TOKENS = 1024, 64, 2_000_000
#: Buckets of the histogram that bounds overlaps from above.
BUCKETS = 256
#: Bytes of text hashed at once, unless one text is longer.
CHUNK = 1 << 18
_U = np.uint64
_SALTS = tuple(_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse
_LETTER = np.random.default_rng(20_240_501).integers(0, 1 << 64, 256, np.uint64)
_LETTER[65:91] = _LETTER[97:123]  # A-Z are a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse up to ``n`` - 1."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK)
        for k, x in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, x, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _sets_of(data: np.ndarray, ends: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; ``data``: the UTF-8 of all, ``ends``: where each ends.

    A word's hash comes from running sums of letter values times powers of a base, so a whole batch takes a fixed
    number of array operations and no loop over words.
    """
    none = np.zeros(0, np.uint64)
    if not len(data):
        yield from (none for _ in ends)
        return
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    edge[0] = True
    before = np.r_[False, word[:-1]] & ~edge[:-1]
    after = np.r_[word[1:], False] & ~edge[1:]
    starts, stops = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    up, down = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTER[data] * up[: len(data)], out=sums[1:])
    w = _mixed((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))
    last = np.searchsorted(starts, ends)
    first = np.r_[0, last[:-1]]
    n = len(w) - width + 1
    h = none
    if n > 0:
        h = w[:n].copy()
        for k in range(1, width):
            h *= _U(0x100000001B3)
            h += w[k : k + n]
        h = _mixed(h)
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= width:
            t = np.sort(h[a : b - width + 1])
            keep = np.empty(len(t), bool)
            keep[0] = True
            np.not_equal(t[1:], t[:-1], out=keep[1:])
            yield t[keep]
        elif b > a:
            x = np.full(1, b - a, np.uint64)
            for k in range(a, b):
                x = _mixed(x * _U(0x100000001B3) + w[k])
            yield x
        else:
            yield none


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; of its whole word sequence if that is shorter than ``width``."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    return next(_sets_of(data, np.array([len(data)]), width))


def _column_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sets of a text column without nulls, from its buffers."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, side="right")) - 1)
        yield from _sets_of(data[offsets[at] : offsets[end]], offsets[at + 1 : end + 1] - offsets[at], width)
        at = end


def set_digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def keys_of(tokens: np.ndarray) -> np.ndarray:
    """Two keys, each of two min-hashes."""
    least = np.array([tokens[0], *((tokens * s).min() for s in _SALTS)], np.uint64)
    return _mixed(least[::2] * _U(0x100000001B3) + least[1::2])


def histogram(tokens: np.ndarray) -> bytes:
    """How many tokens each bucket has; 255 means that or more."""
    return np.minimum(np.bincount((tokens & _U(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS), 255).astype(np.uint8).tobytes()


def most_overlap(a: bytes, b: bytes, n: int, m: int) -> int:
    """No overlap of sets with these histograms and sizes is larger."""
    both = np.minimum(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8))
    return min(n, m) if (both == 255).any() else int(both.sum(dtype=np.int64))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def needed(n: np.ndarray | int, m: np.ndarray | int, percent: int) -> np.ndarray | int:
    """The least overlap of linked sets of these sizes."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _sets(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, bytes]]:
    """(tokens, digest) of every set once for each task (or so); empty ones are left out."""
    seen: set[bytes] = set()
    for batch in batches:
        for tokens in _column_sets(batch.column("text"), width):
            digest = set_digest(tokens)
            if digest in seen or not len(tokens):
                continue
            if len(seen) >= 500_000:
                seen.clear()
            seen.add(digest)
            yield tokens, digest


def _hash64(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _chunks(rows: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    some: list[tuple] = []
    for row in rows:
        some.append(row)
        if len(some) == size:
            yield some
            some = []
    if some:
        yield some


class _Held:
    """The sets of the texts met last, by class; at most ``CACHE_TOKENS`` tokens of them, unless one set has more."""

    def __init__(self, width: int):
        self.width, self.sets, self.tokens = width, {}, 0

    def all(self, ids: list[bytes], texts: list[str]) -> dict[bytes, np.ndarray]:
        """The sets of ``ids``, whose texts are given."""
        out = {c: self.sets[c] for c in ids if c in self.sets}
        new = {c: t for c, t in zip(ids, texts, strict=True) if c not in out}
        if new:
            made = dict(zip(new, _column_sets(pa.array(new.values(), pa.large_string()), self.width), strict=True))
            n = sum(map(len, made.values()))
            if self.tokens + n > CACHE_TOKENS:
                self.sets, self.tokens = {}, 0
            self.sets |= made
            self.tokens += n
            out |= made
        return out


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings (token, ref, pos), which come ordered, of tokens that two sets have or that are frequent (``pos`` below 0)."""
    carry, carried = None, False
    for batch in batches:
        t, r, p = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "ref", "pos"))
        if carry is not None:
            t, r, p = (np.r_[x, y] for x, y in zip(carry, (t, r, p), strict=True))
        if not len(t):
            continue
        new = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (r[1:] != r[:-1])])
        t, r, p = t[new], r[new], p[new]
        same = t[1:] == t[:-1]
        keep = np.r_[carried, same] | np.r_[same, False] | (p < 0)
        carry, carried = (t[-1:], r[-1:], p[-1:]), bool(keep[-1])
        keep[-1] = False
        if keep.any():
            yield _postings(t[keep], r[keep], p[keep])
    if carried:
        yield _postings(*carry)


def _postings(t: np.ndarray, r: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array(r, pa.int64()), pa.array(np.where(p < 0, -1 - p, p), pa.int32())], names=["token", "ref", "pos"])


def _lists(rows: Iterator[tuple]) -> Iterator[tuple[bool, list[tuple]]]:
    """Whether a list holds two parts of its token, and its entries (leader, label, least, most, rest, part), which come ordered by size."""
    now, entries = None, []
    for token, home, low, high, *entry in rows:
        if (token, home, low, high) != now:
            if len(entries) > 1:
                yield now[2] != now[3], entries
            now, entries = (token, home, low, high), []
        entries.append(tuple(entry))
    if len(entries) > 1:
        yield now[2] != now[3], entries


def _met(lists: Iterator[tuple[bool, list[tuple]]], percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of a list's clusters that may hold linked sets.

    ``least`` and ``most`` are the sizes in a cluster, ``rest`` the most tokens that one of its sets has from this
    token on.  A block of earlier entries is skipped if its largest size or rest is too small.
    """
    seen: set[tuple[int, int]] = set()
    for apart, entries in lists:
        most, rest = [e[3] for e in entries], [e[4] for e in entries]
        blocks = [(k, max(most[k : k + LIST_BLOCK]), max(rest[k : k + LIST_BLOCK])) for k in range(0, len(entries), LIST_BLOCK)]
        for i, (leader, label, size, _, own, part) in enumerate(entries):
            for first, block_most, block_rest in blocks:
                if first >= i:
                    break
                if 100 * block_most < percent * size or min(own, block_rest) < needed(size, entries[first][2], percent):
                    continue
                for j in range(first, min(i, first + LIST_BLOCK)):
                    if 100 * most[j] >= percent * size and entries[j][1] != label and min(own, rest[j]) >= needed(size, entries[j][2], percent):
                        if apart and entries[j][5] == part:
                            continue
                        other = entries[j][0]
                        pair = (leader, other) if leader < other else (other, leader)
                        if pair not in seen:
                            if len(seen) >= 500_000:
                                seen.clear()
                            seen.add(pair)
                            yield pair


class SetJoin:
    """The steps of the join over ``docs``; every step is a method, so that tests can take them one by one."""

    def __init__(self, docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS, max_filter_bytes: int = bloom.MAX_BYTES, list_entries: int = LIST_ENTRIES):
        if not 1 <= percent <= 100:
            raise ValueError("percent must be 1 to 100")
        text = text_of(text_col)
        row = F.unhex(F.md5(F.concat(F.md5(text), F.coalesce(F.col(id_col).cast("string"), F.lit("")))))
        self.rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), row.alias("c"))
        self.texts = self.rows.select("text")
        self.spark, self.width, self.percent, self.max_filter_bytes, self.list_entries = docs.sparkSession, width, percent, max_filter_bytes, list_entries
        self.cells = cells
        self.scratch = Scratch(self.spark)
        self.written = self.scratch.written

    def _broadcast(self, x: object):
        return self.spark.sparkContext.broadcast(x)

    # -- step 0: sets, digests and the sketch ---------------------------------------------------------------

    def measure(self) -> None:
        """The table of documents, the classes, and the order of tokens."""
        width, cells = self.width, self.cells
        id_type = self.rows.schema["doc_id"].dataType
        names = ["doc_id", "n", "digest", "ref", "c", "key1", "key2", "hist", "block", "counts"]
        types = [to_arrow_type(id_type), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
        schema = pa.schema(list(zip(names, types, strict=True)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def out() -> Iterator[tuple]:
                counts = np.zeros(cells, np.uint32)
                shift = np.uint64(64 - cells.bit_length() + 1)
                for batch in batches:
                    for doc_id, c, tokens in zip(batch.column("doc_id").to_pylist(), batch.column("c").to_pylist(), _column_sets(batch.column("text"), width), strict=True):
                        if len(tokens):
                            np.add.at(counts, (tokens >> shift).astype(np.int64), 1)
                            digest = set_digest(tokens)
                            yield doc_id, len(tokens), digest, _hash64(digest), c, *keys_of(tokens).view(np.int64).tolist(), histogram(tokens), None, None
                        else:
                            yield doc_id, 0, None, None, c, None, None, None, None, None
                for k in range(0, cells, CELL_BLOCK):
                    part = counts[k : k + CELL_BLOCK]
                    if most := int(part.max()):
                        small = part.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32)
                        yield *[None] * 8, k // CELL_BLOCK, zlib.compress(small.tobytes(), 1)

            yield from batched(out(), schema, 512)

        ddl = f"doc_id {id_type.simpleString()}, n long, digest binary, ref long, c binary, key1 long, key2 long, hist binary, block int, counts binary"
        both = self.written(self.rows.mapInArrow(run, ddl), "sets")
        self.documents = both.where(F.col("block").isNull()).select("doc_id", "n", "digest")
        self.order = self._broadcast(self._levels(both.where(F.col("block").isNotNull()).select("block", "counts")))
        # min, not first: the same for every order of rows
        least = [F.min(x).alias(x) for x in ("doc_id", "n", "ref", "c", "key1", "key2", "hist")]
        self.classes = self.written(both.where(F.col("n") > 0).groupBy("digest").agg(*least), "set-classes").withColumn("k", F.xxhash64("c"))

    def _levels(self, blocks: DataFrame) -> np.ndarray:
        """For each cell, how far its count lies above the noise of a hashed count: 0 for rare tokens, then by logarithm."""
        cells = self.cells
        width = min(CELL_BLOCK, cells)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def out() -> Iterator[tuple]:
                now, total = None, np.zeros(width, np.uint64)
                for block, counts in rows_of(batches, "block", "counts"):
                    if block != now:
                        if now is not None:
                            yield now, total.astype("<u8").tobytes()
                        now, total = block, np.zeros(width, np.uint64)
                    raw = zlib.decompress(counts)
                    total += np.frombuffer(raw, f"<u{len(raw) // width}")
                if now is not None:
                    yield now, total.astype("<u8").tobytes()

            yield from batched(out(), pa.schema([("block", pa.int32()), ("counts", pa.binary())]), 4)

        counts = np.zeros(cells, np.uint64)
        for block, part in blocks.repartition("block").sortWithinPartitions("block").mapInArrow(add, "block int, counts binary").toLocalIterator():
            counts[block * width : (block + 1) * width] = np.frombuffer(part, "<u8")
        mean = float(counts.mean())
        over = (counts.astype(np.float64) - mean) / np.sqrt(mean + 1) / 2
        return np.minimum(255, np.where(over >= 1, 1 + 8 * np.log2(np.maximum(over, 1)), 0)).astype(np.uint8)

    def fetch(self, ids: DataFrame) -> DataFrame:
        """(c, text) of the classes ``ids`` (c) and of few others; a row that repeats may come once from each task."""
        ids = self.written(ids.distinct(), "asked")
        held = self._broadcast(bloom.filter_of(ids.select(F.xxhash64("c").alias("h")), ids.count(), True, self.max_filter_bytes))

        @F.pandas_udf("boolean")
        def asked(rows: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            seen: set[bytes] = set()
            for c, h in rows:
                ok = bloom.contains(held.value, h.to_numpy(np.int64).view(np.uint64))
                for i in np.flatnonzero(ok):
                    ok[i] = c[i] not in seen
                    if len(seen) >= 500_000:
                        seen.clear()
                    seen.add(c[i])
                yield pd.Series(ok)

        # what it says of a row depends on the rows before, so it must not be copied to other tables
        return self.rows.select("c", "text").where(asked.asNondeterministic()("c", F.xxhash64("c")))

    # -- step 1: relations ----------------------------------------------------------------------------------

    def relate(self) -> None:
        """Clusters of sets within the threshold of a leader: (a, b, d), b the leader, d the distance."""
        width, percent = self.width, self.percent
        keyed = self.classes.select("c", F.explode(F.array_distinct(F.array("key1", "key2"))).alias("key"))
        # a key that very many sets have is dealt to several tasks
        shared = keyed.groupBy("key").count().where("count > 1").select("key", F.ceil(F.col("count") / KEY_SETS).cast("int").alias("parts"))
        keyed = self.written(keyed.join(shared, "key").select("c", "key", F.pmod(F.xxhash64("c"), F.col("parts")).cast("int").alias("salt")), "keys")

        def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def out() -> Iterator[tuple]:
                now, leaders, last = None, [], None
                for batch in batches:
                    ids = zip(*(batch.column(x).to_pylist() for x in ("key", "salt", "c")), strict=True)
                    for (key, salt, c), own in zip(ids, _column_sets(batch.column("text"), width), strict=True):
                        if (key, salt) != now:
                            now, leaders, last = (key, salt), [], None
                        if c == last:
                            continue
                        last = c
                        for other, theirs in leaders:
                            if 100 * min(len(own), len(theirs)) < percent * max(len(own), len(theirs)):
                                continue
                            both = overlap(own, theirs)
                            if both >= needed(len(own), len(theirs), percent):
                                yield c, other, 1 - both / (len(own) + len(theirs) - both)
                                break
                        else:
                            if len(leaders) < LEADERS:
                                leaders.append((c, own))

            yield from batched(out(), pa.schema([("a", pa.binary()), ("b", pa.binary()), ("d", pa.float64())]))

        dealt = self.fetch(keyed.select("c")).join(keyed, "c").select("key", "salt", "c", "text")
        self.relations = self.written(dealt.repartition("key", "salt").sortWithinPartitions("key", "salt", "c").mapInArrow(lead, "a binary, b binary, d double"), "relations")
        self.cluster()

    def cluster(self) -> None:
        """From the relations: the provisional component of a set, and its cluster: the nearest leader it was compared with.

        A leader of others leads its own cluster, so every distance is that of a direct comparison.
        """
        self.labels = self.roots(self.relations)
        leads = self.relations.select(F.col("b").alias("a")).distinct()
        follow = self.relations.join(leads, "a", "left_anti")
        self.clusters = self.written(follow.groupBy(F.col("a").alias("c")).agg(F.min_by("b", F.struct("d", "b")).alias("leader"), F.min("d").alias("d")), "clusters")
        self.radii = self.written(self.clusters.groupBy("leader").agg(F.max("d").alias("r"), (F.count(F.lit(1)) + 1).alias("k")), "radii")

    def roots(self, edges: DataFrame) -> DataFrame:
        """(c, label) of every node of the edges (a, b)."""
        stars = components(edges.select("a", "b"), "labels", self.scratch)
        return self.written(stars.union(stars.select("m", "m").distinct()).toDF("c", "label"), "roots")

    def unconnected(self, pairs: DataFrame, roots: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
        """Those of the pairs whose two sides are not in one component."""
        of = lambda x: roots.select(F.col("c").alias(x), F.col("label").alias(f"of_{x}"))
        both = pairs.join(of(a), a, "left").join(of(b), b, "left")
        return both.where(F.coalesce(f"of_{a}", a) != F.coalesce(f"of_{b}", b)).select(*pairs.columns)

    # -- step 2: the index ----------------------------------------------------------------------------------

    def _prefix(self):
        order, percent, cells = self.order, self.percent, self.cells

        def prefix(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """The first tokens in the order, and whether they are frequent."""
            level = order.value[(tokens >> np.uint64(64 - cells.bit_length() + 1)).astype(np.int64)]
            n = prefix_length(len(tokens), percent)
            if not level.any():
                return tokens[:n], np.zeros(n, bool)
            at = np.argsort(level, kind="stable")[:n]
            return tokens[at], level[at] > 0

        return prefix

    def index(self) -> None:
        """The postings that may be shared: (token, ref, pos); ``ref`` stands for a digest."""
        width, prefix = self.width, self._prefix()

        def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in _chunks(_sets(batches, width), 256):
                tokens, often = zip(*(prefix(t) for t, _ in part), strict=True)
                sizes = [len(t) for t in tokens]
                pos = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
                ref = np.repeat(np.array([_hash64(d) for _, d in part], np.int64), sizes)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(ref), pa.array(np.where(np.concatenate(often), -1 - pos, pos))], names=["token", "ref", "pos"])

        posts = self.texts.mapInArrow(post, "token long, ref long, pos int")
        # a frequent token is shared for certain, so its postings need not meet and are dealt by set
        salt = F.when(F.col("pos") < 0, F.pmod("ref", F.lit(1024))).otherwise(-1)
        self.postings = posts.repartition(F.col("token"), salt).sortWithinPartitions("token", "ref").mapInArrow(_repeated, "token long, ref long, pos int")

    def candidates(self) -> DataFrame:
        """Pairs (a, b) of leaders whose clusters' lists meet."""
        percent = self.percent
        known = self.classes.select("c", "ref", "n").join(self.labels, "c", "left").join(self.clusters.select("c", "leader"), "c", "left")
        leader = F.coalesce("leader", "c")
        known = known.select("ref", "n", F.xxhash64(leader).alias("leader"), F.xxhash64(F.coalesce("label", leader)).alias("label"))
        entries = self.postings.join(known, "ref").groupBy("token", "leader", "label").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max(F.col("n") - F.col("pos")).alias("rest"))
        entries = self.written(entries, "entries")
        dealt = self.dealt(entries)

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = rows_of(batches, "token", "home", "low", "high", "leader", "label", "least", "most", "rest", "part")
            yield from batched(_met(_lists(rows), percent), pa.schema([("a", pa.int64()), ("b", pa.int64())]))

        keys = ("token", "home", "low", "high")
        met = dealt.repartition(*keys).sortWithinPartitions(*keys, "least").mapInArrow(meet, "a long, b long").distinct()
        side = lambda x: self.classes.select(F.col("k").alias(x), F.col("c").alias(f"c{x}"))
        return self.written(met.join(side("a"), "a").join(side("b"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")), "candidates")

    def dealt(self, entries: DataFrame) -> DataFrame:
        """The entries of lists of several components, each to the meetings (token, home, low, high) where it is a ``part``.

        A list of up to ``list_entries`` is one meeting.  In a longer one, sizes a <= b of linked sets lie in one class or in
        neighbours, as a class spans the factor that the threshold allows.  An entry is at home in the class of its least size and
        visits those up to the one after its largest size.  At a class, parts of those at home meet each other, and parts of
        visitors meet parts of those at home; so every pair that can link meets once, where the larger is at home.
        """
        size = self.list_entries
        many = entries.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("label").alias("k")).where("k > 1").drop("k")
        if self.percent == 100:
            low = high = lambda n: n  # equal sizes only
            last = F.col("most")
        else:
            step = float(np.log(100 / self.percent))
            low, high = (lambda n: F.floor(F.log(n) / step - 1e-6)), (lambda n: F.floor(F.log(n) / step + 1e-6))
            last = high(F.col("most")) + 1
        long = F.col("n") > size
        rows = entries.join(many, "token").withColumn("lo", F.when(long, low(F.col("least"))).otherwise(0).cast("int")).withColumn("hi", F.when(long, last).otherwise(0).cast("int"))
        rows = rows.withColumn("home", F.explode(F.sequence("lo", F.greatest("lo", "hi")))).withColumn("at_home", F.col("home") == F.col("lo"))
        parts = rows.groupBy("token", "home").agg(F.ceil(F.count_if("at_home") / size).cast("int").alias("own"), F.ceil(F.count_if(~F.col("at_home")) / size).cast("int").alias("others")).where("own > 0")
        rows = rows.join(parts, ["token", "home"]).withColumn("p", F.pmod("leader", F.greatest(F.when(F.col("at_home"), F.col("own")).otherwise(F.col("others")), F.lit(1))).cast("int"))
        meeting = lambda low, high, part: F.struct(low.cast("int").alias("low"), high.cast("int").alias("high"), part.cast("int").alias("part"))
        each = lambda n, f: F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), f)).otherwise(F.expr("cast(array() as array<struct<low:int,high:int,part:int>>)"))
        p = F.col("p")
        among = each(F.col("own"), lambda q: meeting(F.least(p, q), F.greatest(p, q), p))
        with_visitors = each(F.col("others"), lambda q: meeting(-1 - p, q, F.lit(0)))
        as_visitor = each(F.col("own"), lambda q: meeting(-1 - q, p, F.lit(1)))
        rows = rows.withColumn("m", F.explode(F.when(F.col("at_home"), F.concat(among, with_visitors)).otherwise(as_visitor)))
        return rows.select("token", "home", "m.low", "m.high", "leader", "label", "least", "most", "rest", "m.part")

    def bounded(self, pairs: DataFrame, clusters: bool) -> DataFrame:
        """Those of the pairs (a, b) whose histograms leave room for a link: of the sets, or of sets of their ``clusters``.

        The largest overlap gives the smallest distance, and members are at most a radius from their leader.
        """
        percent, near = self.percent, 1 - self.percent / 100 + 1e-9
        side = lambda x: self.classes.select(F.col("c").alias(x), F.col("hist").alias(f"h{x}"), F.col("n").alias(f"n{x}"))
        ring = lambda x: self.radii.select(F.col("leader").alias(x), F.col("r").alias(f"r{x}"))

        def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ok = []
                for h, g, n, m, r in rows_of(iter([batch]), "ha", "hb", "na", "nb", "r"):
                    most = most_overlap(h, g, n, m)
                    ok.append(most >= needed(n, m, percent) or r > 0 and 1 - most / (n + m - most) - r <= near)
                yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

        rows = pairs.join(side("a"), "a").join(side("b"), "b")
        if clusters:
            rows = rows.join(ring("a"), "a", "left").join(ring("b"), "b", "left").withColumn("r", F.coalesce("ra", F.lit(0.0)) + F.coalesce("rb", F.lit(0.0)))
        else:
            rows = rows.withColumn("r", F.lit(0.0))
        return rows.select("a", "b", "ha", "hb", "na", "nb", "r").mapInArrow(check, "a binary, b binary")

    # -- step 3: answers ------------------------------------------------------------------------------------

    def overlaps(self, pairs: DataFrame, apart: bool = False) -> DataFrame:
        """(a, b, na, nb, both) for pairs of classes, and if asked for the tokens that only one of them has (``apart``)."""
        width = self.width
        texts = self.fetch(pairs.select(F.col("a").alias("c")).union(pairs.select("b"))).dropDuplicates(["c"])
        # the set that many pairs share is b by custom: its narrow requests meet it first, then go to many tasks by a
        half = pairs.join(texts.select(F.col("c").alias("b"), F.col("text").alias("tb")), "b")
        whole = half.join(texts.select(F.col("c").alias("a"), F.col("text").alias("ta")), "a")

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def out() -> Iterator[tuple]:
                held = _Held(width)
                for batch in batches:
                    for at in range(0, batch.num_rows, 64):
                        a, b, ta, tb = (batch.slice(at, 64).column(x).to_pylist() for x in ("a", "b", "ta", "tb"))
                        sets = held.all(a + b, ta + tb)
                        for x, y in zip(a, b, strict=True):
                            p, q = sets[x], sets[y]
                            yield x, y, len(p), len(q), overlap(p, q), np.setxor1d(p, q, assume_unique=True).view(np.int64).tolist() if apart else None

            yield from batched(out(), pa.schema([("a", pa.binary()), ("b", pa.binary()), ("na", pa.int64()), ("nb", pa.int64()), ("both", pa.int64()), ("apart", pa.list_(pa.int64()))]), 512)

        found = whole.select("a", "b", "ta", "tb").mapInArrow(count, "a binary, b binary, na long, nb long, both long, apart array<long>")
        return self.written(found if apart else found.drop("apart"), "overlaps")

    def answers(self) -> DataFrame:
        """Edges (a, b) that connect what the join links: clusters, linked leaders, and links derived for members."""
        percent = self.percent
        known = self.overlaps(self.written(self.bounded(self.candidates(), True), "leader-pairs"))
        # integers throughout: 100 * both >= percent * union
        linked = F.col("both") * (100 + percent) >= F.lit(percent) * (F.col("na") + F.col("nb"))
        gap = 1 - F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))
        edges = known.where(linked).select("a", "b").union(self.relations.select("a", "b"))
        ring = lambda x: self.radii.select(F.col("leader").alias(x), F.col("r").alias(f"r{x}"), F.col("k").alias(f"k{x}"))
        none = {"ra": 0.0, "rb": 0.0, "ka": 1, "kb": 1}
        close = known.where(~linked).select("a", "b", gap.alias("gap")).join(ring("a"), "a", "left").join(ring("b"), "b", "left").fillna(none)
        near = F.lit(1 - percent / 100 + 1e-9)
        close = close.where((F.col("ka") + F.col("kb") > 2) & (F.col("gap") - F.col("ra") - F.col("rb") <= near))
        # the larger cluster's leader is the reference, from which the answers of both clusters' members derive
        larger = F.col("ka") >= F.col("kb")
        close = self.written(close.select(F.when(larger, F.col("a")).otherwise(F.col("b")).alias("ref"), F.when(larger, F.col("b")).otherwise(F.col("a")).alias("other")), "close-pairs")
        if close.isEmpty():
            return edges
        close = self.written(self.unconnected(close, self.roots(edges), "ref", "other"), "close-pairs")
        if close.isEmpty():
            return edges
        members = self.clusters.select("c", "leader").union(close.select(F.col("other").alias("c"), "other").distinct())
        # the other cluster's members first: one that links with the reference answers for its cluster
        others = close.join(members.withColumnRenamed("leader", "other"), "other").select(F.col("c").alias("a"), F.col("ref").alias("b"), "other")
        others = self.written(others, "derivations")
        told = self.overlaps(others.select("a", "b").distinct(), apart=True)
        edges = edges.union(told.where(linked).select("a", "b"))
        close = self.written(self.unconnected(close, self.roots(edges), "ref", "other"), "close-pairs")
        if close.isEmpty():
            return edges
        others = others.join(close.withColumnRenamed("ref", "b"), ["b", "other"], "left_semi").distinct()
        own = close.select("ref").distinct().join(self.clusters.withColumnRenamed("leader", "ref"), "ref").select(F.col("c").alias("a"), F.col("ref").alias("b"))
        told = told.join(others.select("a", "b"), ["a", "b"], "left_semi").withColumn("own", F.lit(False)).union(self.overlaps(own, apart=True).withColumn("own", F.lit(True)))
        # with R = ref, |x & y| = |x & R| + |y & R| - |R| + (differences from R that x and y share), so a link needs
        # A(x) + B(y) + |R| shared differences (in units of 1 / (100 + percent)), which splits by set
        part = F.lit(percent) * F.col("na") - F.lit(100 + percent) * F.col("both")
        rows = self.written(told.select("b", F.col("a").alias("z"), "own", F.col("nb").alias("nr"), part.alias("part"), "apart"), "differences")
        least = rows.groupBy("b").agg(F.min(F.when(F.col("own"), F.col("part"))).alias("least_x"), F.min(F.when(~F.col("own"), F.col("part"))).alias("least_y"))
        # with no member but the reference nothing is left to derive
        asked = rows.join(least.where("least_x is not null and least_y is not null"), "b")
        short = F.col("part") + F.when(F.col("own"), F.col("least_y")).otherwise(F.col("least_x")) + F.lit(100 + percent) * F.col("nr")
        asked = asked.withColumn("short", F.greatest(F.ceil(short / F.lit(100 + percent)), F.lit(0)))
        sure = asked.where(~F.col("own") & (F.col("short") <= 0)).select(F.col("z").alias("a"), "b")
        edges = edges.union(sure)
        # prefix filter: of d differences, d - needed + 1 rare ones must meet; of two sets' own edits none do
        whose = others.select("b", F.col("a").alias("z"), "other")
        each = asked.where(F.col("own") | (F.col("short") > 0)).join(whose, ["b", "z"], "left")
        each = each.select("b", "z", "other", "own", "short", "part", "nr", F.size("apart").alias("d"), F.explode("apart").alias("t"))
        rare = each.groupBy("b", "t").agg(F.count(F.lit(1)).alias("f"), (F.bool_or("own") & F.bool_or(~F.col("own"))).alias("met"))
        nth = F.row_number().over(Window.partitionBy("b", "z").orderBy("f", "t"))
        prefix = each.join(rare, ["b", "t"]).withColumn("nth", nth).where((F.col("nth") <= F.col("d") - F.greatest("short", F.lit(1)) + 1) & F.col("met"))
        # at the first difference that two sets share, what is left of both must still hold what they need
        prefix = self.written(prefix.select("b", "t", "z", "other", "own", "part", "nr", (F.col("d") - F.col("nth") + 1).alias("left")), "difference-prefixes")
        x = prefix.where("own").select("b", "t", "nr", F.col("z").alias("x"), F.col("part").alias("px"), F.col("left").alias("lx"))
        y = prefix.where(~F.col("own")).select("b", "t", "other", F.col("z").alias("y"), F.col("part").alias("py"), F.col("left").alias("ly"))
        room = F.col("px") + F.col("py") + F.lit(100 + percent) * F.col("nr") <= F.lit(100 + percent) * F.least("lx", "ly")
        # one pair of members for each pair of clusters, the likeliest; then all that may link of the clusters that stay apart
        best = x.groupBy("b", "t").agg(F.min("nr").alias("nr"), *(F.min_by(c, F.struct("px", "x")).alias(c) for c in ("x", "px", "lx")))
        best = best.join(y.groupBy("b", "t", "other").agg(*(F.min_by(c, F.struct("py", "y")).alias(c) for c in ("y", "py", "ly"))), ["b", "t"]).where(room)
        first = best.groupBy("b", "other").agg(*(F.min_by(c, F.struct(F.col("px") + F.col("py"), "t")).alias(k) for c, k in (("x", "a"), ("y", "b2")))).select("a", F.col("b2").alias("b")).distinct()
        edges = edges.union(self.overlaps(self.written(first, "member-pairs")).where(linked).select("a", "b"))
        stay = self.unconnected(close, self.roots(edges), "ref", "other").withColumnRenamed("ref", "b")
        y = self.written(y.join(stay, ["b", "other"], "left_semi"), "members-apart")
        meet = x.join(y, ["b", "t"]).where(room)
        derived = self.written(self.bounded(meet.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), False), "member-pairs")
        if derived.isEmpty():
            return edges
        return edges.union(self.overlaps(derived).where(linked).select("a", "b"))

    def groups(self) -> DataFrame:
        """doc_id, n_shingles, component_id of every row."""
        with small_batches(self.spark):
            self.measure()
            self.relate()
            self.index()
            roots = components(self.answers(), "components", self.scratch)
            rooted = self.classes.select("c", "digest", "doc_id").join(roots.select(F.col("v").alias("c"), F.col("m").alias("root")), "c", "left").withColumn("root", F.coalesce("root", "c"))
            ids = self.written(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k"), "component-ids")
            # a class of its own has its own id; of the others, few in most tables, a component's id is told by its root
            of = self.written(rooted.join(ids, "root", "left").select("digest", F.coalesce("component_id", "doc_id").alias("component_id")), "class-components")
        self.scratch.clear("sets", "class-components")
        return self.documents.join(of, "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def ngram_jaccard_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``.

    Two documents link if ``100 * intersection >= percent * union`` of their sets of ``width``-word shingles; a
    component's id is the smallest document id in it.  A text of fewer words is one shingle; without words (or
    null) the set is empty, links with nothing and the row is its own component.  Repeated rows have equal sets
    and link.  Null ids count for no component id unless all ids of the component are null.  An empty table gives
    an empty result; further columns are not read.
    """
    return SetJoin(docs, width, percent, id_col, text_col).groups()


#: The same on the shingles' texts, for tables that a single machine joins.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, unnest(x) AS a, generate_subscripts(x, 1) AS i, len(x) AS n FROM (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS x FROM documents)),
f AS (SELECT doc_id, n, i, concat_ws(' ', a, lead(a, 1) OVER o, lead(a, 2) OVER o, lead(a, 3) OVER o, lead(a, 4) OVER o) AS g FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT DISTINCT doc_id, g FROM f WHERE i <= greatest(n - 4, 1)),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
l AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT l.a, l.b FROM l JOIN c x ON x.doc_id = l.a JOIN c y ON y.doc_id = l.b WHERE 100 * k >= 75 * (x.n + y.n - k)),
r AS (SELECT doc_id AS a, doc_id AS m FROM c UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.a)
SELECT d.doc_id, coalesce(any_value(c.n), 0)::BIGINT AS n_shingles, coalesce(min(r.m), d.doc_id) AS component_id
FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN r ON r.a = d.doc_id GROUP BY d.doc_id
"""
