"""Sharding by sampled splitters; the law is ``bytes``: shards of nearly equal size.

The key of a record is the hash of its text, so equal texts are neighbours.  A size-weighted sample of keys gives
quantile splitters for many more ranges than shards; ranges that turn out overfull are subdivided, first by taking
out the keys that are heavy by themselves, then by hashing the other keys.  A group of equal texts stays whole
unless it is larger than an even share; only such a group is cut into pieces.  The measured ranges go to shards by
longest-processing-time-first, so sizes differ by about the smallest range.

The driver holds a sample, the ranges and the heavy keys: at most ``max_ranges`` times a constant, whatever the
input.  Slots are numbered range by range with the ranges' counts as offsets: no shard is ever one task.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import text_of, written

LAW = "bytes"
#: Ranges for each shard at least, rows for each range at most (as long as max_ranges allows), samples for each range.
RANGES_PER_SHARD, ROWS_PER_RANGE, SAMPLES_PER_RANGE = 64, 50_000, 8
#: A heavy group is cut into pieces of this part of a share at most.
PIECES = 32


def splitters(rows: DataFrame, total: int, ranges: int) -> np.ndarray:
    """At most ``ranges - 1`` boundaries at quantiles of a size-weighted sample of keys.

    A row is drawn with a chance in proportion to its size by a hash of its own values, so a retried task draws
    the same rows; a row that is sure to be drawn counts with its size.
    """
    per = max(1.0, total / (ranges * SAMPLES_PER_RANGE))
    u = F.pmod(F.xxhash64("sub", F.lit("sample")), F.lit(1 << 52)) / F.lit(float(1 << 52))
    drawn = rows.where(u < F.col("size") / F.lit(per)).groupBy("key").agg(F.sum(F.greatest(F.col("size").cast("double"), F.lit(per))).alias("w")).toPandas()
    if drawn.empty:
        return np.zeros(0, np.int64)
    drawn = drawn.sort_values("key")
    at = np.cumsum(drawn["w"].to_numpy())
    cut = np.searchsorted(at, at[-1] * np.arange(1, ranges) / ranges)
    return np.unique(drawn["key"].to_numpy()[np.minimum(cut, len(drawn) - 1)])


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", max_ranges: int = 65_536) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law) for every row.

    ``size``: UTF-8 bytes plus 1; a null text has none and forms a group with empty texts.  Repeated rows get a
    slot each.  Ids may be null.  An empty table gives an empty result; further columns are not read.
    """
    text = text_of(text_col)
    rows = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            F.xxhash64(text, F.col(id_col).cast("string")).alias("sub"),
        ),
        "shard-rows",
    )
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    ranges = min(max_ranges, max(shards * RANGES_PER_SHARD, n // ROWS_PER_RANGE))
    share, target = total / shards, total / ranges
    bounds = splitters(rows, total, ranges)
    held = docs.sparkSession.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def range_of(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for k in keys:
            yield pd.Series(np.searchsorted(held.value, k.to_numpy(), side="left").astype(np.int32))

    ranged = rows.withColumn("range", range_of("key"))
    sizes = {r: (b, c) for r, b, c in ranged.groupBy("range").agg(F.sum("size"), F.count(F.lit(1))).toLocalIterator()}
    over = [(r,) for r, (b, _) in sizes.items() if b > 2 * target]
    spark = docs.sparkSession
    overfull = F.broadcast(spark.createDataFrame(over, "range int"))
    # the heavy keys of overfull ranges: at most 2 * ranges of them, as each has more than half a target
    heavy = [(k, b) for k, b in ranged.join(overfull, "range", "left_semi").groupBy("key").agg(F.sum("size").alias("b")).where(F.col("b") > target / 2).toLocalIterator()]
    # a heavy group is numbered in pieces, by as many tasks; they go to one shard unless the group is larger than a share
    alone = [(k, int(np.ceil(b / (share / PIECES)))) for k, b in heavy]
    whole = {k for k, b in heavy if b <= share}
    in_heavy: dict[int, int] = {}
    for k, b in heavy:
        r = int(np.searchsorted(bounds, k, side="left"))
        in_heavy[r] = in_heavy.get(r, 0) + b
    pieces = [(r, max(1, int(np.ceil((sizes[r][0] - in_heavy.get(r, 0)) / target)))) for (r,) in over]
    alone_df = F.broadcast(spark.createDataFrame(alone, "key long, parts int"))
    pieces_df = F.broadcast(spark.createDataFrame(pieces, "range int, parts_of_range int"))
    atoms = ranged.join(alone_df, "key", "left").join(pieces_df, "range", "left").select(
        "doc_id",
        "size",
        "text_crc32",
        "key",
        "sub",
        "range",
        F.when(F.col("parts").isNotNull(), F.col("key")).alias("own"),
        F.when(F.col("parts").isNotNull(), F.pmod("sub", F.col("parts"))).otherwise(F.coalesce(F.pmod(F.xxhash64("key"), F.col("parts_of_range")), F.lit(0))).cast("int").alias("part"),
    )
    pieces_of: dict[tuple, list] = {}
    for r, own, part, b, c in atoms.groupBy("range", "own", "part").agg(F.sum("size"), F.count(F.lit(1))).toLocalIterator():
        pieces_of.setdefault((r, own) if own in whole else (r, own, part), []).append((part, b, c))
    measured = sorted(((sum(b for _, b, _ in ps), key[0], key[1], sorted(ps)) for key, ps in pieces_of.items()), key=lambda x: (-x[0], x[1], x[2] is not None, x[2] or 0, x[3]))
    load, slots, placed = [(0, s) for s in range(shards)], [0] * shards, []
    for b, r, own, ps in measured:
        at, s = heapq.heappop(load)
        for part, _, c in ps:
            placed.append((r, own, part, s, slots[s]))
            slots[s] += c
        heapq.heappush(load, (at + b, s))
    places = F.broadcast(spark.createDataFrame(placed, "range int, own long, part int, shard int, first long"))
    a, p = atoms.alias("a"), places.alias("p")
    within = Window.partitionBy("a.range", "a.own", "a.part").orderBy("a.key", "a.doc_id")
    same = (F.col("a.range") == F.col("p.range")) & (F.col("a.part") == F.col("p.part")) & F.col("a.own").eqNullSafe(F.col("p.own"))
    return a.withColumn("nth", F.row_number().over(within)).alias("a").join(p, same).select(
        "a.doc_id", "a.size", "a.text_crc32", F.lit(LAW).alias("law"), "p.shard", (F.col("p.first") + F.col("a.nth") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
