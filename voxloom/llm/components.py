"""Connected components of an edge table: spanning forests of parts, then alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import Scratch, batched, rows_of

#: Edges that one task joins to a forest, a hundred megabytes of Python objects or so.
PART_EDGES = 500_000


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first())


def forest(edges: Iterator[tuple]) -> Iterator[tuple]:
    """(v, m) for every node of the edges that isn't the smallest of its component; m is the smallest."""
    up: dict = {}

    def root(x):
        top = x
        while (y := up.get(top, top)) != top:
            top = y
        while x != top:
            up[x], x = top, up.get(x, top)
        return top

    for a, b in edges:
        x, y = root(a), root(b)
        if x != y:
            up[max(x, y)] = min(x, y)
    for x in list(up):
        yield x, root(x)


def components(edges: DataFrame, name: str = "stars", scratch: Scratch | None = None, part_edges: int = PART_EDGES) -> DataFrame:
    """(v, m) for every node v of ``edges`` (a, b) that isn't the smallest of its component; m is the smallest.

    Parts of at most ``part_edges`` edges (in the mean) become forests, a task each; a single part is done by that.
    The forests of several parts meet by minima from partial aggregation and by joins that adaptive execution may
    split: no group of neighbours is collected.  Each round is a written table (of ``scratch``, if given), so a lost executor
    costs one round.  Loops and repeated edges change nothing; edges with a null end are left out.
    """
    written = (scratch or Scratch(edges.sparkSession)).written
    now = written(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")), name)
    parts = -(-now.count() // part_edges)
    kind = now.schema["v"].dataType
    arrow = pa.schema([("v", to_arrow_type(kind)), ("m", to_arrow_type(kind))])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(forest(rows_of(batches, "v", "m")), arrow)

    dealt = now.repartition(parts) if parts > 1 else now.coalesce(1)
    now = written(dealt.mapInArrow(join, f"v {kind.simpleString()}, m {kind.simpleString()}"), name)
    if parts <= 1:
        return now
    before = _signature(now)
    while before[0]:
        both = now.select(F.col("v").alias("u"), F.col("m").alias("w")).union(now.select("m", "v"))
        least = both.groupBy("u").agg(F.min("w").alias("w0")).select("u", F.least("u", "w0").alias("m"))
        large = both.where(F.col("w") > F.col("u")).join(least, "u").select(F.col("w").alias("v"), "m").where(F.col("v") != F.col("m")).distinct()
        small = large.groupBy("v").agg(F.min("m").alias("m0"))
        out = large.join(small, "v").select(F.col("m").alias("v"), F.col("m0").alias("m")).where(F.col("v") != F.col("m")).union(small).distinct()
        now = written(out, name)
        after = _signature(now)
        if after == before:
            break
        before = after
    return now
