"""What the operators of this folder share: text conventions, the shared folder, small Arrow helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every text contract of this folder.
WS = " \t\n\x0b\x0c\r"
WS_CLASS = r"[\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where it is unset and all runs in one process (tests), a temporary one."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        at = spark.sparkContext.getCheckpointDir()
    if not at:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="voxloom-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a table in the shared folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Written tables of one job, which go once what was made of them is written itself."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """As ``written``."""
        path = fresh_path(self.spark, name)
        self.paths.append((name, path))
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self, *keep: str) -> None:
        """Deletes all tables but those of the names ``keep``."""
        for name, path in self.paths:
            if name not in keep:
                at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        self.paths = [x for x in self.paths if x[0] in keep]


@contextmanager
def small_batches(spark: SparkSession, most: int = 1024) -> Iterator[None]:
    """Arrow batches of at most ``most`` rows while jobs run here: rows there hold whole texts or sets, and a batch is in memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= most:
        spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer by underscores until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(col: str) -> Column:
    """A text column; null is empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows_of(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Python values of the named columns, row by row, one small slice of a batch at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            yield from zip(*(part.column(c).to_pylist() for c in columns), strict=True)


def batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows."""
    some: list[tuple] = []
    for row in rows:
        some.append(row)
        if len(some) == size:
            yield _batch(some, schema)
            some = []
    if some:
        yield _batch(some, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
