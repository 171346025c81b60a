"""Streaming forms: silences as session windows, incremental revalidation, transcription as a map with failures kept."""

from __future__ import annotations

import multiprocessing
from collections.abc import Callable, Iterator
from multiprocessing.connection import Connection

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.compare import validate
from ..operators.parse import parse_response


def talk_sessions(events: DataFrame, key: str, time: str, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """W2 on a stream: (key, start, end, events) of stretches without a pause of ``gap``; events later than ``late`` are dropped."""
    rows = events.withWatermark(time, late).groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count(F.lit(1)).alias("events"))
    return rows.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")


def revalidate_stream(manifest: DataFrame, results_path: str, checkpoint: str, key: str = "file", parts: int = 64) -> StreamingQuery:
    """J9, C10 on a stream: rows of each batch whose file has not passed yet are validated and appended to ``results_path``.

    Results lie in ``parts`` folders by a hash of the file, of which a batch reads those that its files are in.  A batch that
    runs twice finds its own results and adds nothing that has passed, so a restart is safe.
    """

    part = F.pmod(F.xxhash64(key), F.lit(parts)).alias("part")

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        todo = batch.withColumn("part", part)
        try:
            results = spark.read.parquet(results_path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            asked = [r.part for r in todo.select("part").distinct().collect()]
            passed = results.where(F.col("part").isin(asked) & (F.col("status") == "OK")).select(key)
            todo = todo.join(passed, key, "left_anti")
        validate(todo).withColumn("batch", F.lit(number)).write.mode("append").partitionBy("part").parquet(results_path)

    return manifest.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Fixed value: seconds after which a transcription is given up.
TIME_LIMIT_S = 120.0


def _serve(load: Callable[[], Callable[[str], str]], calls: Connection, asker: Connection) -> None:
    """What a worker process does: answers one call after the other, until the asking side is closed."""
    asker.close()
    model = load()
    while True:
        try:
            x = calls.recv()
        except EOFError:
            return
        try:
            calls.send((model(x), None))
        except Exception as error:  # noqa: BLE001  whatever a model raises is that row's error
            calls.send((None, f"ERROR: {error}"))


class Watched:
    """A model in a process of its own, which is ended and begun anew when a call takes too long or the process dies."""

    def __init__(self, load: Callable[[], Callable[[str], str]], seconds: float):
        self.load, self.seconds, self.process = load, seconds, None

    def begin(self) -> None:
        forks = multiprocessing.get_context("fork")
        self.calls, other = forks.Pipe()
        self.process = forks.Process(target=_serve, args=(self.load, other, self.calls), daemon=True)
        self.process.start()
        other.close()

    def end(self) -> None:
        if self.process is not None:
            self.process.kill()
            self.process.join()
            self.calls.close()
            self.process = None

    def __call__(self, x: str) -> tuple[str | None, str | None]:
        if self.process is None:
            self.begin()
        try:
            self.calls.send(x)
            if self.calls.poll(self.seconds):
                return self.calls.recv()
            reason = f"ERROR: no answer in {self.seconds:g} s"
        except (EOFError, OSError):
            reason = "ERROR: the model's process ended"
        self.end()
        return None, reason


def transcribed(rows: DataFrame, load: Callable[[], Callable[[str], str]], path: str = "file", seconds: float | None = TIME_LIMIT_S) -> DataFrame:
    """``rows`` with transcription and error; the model is loaded once for each task, a failure is a null and its text.

    A call that takes more than ``seconds`` is given up: the model runs in a process of its own that the task watches, ends and
    begins anew, so a hanging row costs its time limit and no more.  With None the model runs in the task itself.
    """
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in rows.schema.fields)}, transcription string, error string"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        watched = None if seconds is None else Watched(load, seconds)
        if watched is not None:
            # before the first batch is read: a process that is forked later keeps a copy of it
            watched.begin()
        model = load() if seconds is None else None

        def one(x: str) -> tuple[str | None, str | None]:
            if watched is not None:
                return watched(x)
            try:
                return model(x), None
            except Exception as error:  # noqa: BLE001  whatever a model raises is that row's error
                return None, f"ERROR: {error}"

        try:
            for part in parts:
                both = [one(x) for x in part[path]]
                yield part.assign(transcription=[t for t, _ in both], error=[e for _, e in both])
        finally:
            if watched is not None:
                watched.end()

    return rows.mapInPandas(run, schema)


def measured(rows: DataFrame, checks: dict[str, tuple[str, Callable[[], Callable[..., object]]]], inputs: list[str]) -> DataFrame:
    """``rows`` with a column for each of ``checks`` (name: type and a loader of a model on ``inputs``).

    Only the checks that are given run; a model is loaded once for each task, and what it cannot measure is null, which C8
    takes as no flag.
    """
    own = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = {name: load() for name, (_, load) in checks.items()}

        def one(model: Callable[..., object], values: tuple) -> object:
            try:
                return model(*values)
            except Exception:  # noqa: BLE001  a measure that fails is missing
                return None

        for part in parts:
            values = list(zip(*(part[c] for c in inputs), strict=True))
            yield part.assign(**{name: pd.Series([one(m, v) for v in values], index=part.index, dtype=object) for name, m in models.items()})

    return rows.mapInPandas(run, ", ".join([own, *(f"{name} {kind}" for name, (kind, _) in checks.items())])) if checks else rows


def answered(rows: DataFrame, prompt: Column, load: Callable[[], Callable[[str], str]]) -> DataFrame:
    """``rows`` with prompt, answer and error of an injected call, and the answer read as JSON.

    One pass of a chain (extract, draft, review, revise): the next pass builds its prompt from these columns.
    """
    asked = rows.withColumn("prompt", prompt)
    heard = transcribed(asked, load, "prompt").withColumnRenamed("transcription", "answer")
    return heard.withColumn("parsed", F.when(F.col("answer").isNotNull(), parse_response(F.col("answer"))))
