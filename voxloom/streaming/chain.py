"""A chain of model passes with a ledger, so that no answer is asked for twice.

A pass is a name, an instruction and a prompt for each row.  Its request is known by a digest of all three; the ledger at
``path`` holds the answers of all runs by (pass, digest).  A pass joins the ledger first, asks only for what is not there, equal
requests once, and appends what it got.  A run that ends early goes on from there, and a run that changes a source, or an
instruction, asks only for what follows from it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import nested, parse, rollup
from ..operators.chunked import settled
from .streams import transcribed

LEDGER = "pass string, digest string, answer string, run string"
#: Words a minute of planned dialogue, and words from which a line is cut into segments.
WORDS_A_MINUTE, LONG_LINE = 150, 35
#: What each pass is told; a caller may give others.
INSTRUCTIONS = {
    "extract": "Read the sources and answer with a JSON brief: the topic, the points in their order, and the facts behind each.",
    "draft": "Write a dialogue of about {words} words in {language} from the brief. Every line is: Speaker: [emotion] text.",
    "direct": "Make the dialogue lively: interruptions, reactions, varied length. Keep the form of every line.",
    "pronounce": "Respell foreign names the way they sound in {language}. Change nothing else.",
    "fidelity": 'Compare the dialogue with the sources. Answer with JSON: {{"issues": [{{"severity": "HIGH|MEDIUM|LOW", "type": "...", "explanation": "..."}}]}}.',
    "listener": 'Say what a listener would miss or tire of. Answer with JSON: {{"notes": [{{"type": "...", "note": "..."}}]}}.',
    "narrative": 'Score opening, build, payoff and ending. Answer with JSON: {{"scores": [{{"item": "...", "score": "PASS|PARTIAL|FAIL", "evidence": "..."}}]}}.',
    "revise": "Revise the dialogue by the review, and keep the form of every line.",
    "segment": 'Cut the line where a speaker would pause. Answer with JSON: [{{"text": "...", "pause_after": 0.3}}]. Keep every word.',
}
_ISSUES = "array<struct<severity:string,type:string,explanation:string>>"
_NOTES = "array<struct<type:string,note:string>>"
_SCORES = "array<struct<item:string,score:string,evidence:string>>"
_SEGMENTS = "array<struct<text:string,pause_after:double>>"


@dataclass
class Chain:
    """A ledger and a model: ``load`` gives, in each task, a function of (instruction and prompt) that answers."""

    spark: SparkSession
    path: str
    load: Callable[[], Callable[[str], str]]
    seconds: float | None = None

    def known(self) -> DataFrame:
        """(pass, digest, answer) of the ledger, each once, also where two runs met."""
        self.spark.createDataFrame([], LEDGER).write.mode("append").parquet(self.path)
        return self.spark.read.schema(LEDGER).parquet(self.path).groupBy("pass", "digest").agg(F.min("answer").alias("answer"))

    def ask(self, rows: DataFrame, name: str, instruction: Column | str, prompt: Column) -> DataFrame:
        """``rows`` with ``answer``: the ledger's, or a new one that goes there first; null where the model failed, to be asked anew by the next run.

        A null prompt is no request.
        """
        text = F.concat(instruction if isinstance(instruction, Column) else F.lit(instruction), F.lit("\n\n"), prompt)
        asked = rows.withColumn("__prompt", text).withColumn("__digest", F.sha2("__prompt", 256))
        own = self.known().where(F.col("pass") == name)
        todo = asked.where("__digest is not null").select("__digest", "__prompt").dropDuplicates(["__digest"]).join(own.select(F.col("digest").alias("__digest")), "__digest", "left_anti")
        new = transcribed(todo, self.load, "__prompt", self.seconds).where("error is null")
        new.select(F.lit(name).alias("pass"), F.col("__digest").alias("digest"), F.col("transcription").alias("answer"), F.lit(self.spark.sparkContext.applicationId).alias("run")).write.mode("append").parquet(self.path)
        answers = self.known().where(F.col("pass") == name).select(F.col("digest").alias("__digest"), "answer")
        return settled(asked.join(answers, "__digest", "left").drop("__digest", "__prompt"))


def _listed(answer: Column, at: str, kind: str) -> Column:
    return F.coalesce(F.try_variant_get(parse.parse_response(answer)["value"], at, kind), F.expr(f"cast(array() as {kind})"))


def write_scripts(episodes: DataFrame, chain: Chain, key: str = "episode_id", instructions: dict[str, str] | None = None, review_chars: int = 50_000) -> dict[str, DataFrame]:
    """Scripts, reviews and overrides of episodes (key, source, topic, cast: array of names, language, minutes).

    Extract, draft, direct, pronounce, three reviews; only episodes with a HIGH issue or a FAIL (A10) are revised.  Long lines of
    the script are cut into segments (W28), and those whose JSON reads become overrides (SC12's form).  An episode whose brief does
    not read as JSON, or whose model fails, has a null script and goes no further; it is asked again by the next run.  The review reads
    the first ``review_chars`` characters of the source, as the feature does.
    """
    told = INSTRUCTIONS | (instructions or {})
    filled = lambda name: F.replace(F.replace(F.lit(told[name].replace("{{", "{").replace("}}", "}")), F.lit("{words}"), (F.col("minutes") * WORDS_A_MINUTE).cast("string")), F.lit("{language}"), F.coalesce("language", F.lit("en")))
    angle = F.when(F.col("topic").isNotNull(), F.concat(F.lit("ANGLE: "), "topic", F.lit("\n\n"))).otherwise("")
    rows = chain.ask(episodes, "extract", filled("extract"), F.concat(angle, F.lit("SOURCES:\n\n"), "source"))
    read = parse.parse_response(F.col("answer"))
    rows = rows.withColumn("brief", F.when(~read["parse_error"], F.to_json(read["value"]))).drop("answer")
    cast = F.concat(F.lit("CAST: "), F.array_join("cast", ", "), F.lit("\n\nBRIEF:\n"), F.col("brief"))
    rows = chain.ask(rows, "draft", filled("draft"), cast).withColumnRenamed("answer", "script")
    for name in ("direct", "pronounce"):
        rows = chain.ask(rows, name, filled(name), F.concat(F.lit("SCRIPT:\n"), "script")).drop("script").withColumn("script", F.trim(parse.fenced_json(F.col("answer")))).drop("answer")
    prompts = {"fidelity": F.concat(F.lit("SOURCES:\n\n"), F.left("source", F.lit(review_chars)), F.lit("\n\nSCRIPT:\n"), "script")}
    for name in ("fidelity", "listener", "narrative"):
        rows = chain.ask(rows, name, filled(name), prompts.get(name, F.concat(F.lit("SCRIPT:\n"), "script"))).withColumnRenamed("answer", name)
    issues = rows.select(key, F.posexplode(_listed(F.col("fidelity"), "$.issues", _ISSUES)).alias("nth", "x")).select(key, "nth", "x.*")
    notes = rows.select(key, F.posexplode(_listed(F.col("listener"), "$.notes", _NOTES)).alias("nth", "x")).select(key, "nth", "x.*")
    scores = rows.select(key, F.posexplode(_listed(F.col("narrative"), "$.scores", _SCORES)).alias("nth", "x")).select(key, "nth", "x.*")
    review = rollup.needs_revision(issues, scores, key).join(rollup.review_digest(issues, notes, scores, key), key, "full")
    rows = rows.join(review, key, "left").withColumn("revise", F.coalesce("revise", F.lit(False)))
    again = F.when(F.col("revise"), F.concat(F.lit("REVIEW:\n"), F.coalesce("digest", F.lit("")), F.lit("\n\nSCRIPT:\n"), "script"))
    rows = chain.ask(rows, "revise", filled("revise"), again).withColumn("script", F.coalesce("answer", "script")).drop("answer")
    scripts = rows.select(key, "script", "revise", F.col("digest").alias("review"))
    long = parse.long_lines(scripts.where("script is not null"), LONG_LINE, key, "script")
    cut = chain.ask(long, "segment", told["segment"].replace("{{", "{").replace("}}", "}"), F.concat(F.lit("LINE:\n"), "text"))
    segments = F.try_variant_get(parse.parse_response(F.col("answer"))["value"], "$", _SEGMENTS)
    good = cut.withColumn("segments", segments).where(F.size("segments") > 0).where(F.forall("segments", lambda s: s["text"].isNotNull()))
    files = good.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("line_key", "segments")))).alias("overrides"))
    return {"scripts": scripts, "overrides": files.select(key, F.to_json(F.struct("overrides")).alias("json"))}


def segments_of(overrides: DataFrame, key: str = "episode_id") -> DataFrame:
    """The override files read as SC12 reads them: (key, line_key, seg, text, pause_after, segmented)."""
    return nested.overrides(overrides, key)
