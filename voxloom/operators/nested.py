"""JSON of two or more shapes: manifests, overrides, prosody references, by the VARIANT type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEGMENT = "array<struct<text:string,pause_after:double>>"
_ENTRY = "array<struct<file:string,text:string,speaker:string,language:string,ref_audio:string,ref_text:string,duration:double>>"


def manifest_entries(manifests: DataFrame, key: str, json: str = "json") -> DataFrame:
    """SC11: (key, nth, file, text, ...) of an array, or of an object's ``main`` and then ``intro``."""
    plain = F.from_json(F.col(json), _ENTRY)
    both = F.from_json(F.col(json), f"struct<main:{_ENTRY},intro:{_ENTRY}>")
    none = F.expr(f"cast(array() as {_ENTRY})")
    is_list = F.ltrim(F.col(json)).startswith("[")
    entries = F.when(is_list, F.coalesce(plain, none)).otherwise(F.concat(F.coalesce(both["main"], none), F.coalesce(both["intro"], none)))
    return manifests.select(key, F.posexplode(entries).alias("nth", "e")).select(key, "nth", "e.*")


def overrides(files: DataFrame, key: str, json: str = "json") -> DataFrame:
    """SC12, F15: (key, line_key, seg, text, pause_after, segmented); a plain text is one segment without a pause."""
    values = F.try_variant_get(F.try_parse_json(F.col(json)), "$.overrides", "map<string,variant>")
    rows = files.select(key, F.explode(values).alias("line_key", "v"))
    listed = F.schema_of_variant("v").startswith("ARRAY")
    segments = F.when(listed, F.try_variant_get("v", "$", _SEGMENT)).otherwise(F.array(F.struct(F.try_variant_get("v", "$", "string").alias("text"), F.lit(0.0).alias("pause_after"))))
    out = rows.select(key, "line_key", listed.alias("segmented"), F.posexplode(segments).alias("seg", "s"))
    return out.select(key, "line_key", "seg", "s.text", F.coalesce("s.pause_after", F.lit(0.0)).alias("pause_after"), "segmented")


def override_issues(files: DataFrame, key: str, json: str = "json") -> DataFrame:
    """(key, line_key, issue) of everything that is wrong with an override file."""
    values = F.try_variant_get(F.try_parse_json(F.col(json)), "$.overrides", "map<string,variant>")
    rows = files.select(key, F.explode(values).alias("line_key", "v")).withColumn("kind", F.schema_of_variant("v"))

    def segment(s: Column, i: Column) -> Column:
        kind = F.schema_of_variant(s)
        text, pause = F.try_variant_get(s, "$.text", "string"), F.try_variant_get(s, "$.pause_after", "variant")
        say = lambda what: F.concat(F.lit("segment "), i.cast("string"), F.lit(f": {what}"))
        number = F.schema_of_variant(pause).rlike("^(BIGINT|DOUBLE|DECIMAL|INT|FLOAT)")
        of_text = F.when(text.isNull(), say("missing text")).when(F.trim(text) == "", say("empty text"))
        of_pause = F.when(pause.isNull(), None).when(~number, say("pause is not a number")).when(F.try_variant_get(s, "$.pause_after", "double") < 0, say("negative pause"))
        return F.when(~kind.startswith("OBJECT"), F.array(say("not an object"))).otherwise(F.array(of_text, of_pause))

    parts = F.flatten(F.transform(F.try_variant_get("v", "$", "array<variant>"), segment))
    issues = (
        F.when(~F.col("line_key").rlike(r"^\d+$"), F.array(F.lit("key is not a number")))
        .when(F.col("kind").startswith("ARRAY"), F.array_compact(parts))
        .when(F.col("kind") == "STRING", F.array_compact(F.array(F.when(F.trim(F.try_variant_get("v", "$", "string")) == "", "empty text"))))
        .otherwise(F.array(F.lit("value is neither text nor list")))
    )
    return rows.select(key, "line_key", F.explode(issues).alias("issue"))


def prosody_refs(files: DataFrame, json: str = "json") -> DataFrame:
    """SC16: (voice, ordinal, category, file, text) of a reference manifest."""
    by_voice = F.from_json(F.col(json), "map<string,map<string,struct<file:string,text:string>>>")
    rows = files.select(F.explode(by_voice).alias("voice", "refs")).select(F.lower("voice").alias("voice"), F.posexplode(F.map_entries("refs")).alias("ordinal", "r"))
    return rows.select("voice", "ordinal", F.col("r.key").alias("category"), F.col("r.value.file").alias("file"), F.col("r.value.text").alias("text"))
