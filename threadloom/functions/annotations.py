"""Model output as text: parsing, mapping to columns, and what stands in for a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import clamp

# What an annotation may say; the last entry is what anything else becomes.
LANGUAGES = ["en", "zh", "ja", "ko", "es", "fr", "de", "pt", "ru", "other"]
CLASSIFICATIONS = ["emergent_issue", "common_issue", "learn_microsoft", "faq", "good_trivia", "bad_trivia", "custom_code", "not_usable"]
RESOLUTIONS = ["solved", "workaround", "unsolved", "unknown"]

SCHEMA = (
    "language string, product string, classification string, resolution_status string, solution_usefulness double, is_emergent string, "
    "emergent_signal double, emergent_signal_text string, topic_cluster_key string, scenario_cluster_key string, variant_cluster_key string, "
    "resolution_leaf_key string, signature_text string, resolution_signature_text string"
)


def parse_object(c: Column) -> Column:
    """struct(body, error): the JSON object in a model's output, fenced or within other text, and why there is none."""
    t = F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\A\s+|\s+\z", "")), r"\A```[a-zA-Z]*\s*", ""), r"\s*```\z", "")
    whole = F.try_parse_json(t)
    is_object = lambda v: F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    inner = F.regexp_extract(t, r"(?s)\{.*\}", 0)
    part = F.try_parse_json(F.nullif(inner, F.lit("")))
    body = F.when(is_object(whole), t).when(whole.isNull() & is_object(part), inner)
    error = (
        F.when(t == "", "empty_model_output").when(is_object(whole), F.lit(None)).when(whole.isNotNull(), "json_not_object").when(inner == "", "json_parse_failed")
        .when(part.isNull(), "json_extract_parse_failed").when(~is_object(part), "json_extract_not_object"))
    return F.struct(body.alias("body"), error.alias("error"))


def _one_of(c: Column, allowed: list[str], other: str) -> Column:
    return F.when(c.isin(*allowed), c).otherwise(F.lit(other))


def annotation_columns(rows: DataFrame, output: str = "output") -> DataFrame:
    """Typed columns of annotations: whitelists, clamps, and keys that default from the level above."""
    parsed = rows.withColumn("_p", parse_object(F.col(output))).withColumn("_j", F.from_json(F.col("_p.body"), SCHEMA))
    j = lambda k: F.nullif(F.trim(F.col(f"_j.{k}")), F.lit(""))
    ok = F.col("_p.error").isNull()
    product = F.substring(F.coalesce(j("product"), F.lit("Other")), 1, 64)
    topic = F.substring(F.coalesce(j("topic_cluster_key"), F.concat(product, F.lit(":unknown"))), 1, 200)
    scenario = F.substring(F.coalesce(j("scenario_cluster_key"), topic), 1, 250)
    variant = F.substring(F.coalesce(j("variant_cluster_key"), scenario), 1, 300)
    leaf = F.substring(F.coalesce(j("resolution_leaf_key"), F.concat(variant, F.lit("__unknown"))), 1, 350)
    # A JSON true, or any text but the empty one, "false" in quotation marks as well.
    quoted = F.col("_p.body").rlike(r'"is_emergent"\s*:\s*"[^"]')
    emergent = quoted | F.coalesce(F.col("_j.is_emergent") == "true", F.lit(False))
    use = clamp(F.coalesce(F.col("_j.solution_usefulness"), F.lit(0.0)), 0.0, 1.0)
    return parsed.select(
        "thread_id", F.col("_p.error").alias("parse_error"),
        F.when(ok, _one_of(j("language"), LANGUAGES, "other")).alias("language"), F.when(ok, product).alias("product"),
        F.when(ok, _one_of(j("classification"), CLASSIFICATIONS, "not_usable")).otherwise(F.lit("not_usable")).alias("classification"),
        F.when(ok, _one_of(j("resolution_status"), RESOLUTIONS, "unknown")).otherwise(F.lit("unknown")).alias("resolution_status"),
        F.when(ok, use).otherwise(F.lit(0.0)).alias("usefulness"), F.when(ok, emergent).otherwise(F.lit(False)).alias("is_emergent"),
        F.when(ok & emergent, clamp(F.col("_j.emergent_signal"), 0.0, 1.0)).alias("emergent_signal"),
        F.when(ok, topic).otherwise(F.lit("")).alias("topic_key"), F.when(ok, scenario).otherwise(F.lit("")).alias("scenario_key"),
        F.when(ok, variant).otherwise(F.lit("")).alias("variant_key"), F.when(ok, leaf).otherwise(F.lit("")).alias("leaf_key"))


def annotate_by_rules(threads: DataFrame, topics: DataFrame, least: float = 0.2) -> DataFrame:
    """A deterministic stand-in for a model: the topic of most common words, or NO_MATCH; as JSON text in `output`.

    Words link threads and topics; a pair without a common word is never compared.
    """
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+"), lambda x: x != ""))
    a = threads.select("thread_id", words(F.col("signature_text")).alias("tw"))
    b = topics.select("topic_key", words(F.concat_ws(" ", "topic_key", "signature_text")).alias("kw"))
    pairs = a.withColumn("w", F.explode("tw")).join(b.withColumn("w", F.explode("kw")), "w").groupBy("thread_id", "topic_key").agg(
        (F.count("*") / F.first(F.size("tw") + F.size("kw"))).alias("share"))
    score = F.col("share") / (1 - F.col("share"))
    best = pairs.withColumn("score", score).where(F.col("score") >= least).groupBy("thread_id").agg(F.max_by("topic_key", F.struct("score", "topic_key")).alias("topic_key"))
    out = threads.select("thread_id").join(best, "thread_id", "left")
    return out.select("thread_id", F.to_json(F.struct(F.coalesce("topic_key", F.lit("NO_MATCH")).alias("topic_cluster_key"))).alias("output"))


def replay(threads: DataFrame, recorded: DataFrame) -> DataFrame:
    """Recorded outputs in place of a model."""
    return threads.select("thread_id").join(recorded.select("thread_id", "output"), "thread_id", "left")
