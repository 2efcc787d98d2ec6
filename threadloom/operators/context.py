"""Nested texts for prompts and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import markdown_list

_LINK = r"\[\[([^\]]+)\]\]"


def resolve_wiki_links(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """[[key]] and [[display|key]] become links to the active node with the largest id of those with the key and a path.

    Texts are cut at links, links joined to the catalog, and the pieces put together again by place.
    """
    targets = catalog.where("is_active and wiki_path is not null").groupBy("cluster_key").agg(F.max_by("wiki_path", "cluster_id").alias("path"))
    segments = F.transform(F.split("path", "/"), lambda s: F.replace(F.url_encode(s), F.lit("+"), F.lit("%20")))
    targets = targets.select(F.col("cluster_key").alias("_key"), F.array_join(segments, "/").alias("path"))
    found = F.regexp_extract_all("text", F.lit(_LINK), 1)
    plain = F.split(F.regexp_replace("text", _LINK, "\u0001"), "\u0001")
    pieces = rows.select("cluster_id", F.posexplode(F.arrays_zip(plain.alias("before"), found.alias("link"))).alias("pos", "p"))
    pieces = pieces.select("cluster_id", "pos", F.col("p.before").alias("before"), F.col("p.link").alias("link"))
    key = F.trim(F.substring_index("link", "|", -1))
    shown = F.trim(F.substring_index("link", "|", 1))
    joined = pieces.withColumn("key", key).join(targets, F.col("key") == F.col("_key"), "left")
    link = F.when(F.col("link").isNull(), F.lit("")).when(F.col("path").isNull(), shown).otherwise(F.concat(F.lit("["), shown, F.lit("]("), "path", F.lit(")")))
    out = joined.groupBy("cluster_id").agg(F.sort_array(F.collect_list(F.struct("pos", F.concat(F.coalesce("before", F.lit("")), link).alias("t")))).alias("x"))
    return out.select("cluster_id", F.array_join(F.transform("x", lambda v: v["t"]), "").alias("text"))


def playbook(title: Column, problem: Column, steps: Column, checks: Column) -> Column:
    """A page of fixed sections; an empty one says so."""
    shown = lambda c: F.when(c == "", F.lit("- none given")).otherwise(c)
    return F.concat(F.lit("# "), title, F.lit("\n\n## Problem\n"), shown(F.coalesce(problem, F.lit(""))), F.lit("\n\n## Resolution\n"), shown(markdown_list(steps, ordered=True)), F.lit("\n\n## Validation\n"), shown(markdown_list(checks)))
