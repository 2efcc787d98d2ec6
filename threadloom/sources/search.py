"""A search over documents: BM25 as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.limits import bounded

K1, B = 1.2, 0.75


def search(docs: DataFrame, query: str, top: int = 5) -> DataFrame:
    """(doc_id, score, title, content) of the best documents; top is kept within 1 and 10; doc_id names one document.

    Texts are counted in one scan: the counts, a few numbers for each document, are dealt once, and both the facts of the
    whole and the scores read them. Only the best documents' texts are fetched.
    """
    import re

    top = bounded("search", top=top)["top"]
    words = sorted({w for w in re.split("[^a-z0-9]+", query.lower()) if w})
    # Words are counted where they stand, by how much shorter the text gets without them; no list of words is made.
    spaced = F.trim(F.regexp_replace(F.lower("text"), "[^a-z0-9]+", " "))
    gone = lambda c, part: (F.length(c) - F.length(F.replace(c, F.lit(part), F.lit("")))) / F.lit(len(part))
    doubled = F.concat(F.lit(" "), F.replace(F.col("_s"), F.lit(" "), F.lit("  ")), F.lit(" "))
    rows = docs.select("doc_id", spaced.alias("_s")).select("doc_id", "_s", doubled.alias("_d"))
    n = F.when(F.col("_s") == "", F.lit(0)).otherwise(gone("_s", " ").cast("int") + 1)
    rows = rows.select("doc_id", n.alias("_n"), *(gone("_d", f" {w} ").cast("int").alias(f"_{i}") for i, w in enumerate(words))).repartition("doc_id")
    facts = rows.agg(F.count_if(F.col("_n") > 0).alias("docs"), F.avg(F.when(F.col("_n") > 0, F.col("_n"))).alias("mean"), *(F.count_if(F.col(f"_{i}") > 0).alias(f"df{i}") for i in range(len(words))))
    joined = rows.crossJoin(F.broadcast(facts))  # one row
    score = F.lit(0.0)
    for i in range(len(words)):
        tf, df = F.col(f"_{i}"), F.col(f"df{i}")
        idf = F.log1p((F.col("docs") - df + 0.5) / (df + 0.5))
        score = score + F.when(tf > 0, idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("_n") / F.col("mean")))).otherwise(0.0)
    best = joined.select("doc_id", F.round(score, 6).alias("score")).where(F.col("score") > 0).orderBy(F.desc("score"), "doc_id").limit(top)
    out = docs.join(F.broadcast(best), "doc_id")  # at most ten rows
    return out.select("doc_id", "score", F.substring("text", 1, 200).alias("title"), F.substring("text", 1, 1400).alias("content")).orderBy(F.desc("score"), "doc_id")
