"""What a model is given: payloads cut to each stage's lengths, context blocks, diagnostic bundles, and what batches carry over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .selection import pages_of

# How much of a thread's texts each stage sends, in characters.
LENGTHS = {
    "catalog": {"signature_text": 700, "resolution_text": 700},
    "assign": {"signature_text": 900, "resolution_text": 900},
    "emergent_assign": {"signature_text": 600, "resolution_text": 400},
    "detect": {"signature_text": 900, "resolution_text": 900},
    "mining": {"signature_text": 500, "resolution_text": 500, "content": 3200},
}


def cut(column: str, most: int) -> Column:
    return F.substring(F.coalesce(F.col(column), F.lit("")), 1, most)


def thread_payload(stage: str, more: dict[str, Column] | None = None) -> Column:
    """A thread as a stage sends it: its id, its texts cut to the stage's lengths, and further fields."""
    texts = [cut(c, n).alias(c) for c, n in LENGTHS[stage].items()]
    return F.struct(F.coalesce(F.col("thread_id").cast("string"), F.lit("")).alias("thread_id"), *texts, *(v.alias(k) for k, v in (more or {}).items()))


def batch_payloads(threads: DataFrame, stage: str, order: list, size: int, more: dict[str, Column] | None = None) -> DataFrame:
    """(product, page, payload): each product's threads in batches of `size`, a JSON object for each."""
    paged = pages_of(threads, order, size, ["product"])
    lists = paged.groupBy("product", "page").agg(F.sort_array(F.collect_list(F.struct("rn", thread_payload(stage, more).alias("t")))).alias("x"))  # `size` threads
    return lists.select("product", "page", F.to_json(F.struct("product", F.transform("x", lambda v: v["t"]).alias("threads"))).alias("payload"))


def some_of(items: Column, most: int, length: int) -> Column:
    """The first items, each cut, in one line."""
    return F.array_join(F.transform(F.slice(items, 1, most), lambda s: F.substring(s, 1, length)), "; ")


def leaf_block(place: Column, symptoms: Column, checks: Column, solution: Column) -> Column:
    """A leaf of a variant's context (cluster_key, wiki_path, signature_text, resolution_text, member_count, title)."""
    line = lambda head, items, most, length: F.when(F.size(items) > 0, F.concat(F.lit(f"  {head}: "), some_of(items, most, length), F.lit("\n"))).otherwise("")
    state = F.when(F.coalesce(F.col("wiki_path"), F.lit("")) != "", "on the wiki").otherwise("not on the wiki")
    head = F.concat(F.lit("LEAF "), place.cast("string"), F.lit(": "), F.coalesce(F.col("cluster_key"), F.lit("?")), F.lit(" ["), state, F.lit("]\n  Signature: "), cut("signature_text", 200), F.lit("\n  Fix: "), cut("resolution_text", 200), F.lit("\n  Members: "), F.coalesce(F.col("member_count"), F.lit(0)).cast("string"), F.lit("\n"))
    title = F.when(F.coalesce(F.col("title"), F.lit("")) != "", F.concat(F.lit("  Playbook: "), "title", F.lit("\n"))).otherwise("")
    return F.concat(head, title, line("Symptoms", symptoms, 5, 120), line("Checks", checks, 4, 120), line("Solution", solution, 3, 100))


def problem_text(symptoms: Column, checks: Column) -> Column:
    """The first ten symptoms and checks as lists; a part without any is left out."""
    part = lambda head, items: F.when(F.size(items) > 0, F.concat(F.lit(f"{head}\n- "), F.array_join(F.slice(items, 1, 10), "\n- "), F.lit("\n"))).otherwise("")
    return F.concat(part("Symptoms:", symptoms), part("\nChecks:", checks))


BUNDLE = ["symptoms", "anti_symptoms", "checks", "solution", "verification", "flows", "notes"]


def diagnostic_bundle(lists: dict[str, Column], threads: Column, docs: Column) -> Column:
    """The seven lists of a diagnosis (missing ones empty), the threads it rests on and the documents found, as JSON."""
    none = F.array().cast("array<string>")
    return F.to_json(F.struct(*(F.coalesce(lists.get(k, none), none).alias(k) for k in BUNDLE), threads.alias("source_threads"), docs.alias("docs")))


def carried_over(batches: DataFrame, most: int, key: str = "topic_key") -> DataFrame:
    """(product, page, place, key): what each batch (product, page) is given of the keys that earlier batches of its product have
    settled, in the order in which they came, the newest `most` of them."""
    firsts = batches.groupBy("product", key).agg(F.min("page").alias("_first"))
    pages = batches.select("product", "page").distinct()
    f = firsts.select(F.col("product").alias("_p"), key, "_first")
    known = pages.join(f, (F.col("product") == F.col("_p")) & (F.col("_first") < F.col("page")))
    newest = Window.partitionBy("product", "page").orderBy(F.desc("_first"), F.desc(key))
    kept = known.withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= most)
    place = F.row_number().over(Window.partitionBy("product", "page").orderBy("_first", key))
    return kept.select("product", "page", place.alias("place"), key)
