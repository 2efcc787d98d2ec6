"""Candidate selection: top-k, per-group top-k, claiming and paging. Every order ends in an id, so that ties are settled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import numbered, numbered_by
from .predicates import non_blank
from .rollup import top_n


def newest_product(eligible: DataFrame, exclude: list[str] = ()) -> DataFrame:
    """Product of the newest eligible row."""
    rows = eligible.where(~F.col("product").isin(*exclude)) if exclude else eligible
    return rows.orderBy(F.desc("created_on"), F.desc("thread_id")).limit(1).select("product")


def pages_of(rows: DataFrame, order: list, size: int, by: list[str] | None = None) -> DataFrame:
    """Numbers every row and its page: what a loop of keyset pages fetches, of the whole table or of each value of `by`."""
    out = numbered_by(rows, by, order) if by else numbered(rows, order)
    return out.withColumn("page", F.floor((F.col("rn") - 1) / size).cast("long"))


def claim(rows: DataFrame, eligible: Column, order: list, n: int, now) -> tuple[DataFrame, DataFrame]:
    """The n rows taken, and the table with their start noted."""
    taken = rows.where(eligible).orderBy(*order).limit(n)
    ids = taken.select(F.col("thread_id").alias("_id"))
    marked = rows.join(ids, F.col("thread_id") == F.col("_id"), "left")
    return taken, marked.withColumn("started_on", F.when(F.col("_id").isNotNull(), F.lit(now)).otherwise(F.col("started_on"))).drop("_id")


def round_robin(eligible: DataFrame, order: list, size: int, cap: int) -> DataFrame:
    """Batches of each product in turn: (round, product, thread_id), at most `cap` rounds."""
    w = Window.partitionBy("product").orderBy(*order)
    out = eligible.withColumn("round", F.floor((F.row_number().over(w) - 1) / size).cast("long"))
    return out.where(F.col("round") < cap).select("round", "product", "thread_id")


def leaf_candidates(catalog: DataFrame, solutions: DataFrame, members: int, usefulness: float, n: int) -> DataFrame:
    """Active leaves without a solution that are large and useful enough, or very useful."""
    enough = (F.col("member_count") >= members) & (F.col("max_usefulness") >= F.lit(str(usefulness)).cast("decimal(4,3)"))
    good = enough | (F.col("max_usefulness") >= F.lit("0.9").cast("decimal(4,3)"))
    rows = catalog.where((F.col("cluster_level") == 4) & F.col("is_active") & good)
    rows = rows.join(solutions.select("cluster_id"), "cluster_id", "left_anti")
    return rows.orderBy(F.desc("max_usefulness"), F.desc("member_count"), F.desc("last_seen"), "cluster_id").limit(n)


def with_leafless_threads(catalog: DataFrame, threads: DataFrame, solutions: DataFrame, level: int, n: int) -> DataFrame:
    """Active nodes of a level with a thread that has no leaf, and without a solution."""
    fk = {2: "scenario_id", 3: "variant_id"}[level]
    loose = threads.where("started_on is null").select(F.col(fk).alias("cluster_id")).where("cluster_id is not null")
    rows = catalog.where((F.col("cluster_level") == level) & F.col("is_active")).join(loose, "cluster_id", "left_semi")
    rows = rows.join(solutions.select("cluster_id"), "cluster_id", "left_anti")
    return rows.orderBy(F.desc("max_usefulness"), F.desc("member_count"), F.desc("last_seen"), "cluster_id").limit(n)


def top_threads(threads: DataFrame, node: str, n: int) -> DataFrame:
    """The most useful threads of every node, newest first among equals."""
    return top_n(threads.where(F.col(node).isNotNull()), [node], [F.desc_nulls_last("usefulness"), F.desc("created_on"), "thread_id"], n)


def top_children(catalog: DataFrame, level: int, n: int) -> DataFrame:
    """The largest active children of every node, all parents in one pass."""
    rows = catalog.where((F.col("cluster_level") == level) & F.col("is_active") & F.col("parent_id").isNotNull())
    return top_n(rows, ["parent_id"], [F.desc("member_count"), F.desc("max_usefulness"), "cluster_id"], n)


def variant_pages(catalog: DataFrame, solutions: DataFrame, members: int, usefulness: float, n: int) -> DataFrame:
    """Variants without a page that pass the thresholds; those with a solved leaf first."""
    solved = catalog.where("cluster_level = 4 and is_active").join(solutions.select("cluster_id"), "cluster_id", "left_semi")
    solved = solved.select(F.col("parent_id").alias("cluster_id")).distinct().withColumn("has_solution", F.lit(1))
    rows = catalog.where((F.col("cluster_level") == 3) & F.col("is_active") & F.col("wiki_path").isNull() & (F.col("member_count") >= members) & (F.col("max_usefulness") >= F.lit(str(usefulness)).cast("decimal(4,3)")))
    rows = rows.join(solved, "cluster_id", "left").withColumn("has_solution", F.coalesce("has_solution", F.lit(0)))
    return rows.orderBy(F.desc("has_solution"), F.desc("member_count"), F.desc("last_seen"), "cluster_id").limit(n)


def parent_pages(catalog: DataFrame, level: int, members: int, child: Column, n: int) -> DataFrame:
    """Nodes of a level without a page, large enough, with an active child that meets a condition."""
    kids = catalog.where((F.col("cluster_level") == level + 1) & F.col("is_active") & child).select(F.col("parent_id").alias("cluster_id"))
    rows = catalog.where((F.col("cluster_level") == level) & F.col("is_active") & F.col("wiki_path").isNull() & (F.col("member_count") >= members))
    return rows.join(kids, "cluster_id", "left_semi").orderBy(F.desc("member_count"), F.desc("last_seen"), "cluster_id").limit(n)


def orphans(results: DataFrame, n: int = 12) -> DataFrame:
    """Useful threads that found no leaf."""
    rows = results.where(F.col("status").isin("no_leaf_match", "missing_leaf") & (F.col("usefulness") > F.lit("0.4").cast("decimal(4,3)")))
    return rows.orderBy(F.desc("usefulness"), "thread_id").limit(n)


def circular_window(rows: DataFrame, order: list, start: int, size: int) -> DataFrame:
    """`size` rows from place start modulo n, going round: a numbered pass and one count."""
    placed = numbered(rows, order, "_rn")
    counted = placed.crossJoin(F.broadcast(placed.agg(F.count("*").alias("_n"))))  # one row
    turn = F.pmod(F.col("_rn") - 1 - F.pmod(F.lit(start), F.col("_n")), F.col("_n"))
    return counted.withColumn("turn", turn).where(F.col("turn") < size).drop("_rn", "_n")


def eligible_signature(rows: DataFrame) -> DataFrame:
    return rows.where(non_blank("signature_text"))
