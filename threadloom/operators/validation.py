"""Checks of model output against what was asked for, and merges of partial answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .rollup import first_of

# The states that an incident may be given.
INCIDENT_STATUSES = ("active", "investigating", "mitigated", "resolved", "by-design", "false-positive", "archived")

#: What a thread is assigned, from the widest group to the narrowest.
KEYS = ["topic_key", "scenario_key", "variant_key", "leaf_key"]


def coverage(expected: DataFrame, answers: DataFrame, what: str = "assignments") -> DataFrame:
    """(batch, error): missing_<what>:n before extra_<what>:n, null where every expected id is answered and no other."""
    e = expected.select("batch", "thread_id").distinct().withColumn("_e", F.lit(1))
    a = answers.select("batch", "thread_id").distinct().withColumn("_a", F.lit(1))
    both = e.join(a, ["batch", "thread_id"], "full_outer")
    counts = both.groupBy("batch").agg(F.count_if(F.col("_a").isNull()).alias("missing"), F.count_if(F.col("_e").isNull()).alias("extra"))
    tag = lambda name: F.concat(F.lit(f"{name}_{what}:"), F.col(name).cast("string"))
    return counts.select("batch", F.when(F.col("missing") > 0, tag("missing")).when(F.col("extra") > 0, tag("extra")).alias("error"))


def last_answer(answers: DataFrame, key: str = "thread_id", at: str = "pos") -> DataFrame:
    """Of several answers for one id, the last."""
    rest = [c for c in answers.columns if c != key]
    best = answers.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(at)).alias("_x"))
    return best.select(key, *(F.col(f"_x.{c}").alias(c) for c in rest))


def soft_coverage(expected: DataFrame, answers: DataFrame) -> DataFrame:
    """Every expected id with its answer or null; answers for other ids are ignored."""
    return expected.join(last_answer(answers), "thread_id", "left")


def resolve_assignments(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Walks topic, scenario, variant and leaf keys down the catalog by (product, level, key, parent); says how far it came."""
    active = catalog.where("is_active")
    out = rows
    parent = None
    for level, name in ((1, "topic"), (2, "scenario"), (3, "variant"), (4, "leaf")):
        n = active.where(F.col("cluster_level") == level).groupBy("product", "cluster_key", "parent_id").agg(F.min("cluster_id").alias(f"{name}_cluster"))
        n = n.select(F.col("product").alias("_p"), F.col("cluster_key").alias("_k"), F.col("parent_id").alias("_up"), f"{name}_cluster")
        cond = (F.col("product") == F.col("_p")) & (F.col(f"{name}_key") == F.col("_k"))
        cond = cond & (F.col("_up").isNull() if parent is None else F.col("_up") == F.col(parent))
        out = out.join(n, cond, "left").drop("_p", "_k", "_up")
        parent = f"{name}_cluster"
    none = lambda c: F.coalesce(F.col(c).isin("", "NO_MATCH"), F.lit(True))
    status = (
        F.when(none("topic_key"), "bad_assignment").when(F.col("topic_cluster").isNull(), "missing_topic")
        .when(none("scenario_key"), "assigned_topic_only").when(F.col("scenario_cluster").isNull(), "missing_scenario")
        .when(none("variant_key"), "assigned_topic_scenario").when(F.col("variant_cluster").isNull(), "missing_variant")
        .when(none("leaf_key"), "no_leaf_match").when(F.col("leaf_cluster").isNull(), "missing_leaf").otherwise("assigned"))
    return out.withColumn("status", status)


def nugget_gate(nuggets: DataFrame, catalog: DataFrame) -> DataFrame:
    """Kept nuggets whose reference is the id of an active topic or scenario; its level and key."""
    ref = F.expr("try_cast(cluster_ref as bigint)")
    nodes = catalog.where("is_active and cluster_level <= 2").select(F.col("cluster_id").alias("ref"), F.col("cluster_level").alias("target_level"), "cluster_key")
    return nuggets.where("action = 'keep'").withColumn("ref", ref).join(nodes, "ref")


def staged_merge(seed: DataFrame, *stages: tuple[DataFrame, list[str]]) -> DataFrame:
    """Later stages overwrite the named columns of the rows that they answered; a failed stage leaves what was there."""
    out = seed
    for rows, columns in stages:
        s = rows.select(F.col("thread_id").alias("_k"), *(F.col(c).alias(f"_{c}") for c in columns))
        out = out.join(s, F.col("thread_id") == F.col("_k"), "left")
        out = out.withColumns({c: F.coalesce(f"_{c}", c) for c in columns}).drop("_k", *(f"_{c}" for c in columns))
    return out


def staged_assign(threads: DataFrame, topics: DataFrame, scenarios: DataFrame, leaves: DataFrame, full: DataFrame, most_topics: int = 4, most_scenarios: int = 6) -> DataFrame:
    """(batch, thread_id, topic_key, scenario_key, variant_key, leaf_key, source): batches of threads (batch, thread_id) answered in
    stages, or at once.

    topics (batch, thread_id, topic_key) answer a whole batch, scenarios (…, asked, scenario_key) the threads of a batch with
    the topic `asked`, leaves (…, asked, variant_key, leaf_key) those with a scenario; full (…, all four keys) answers a batch in
    one call. An answer stands if it names exactly the threads it was asked for, the last of a thread's (`pos`) counting. A batch
    whose topics don't stand takes those of its full answer; where its threads fall into more than `most_topics` topics (no topic
    is one), or then into more than `most_scenarios` scenarios, the full answer stands for all stages. A group whose scenario
    or leaf stage doesn't stand keeps what it had. Where a full answer is needed and doesn't stand either, `source` says which
    failed and keys are null.
    """
    stages = {"topic": (topics, ["topic_key"]), "full": (full, KEYS), "scenario": (scenarios, ["asked", "scenario_key"]), "leaf": (leaves, ["asked", "variant_key", "leaf_key"])}
    rows = threads.select("batch", "thread_id", F.lit(True).alias("asked"))
    for stage, (answers, columns) in stages.items():
        rows = rows.unionByName(answers.select("batch", "thread_id", F.struct("pos", *columns).alias(stage)), allowMissingColumns=True)
    return assign_dealt(rows.repartition("batch"), most_topics, most_scenarios)


def assign_dealt(rows: DataFrame, most_topics: int = 4, most_scenarios: int = 6) -> DataFrame:
    """`staged_assign` of rows that hold what is known of a thread: (batch, thread_id, asked, topic, full, scenario, leaf).

    `asked` is true in a row of a thread of the batch; the others are structs of an answer, `pos` first, then its columns, and null
    where the row has none. Any number of rows may speak of a thread. Rows that are dealt by batch aren't dealt again: a batch is
    what one call answers, so its rows are held together and what its groups were told is kept beside each of its threads.
    """
    thread, batch = Window.partitionBy("batch", "thread_id").orderBy("thread_id"), Window.partitionBy("batch")
    every = thread.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    text = lambda c: F.coalesce(F.trim(c), F.lit(""))

    # One row for each thread: its last answers to a batch's stages, and all that were given to groups.
    out = rows.select(
        "batch", "thread_id", F.row_number().over(thread).alias("_row"), F.coalesce(F.max("asked").over(every), F.lit(False)).alias("_asked"),
        *(F.max_by(s, F.col(s)["pos"]).over(every).alias(s) for s in ("topic", "full")), *((F.count(s).over(every) > 0).alias(f"_{s}_said") for s in ("topic", "full")),
        *(F.collect_list(s).over(every).alias(f"_{s}s") for s in ("scenario", "leaf"))).where("_row = 1").drop("_row")
    known = F.col("_asked") & F.col("batch").isNotNull() & F.col("thread_id").isNotNull()  # an answer can't name a null
    odd = lambda s: F.count_if((F.col("_asked") | F.col(f"_{s}_said")) & ~(known & F.col(s).isNotNull())).over(batch)
    out = out.withColumns({"_staged": odd("topic") == 0, "_full": odd("full") == 0})
    out = out.withColumn("source", F.when(~F.col("_staged") & ~F.col("_full"), F.lit("fallback_full_validation_failed")))
    out = out.withColumn("topic_key", text(F.when(F.col("_staged"), F.col("topic.topic_key")).when(F.col("_full"), F.col("full.topic_key"))))

    def stage(rows: DataFrame, group: str, said: str, most: int, none_counts: bool) -> DataFrame:
        """Asks the threads by the column `group`: `_answer` is the last answer of a thread whose group is answered exactly.

        A group is spoilt by a thread that lacks an answer, and by an answer to it for a thread that isn't of it.
        """
        counted = F.when(F.col("_asked") & F.col("source").isNull() & (F.lit(none_counts) | (F.col(group) != "")), F.col(group))
        rows = rows.withColumn("_group", F.when(F.col("_asked") & F.col("source").isNull() & (F.col(group) != ""), F.col(group)))
        rows = rows.withColumn("_answer", F.array_max(F.filter(said, lambda x: (x["asked"] == F.col("_group")) & x["pos"].isNotNull())))
        strange = F.transform(F.filter(said, lambda x: x["asked"].isNotNull() & ~x["asked"].eqNullSafe(F.col("_group"))), lambda x: x["asked"])
        spoils = F.concat(strange, F.when(F.col("_group").isNotNull() & F.col("_answer").isNull(), F.array("_group")).otherwise(F.array().cast("array<string>")))
        rows = rows.withColumn("_spoils", F.when(F.size(spoils) > 0, spoils))
        rows = rows.withColumns({"_groups": F.size(F.collect_set(counted).over(batch)), "_spoilt": F.collect_set("_spoils").over(batch)})
        at_once = F.when(F.col("_full"), F.lit("full")).otherwise(F.lit("full_validation_failed"))
        stands = F.col("_group").isNotNull() & ~F.exists("_spoilt", lambda x: F.array_contains(x, F.col("_group")))
        rows = rows.withColumns({"source": F.when(F.col("source").isNull() & (F.col("_groups") > most), at_once).otherwise(F.col("source")), "_answer": F.when(stands, F.col("_answer"))})
        return rows.drop("_group", "_groups", "_spoils", "_spoilt", said)

    out = stage(out, "topic_key", "_scenarios", most_topics, True).withColumn("scenario_key", text(F.col("_answer")["scenario_key"]))
    out = stage(out, "scenario_key", "_leafs", most_scenarios, False).withColumns({k: text(F.col("_answer")[k]) for k in ("variant_key", "leaf_key")})
    chosen = [F.when(F.col("source").isNull(), F.col(k)).when(F.col("source") == "full", text(F.col("full")[k])).alias(k) for k in KEYS]
    return out.where("_asked").select("batch", "thread_id", *chosen, F.coalesce("source", F.lit("stages")).alias("source"))


def refine(have: DataFrame, drops: DataFrame, keeps: DataFrame, adds: DataFrame, key: str, share: float = 0.85, order: str | None = None) -> DataFrame:
    """Takes out drops; keeps only the keep-list if it holds at least int(share * prior) ids; then adds.

    Of adds with one id the last by the column `order` wins, or without one the last by their values.
    """
    left = have.join(drops.select(key), key, "left_anti")
    gate = left.agg(F.floor(F.count("*") * share).alias("_least")).crossJoin(keeps.join(left, key, "left_semi").agg(F.countDistinct(key).alias("_kept")))
    kept = keeps.select(F.col(key).alias("_k")).distinct()
    chosen = left.join(kept, F.col(key) == F.col("_k"), "left").crossJoin(F.broadcast(gate)).where((F.col("_kept") < F.col("_least")) | F.col("_k").isNotNull())
    chosen = chosen.select(*have.columns)
    return chosen.join(adds.select(key), key, "left_anti").unionByName(first_of(adds, [key], [F.desc(c) for c in ([order] if order else [c for c in have.columns if c != key])]).select(*have.columns))


def refine_until_stable(have: DataFrame, propose, key: str, share: float = 0.85, order: str | None = None, rounds: int = 10) -> tuple[DataFrame, int]:
    """Rounds of `refine` until one leaves the set of ids as the round before did, `rounds` of them at most; and their number.

    `propose(k, rows)` gives drops, keeps and adds for the rows of round k, from 1. A round's rows are written once, which
    cuts their lineage; sets are compared by their size and a 128-bit sum of hashes of their ids, the only thing the driver gets.
    """
    from ..sources.scratch import written

    def mark(rows):
        wide = lambda c: F.sum(c.cast("decimal(38,0)"))
        return tuple(rows.select(key).distinct().agg(F.count("*"), wide(F.xxhash64(key)), wide(F.xxhash64(F.lit(1), key))).first())

    now, before, k = have, None, 0
    while k < rounds:
        k += 1
        now = written(refine(now, *propose(k, now), key, share, order), f"refine-{k}")
        this = mark(now)
        if this == before:
            break
        before = this
    return now, k


def overlay(base: DataFrame, newer: DataFrame, key: str = "thread_id") -> DataFrame:
    """Rows of `newer` stand for those of `base`, field by field where they have a value."""
    rest = [c for c in base.columns if c != key]
    n = newer.select(key, *(F.col(c).alias(f"_{c}") for c in rest))
    out = base.join(n, key, "left")
    return out.select(key, *(F.coalesce(f"_{c}", c).alias(c) for c in rest))


def candidates_to_nodes(rows: DataFrame, order: str) -> DataFrame:
    """(product, level, key, parent_key) of candidates by their level, each once, by level then order."""
    key = F.when(F.col("level") == 1, F.col("topic_key")).when(F.col("level") == 2, F.col("scenario_key")).when(F.col("level") == 3, F.col("variant_key")).otherwise(F.col("leaf_key"))
    up = F.when(F.col("level") == 2, F.col("topic_key")).when(F.col("level") == 3, F.col("scenario_key")).when(F.col("level") == 4, F.col("variant_key"))
    out = rows.withColumn("cluster_key", key).withColumn("parent_key", up)
    w = Window.partitionBy("product", "level", "cluster_key", "parent_key").orderBy(order)
    return out.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def scaffold_parents(rows: DataFrame) -> DataFrame:
    """(product, level, topic_key, scenario_key, variant_key) of the ancestors that candidates of levels 2 to 4 lack."""
    levels = rows.where("level > 1").withColumn("up", F.explode(F.sequence(F.lit(1), F.col("level") - 1)))
    keys = ["topic_key", "scenario_key", "variant_key"]
    cut = levels.select("product", F.col("up").alias("level"), *(F.when(F.col("up") > i, F.col(k)).otherwise(F.lit("")).alias(k) for i, k in enumerate(keys)))
    have = rows.select("product", "level", *(F.when(F.col("level") > i, F.col(k)).otherwise(F.lit("")).alias(k) for i, k in enumerate(keys)))
    return cut.distinct().join(have, ["product", "level", *keys], "left_anti")


def validate_candidates(rows: DataFrame, product: str, aliases: list[str], known_topics: DataFrame, fallback: bool = True) -> DataFrame:
    """The first rule that a candidate breaks, in `skip_reason`; null if none."""
    topics = known_topics.select(F.col("topic_key").alias("_known")).distinct()
    proposed = rows.where("level = 1").select(F.col("topic_key").alias("_known"))
    out = rows.join(topics.union(proposed).distinct(), F.col("topic_key") == F.col("_known"), "left")
    own = F.when(F.col("level") == 1, F.col("topic_key")).when(F.col("level") == 2, F.col("scenario_key")).when(F.col("level") == 3, F.col("variant_key")).otherwise(F.col("leaf_key"))
    empty = lambda c: F.coalesce(F.trim(F.col(c)) == "", F.lit(True))
    lacks = F.lit(False)
    for i, k in enumerate(("topic_key", "scenario_key", "variant_key", "leaf_key")):
        lacks = lacks | ((F.col("level") > i) & empty(k))
    text = F.lit(False) if fallback else (F.col("level") == 4) & empty("resolution_text")
    taken = F.lit(False)
    for a in aliases:
        taken = taken | (own == a) | own.startswith(f"{a}-")
    reason = (
        F.when(F.col("product") != product, "other_product").when(~F.col("level").between(1, 4), "bad_level").when(lacks, "missing_key")
        .when(taken, "product_alias").when((F.col("level") > 1) & F.col("_known").isNull(), "unknown_topic").when(text, "missing_resolution"))
    return out.withColumn("skip_reason", reason).drop("_known")
