"""Roll-ups over the four-level catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .predicates import non_blank

LEVELS = {1: ("topic_id", "topic_key"), 2: ("scenario_id", "scenario_key"), 3: ("variant_id", "variant_key"), 4: ("leaf_id", "leaf_key")}


def fk_or_key_matches(threads: DataFrame, nodes: DataFrame, fk: str, key: str) -> DataFrame:
    """(cluster_id, thread_id, usefulness) of threads that name a node by id or by (product, key).

    The disjunction is a union of two equi-joins: joined as it stands, it would compare all pairs. `threads` has a row for
    each thread; what a thread's id found already, its key doesn't find again, so nothing has to be made distinct.
    """
    t = threads.where(non_blank("product")).select("thread_id", "usefulness", "product", fk, key)
    by_id = t.join(nodes.select("cluster_id"), F.col(fk) == F.col("cluster_id"))
    n = nodes.select("cluster_id", F.col("product").alias("_p"), F.col("cluster_key").alias("_k"))
    by_key = t.join(n, (F.col("product") == F.col("_p")) & (F.col(key) == F.col("_k"))).where(~F.col("cluster_id").eqNullSafe(F.col(fk)))
    cols = ["cluster_id", "thread_id", "usefulness"]
    return by_id.select(cols).union(by_key.select(cols))


def level_matches(threads: DataFrame, catalog: DataFrame) -> DataFrame:
    """(cluster_id, up, n, best): numbers of threads that name a node of any level by id or by (product, key).

    `threads` has a row for each thread. It is read once: each thread gives a row for each level, and threads that name the
    same things there are counted together before anything is joined, so a node that many threads name meets a few rows.
    These join the nodes by name; where a node is named both ways, its key doesn't count. up: the node's parent, if the node
    is active; best: the largest usefulness, a missing one counting 0.
    """
    levels = F.array(*(F.struct(F.lit(level).alias("level"), F.col(fk).cast("long").alias("fk"), F.col(key).alias("key")) for level, (fk, key) in LEVELS.items()))
    t = threads.where(non_blank("product")).select("product", "usefulness", F.explode(levels).alias("_l")).select("product", "usefulness", "_l.*")
    zero = F.lit(0).cast("decimal(4,3)")
    t = t.groupBy("level", "fk", "product", "key").agg(F.count("*").alias("n"), F.max(F.coalesce("usefulness", zero)).alias("best"))
    names = F.array(F.when(F.col("fk").isNotNull(), _name("id", F.col("level"), F.col("fk"))), F.when(F.col("key").isNotNull(), _name("key", F.col("level"), F.col("product"), F.col("key"))))
    t = t.select("fk", "n", "best", F.explode(F.array_compact(names)).alias("_n")).select("fk", "n", "best", "_n.*")
    level = F.col("cluster_level").cast("int")
    by_id = _name("id", level, F.col("cluster_id").cast("long"))
    by_key = F.when(F.col("product").isNotNull() & F.col("cluster_key").isNotNull(), _name("key", level, F.col("product"), F.col("cluster_key")))
    nodes = catalog.where(F.col("cluster_level").isin(*LEVELS)).select("cluster_id", active_parent().alias("up"), F.explode(F.array_compact(F.array(by_id, by_key))).alias("_n"))
    both = t.join(nodes.select("cluster_id", "up", "_n.*"), ["h", "g", "kind"])
    return both.where((F.col("kind") == "id") | ~F.col("cluster_id").eqNullSafe(F.col("fk"))).select("cluster_id", "up", "n", "best")


def _name(kind: str, level: Column, *parts: Column) -> Column:
    """128 bits for a name of a node: two numbers are dealt and sorted faster than the text."""
    return F.struct(F.xxhash64(F.lit(kind), level, *parts).alias("h"), F.xxhash64(*parts, level, F.lit(kind)).alias("g"), F.lit(kind).alias("kind"))


def active_parent() -> Column:
    return F.when(F.col("is_active"), F.col("parent_id"))


def with_lines(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Adds `to`: for each row (cluster_id, up) the node and its ancestors, as far as a line of active nodes leads.

    Only nodes that can be reached are looked up: those of levels 2 and 3 for the second step, of level 2 for the third.
    """
    out, last = rows, "up"
    for k, levels in ((2, (2, 3)), (3, (2,))):
        nodes = catalog.where(F.col("cluster_level").isin(*levels)).select(F.col("cluster_id").alias("_id"), active_parent().alias(f"_{k}"))
        out = out.join(nodes, F.col(last) == F.col("_id"), "left").drop("_id")
        last = f"_{k}"
    return out.withColumn("to", F.explode(F.array_compact(F.array("cluster_id", "up", "_2", "_3"))))


def rollup_levels(threads: DataFrame, catalog: DataFrame) -> DataFrame:
    """Member counts and best usefulness of every node.

    A node's best is the larger of its own threads' and its active children's, whichever exist; so a node's own best goes
    to all nodes that a line of active ones leads to, and one aggregate serves all levels.
    """
    direct = level_matches(threads, catalog).groupBy("cluster_id", "up").agg(F.sum("n").alias("members"), F.max("best").alias("best"))
    spread = with_lines(direct, catalog)
    own = F.when(F.col("to") == F.col("cluster_id"), F.col("members"))
    rolled = spread.groupBy(F.col("to").alias("_to")).agg(F.sum(own).alias("_members"), F.max("best").alias("max_usefulness"))
    nodes = catalog.where(F.col("cluster_level").isin(*LEVELS)).select("cluster_id", "cluster_level", "product", "cluster_key", "parent_id", "is_active", "last_seen")
    out = nodes.join(rolled, F.col("cluster_id") == F.col("_to"), "left")
    return out.select(*nodes.columns, F.coalesce("_members", F.lit(0)).cast("long").alias("member_count"), "max_usefulness")


def sum_members(catalog: DataFrame, memberships: DataFrame) -> DataFrame:
    """Leaf counts from memberships, summed upwards through the parents."""
    leaf = memberships.groupBy(F.col("leaf_id").alias("cluster_id")).agg(F.countDistinct("thread_id").alias("members"))
    own = catalog.select("cluster_id", "cluster_level", "parent_id")
    now = own.where("cluster_level = 4").join(leaf, "cluster_id").select("cluster_id", "parent_id", "members")
    out = now
    for level in (3, 2, 1):
        up = now.groupBy(F.col("parent_id").alias("cluster_id")).agg(F.sum("members").alias("members"))
        now = own.where(F.col("cluster_level") == level).join(up, "cluster_id").select("cluster_id", "parent_id", "members")
        out = out.unionByName(now)
    return out.select("cluster_id", "members")


def exclusive_groups(rows: DataFrame, group: str, member: str, value) -> DataFrame:
    """Groups all of whose rows carry `value` in `member`: one aggregate, no second scan."""
    inside = F.count_if(F.coalesce(F.col(member) == value, F.lit(False)))
    return rows.groupBy(group).agg(inside.alias("inside"), F.count("*").alias("total")).where("inside = total and inside > 0")


def with_ancestors(nodes: DataFrame, catalog: DataFrame) -> DataFrame:
    """Adds the keys of the ancestors (depth is at most four: three joins); an inactive ancestor ends the chain."""
    out = nodes
    child = "parent_id"
    for k in (1, 2, 3):
        up = catalog.where("is_active").select(F.col("cluster_id").alias(f"_id{k}"), F.col("cluster_key").alias(f"up{k}_key"), F.col("parent_id").alias(f"_parent{k}"))
        out = out.join(up, F.col(child) == F.col(f"_id{k}"), "left")
        child = f"_parent{k}"
    return out.drop("_id1", "_id2", "_id3", "_parent1", "_parent2", "_parent3")


def first_of(rows: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """One row of each key: the first in the given order, else by the values of the other columns, so that runs agree."""
    plain = [c for c, t in rows.dtypes if c not in keys and "map<" not in t and "variant" not in t]
    w = Window.partitionBy(*keys).orderBy(*(order or []), *(plain or keys))
    return rows.withColumn("_first", F.row_number().over(w)).where("_first = 1").drop("_first")


def top_n(rows: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """First n rows of each key in the given order, numbered in `rn`."""
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rn") <= n)


def ancestor_lines(nodes: DataFrame, key: str = "cluster_id", up: str = "parent_id", hops: int = 10) -> DataFrame:
    """(key, ancestors): the line of ancestors of every node, the nearest first, at most `hops` of them.

    A line ends at a node without a parent, at a parent that isn't in the table, and before a node that it has met (the node
    itself included): cycles are left where they close. Lines are doubled: in each round a node's line is continued by that
    of its last ancestor, so ten hops take four joins, whatever the number of nodes.
    """
    have = nodes.select(F.col(key).alias("_id")).distinct()
    lines = first_of(nodes.select(F.col(key).alias("_id"), F.col(up).alias("_up")), ["_id"])
    lines = lines.join(have.select(F.col("_id").alias("_found")), F.col("_up") == F.col("_found"), "left")
    lines = lines.select("_id", F.filter(F.array("_found"), lambda x: x.isNotNull()).alias("_line"))
    reach = 1
    while reach < hops:
        rest = lines.select(F.col("_id").alias("_last"), F.col("_line").alias("_more"))
        lines = lines.join(rest, F.try_element_at("_line", F.lit(-1)) == F.col("_last"), "left")
        lines = lines.select("_id", F.when(F.col("_more").isNull(), F.col("_line")).otherwise(F.concat("_line", "_more")).alias("_line"))
        reach *= 2
    line = F.slice("_line", 1, hops)
    places = F.when(F.size(line) > 0, F.sequence(F.lit(1), F.size(line)))
    repeated = F.filter(places, lambda i: (F.element_at(line, i) == F.col("_id")) | (F.array_position(line, F.element_at(line, i)) < i))
    clean = F.when(F.size(repeated) > 0, F.slice(line, F.lit(1), F.element_at(repeated, 1) - 1)).otherwise(line)
    return lines.select(F.col("_id").alias(key), clean.alias("ancestors"))
