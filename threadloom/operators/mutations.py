"""Upserts, merges and state changes as functions of snapshots: (table, changes, now) -> table.

A full-outer join on the key stands for insert-or-update; what was there before is kept with coalesce or when.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import numbered
from .rollup import first_of


def upsert(base: DataFrame, changes: DataFrame, key: str | list[str], keep: dict[str, Column] | None = None) -> DataFrame:
    """Rows of `changes` replace or join those of `base`; `keep` overrides columns, over b.<col>, c.<col> and `matched`."""
    keys = [key] if isinstance(key, str) else key
    b, c = base.withColumn("_b", F.lit(True)).alias("b"), changes.withColumn("_c", F.lit(True)).alias("c")
    cond = [F.col(f"b.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    joined = b.join(c, cond, "full_outer")
    changed = F.col("c._c").isNotNull()
    out = []
    for name in base.columns:
        if name in keys:
            out.append(F.coalesce(F.col(f"b.{name}"), F.col(f"c.{name}")).alias(name))
        elif keep and name in keep:
            out.append(keep[name].alias(name))
        elif name in changes.columns:
            out.append(F.when(changed, F.col(f"c.{name}")).otherwise(F.col(f"b.{name}")).alias(name))
        else:
            out.append(F.col(f"b.{name}").alias(name))
    return joined.select(*out)


def matched() -> Column:
    return F.col("b._b").isNotNull() & F.col("c._c").isNotNull()


def count_up(base: DataFrame, changes: DataFrame, key: str, counter: str, seen: str, now) -> DataFrame:
    """Adds the number of changes of each key to its counter and notes when it was seen."""
    grouped = changes.groupBy(key).agg(F.count("*").alias(counter)).withColumn(seen, F.lit(now))
    total = F.coalesce(F.col(f"b.{counter}"), F.lit(0)) + F.coalesce(F.col(f"c.{counter}"), F.lit(0))
    return upsert(base, grouped, key, {counter: total, seen: F.coalesce(F.col(f"c.{seen}"), F.col(f"b.{seen}"))})


def insert_absent(base: DataFrame, rows: DataFrame, key: str | list[str]) -> DataFrame:
    """Adds the rows whose key isn't there yet, each key once, of several the first by their values."""
    keys = [key] if isinstance(key, str) else key
    new = first_of(rows, keys).join(base.select(*keys), keys, "left_anti")
    return base.unionByName(new.select(*base.columns))


def fold_aliases(pairs: list[tuple[str, str]]) -> dict[str, str]:
    """What a chain of ordered renames does to each name: a later pair sees what earlier ones wrote."""
    out: dict[str, str] = {}
    for alias, product in pairs:
        for k, v in out.items():
            if v == alias:
                out[k] = product
        out.setdefault(alias, product)
    return {k: v for k, v in out.items() if k != v}


def backfill_aliases(rows: DataFrame, pairs: list[tuple[str, str]], name: str = "product") -> DataFrame:
    """Renames by an ordered list of (alias, product), a short configuration."""
    renames = fold_aliases(pairs)
    if not renames:
        return rows
    table = F.create_map(*(F.lit(x) for kv in renames.items() for x in kv))
    return rows.withColumn(name, F.coalesce(F.try_element_at(table, F.col(name)), F.col(name)))


def rename_product(rows: DataFrame, old: str, new: str, name: str = "product") -> DataFrame:
    return rows.withColumn(name, F.when(F.col(name) == old, F.lit(new)).otherwise(F.col(name)))


def merge_products(registry: DataFrame, absorbed: str, into: str) -> DataFrame:
    """Adds the absorbed product's count to the other, takes the later date, and drops it."""
    a = registry.where(F.col("name") == absorbed).select(F.col("thread_count").alias("_n"), F.col("seen").alias("_s"), F.lit(into).alias("_into"))
    out = registry.join(F.broadcast(a.limit(1)), F.col("name") == F.col("_into"), "left")
    later = F.when(F.col("_s") > F.col("seen"), F.col("_s")).otherwise(F.col("seen"))
    return out.where(F.col("name") != absorbed).select("name", (F.col("thread_count") + F.coalesce("_n", F.lit(0))).alias("thread_count"), later.alias("seen"))


def keep_longer(base: DataFrame, changes: DataFrame, keys: list[str], text: str, order: str) -> DataFrame:
    """Replaces a text only by a longer one; trailing blanks don't count. Of several candidates: the longest, the first of equals."""
    size = lambda c: F.length(F.rtrim(c))
    best = changes.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(size(F.col(text))), order))).where("_rn = 1").drop("_rn", order)
    old, new = F.col(f"b.{text}"), F.col(f"c.{text}")
    value = F.when(F.col("b._b").isNull() | (size(new) > size(F.coalesce(old, F.lit("")))), F.coalesce(new, old)).otherwise(old)
    return upsert(base, best, keys, {text: value})


def incident_stats(links: DataFrame) -> DataFrame:
    at = F.coalesce("created_on", "added_on")
    return links.groupBy("incident_id").agg(F.count("*").alias("threads"), F.min(at).alias("first_seen"), F.max(at).alias("last_seen"))


def incident_upsert(base: DataFrame, incoming: DataFrame, links: DataFrame) -> DataFrame:
    """Incoming incidents (incident_id, confidence, last_seen, incoming: threads) over stored ones.

    A greater confidence or a later date replaces a stored one, but never a missing one; the count is that of the
    stored links plus the incoming threads, so threads seen again count twice until the next refresh.
    """
    stored = links.groupBy("incident_id").agg(F.count("*").alias("stored"))
    c = incoming.join(stored, "incident_id", "left").withColumn("thread_count", F.coalesce("stored", F.lit(0)) + F.col("incoming"))
    up = lambda name: F.when(F.col("b._b").isNull(), F.col(f"c.{name}")).when(F.col(f"c.{name}") > F.col(f"b.{name}"), F.col(f"c.{name}")).otherwise(F.col(f"b.{name}"))
    return upsert(base, c, "incident_id", {"confidence": up("confidence"), "last_seen": up("last_seen")})


def incident_lifecycle(incidents: DataFrame, links: DataFrame, stale_from, resolved_from) -> DataFrame:
    """Refresh, then age, resolve and revive, in this order; dates: last seen before which an incident is stale or resolved."""
    stats = incident_stats(links).select("incident_id", F.col("threads").alias("_n"), F.col("first_seen").alias("_first"), F.col("last_seen").alias("_last"))
    out = incidents.join(stats, "incident_id", "left").withColumn("old_status", F.col("status"))
    live = F.col("status").isin("active", "possibly_resolved") & F.col("_n").isNotNull()
    out = out.withColumns({
        "thread_count": F.when(live, F.col("_n")).otherwise(F.col("thread_count")),
        "first_seen": F.when(live & (F.col("_first") < F.col("first_seen")), F.col("_first")).otherwise(F.col("first_seen")),
        "last_seen": F.when(live, F.col("_last")).otherwise(F.col("last_seen")),
    })
    last = F.col("last_seen")
    stale = (F.col("status") == "active") & (last < F.lit(stale_from)) & (last >= F.lit(resolved_from))
    out = out.withColumn("status", F.when(stale, F.lit("possibly_resolved")).otherwise(F.col("status")))
    over = F.col("status").isin("active", "possibly_resolved") & (last < F.lit(resolved_from))
    out = out.withColumn("resolved_on", F.when(over, F.coalesce("resolved_on", F.lit(stale_from))).otherwise(F.col("resolved_on")))
    out = out.withColumn("status", F.when(over, F.lit("resolved")).otherwise(F.col("status")))
    again = (F.col("status") == "resolved") & (last >= F.lit(stale_from))
    out = out.withColumn("resolved_on", F.when(again, F.lit(None)).otherwise(F.col("resolved_on")))
    return out.withColumn("status", F.when(again, F.lit("active")).otherwise(F.col("status"))).drop("_n", "_first", "_last")


def mark(rows: DataFrame, ids: DataFrame, column: str, now, first_write_wins: bool = True, key: str = "thread_id") -> DataFrame:
    """Notes `now` in a column of the named rows."""
    hit = ids.select(F.col(key).alias("_k")).distinct()
    value = F.coalesce(F.col(column), F.lit(now)) if first_write_wins else F.lit(now)
    return rows.join(hit, F.col(key) == F.col("_k"), "left").withColumn(column, F.when(F.col("_k").isNotNull(), value).otherwise(F.col(column))).drop("_k")


def stamp_batch(rows: DataFrame, batch: str, n: int, force: bool = False) -> DataFrame:
    """Gives the first n rows (by id) without a batch, or of other batches if forced, a batch."""
    free = (F.col("batch_id") != batch) if force else F.col("batch_id").isNull()
    ids = rows.where(F.coalesce(free, F.lit(True))).orderBy("thread_id").limit(n).select(F.col("thread_id").alias("_k"))
    return rows.join(ids, F.col("thread_id") == F.col("_k"), "left").withColumn("batch_id", F.when(F.col("_k").isNotNull(), F.lit(batch)).otherwise(F.col("batch_id"))).drop("_k")


def clear_stale_claims(rows: DataFrame, before) -> DataFrame:
    stale = F.col("started_on").isNotNull() & F.col("completed_on").isNull() & (F.col("started_on") < F.lit(before))
    return rows.withColumn("started_on", F.when(stale, F.lit(None)).otherwise(F.col("started_on")))


def reset_states(rows: DataFrame, where: Column, columns: list[str]) -> DataFrame:
    return rows.withColumns({c: F.when(where, F.lit(None)).otherwise(F.col(c)) for c in columns})


def surrogate_ids(rows: DataFrame, keys: list[str], after: DataFrame, id_: str) -> DataFrame:
    """Ids for new keys: the largest there is plus the rank of the key."""
    top = after.agg(F.coalesce(F.max(id_), F.lit(0)).alias("_top"))
    ranked = numbered(rows, keys, "_rn")
    return ranked.crossJoin(F.broadcast(top)).withColumn(id_, F.col("_top") + F.col("_rn")).drop("_top", "_rn")


def get_or_create_nodes(catalog: DataFrame, wanted: DataFrame, level: int, phase: str, lanes: tuple = ("own", "none")) -> DataFrame:
    """New nodes of a level for `wanted` (product, cluster_key, parent_key, signature_text).

    A key that an active node of the product and level has is taken as it is, whatever its parent. The parent is the
    newest active node of its key in the first lane (own phase, no phase, any phase) that has one.
    """
    absent = first_of(wanted, ["product", "cluster_key"]).join(catalog.where(F.col("is_active") & (F.col("cluster_level") == level)).select("product", "cluster_key"), ["product", "cluster_key"], "left_anti")
    if level > 1:
        up = catalog.where(F.col("is_active") & (F.col("cluster_level") == level - 1))
        lane = {"own": F.col("created_by") == phase, "none": F.col("created_by").isNull(), "any": F.lit(True)}
        best = up.groupBy("product", F.col("cluster_key").alias("parent_key")).agg(*(F.max(F.when(lane[k], F.col("cluster_id"))).alias(f"_{k}") for k in lanes))
        absent = absent.join(best, ["product", "parent_key"], "left").withColumn("parent_id", F.coalesce(*(F.col(f"_{k}") for k in lanes))).drop(*(f"_{k}" for k in lanes)).where("parent_id is not null")
    else:
        absent = absent.withColumn("parent_id", F.lit(None).cast("long"))
    out = surrogate_ids(absent, ["product", "cluster_key"], catalog, "cluster_id")
    return out.select("cluster_id", F.lit(level).alias("cluster_level"), "product", "cluster_key", "parent_id", "signature_text", F.lit(phase).alias("created_by"))


def fill_blank(rows: DataFrame, values: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Fills a blank text from `values`, never replaces one."""
    v = values.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col(text).alias("_new"))
    out = rows.join(v, [F.col(k) == F.col(f"_{k}") for k in keys], "left")
    blank = F.coalesce(F.trim(text) == "", F.lit(True))
    fresh = F.coalesce(F.trim("_new") != "", F.lit(False))
    return out.withColumn(text, F.when(blank & fresh, F.col("_new")).otherwise(F.col(text))).drop("_new", *(f"_{k}" for k in keys))


def latest_with_signature(clusters: DataFrame, wanted: DataFrame, now, days: int = 0) -> DataFrame:
    """(kind, signature_hash, cluster_id): for each signature of `wanted` the newest cluster of its kind that has it.

    `days`: only clusters made so many days before `now` at most; 0: of any age. Of equal dates the largest id.
    """
    recent = clusters.where(F.col("created_on") >= F.date_sub(F.lit(now), days)) if days else clusters
    keys = ["kind", "signature_hash"]
    newest = recent.groupBy(*keys).agg(F.max(F.struct("created_on", "cluster_id")).alias("_n")).select(*keys, F.col("_n.cluster_id").alias("cluster_id"))
    return wanted.select(*keys).distinct().join(newest, keys)


def upsert_signatures(clusters: DataFrame, wanted: DataFrame, now, days: int = 0) -> DataFrame:
    """The clusters, those found by signature with `last_seen` set, and a new one for each signature that wasn't found."""
    keys = ["kind", "signature_hash"]
    hits = latest_with_signature(clusters, wanted, now, days)
    seen = hits.select(F.col("cluster_id").alias("_id"))
    kept = clusters.join(seen, F.col("cluster_id") == F.col("_id"), "left").withColumn("last_seen", F.when(F.col("_id").isNotNull(), F.lit(now)).otherwise(F.col("last_seen"))).drop("_id")
    new = surrogate_ids(first_of(wanted, keys).join(hits.select(*keys), keys, "left_anti"), keys, clusters, "cluster_id")
    return kept.unionByName(new.withColumn("created_on", F.lit(now)).withColumn("last_seen", F.lit(now)).select(*kept.columns))
