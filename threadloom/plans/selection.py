"""Selection queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import predicates as P
from ..operators import rollup as R
from ..operators import selection as K
from ..registry import query
from .aggregates import _F2


def _order():
    return [F.desc("created_on"), F.desc("thread_id")]


_ELIG = f"{_F2} AND coalesce(usefulness, 0) >= 0.4 AND checked_on IS NULL"
_ASSIGN = f"{_F2} AND coalesce(usefulness, 0) >= 0.3 AND checked_on IS NOT NULL AND started_on IS NULL AND completed_on IS NULL"


@query("k1_next_product", f"SELECT product FROM threads WHERE {_ELIG} AND product NOT IN ('BUILDING') ORDER BY created_on DESC, thread_id DESC LIMIT 1")
def k1(t):
    return K.newest_product(t.threads.where(P.catalog_eligible()), ["BUILDING"])


@query("k2_keyset_pages", f"SELECT thread_id, product, (row_number() OVER (PARTITION BY product ORDER BY created_on DESC, thread_id DESC) - 1) // 25 AS page FROM threads WHERE {_ELIG}")
def k2(t):
    return K.pages_of(t.threads.where(P.catalog_eligible()), _order(), 25, ["product"]).select("thread_id", "product", "page")


@query("k3_claim_batch", f"SELECT thread_id FROM threads WHERE {_ASSIGN} ORDER BY created_on DESC, thread_id DESC LIMIT 30")
def k3(t):
    return K.claim(t.threads, P.assign_eligible(), _order(), 30, dt.date(2024, 2, 5))[0].select("thread_id")


@query("k3_claim_snapshot", f"WITH c AS (SELECT thread_id FROM threads WHERE {_ASSIGN} ORDER BY created_on DESC, thread_id DESC LIMIT 30) SELECT thread_id, CASE WHEN thread_id IN (SELECT thread_id FROM c) THEN date '2024-02-05' ELSE started_on END AS started_on FROM threads")
def k3b(t):
    return K.claim(t.threads, P.assign_eligible(), _order(), 30, dt.date(2024, 2, 5))[1].select("thread_id", "started_on")


@query("k4_leaf_candidates", "SELECT cluster_id, member_count, max_usefulness FROM catalog WHERE cluster_level = 4 AND is_active AND ((member_count >= 2 AND max_usefulness >= 0.6) OR max_usefulness >= 0.9) AND cluster_id NOT IN (SELECT cluster_id FROM solutions) ORDER BY max_usefulness DESC, member_count DESC, last_seen DESC, cluster_id LIMIT 100")
def k4(t):
    return K.leaf_candidates(t.catalog, t.solutions, 2, 0.6, 100).select("cluster_id", "member_count", "max_usefulness")


def _loose(level, fk):
    return f"SELECT cluster_id FROM catalog c WHERE cluster_level = {level} AND is_active AND EXISTS (SELECT 1 FROM threads t WHERE t.{fk} = c.cluster_id AND started_on IS NULL) AND NOT EXISTS (SELECT 1 FROM solutions s WHERE s.cluster_id = c.cluster_id) ORDER BY max_usefulness DESC, member_count DESC, last_seen DESC, cluster_id LIMIT 50"


@query("k5_variant_leafless", _loose(3, "variant_id"))
def k5(t):
    return K.with_leafless_threads(t.catalog, t.threads, t.solutions, 3, 50).select("cluster_id")


@query("k5_scenario_leafless", _loose(2, "scenario_id"))
def k5b(t):
    return K.with_leafless_threads(t.catalog, t.threads, t.solutions, 2, 50).select("cluster_id")


@query("k6_emergent_leaves", "SELECT cluster_id FROM catalog c WHERE cluster_level = 4 AND is_active AND member_count >= 3 AND NOT EXISTS (SELECT 1 FROM solutions s WHERE s.cluster_id = c.cluster_id) ORDER BY member_count DESC, last_seen DESC, cluster_id LIMIT 20")
def k6(t):
    rows = t.catalog.where("cluster_level = 4 and is_active and member_count >= 3").join(t.solutions.select("cluster_id"), "cluster_id", "left_anti")
    return rows.orderBy(F.desc("member_count"), F.desc("last_seen"), "cluster_id").limit(20).select("cluster_id")


@query("k7_top_threads_per_node", "SELECT leaf_id, thread_id, rn::INT AS rn FROM (SELECT leaf_id, thread_id, row_number() OVER (PARTITION BY leaf_id ORDER BY usefulness DESC NULLS LAST, created_on DESC, thread_id) AS rn FROM threads WHERE leaf_id IS NOT NULL) WHERE rn <= 12")
def k7(t):
    return K.top_threads(t.threads, "leaf_id", 12).select("leaf_id", "thread_id", "rn")


@query("k7_top4_of_scenario", "SELECT scenario_id, thread_id, rn::INT AS rn FROM (SELECT scenario_id, thread_id, row_number() OVER (PARTITION BY scenario_id ORDER BY usefulness DESC NULLS LAST, created_on DESC, thread_id) AS rn FROM threads WHERE scenario_id IS NOT NULL) WHERE rn <= 4")
def k7b(t):
    return K.top_threads(t.threads, "scenario_id", 4).select("scenario_id", "thread_id", "rn")


@query("k8_top_children", "SELECT parent_id, cluster_id, rn::INT AS rn FROM (SELECT parent_id, cluster_id, row_number() OVER (PARTITION BY parent_id ORDER BY member_count DESC, max_usefulness DESC, cluster_id) AS rn FROM catalog WHERE cluster_level = 3 AND is_active AND parent_id IS NOT NULL) WHERE rn <= 5")
def k8(t):
    return K.top_children(t.catalog, 3, 5).select("parent_id", "cluster_id", "rn")


@query("k8_nested_children", "SELECT parent_id, string_agg(cluster_key, ';' ORDER BY rn) AS children FROM (SELECT parent_id, cluster_key, row_number() OVER (PARTITION BY parent_id ORDER BY member_count DESC, max_usefulness DESC, cluster_id) AS rn FROM catalog WHERE cluster_level = 3 AND is_active AND parent_id IS NOT NULL) WHERE rn <= 6 GROUP BY 1")
def k8b(t):
    kids = K.top_children(t.catalog, 3, 6).groupBy("parent_id").agg(F.sort_array(F.collect_list(F.struct("rn", "cluster_key"))).alias("k"))
    return kids.select("parent_id", F.array_join(F.transform("k", lambda x: x["cluster_key"]), ";").alias("children"))


@query("k9_variant_pages", """SELECT cluster_id, CASE WHEN EXISTS (SELECT 1 FROM catalog l JOIN solutions s ON s.cluster_id = l.cluster_id WHERE l.parent_id = c.cluster_id AND l.cluster_level = 4 AND l.is_active) THEN 1 ELSE 0 END AS has_solution
FROM catalog c WHERE cluster_level = 3 AND is_active AND wiki_path IS NULL AND member_count >= 3 AND max_usefulness >= 0.4 ORDER BY has_solution DESC, member_count DESC, last_seen DESC, cluster_id LIMIT 50""")
def k9(t):
    return K.variant_pages(t.catalog, t.solutions, 3, 0.4, 50).select("cluster_id", "has_solution")


@query("k10_scenario_pages", "SELECT cluster_id FROM catalog c WHERE cluster_level = 2 AND is_active AND wiki_path IS NULL AND member_count >= 6 AND EXISTS (SELECT 1 FROM catalog v WHERE v.parent_id = c.cluster_id AND v.cluster_level = 3 AND v.is_active AND v.member_count >= 3 AND v.max_usefulness >= 0.4) ORDER BY member_count DESC, last_seen DESC, cluster_id LIMIT 50")
def k10(t):
    return K.parent_pages(t.catalog, 2, 6, (F.col("member_count") >= 3) & (F.col("max_usefulness") >= F.lit("0.4").cast("decimal(4,3)")), 50).select("cluster_id")


@query("k11_topic_pages", "SELECT cluster_id FROM catalog c WHERE cluster_level = 1 AND is_active AND wiki_path IS NULL AND member_count >= 1 AND EXISTS (SELECT 1 FROM catalog v WHERE v.parent_id = c.cluster_id AND v.cluster_level = 2 AND v.is_active AND v.wiki_path IS NOT NULL) ORDER BY member_count DESC, last_seen DESC, cluster_id LIMIT 30")
def k11(t):
    return K.parent_pages(t.catalog, 1, 1, F.col("wiki_path").isNotNull(), 30).select("cluster_id")


@query("k12_orphans", "SELECT thread_id, usefulness FROM threads WHERE leaf_id IS NULL AND usefulness > 0.4 ORDER BY usefulness DESC, thread_id LIMIT 12")
def k12(t):
    results = t.threads.withColumn("status", F.when(F.col("leaf_id").isNull(), F.lit("no_leaf_match")).otherwise(F.lit("assigned")))
    return K.orphans(results).select("thread_id", "usefulness")


@query("k13_recent", "SELECT thread_id, coalesce(completed_on, created_on) AS at FROM threads ORDER BY coalesce(completed_on, created_on) DESC, thread_id LIMIT 20")
def k13(t):
    at = F.coalesce("completed_on", "created_on")
    return t.threads.select("thread_id", at.alias("at")).orderBy(F.desc("at"), "thread_id").limit(20)


@query("k14_branch_threads", "SELECT product, topic_key, thread_id FROM (SELECT product, topic_key, thread_id, row_number() OVER (PARTITION BY product, topic_key ORDER BY created_on DESC, thread_id DESC) AS rn FROM threads WHERE (classification = 'emergent_issue' OR is_emergent) AND coalesce(emergent_signal, 0) >= 0.5) WHERE rn <= 500")
def k14(t):
    return R.top_n(t.threads.where(P.emergent_eligible()), ["product", "topic_key"], _order(), 500).select("product", "topic_key", "thread_id")


@query("k14_branch_incidents", "SELECT incident_id, product FROM incidents WHERE status <> 'archived'")
def k14b(t):
    return t.incidents.where("status <> 'archived'").select("incident_id", "product")


@query("k15_nuggets_of_topic", "SELECT product, topic_key, nugget_id, rn::INT AS rn FROM (SELECT product, topic_key, nugget_id, row_number() OVER (PARTITION BY product, topic_key ORDER BY score DESC, nugget_id) AS rn FROM nuggets) WHERE rn <= 3")
def k15(t):
    return R.top_n(t.nuggets, ["product", "topic_key"], [F.desc("score"), "nugget_id"], 3).select("product", "topic_key", "nugget_id", "rn")


@query("k16_enrichment_candidates", "SELECT question_id FROM raw_threads WHERE content IS NOT NULL ORDER BY coalesce(created_on, date '1900-01-01') DESC, question_id DESC LIMIT 25")
def k16(t):
    return t.raw_threads.where("content is not null").orderBy(F.desc(F.coalesce("created_on", F.lit(dt.date(1900, 1, 1)))), F.desc("question_id")).limit(25).select("question_id")


@query("k17_chunks", "SELECT nugget_id, product, (row_number() OVER (PARTITION BY product ORDER BY nugget_id) - 1) // 12 AS page FROM nuggets")
def k17(t):
    return K.pages_of(t.nuggets, [F.col("nugget_id")], 12, ["product"]).select("nugget_id", "product", "page")


@query("k2_table_pages", "SELECT thread_id, row_number() OVER (ORDER BY created_on DESC, thread_id DESC) AS rn, (row_number() OVER (ORDER BY created_on DESC, thread_id DESC) - 1) // 2000 AS page FROM threads")
def k2_table(t):
    return K.pages_of(t.threads.select("thread_id", "created_on"), _order(), 2000).select("thread_id", "rn", "page")


@query("k18_lookups", "SELECT name, thread_count FROM products WHERE name = 'Brand#2'")
def k18(t):
    return t.products.where("name = 'Brand#2'").select("name", "thread_count")


@query("k19_round_robin", "SELECT r AS round, product, thread_id FROM (SELECT (row_number() OVER (PARTITION BY product ORDER BY created_on DESC, thread_id DESC) - 1) // 15 AS r, product, thread_id FROM threads WHERE (classification = 'emergent_issue' OR is_emergent) AND coalesce(emergent_signal, 0) >= 0.5) WHERE r < 4")
def k19(t):
    return K.round_robin(t.threads.where(P.emergent_eligible()), _order(), 15, 4)


@query("n18_circular_window", "WITH p AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS rn, count(*) OVER () AS n FROM products) SELECT name, ((rn - 40 % n + n) % n)::BIGINT AS turn FROM p WHERE (rn - 40 % n + n) % n < 12")
def n18(t):
    return K.circular_window(t.products, [F.col("name")], 40, 12).select("name", F.col("turn").cast("long").alias("turn"))


@query("s3_catalog_cap", "SELECT cluster_id FROM (SELECT cluster_id, product FROM catalog WHERE is_active ORDER BY cluster_level, cluster_id LIMIT 8000) WHERE product = 'BUILDING'")
def s3(t):
    from ..sources.catalog import capped_catalog

    return capped_catalog(t.catalog, 8000).where("product = 'BUILDING'").select("cluster_id")


@query("n20_catalog_groups", "SELECT product, cluster_level, string_agg(cluster_key, ',' ORDER BY cluster_id) AS keys FROM (SELECT *, row_number() OVER (PARTITION BY product, cluster_level ORDER BY cluster_id) AS rn FROM catalog WHERE is_active) WHERE rn <= 10 GROUP BY ALL")
def n20(t):
    rows = R.top_n(t.catalog.where("is_active"), ["product", "cluster_level"], [F.col("cluster_id")], 10)
    kept = rows.groupBy("product", "cluster_level").agg(F.sort_array(F.collect_list(F.struct("rn", "cluster_key"))).alias("k"))
    return kept.select("product", "cluster_level", F.array_join(F.transform("k", lambda x: x["cluster_key"]), ",").alias("keys"))


@query("n21_stage_catalog", "SELECT l.cluster_id, l.cluster_level FROM catalog s JOIN catalog v ON v.parent_id = s.cluster_id AND v.is_active JOIN catalog l ON (l.cluster_id = v.cluster_id OR l.parent_id = v.cluster_id) AND l.is_active WHERE s.cluster_key = 'nation_3' AND s.cluster_level = 2 AND s.product = 'BUILDING' ORDER BY l.cluster_level, l.cluster_id LIMIT 150")
def n21(t):
    active = t.catalog.where("is_active")
    root = t.catalog.where("cluster_key = 'nation_3' and cluster_level = 2 and product = 'BUILDING'").select(F.col("cluster_id").alias("up"))
    variants = active.join(root, F.col("parent_id") == F.col("up"), "left_semi")
    leaves = active.join(variants.select(F.col("cluster_id").alias("up")), F.col("parent_id") == F.col("up"), "left_semi")
    cols = ["cluster_id", "cluster_level"]
    return variants.select(cols).union(leaves.select(cols)).orderBy("cluster_level", "cluster_id").limit(150)


@query("n22_most_common_product", "SELECT product FROM threads WHERE trim(product) <> '' GROUP BY product ORDER BY count(*) DESC, min(thread_id) LIMIT 1")
def n22(t):
    counts = t.threads.where(P.non_blank("product")).groupBy("product").agg(F.count("*").alias("n"), F.min("thread_id").alias("first"))
    return counts.orderBy(F.desc("n"), "first").limit(1).select("product")


@query("n24_carry_over", "WITH b AS (SELECT product, nugget_id, topic_key, (row_number() OVER (PARTITION BY product ORDER BY nugget_id) - 1) // 10 AS page FROM nuggets), f AS (SELECT product, topic_key, min(page) AS first_page FROM b GROUP BY ALL), p AS (SELECT DISTINCT product, page FROM b) SELECT p.product, p.page, count(f.topic_key) AS known FROM p LEFT JOIN f ON f.product = p.product AND f.first_page < p.page GROUP BY ALL")
def n24(t):
    from pyspark.sql import Window

    b = K.pages_of(t.nuggets, [F.col("nugget_id")], 10, ["product"])
    firsts = b.groupBy("product", "topic_key").agg(F.min("page").alias("page")).groupBy("product", "page").agg(F.count("*").alias("new"))
    every = b.select("product", "page").distinct().join(firsts, ["product", "page"], "left")
    before = Window.partitionBy("product").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    return every.select("product", "page", F.coalesce(F.sum("new").over(before), F.lit(0)).alias("known"))


_TOPIC = "lower(p_type) || (p_size % 4)"


@query("n24_carried_slices", f"""WITH b AS (SELECT p_brand AS product, p_partkey AS id, {_TOPIC} AS topic_key, (row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) // 10 AS page FROM part), f AS (SELECT product, topic_key, min(page) AS first FROM b GROUP BY ALL), p AS (SELECT DISTINCT product, page FROM b),
k AS (SELECT p.product, p.page, f.topic_key, f.first, row_number() OVER (PARTITION BY p.product, p.page ORDER BY first DESC, topic_key DESC) AS back FROM p JOIN f ON f.product = p.product AND f.first < p.page)
SELECT product, page, (row_number() OVER (PARTITION BY product, page ORDER BY first, topic_key))::INT AS place, topic_key FROM k WHERE back <= 6""")
def n24_slices(t):
    from ..operators.prompts import carried_over

    rows = t.part.select(F.col("p_brand").alias("product"), F.col("p_partkey").alias("id"), F.expr(_TOPIC).alias("topic_key"))
    return carried_over(K.pages_of(rows, ["id"], 10, ["product"]), 6)
