"""Roll-ups, dashboard aggregates and predicates, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import predicates as P
from ..operators import rollup as R
from ..registry import query

_MATCH = """m{l} AS (SELECT DISTINCT n.cluster_id, t.thread_id, t.usefulness FROM catalog n JOIN threads t ON trim(t.product) <> '' AND n.cluster_level = {l} AND (t.{fk} = n.cluster_id)
 UNION SELECT n.cluster_id, t.thread_id, t.usefulness FROM catalog n JOIN threads t ON trim(t.product) <> '' AND n.cluster_level = {l} AND t.product = n.product AND t.{key} = n.cluster_key),
d{l} AS (SELECT cluster_id, count(DISTINCT thread_id) AS c, max(coalesce(usefulness, 0)) AS u FROM m{l} GROUP BY cluster_id)"""
_PARTS = [_MATCH.format(l=lv, fk=fk, key=key) for lv, (fk, key) in R.LEVELS.items()]
ROLLUP = "WITH " + ",\n".join(_PARTS) + """,
r4 AS (SELECT n.*, coalesce(d.c, 0) AS c, d.u AS u FROM catalog n LEFT JOIN d4 d USING (cluster_id) WHERE cluster_level = 4),
r3 AS (SELECT n.*, coalesce(d.c, 0) AS c, greatest(d.u, x.u) AS u FROM catalog n LEFT JOIN d3 d USING (cluster_id) LEFT JOIN (SELECT parent_id, max(u) AS u FROM r4 WHERE is_active GROUP BY 1) x ON x.parent_id = n.cluster_id WHERE cluster_level = 3),
r2 AS (SELECT n.*, coalesce(d.c, 0) AS c, greatest(d.u, x.u) AS u FROM catalog n LEFT JOIN d2 d USING (cluster_id) LEFT JOIN (SELECT parent_id, max(u) AS u FROM r3 WHERE is_active GROUP BY 1) x ON x.parent_id = n.cluster_id WHERE cluster_level = 2),
r1 AS (SELECT n.*, coalesce(d.c, 0) AS c, greatest(d.u, x.u) AS u FROM catalog n LEFT JOIN d1 d USING (cluster_id) LEFT JOIN (SELECT parent_id, max(u) AS u FROM r2 WHERE is_active GROUP BY 1) x ON x.parent_id = n.cluster_id WHERE cluster_level = 1),
rolled AS (SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3 UNION ALL SELECT * FROM r4)
"""


@query("a1_rollup", ROLLUP + "SELECT cluster_id, cluster_level, c AS member_count, CAST(u AS DECIMAL(4,3)) AS max_usefulness FROM rolled")
def a1(t):
    return R.rollup_levels(t.threads, t.catalog).select("cluster_id", "cluster_level", "member_count", "max_usefulness")


@query("j5_fk_or_key_join", "SELECT DISTINCT n.cluster_id, t.thread_id FROM catalog n JOIN threads t ON trim(t.product) <> '' AND n.cluster_level = 4 AND t.leaf_id = n.cluster_id UNION SELECT n.cluster_id, t.thread_id FROM catalog n JOIN threads t ON trim(t.product) <> '' AND n.cluster_level = 4 AND t.product = n.product AND t.leaf_key = n.cluster_key")
def j5(t):
    return R.fk_or_key_matches(t.threads, t.catalog.where("cluster_level = 4"), "leaf_id", "leaf_key").select("cluster_id", "thread_id")


@query("a2_sum_members", """WITH l AS (SELECT c.cluster_id, c.parent_id, count(DISTINCT thread_id) AS members FROM catalog c JOIN memberships m ON m.leaf_id = c.cluster_id WHERE cluster_level = 4 GROUP BY ALL),
v AS (SELECT c.cluster_id, c.parent_id, sum(members) AS members FROM catalog c JOIN l ON l.parent_id = c.cluster_id GROUP BY ALL),
s AS (SELECT c.cluster_id, c.parent_id, sum(members) AS members FROM catalog c JOIN v ON v.parent_id = c.cluster_id GROUP BY ALL),
p AS (SELECT c.cluster_id, c.parent_id, sum(members) AS members FROM catalog c JOIN s ON s.parent_id = c.cluster_id GROUP BY ALL)
SELECT cluster_id, members::BIGINT AS members FROM (SELECT * FROM l UNION ALL SELECT * FROM v UNION ALL SELECT * FROM s UNION ALL SELECT * FROM p)""")
def a2(t):
    return R.sum_members(t.catalog, t.memberships)


@query("a3_product_stats", """SELECT coalesce(product, 'Unknown') AS product, count(*) AS threads, count(*) FILTER (classification = 'emergent_issue') AS emergent, max(created_on) AS newest,
CAST(round(CAST(sum(coalesce(usefulness, 0)) AS DOUBLE) / count(*), 6) AS DOUBLE) AS mean_usefulness FROM threads GROUP BY product""")
def a3(t):
    zero = F.lit(0).cast("decimal(4,3)")
    out = t.threads.groupBy("product").agg(
        F.count("*").alias("threads"), F.count_if(F.col("classification") == "emergent_issue").alias("emergent"), F.max("created_on").alias("newest"),
        F.round(F.sum(F.coalesce("usefulness", zero)).cast("double") / F.count("*"), 6).alias("mean_usefulness"))
    return out.withColumn("product", F.coalesce("product", F.lit("Unknown"))).orderBy(F.desc("threads"), "product")


@query("a4_catalog_stats", "SELECT product, cluster_level, count(*) AS nodes, sum(member_count)::BIGINT AS members, max(coalesce(max_usefulness, 0)) AS best FROM catalog WHERE is_active GROUP BY ALL")
def a4(t):
    return t.catalog.where("is_active").groupBy("product", "cluster_level").agg(F.count("*").alias("nodes"), F.sum("member_count").alias("members"), F.max(F.coalesce("max_usefulness", F.lit(0).cast("decimal(4,3)"))).alias("best"))


@query("a5_batch_summary", """SELECT batch_id, count(*) AS threads, count(DISTINCT product) AS products, count(*) FILTER (checked_on IS NOT NULL) AS checked, count(*) FILTER (completed_on IS NOT NULL) AS completed,
count(*) FILTER (mined_on IS NOT NULL) AS mined, min(created_on) AS oldest, max(created_on) AS newest FROM threads GROUP BY batch_id""")
def a5(t):
    got = lambda c: F.count_if(F.col(c).isNotNull())
    return t.threads.groupBy("batch_id").agg(
        F.count("*").alias("threads"), F.countDistinct("product").alias("products"), got("checked_on").alias("checked"), got("completed_on").alias("completed"),
        got("mined_on").alias("mined"), F.min("created_on").alias("oldest"), F.max("created_on").alias("newest")).orderBy(F.desc("newest"), "batch_id")


@query("a6_kpis", """SELECT (SELECT count(*) FROM threads) AS threads, (SELECT count(*) FROM threads WHERE completed_on IS NOT NULL) AS assigned, (SELECT count(*) FROM threads WHERE classification = 'emergent_issue') AS emergent,
(SELECT count(*) FROM catalog WHERE is_active) AS nodes, (SELECT count(*) FROM solutions) AS solutions, (SELECT count(*) FROM incidents WHERE status = 'active') AS incidents""")
def a6(t):
    one = t.threads.agg(F.count("*").alias("threads"), F.count("completed_on").alias("assigned"), F.count_if(F.col("classification") == "emergent_issue").alias("emergent"))
    rest = [t.catalog.agg(F.count_if("is_active").alias("nodes")), t.solutions.agg(F.count("*").alias("solutions")), t.incidents.agg(F.count_if(F.col("status") == "active").alias("incidents"))]
    for r in rest:  # each a single row
        one = one.crossJoin(r)
    return one


@query("a7_push_summary", "SELECT count(*) AS total, coalesce(sum(CASE WHEN pushed THEN 1 ELSE 0 END), 0)::BIGINT AS pushed, coalesce(sum(CASE WHEN pushed THEN 0 ELSE 1 END), 0)::BIGINT AS pending FROM solutions")
def a7(t):
    return t.solutions.agg(F.count("*").alias("total"), F.coalesce(F.sum(F.col("pushed").cast("long")), F.lit(0)).alias("pushed"), F.coalesce(F.sum((~F.col("pushed")).cast("long")), F.lit(0)).alias("pending"))


@query("a8_distinct_products", "SELECT DISTINCT trim(product) AS product FROM threads WHERE trim(product) <> ''")
def a8(t):
    return t.threads.where(P.non_blank("product")).select(F.trim("product").alias("product")).distinct().orderBy("product")


@query("a8_recent_batches", "SELECT batch_id, max(created_on) AS newest FROM threads GROUP BY 1 ORDER BY newest DESC, batch_id LIMIT 5")
def a8b(t):
    return t.threads.groupBy("batch_id").agg(F.max("created_on").alias("newest")).orderBy(F.desc("newest"), "batch_id").limit(5)


@query("a9_exclusive_groups", "SELECT leaf_key, count(*) AS total FROM threads t WHERE product = 'BUILDING' GROUP BY leaf_key HAVING count(*) FILTER (batch_id = 'b1998') = count(*)")
def a9(t):
    return R.exclusive_groups(t.threads.where("product = 'BUILDING'"), "leaf_key", "batch_id", "b1998").select("leaf_key", "total")


@query("a10_incident_thread_stats", "SELECT incident_id, count(*) AS threads, min(coalesce(created_on, added_on)) AS first_seen, max(coalesce(created_on, added_on)) AS last_seen FROM incident_threads GROUP BY 1")
def a10(t):
    from ..operators.mutations import incident_stats

    return incident_stats(t.incident_threads)


@query("a11_diagnostic_counts", """SELECT count(*) AS total, count(*) FILTER (checked_on IS NOT NULL) AS checked, count(*) FILTER (started_on IS NOT NULL) AS started, count(*) FILTER (completed_on IS NOT NULL) AS completed,
count(*) FILTER (product IS NULL OR trim(product) = '') AS no_product, count(*) FILTER (signature_text IS NULL OR trim(signature_text) = '') AS no_signature FROM threads WHERE classification IS NULL OR classification <> 'emergent_issue'""")
def a11(t):
    rows = t.threads.where("classification is null or classification <> 'emergent_issue'")
    return rows.agg(F.count("*").alias("total"), F.count("checked_on").alias("checked"), F.count("started_on").alias("started"), F.count("completed_on").alias("completed"),
                    F.count_if(~P.non_blank("product")).alias("no_product"), F.count_if(~P.non_blank("signature_text")).alias("no_signature"))


@query("a12_phase_progress", """WITH c AS (SELECT count(*) AS n, count(checked_on) AS a, count(completed_on) AS b, count(mined_on) AS m FROM threads)
SELECT 'checked' AS phase, a AS done, round(100.0 * a / n, 1)::DOUBLE AS percent FROM c UNION ALL SELECT 'completed', b, round(100.0 * b / n, 1)::DOUBLE FROM c UNION ALL SELECT 'mined', m, round(100.0 * m / n, 1)::DOUBLE FROM c""")
def a12(t):
    one = t.threads.agg(F.count("*").alias("n"), F.count("checked_on").alias("a"), F.count("completed_on").alias("b"), F.count("mined_on").alias("m"))
    return one.selectExpr("n", "stack(3, 'checked', a, 'completed', b, 'mined', m) as (phase, done)").select("phase", "done", F.round(F.lit(100.0) * F.col("done") / F.col("n"), 1).alias("percent"))


@query("a13_pivot_levels", """SELECT product, count(*) FILTER (cluster_level = 1) AS l1, count(*) FILTER (cluster_level = 2) AS l2, count(*) FILTER (cluster_level = 3) AS l3, count(*) FILTER (cluster_level = 4) AS l4, count(*) AS total FROM catalog GROUP BY 1""")
def a13(t):
    p = t.catalog.groupBy("product").pivot("cluster_level", [1, 2, 3, 4]).count().na.fill(0)
    return p.select("product", *(F.col(str(k)).alias(f"l{k}") for k in (1, 2, 3, 4)), (F.col("1") + F.col("2") + F.col("3") + F.col("4")).alias("total"))


@query("a14_value_counts", "SELECT classification, count(*) AS n FROM threads WHERE classification IS NOT NULL GROUP BY 1 ORDER BY n DESC, classification LIMIT 20")
def a14(t):
    return t.threads.where("classification is not null").groupBy("classification").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "classification").limit(20)


@query("a15_status_histogram", "SELECT status, count(*) AS n FROM incidents GROUP BY 1")
def a15(t):
    return t.incidents.groupBy("status").agg(F.count("*").alias("n"))


@query("a16_member_bounds", "SELECT incident_id, min(created_on) AS first_seen, max(created_on) AS last_seen FROM incident_threads WHERE created_on IS NOT NULL GROUP BY 1")
def a16(t):
    lists = t.incident_threads.groupBy("incident_id").agg(F.collect_set("thread_id").alias("ids"))
    members = lists.select("incident_id", F.explode("ids").alias("thread_id"))
    return members.join(t.incident_threads.select("thread_id", "created_on"), "thread_id").where("created_on is not null").groupBy("incident_id").agg(F.min("created_on").alias("first_seen"), F.max("created_on").alias("last_seen"))


_F2 = "trim(product) <> '' AND product <> 'Other' AND trim(signature_text) <> '' AND (classification IS NULL OR classification NOT IN ('emergent_issue', 'not_usable', 'learn_microsoft'))"


@query("a17_eligible_count", f"SELECT count(*) AS n FROM threads WHERE {_F2} AND coalesce(usefulness, 0) >= 0.4 AND checked_on IS NULL")
def a17(t):
    return t.threads.where(P.catalog_eligible()).agg(F.count("*").alias("n"))


@query("f1_non_blank", "SELECT thread_id FROM threads WHERE product IS NOT NULL AND trim(product) <> ''")
def f1(t):
    return t.threads.where(P.non_blank("product")).select("thread_id")


@query("f2_catalog_eligible", f"SELECT thread_id FROM threads WHERE {_F2} AND coalesce(usefulness, 0) >= 0.4 AND checked_on IS NULL")
def f2(t):
    return t.threads.where(P.catalog_eligible()).select("thread_id")


@query("f2_catalog_eligible_product", "SELECT thread_id FROM threads WHERE product = 'Other' AND trim(signature_text) <> '' AND (classification IS NULL OR classification NOT IN ('emergent_issue', 'not_usable', 'learn_microsoft')) AND coalesce(usefulness, 0) >= 0.4")
def f2p(t):
    return t.threads.where(P.catalog_eligible(product="Other", force=True)).select("thread_id")


@query("f3_assign_eligible", f"SELECT thread_id FROM threads WHERE {_F2} AND coalesce(usefulness, 0) >= 0.3 AND checked_on IS NOT NULL AND started_on IS NULL AND completed_on IS NULL")
def f3(t):
    return t.threads.where(P.assign_eligible()).select("thread_id")


@query("f4_emergent_eligible", "SELECT thread_id FROM threads WHERE (classification = 'emergent_issue' OR is_emergent) AND coalesce(emergent_signal, 0) >= 0.5")
def f4(t):
    return t.threads.where(P.emergent_eligible()).select("thread_id")


@query("f5_nugget_eligible", "SELECT thread_id FROM threads WHERE usefulness >= 0.2 AND mined_on IS NULL AND trim(product) <> '' AND product <> 'Other'")
def f5(t):
    return t.threads.where(P.nugget_eligible()).select("thread_id")


@query("f6_optional_fragments", "SELECT thread_id FROM threads WHERE batch_id = 'b1997' AND product = 'MACHINERY' AND created_on >= date '1997-03-01' AND created_on <= date '1997-09-30'")
def f6(t):
    import datetime as dt

    return t.threads.where(P.in_batch("b1997", "MACHINERY", dt.date(1997, 3, 1), dt.date(1997, 9, 30))).select("thread_id")


@query("f7_watermark_or", "SELECT question_id FROM raw_threads WHERE created_on > date '2024-02-10' OR question_id > 'qa77'")
def f7(t):
    import datetime as dt

    return t.raw_threads.where(P.beyond_watermark("created_on", "question_id", dt.date(2024, 2, 10), "qa77")).select("question_id")


@query("f7_watermark_pair", "SELECT question_id FROM raw_threads WHERE created_on > date '2024-02-10' OR (created_on = date '2024-02-10' AND question_id > 'qa77')")
def f7b(t):
    import datetime as dt

    return t.raw_threads.where(P.beyond_watermark("created_on", "question_id", dt.date(2024, 2, 10), "qa77", strict=True)).select("question_id")


@query("f8_keyset_page", "SELECT thread_id, created_on FROM threads WHERE created_on < date '1998-06-01' OR (created_on = date '1998-06-01' AND thread_id < '5') ORDER BY created_on DESC, thread_id DESC LIMIT 40")
def f8(t):
    import datetime as dt

    return t.threads.where(P.page_after("created_on", "thread_id", dt.date(1998, 6, 1), "5")).select("thread_id", "created_on").orderBy(F.desc("created_on"), F.desc("thread_id")).limit(40)


@query("f9_crawl_dedup", "SELECT url, min(page_id) AS page_id FROM pages WHERE page_id NOT IN (SELECT page_id FROM pages WHERE page_id % 10 = 3) GROUP BY url")
def f9(t):
    known = t.pages.where("page_id % 10 = 3").select("page_id")
    return t.pages.join(known, "page_id", "left_anti").groupBy("url").agg(F.min("page_id").alias("page_id"))


@query("f10_drop_empty", "SELECT question_id FROM raw_threads WHERE content IS NOT NULL AND trim(content) <> ''")
def f10(t):
    return t.raw_threads.where(P.non_blank("content")).select("question_id")
