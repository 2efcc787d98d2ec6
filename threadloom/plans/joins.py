"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rollup as R
from ..registry import query


@query("j1_anti_not_enriched", "SELECT r.question_id FROM raw_threads r LEFT JOIN (SELECT 'qa' || substr(nugget_id, 2) AS q FROM nuggets WHERE action = 'keep') n ON n.q = r.question_id WHERE n.q IS NULL")
def j1(t):
    done = t.nuggets.where("action = 'keep'").select(F.concat(F.lit("qa"), F.substring("nugget_id", 2, 20)).alias("question_id"))
    return t.raw_threads.join(done, "question_id", "left_anti").select("question_id")


@query("j2_left_coalesce_text", "SELECT c.cluster_id, coalesce(nullif(c.signature_text, ''), s.problem) AS text FROM catalog c LEFT JOIN solutions s USING (cluster_id) WHERE c.cluster_level = 4")
def j2(t):
    rows = t.catalog.where("cluster_level = 4").join(t.solutions.select("cluster_id", "problem"), "cluster_id", "left")
    return rows.select("cluster_id", F.coalesce(F.nullif("signature_text", F.lit("")), "problem").alias("text"))


@query("j3_inner_incident_links", "SELECT i.incident_id, i.status, count(*) AS n FROM incidents i JOIN incident_threads l USING (incident_id) GROUP BY ALL")
def j3(t):
    return t.incidents.select("incident_id", "status").join(t.incident_threads.select("incident_id"), "incident_id").groupBy("incident_id", "status").agg(F.count("*").alias("n"))


@query("j4_inner_extra_predicates", "SELECT p.cluster_id, c.cluster_id AS child_id FROM catalog p JOIN catalog c ON c.parent_id = p.cluster_id AND c.cluster_level = 2 AND c.is_active WHERE p.cluster_level = 1")
def j4(t):
    kids = t.catalog.where("cluster_level = 2 and is_active").select(F.col("cluster_id").alias("child_id"), "parent_id")
    return t.catalog.where("cluster_level = 1").select("cluster_id").join(kids, F.col("cluster_id") == F.col("parent_id")).select("cluster_id", "child_id")


@query("j6_semi_exists", "SELECT cluster_id FROM catalog c WHERE cluster_level = 3 AND EXISTS (SELECT 1 FROM catalog l JOIN solutions s USING (cluster_id) WHERE l.parent_id = c.cluster_id)")
def j6(t):
    solved = t.catalog.join(t.solutions.select("cluster_id"), "cluster_id", "left_semi").select(F.col("parent_id").alias("cluster_id"))
    return t.catalog.where("cluster_level = 3").join(solved, "cluster_id", "left_semi").select("cluster_id")


@query("j7_anti_not_in", "SELECT nugget_id FROM nuggets WHERE product NOT IN (SELECT name FROM products WHERE seen >= 50)")
def j7(t):
    return t.nuggets.join(t.products.where("seen >= 50").select(F.col("name").alias("product")), "product", "left_anti").select("nugget_id")


@query("j8_ancestor_walk", """SELECT l.cluster_id, a1.cluster_key AS up1_key, a2.cluster_key AS up2_key, a3.cluster_key AS up3_key FROM catalog l LEFT JOIN catalog a1 ON a1.cluster_id = l.parent_id AND a1.is_active
LEFT JOIN catalog a2 ON a2.cluster_id = a1.parent_id AND a2.is_active LEFT JOIN catalog a3 ON a3.cluster_id = a2.parent_id AND a3.is_active WHERE l.cluster_level = 4""")
def j8(t):
    return R.with_ancestors(t.catalog.where("cluster_level = 4"), t.catalog).select("cluster_id", "up1_key", "up2_key", "up3_key")


_UP = "CASE WHEN p_partkey % 12 <> 0 THEN p_partkey - 1 WHEN p_partkey % 5 = 0 THEN p_partkey + 3 WHEN p_partkey % 7 = 0 THEN -1 END"


@query("j8_deep_lines", f"""WITH RECURSIVE n AS (SELECT p_partkey AS id, {_UP} AS up FROM part), w AS (SELECT n.id, [n.up] AS line, n.up AS cur FROM n JOIN n x ON x.id = n.up WHERE n.up <> n.id
UNION ALL SELECT w.id, list_append(w.line, n.up), n.up FROM w JOIN n ON n.id = w.cur JOIN n x ON x.id = n.up WHERE len(w.line) < 10 AND n.up <> w.id AND NOT list_contains(w.line, n.up))
SELECT n.id, coalesce(array_to_string(arg_max(line, len(line)), '>'), '') AS line FROM n LEFT JOIN w USING (id) GROUP BY n.id""")
def j8_deep(t):
    nodes = t.part.select(F.col("p_partkey").alias("id"), F.expr(_UP).alias("up"))
    return R.ancestor_lines(nodes, "id", "up").select("id", F.array_join(F.col("ancestors").cast("array<string>"), ">").alias("line"))


@query("j9_lateral_top1", "SELECT t.product, t.topic_key, coalesce(max(CASE WHEN created_by = 'phase1b' THEN cluster_id END), max(CASE WHEN created_by IS NULL THEN cluster_id END)) AS parent_id FROM (SELECT DISTINCT product, topic_key FROM threads) t LEFT JOIN catalog c ON c.product = t.product AND c.cluster_key = t.topic_key AND c.cluster_level = 1 AND c.is_active GROUP BY ALL")
def j9(t):
    lane = lambda cond: F.max(F.when(cond, F.col("cluster_id")))
    best = t.catalog.where("cluster_level = 1 and is_active").groupBy("product", F.col("cluster_key").alias("topic_key")).agg(lane(F.col("created_by") == "phase1b").alias("a"), lane(F.col("created_by").isNull()).alias("b"))
    wanted = t.threads.select("product", "topic_key").distinct()
    return wanted.join(best, ["product", "topic_key"], "left").select("product", "topic_key", F.coalesce("a", "b").alias("parent_id"))


@query("j10_composite_lookup", "SELECT t.thread_id, n.cluster_id FROM threads t LEFT JOIN catalog n ON n.product = t.product AND n.cluster_level = 1 AND n.cluster_key = t.topic_key AND n.parent_id IS NULL")
def j10(t):
    n = t.catalog.where("cluster_level = 1 and parent_id is null").select("product", F.col("cluster_key").alias("topic_key"), "cluster_id")
    return t.threads.join(n, ["product", "topic_key"], "left").select("thread_id", "cluster_id")


@query("j11_self_left_children", "SELECT p.cluster_id, count(c.cluster_id) AS children FROM catalog p LEFT JOIN catalog c ON c.parent_id = p.cluster_id AND c.is_active AND c.member_count > 3 WHERE p.cluster_level < 4 GROUP BY 1")
def j11(t):
    kids = t.catalog.where("is_active and member_count > 3").groupBy(F.col("parent_id").alias("cluster_id")).agg(F.count("*").alias("children"))
    return t.catalog.where("cluster_level < 4").join(kids, "cluster_id", "left").select("cluster_id", F.coalesce("children", F.lit(0)).alias("children"))


@query("j12_having_scalar", "SELECT leaf_key, count(*) AS n FROM threads t WHERE batch_id = 'b1998' GROUP BY leaf_key HAVING count(*) = (SELECT count(*) FROM threads u WHERE u.leaf_key = t.leaf_key)")
def j12(t):
    return R.exclusive_groups(t.threads, "leaf_key", "batch_id", "b1998").select("leaf_key", F.col("total").alias("n"))


@query("j13_children_with_solutions", "SELECT v.cluster_id, l.cluster_key, s.title, trim(regexp_extract(s.steps, ',\"\",\"([^\"]*)\"', 1)) AS last_step FROM catalog v JOIN catalog l ON l.parent_id = v.cluster_id AND l.is_active LEFT JOIN solutions s ON s.cluster_id = l.cluster_id WHERE v.cluster_level = 3")
def j13(t):
    leaves = t.catalog.where("is_active and cluster_level = 4").select("cluster_id", "parent_id", "cluster_key")
    last = F.try_element_at(F.from_json("steps", "array<string>"), F.lit(-1))
    full = leaves.join(t.solutions.select("cluster_id", "title", F.trim(last).alias("last_step")), "cluster_id", "left").drop("cluster_id")
    return t.catalog.where("cluster_level = 3").select("cluster_id").join(full, F.col("cluster_id") == F.col("parent_id")).select("cluster_id", "cluster_key", "title", "last_step")
