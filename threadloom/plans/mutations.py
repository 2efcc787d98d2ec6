"""Snapshot mutations, with their SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import mutations as M
from ..operators import rollup as R
from ..registry import query

NOW = dt.date(2024, 2, 5)

_CHANGES = "(SELECT 'qa' || cast(doc_id + 900 AS STRING) AS question_id, date '2024-03-01' AS created_on, lang AS asker, 'new ' || lang AS content FROM documents WHERE doc_id % 4 = 0)"


@query("m1_upsert_threads", f"""SELECT coalesce(b.question_id, c.question_id) AS question_id, CASE WHEN c.question_id IS NOT NULL THEN c.created_on ELSE b.created_on END AS created_on, CASE WHEN c.question_id IS NOT NULL THEN c.asker ELSE b.asker END AS asker,
CASE WHEN b.question_id IS NOT NULL AND c.question_id IS NOT NULL THEN date '2024-02-05' END AS processed_on FROM raw_threads b FULL JOIN {_CHANGES} c ON b.question_id = c.question_id""")
def m1(t):
    base = t.raw_threads.select("question_id", "created_on", "asker").withColumn("processed_on", F.lit(None).cast("date"))
    return M.upsert(base, t.sql(f"SELECT * FROM {_CHANGES}"), "question_id", {"processed_on": F.when(M.matched(), F.lit(NOW)).otherwise(F.col("b.processed_on"))})


@query("m1_parted_upsert", """WITH c AS (SELECT thread_id, product, 'new' AS signature_text FROM threads WHERE product = 'BUILDING' AND usefulness > 0.3 UNION ALL SELECT thread_id, 'Fresh', 'moved' FROM threads WHERE product IS NULL)
SELECT product, signature_text, count(*) AS n FROM (SELECT t.thread_id, t.product, CASE WHEN c.thread_id IS NOT NULL THEN c.signature_text ELSE t.signature_text END AS signature_text FROM threads t LEFT JOIN c ON c.thread_id = t.thread_id AND c.product = t.product UNION ALL SELECT * FROM c WHERE product = 'Fresh') GROUP BY ALL""")
def m1_parted(t):
    # Two parts of six are written again: the one that changes touch, and the new one.
    from ..sources.scratch import new_folder
    from ..sources.tables import PartedTable

    threads = t.threads.select("thread_id", "product", "signature_text")
    table = PartedTable(t.spark, new_folder(t.spark, "threads"), threads.schema, "product")
    table.replace(threads)
    changed = t.threads.where("product = 'BUILDING' and usefulness > 0.3").select("thread_id", "product", F.lit("new").alias("signature_text"))
    moved = t.threads.where("product is null").select("thread_id", F.lit("Fresh").alias("product"), F.lit("moved").alias("signature_text"))
    table.upsert(changed.union(moved), "thread_id")
    return table.read().groupBy("product", "signature_text").agg(F.count("*").alias("n"))


@query("m2_upsert_enrichment", "SELECT coalesce(b.nugget_id, c.nugget_id) AS nugget_id, coalesce(b.source, 'fresh') AS source, CASE WHEN c.nugget_id IS NOT NULL THEN c.title ELSE b.title END AS title FROM (SELECT nugget_id, action AS source, title FROM nuggets WHERE action = 'keep') b FULL JOIN (SELECT nugget_id, 'T ' || title AS title FROM nuggets WHERE cluster_ref = 'x') c ON b.nugget_id = c.nugget_id")
def m2(t):
    base = t.nuggets.where("action = 'keep'").select("nugget_id", F.col("action").alias("source"), "title")
    changes = t.nuggets.where("cluster_ref = 'x'").select("nugget_id", F.lit("fresh").alias("source"), F.concat(F.lit("T "), "title").alias("title"))
    return M.upsert(base, changes, "nugget_id", {"source": F.coalesce("b.source", "c.source")})


@query("m3_counter_upsert", "SELECT coalesce(b.name, c.name) AS name, (coalesce(b.n, 0) + coalesce(c.n, 0))::BIGINT AS thread_count, CASE WHEN c.n IS NOT NULL THEN date '2024-02-05' ELSE b.seen END AS seen FROM (SELECT name, thread_count AS n, date '2023-01-01' AS seen FROM products WHERE name < 'Brand#2') b FULL JOIN (SELECT product AS name, count(*) AS n FROM nuggets WHERE action = 'keep' AND product <> '' AND product <> 'Other' GROUP BY 1) c ON b.name = c.name")
def m3(t):
    base = t.products.where("name < 'Brand#2'").select("name", "thread_count", F.lit(dt.date(2023, 1, 1)).alias("seen"))
    rows = t.nuggets.where("action = 'keep' and product <> '' and product <> 'Other'").select(F.col("product").alias("name"))
    return M.count_up(base, rows, "name", "thread_count", "seen", NOW)


_HAVE = "SELECT lower(p_name || ' ' || p_type) AS alias, min(p_brand) AS product FROM part WHERE p_size % 3 <> 0 GROUP BY 1"
_SEED = "SELECT lower(p_name || ' ' || p_type) AS alias, 'seed ' || max(p_brand) AS product FROM part WHERE p_partkey % 2 = 0 GROUP BY 1"
_NEWER = "SELECT '  ' || lower(p_name || ' ' || p_type) AS alias, max(p_brand) || ' ' AS product FROM part WHERE p_size % 4 = 0 GROUP BY 1"


@query("m4_alias_seed", f"WITH h AS ({_HAVE}) SELECT alias, product FROM h UNION ALL SELECT alias, product FROM ({_SEED}) WHERE alias NOT IN (SELECT alias FROM h)")
def m4(t):
    return M.insert_absent(t.sql(_HAVE), t.sql(_SEED), "alias")


@query("m4_alias_upsert", f"SELECT coalesce(n.alias, h.alias) AS alias, coalesce(n.product, h.product) AS product FROM ({_HAVE}) h FULL JOIN (SELECT trim(alias) AS alias, trim(product) AS product FROM ({_NEWER})) n ON n.alias = h.alias")
def m4b(t):
    new = t.sql(_NEWER).select(F.trim("alias").alias("alias"), F.trim("product").alias("product"))
    return M.upsert(t.sql(_HAVE), new, "alias")


_CHAIN = [("BUILDING", "MACHINERY"), ("MACHINERY", "Tools"), ("Tools", "Tools 2"), ("HOUSEHOLD", "BUILDING")]


@query("m5_alias_backfill", "SELECT thread_id, CASE product WHEN 'BUILDING' THEN 'Tools 2' WHEN 'MACHINERY' THEN 'Tools 2' WHEN 'Tools' THEN 'Tools 2' WHEN 'HOUSEHOLD' THEN 'BUILDING' ELSE product END AS product FROM threads")
def m5(t):
    return M.backfill_aliases(t.threads.select("thread_id", "product"), _CHAIN)


@query("m6_rename_product", "SELECT product, count(*) AS n FROM (SELECT CASE WHEN product = 'BUILDING' THEN 'Construction' ELSE product END AS product FROM threads) GROUP BY 1")
def m6(t):
    return M.rename_product(t.threads, "BUILDING", "Construction").groupBy("product").agg(F.count("*").alias("n"))


@query("m7_merge_products", "SELECT p.name, (p.thread_count + CASE WHEN p.name = 'Brand#3' THEN coalesce(a.thread_count, 0) ELSE 0 END)::BIGINT AS thread_count, CASE WHEN p.name = 'Brand#3' AND a.seen > p.seen THEN a.seen ELSE p.seen END AS seen FROM products p LEFT JOIN (SELECT * FROM products WHERE name = 'Brand#2') a ON TRUE WHERE p.name <> 'Brand#2'")
def m7(t):
    return M.merge_products(t.products, "Brand#2", "Brand#3")


_NEWSIG = "(SELECT product, topic_key, 'sig' || repeat('x', cast(cast(substr(nugget_id, 2) AS BIGINT) % 9 AS INT)) || CASE WHEN score > 0.3 THEN '   ' ELSE '' END AS signature, nugget_id FROM nuggets WHERE action = 'keep')"
_OLDSIG = "(SELECT DISTINCT product, topic_key, CASE WHEN product = 'Brand#5' THEN NULL ELSE 'sigxxxxx' END AS signature FROM nuggets WHERE product < 'Brand#20')"


@query("m8_taxonomy_keep_longer", f"""WITH c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY product, topic_key ORDER BY length(rtrim(signature)) DESC, nugget_id) AS rn FROM {_NEWSIG} x) WHERE rn = 1)
SELECT coalesce(b.product, c.product) AS product, coalesce(b.topic_key, c.topic_key) AS topic_key, CASE WHEN b.product IS NULL OR length(rtrim(c.signature)) > length(rtrim(coalesce(b.signature, ''))) THEN c.signature ELSE b.signature END AS signature
FROM {_OLDSIG} b FULL JOIN c ON b.product = c.product AND b.topic_key = c.topic_key""")
def m8(t):
    return M.keep_longer(t.sql(f"SELECT * FROM {_OLDSIG}"), t.sql(f"SELECT * FROM {_NEWSIG}"), ["product", "topic_key"], "signature", "nugget_id")


_WANTED = "(SELECT DISTINCT c_mktsegment AS product, CASE WHEN c_custkey % 2 = 0 THEN lower(c_name) ELSE 'fresh-' || cast(c_custkey % 40 AS STRING) END AS cluster_key, 'nation_' || cast(c_custkey % 26 AS STRING) AS parent_key FROM customer WHERE c_custkey % 5 = 0)"


def _created(lanes):
    lane = {"own": "max(CASE WHEN created_by = 'phase1b' THEN cluster_id END)", "none": "max(CASE WHEN created_by IS NULL THEN cluster_id END)", "any": "max(cluster_id)"}
    picks = ", ".join(lane[k] for k in lanes)
    return f"""WITH w AS (SELECT product, cluster_key, min(parent_key) AS parent_key FROM {_WANTED} x GROUP BY ALL), a AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM catalog c WHERE c.is_active AND c.cluster_level = 3 AND c.product = w.product AND c.cluster_key = w.cluster_key)),
u AS (SELECT product, cluster_key AS parent_key, coalesce({picks}) AS parent_id FROM catalog WHERE is_active AND cluster_level = 2 GROUP BY ALL), n AS (SELECT a.*, u.parent_id FROM a JOIN u USING (product, parent_key) WHERE u.parent_id IS NOT NULL)
SELECT ((SELECT max(cluster_id) FROM catalog) + row_number() OVER (ORDER BY product, cluster_key))::BIGINT AS cluster_id, product, cluster_key, parent_id FROM n"""


def _wanted(t):
    return t.sql(f"SELECT * FROM {_WANTED}").groupBy("product", "cluster_key").agg(F.min("parent_key").alias("parent_key")).withColumn("signature_text", F.lit("new"))


@query("m9_get_or_create", _created(["own", "none"]))
def m9(t):
    return M.get_or_create_nodes(t.catalog, _wanted(t), 3, "phase1b").select("cluster_id", "product", "cluster_key", "parent_id")


@query("m9_fill_blank_signature", "SELECT cluster_id, CASE WHEN (c.signature_text IS NULL OR trim(c.signature_text) = '') AND cluster_level = 1 THEN 'filled' ELSE c.signature_text END AS signature_text FROM catalog c WHERE cluster_level < 3")
def m9b(t):
    rows = t.catalog.where("cluster_level < 3")
    values = rows.where("cluster_level = 1").select("cluster_id", F.lit("filled").alias("signature_text"))
    return M.fill_blank(rows, values, ["cluster_id"], "signature_text").select("cluster_id", "signature_text")


@query("m10_get_or_create_lanes", _created(["own", "none", "any"]))
def m10(t):
    return M.get_or_create_nodes(t.catalog, _wanted(t), 3, "phase1b", ("own", "none", "any")).select("cluster_id", "product", "cluster_key", "parent_id")


@query("m11_membership_upsert", "SELECT coalesce(b.thread_id, c.thread_id) AS thread_id, coalesce(c.leaf_id, b.leaf_id) AS leaf_id, CASE WHEN c.leaf_id IS NOT NULL THEN date '2024-02-05' ELSE b.assigned_on END AS assigned_on FROM memberships b FULL JOIN (SELECT thread_id, 4000000000 + length(leaf_key) AS leaf_id FROM mutes) c ON b.thread_id = c.thread_id")
def m11(t):
    new = t.mutes.select("thread_id", (F.lit(4000000000) + F.length("leaf_key")).alias("leaf_id"), F.lit(NOW).alias("assigned_on"))
    return M.upsert(t.memberships, new, "thread_id")


@query("m12_apply_ids", "SELECT t.thread_id, CASE WHEN r.topic_id IS NOT NULL THEN r.topic_id ELSE t.topic_id END AS topic_id, CASE WHEN r.topic_id IS NOT NULL THEN date '2024-02-05' ELSE t.completed_on END AS completed_on FROM threads t LEFT JOIN (SELECT thread_id, CASE WHEN leaf_key LIKE '%1' THEN 1000000001 END AS topic_id FROM mutes) r USING (thread_id)")
def m12(t):
    found = t.mutes.select(F.col("thread_id").alias("_k"), F.when(F.col("leaf_key").endswith("1"), F.lit(1000000001)).alias("_topic"))
    rows = t.threads.join(found, F.col("thread_id") == F.col("_k"), "left")
    hit = F.col("_topic").isNotNull()
    return rows.select("thread_id", F.when(hit, F.col("_topic").cast("long")).otherwise(F.col("topic_id")).alias("topic_id"), F.when(hit, F.lit(NOW)).otherwise(F.col("completed_on")).alias("completed_on"))


_INCOMING = "(SELECT incident_id, cast(0.55 AS DECIMAL(5,3)) AS confidence, max(added_on) AS last_seen, count(*) AS incoming FROM incident_threads WHERE incident_id % 3 = 0 GROUP BY incident_id UNION ALL SELECT cast(999999 AS BIGINT), cast(0.5 AS DECIMAL(5,3)), date '2024-02-01', cast(2 AS BIGINT))"


@query("m13_incident_upsert", f"""SELECT coalesce(b.incident_id, c.incident_id) AS incident_id, CASE WHEN b.incident_id IS NULL OR c.confidence > b.confidence THEN c.confidence ELSE b.confidence END AS confidence,
CASE WHEN b.incident_id IS NULL OR c.last_seen > b.last_seen THEN c.last_seen ELSE b.last_seen END AS last_seen, (CASE WHEN c.incident_id IS NOT NULL THEN c.incoming + coalesce(s.n, 0) ELSE b.thread_count END)::BIGINT AS thread_count
FROM incidents b FULL JOIN {_INCOMING} c ON b.incident_id = c.incident_id LEFT JOIN (SELECT incident_id, count(*) AS n FROM incident_threads GROUP BY 1) s ON s.incident_id = c.incident_id""")
def m13(t):
    base = t.incidents.select("incident_id", F.col("confidence").cast("decimal(5,3)").alias("confidence"), "last_seen", "thread_count")
    return M.incident_upsert(base, t.sql(f"SELECT * FROM {_INCOMING}"), t.incident_threads)


@query("m14_incident_upsert_full", """SELECT b.incident_id, CASE WHEN c.status IN ('active', 'investigating', 'mitigated', 'resolved', 'by-design', 'false-positive', 'archived') THEN c.status WHEN c.incident_id IS NOT NULL THEN 'active' ELSE b.status END AS status,
CASE WHEN length(c.summary) > length(b.summary) THEN c.summary ELSE b.summary END AS summary FROM incidents b LEFT JOIN (SELECT incident_id, CASE WHEN incident_id % 2 = 0 THEN 'mitigated' ELSE 'nonsense' END AS status, 'a longer summary' AS summary FROM incidents WHERE incident_id % 5 = 0) c USING (incident_id)""")
def m14(t):
    from ..operators.validation import INCIDENT_STATUSES

    c = t.incidents.where("incident_id % 5 = 0").select("incident_id", F.when(F.col("incident_id") % 2 == 0, F.lit("mitigated")).otherwise(F.lit("nonsense")).alias("status"), F.lit("a longer summary").alias("summary"))
    status = F.when(F.col("c.status").isin(*INCIDENT_STATUSES), F.col("c.status")).when(F.col("c._c").isNotNull(), F.lit("active")).otherwise(F.col("b.status"))
    longer = F.when(F.length("c.summary") > F.length("b.summary"), F.col("c.summary")).otherwise(F.coalesce("b.summary", "c.summary"))
    return M.upsert(t.incidents.select("incident_id", "status", "summary"), c, "incident_id", {"status": status, "summary": longer})


@query("m15_insert_links", "SELECT DISTINCT incident_id, thread_id FROM (SELECT incident_id, thread_id FROM incident_threads WHERE created_on IS NOT NULL UNION ALL SELECT incident_id, thread_id FROM incident_threads)")
def m15(t):
    have = t.incident_threads.where("created_on is not null").select("incident_id", "thread_id")
    lists = t.incident_threads.groupBy("incident_id").agg(F.collect_list("thread_id").alias("ids"))
    return M.insert_absent(have, lists.select("incident_id", F.explode("ids").alias("thread_id")), ["incident_id", "thread_id"])


@query("m16_area_paths", "SELECT sha1(lower(concat_ws('|', p_brand, p_type, 'General', ''))) AS path_hash, p_brand AS product, p_type AS category, count(*) AS n FROM part WHERE p_brand IS NOT NULL AND p_type IS NOT NULL GROUP BY p_brand, p_type")
def m16(t):
    from ..functions.keys import path_hash

    rows = t.part.where("p_brand is not null and p_type is not null")
    h = path_hash(F.col("p_brand"), F.col("p_type"), F.lit("General"), F.lit(None).cast("string"))
    return rows.groupBy(h.alias("path_hash"), F.col("p_brand").alias("product"), F.col("p_type").alias("category")).agg(F.count("*").alias("n"))


_LIFE = """WITH s AS (SELECT incident_id, count(*) AS n, min(coalesce(created_on, added_on)) AS f, max(coalesce(created_on, added_on)) AS l FROM incident_threads GROUP BY 1),
a AS (SELECT i.*, i.status AS old_status, CASE WHEN i.status IN ('active', 'possibly_resolved') AND s.n IS NOT NULL THEN s.l ELSE i.last_seen END AS seen, CASE WHEN i.status IN ('active', 'possibly_resolved') AND s.n IS NOT NULL THEN s.n ELSE i.thread_count END AS n2 FROM incidents i LEFT JOIN s USING (incident_id)),
b AS (SELECT *, CASE WHEN status = 'active' AND seen < date '2024-01-22' AND seen >= date '2024-01-06' THEN 'possibly_resolved' ELSE status END AS s1 FROM a),
c AS (SELECT *, CASE WHEN s1 IN ('active', 'possibly_resolved') AND seen < date '2024-01-06' THEN 'resolved' ELSE s1 END AS s2, CASE WHEN s1 IN ('active', 'possibly_resolved') AND seen < date '2024-01-06' THEN coalesce(resolved_on, date '2024-01-22') ELSE resolved_on END AS r2 FROM b)
SELECT incident_id, old_status, CASE WHEN s2 = 'resolved' AND seen >= date '2024-01-22' THEN 'active' ELSE s2 END AS status, CASE WHEN s2 = 'resolved' AND seen >= date '2024-01-22' THEN NULL ELSE r2 END AS resolved_on, n2 AS thread_count FROM c"""


@query("m17_incident_lifecycle", _LIFE)
def m17(t):
    return M.incident_lifecycle(t.incidents, t.incident_threads, dt.date(2024, 1, 22), dt.date(2024, 1, 6)).select("incident_id", "old_status", "status", "resolved_on", "thread_count")


@query("m18_incidents_to_push", "SELECT incident_id FROM incidents WHERE wiki_path IS NOT NULL AND updated_on > date '2024-01-25'")
def m18(t):
    return t.incidents.where(F.col("wiki_path").isNotNull() & (F.col("updated_on") > F.lit(dt.date(2024, 1, 25)))).select("incident_id")


@query("m19_clear_stale_claims", "SELECT thread_id, CASE WHEN started_on IS NOT NULL AND completed_on IS NULL AND started_on < date '1999-01-01' THEN NULL ELSE started_on END AS started_on FROM threads")
def m19(t):
    return M.clear_stale_claims(t.threads, dt.date(1999, 1, 1)).select("thread_id", "started_on")


@query("m19_force_reset", "SELECT thread_id, CASE WHEN batch_id = 'b1998' THEN NULL ELSE started_on END AS started_on, CASE WHEN batch_id = 'b1998' THEN NULL ELSE completed_on END AS completed_on FROM threads")
def m19b(t):
    return M.reset_states(t.threads, F.col("batch_id") == "b1998", ["started_on", "completed_on"]).select("thread_id", "started_on", "completed_on")


@query("m20_stamp_batch", "SELECT thread_id, CASE WHEN thread_id IN (SELECT thread_id FROM threads WHERE batch_id <> 'b1998' ORDER BY thread_id LIMIT 500) THEN 'b1998' ELSE batch_id END AS batch_id FROM threads")
def m20(t):
    return M.stamp_batch(t.threads, "b1998", 500, force=True).select("thread_id", "batch_id")


@query("m21_wiki_reset", "SELECT cluster_id, CASE WHEN cluster_level = 4 AND cluster_id IN (SELECT leaf_id FROM threads WHERE leaf_id IS NOT NULL GROUP BY leaf_id HAVING count(*) FILTER (batch_id = 'b1998') = count(*)) THEN NULL ELSE wiki_path END AS wiki_path FROM catalog")
def m21(t):
    own = R.exclusive_groups(t.threads.where("leaf_id is not null"), "leaf_id", "batch_id", "b1998").select(F.col("leaf_id").alias("_k"))
    rows = t.catalog.join(own, F.col("cluster_id") == F.col("_k"), "left")
    return rows.select("cluster_id", F.when(F.col("_k").isNull(), F.col("wiki_path")).alias("wiki_path"))


@query("m21_delete_nuggets", "SELECT nugget_id FROM nuggets WHERE product NOT IN (SELECT name FROM products WHERE thread_count > 80)")
def m21b(t):
    return t.nuggets.join(t.products.where("thread_count > 80").select(F.col("name").alias("product")), "product", "left_anti").select("nugget_id")


@query("m22_mark_used", "SELECT thread_id, CASE WHEN thread_id IN (SELECT thread_id FROM mutes) THEN coalesce(mined_on, date '2024-02-05') ELSE mined_on END AS mined_on FROM threads")
def m22(t):
    return M.mark(t.threads, t.mutes, "mined_on", NOW).select("thread_id", "mined_on")


@query("m22_mark_checked", "SELECT thread_id, CASE WHEN thread_id IN (SELECT thread_id FROM mutes) THEN date '2024-02-05' ELSE checked_on END AS checked_on FROM threads")
def m22b(t):
    return M.mark(t.threads, t.mutes, "checked_on", NOW, first_write_wins=False).select("thread_id", "checked_on")


@query("m23_watermark", "SELECT 'batch_clean' AS name, coalesce(max(created_on), date '1900-01-01') AS last_on, coalesce(max(question_id), '') AS last_id FROM raw_threads")
def m23(t):
    have = t.spark.createDataFrame([("batch_clean", dt.date(1900, 1, 1), "")], "name string, last_on date, last_id string")
    new = t.raw_threads.agg(F.coalesce(F.max("created_on"), F.lit(dt.date(1900, 1, 1))).alias("last_on"), F.coalesce(F.max("question_id"), F.lit("")).alias("last_id")).withColumn("name", F.lit("batch_clean"))
    return M.upsert(have, new, "name")


@query("m24_delete_cascade", "SELECT nugget_id, product FROM nuggets WHERE product <> 'Brand#7'")
def m24(t):
    gone = t.products.where("name = 'Brand#7'").select(F.col("name").alias("product"))
    return t.nuggets.join(gone, "product", "left_anti").select("nugget_id", "product")


@query("m25_mark_wiki", "SELECT cluster_id, CASE WHEN cluster_level = 1 THEN '/kb/new/' || cluster_key WHEN cluster_level = 2 AND wiki_path IS NULL THEN 'push_failed' ELSE wiki_path END AS wiki_path, CASE WHEN cluster_level = 1 THEN sha256('# ' || cluster_key) END AS content_hash FROM catalog")
def m25(t):
    one = F.col("cluster_level") == 1
    failed = (F.col("cluster_level") == 2) & F.col("wiki_path").isNull()
    return t.catalog.select("cluster_id", F.when(one, F.concat(F.lit("/kb/new/"), "cluster_key")).when(failed, F.lit("push_failed")).otherwise(F.col("wiki_path")).alias("wiki_path"), F.when(one, F.sha2(F.concat(F.lit("# "), "cluster_key"), 256)).alias("content_hash"))


@query("m26_apply_judgements", "SELECT thread_id, coalesce(emergent_signal, CASE WHEN thread_id IN (SELECT thread_id FROM mutes) THEN 0.7 END)::DECIMAL(4,2) AS emergent_signal FROM threads")
def m26(t):
    j = t.mutes.select(F.col("thread_id").alias("_k"), F.lit("0.7").cast("decimal(4,2)").alias("_s"))
    return t.threads.join(j, F.col("thread_id") == F.col("_k"), "left").select("thread_id", F.coalesce("emergent_signal", "_s").cast("decimal(4,2)").alias("emergent_signal"))


@query("m27_nugget_insert", "SELECT nugget_id, substr(title, 1, 5) AS title, '{\"quote\":\"' || substr(title, 1, 4) || '\"}' AS evidence FROM nuggets WHERE action = 'keep'")
def m27(t):
    return t.nuggets.where("action = 'keep'").select("nugget_id", F.substring("title", 1, 5).alias("title"), F.to_json(F.struct(F.substring("title", 1, 4).alias("quote"))).alias("evidence"))


_CLUSTERS = "SELECT p_partkey AS cluster_id, 'k' || cast(p_size % 2 AS STRING) AS kind, p_type AS signature_hash, date '2024-01-01' + cast(p_partkey % 400 AS INT) AS created_on, date '2024-01-01' AS last_seen FROM part"


@query("m28_signature_lookup", f"SELECT kind, signature_hash, arg_max(cluster_id, (created_on, cluster_id)) AS cluster_id FROM ({_CLUSTERS}) c WHERE created_on >= date '2024-12-01' - 30 AND signature_hash IN (SELECT p_type FROM part WHERE p_partkey % 3 = 0) GROUP BY ALL")
def m28(t):
    wanted = t.sql("SELECT p_type AS signature_hash, 'k0' AS kind FROM part WHERE p_partkey % 3 = 0 UNION SELECT p_type, 'k1' FROM part WHERE p_partkey % 3 = 0")
    return M.latest_with_signature(t.sql(_CLUSTERS), wanted, dt.date(2024, 12, 1), 30)


@query("m28_signature_upsert", f"""WITH c AS ({_CLUSTERS}), w AS (SELECT 'k0' AS kind, p_type AS signature_hash FROM part UNION SELECT 'k0', 'new ' || cast(p_size AS STRING) FROM part),
h AS (SELECT arg_max(cluster_id, (created_on, cluster_id)) AS cluster_id, kind, signature_hash FROM c JOIN w USING (kind, signature_hash) GROUP BY ALL), a AS (SELECT * FROM w ANTI JOIN h USING (kind, signature_hash))
SELECT cluster_id, kind, signature_hash, CASE WHEN cluster_id IN (SELECT cluster_id FROM h) THEN date '2025-05-05' ELSE last_seen END AS last_seen FROM c
UNION ALL SELECT (SELECT max(cluster_id) FROM c) + row_number() OVER (ORDER BY kind, signature_hash), kind, signature_hash, date '2025-05-05' FROM a""")
def m28b(t):
    wanted = t.sql("SELECT 'k0' AS kind, p_type AS signature_hash FROM part UNION SELECT 'k0', 'new ' || cast(p_size AS STRING) FROM part")
    return M.upsert_signatures(t.sql(_CLUSTERS), wanted, dt.date(2025, 5, 5)).select("cluster_id", "kind", "signature_hash", "last_seen")
