"""Keys, product names and annotations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import annotations as A
from ..functions import keys as N
from ..functions import limits as L
from ..functions import products as B
from ..operators import validation as V
from ..registry import query

_ALIASES = ["brand", "brand#2", "eco"]


@query("n1_norm_key", "SELECT nugget_id, left(replace(lower(trim(' ' || title || ' ' || product)), ' ', '-'), 360) AS k FROM nuggets")
def n1(t):
    return t.nuggets.select("nugget_id", N.norm_key(F.concat(F.lit(" "), "title", F.lit(" "), "product")).alias("k"))


_LEVELS = "CASE p_partkey % 9 WHEN 0 THEN 'topic' WHEN 1 THEN ' Variant ' WHEN 2 THEN 'L3' WHEN 3 THEN 'level2' WHEN 4 THEN '4' WHEN 5 THEN '2.0' WHEN 6 THEN '9' WHEN 7 THEN 'what' ELSE NULL END"


@query("n2_norm_level", "SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN 1 WHEN 1 THEN 3 WHEN 2 THEN 3 WHEN 3 THEN 2 WHEN 4 THEN 4 WHEN 5 THEN 2 ELSE 0 END AS level FROM part")
def n2(t):
    return t.part.select("p_partkey", N.norm_level(F.expr(_LEVELS)).alias("level"))


@query("n3_candidate_id", "SELECT cluster_id, left(sha1(lower(concat_ws('|', trim(product), cast(cluster_level AS STRING), trim(cluster_key), '', '', ''))), 12) AS id FROM catalog")
def n3(t):
    none = F.lit(None).cast("string")
    return t.catalog.select("cluster_id", N.candidate_id(F.col("product"), F.col("cluster_level"), F.col("cluster_key"), none, none, none).alias("id"))


@query("n4_path_hash", "SELECT p_partkey, sha1(lower(p_brand || '|' || p_type || '|' || p_name || '|')) AS h FROM part")
def n4(t):
    return t.part.select("p_partkey", N.path_hash(F.col("p_brand"), F.col("p_type"), F.col("p_name"), F.lit(None).cast("string")).alias("h"))


_K = "p_brand || '-' || replace(p_name, ' ', '-')"


@query("n5_alias_strip", f"SELECT p_partkey, CASE WHEN starts_with(lower(k), 'brand#2-') THEN substr(k, 9) WHEN starts_with(lower(k), 'brand-') THEN substr(k, 7) WHEN starts_with(lower(k), 'eco-') THEN substr(k, 5) ELSE k END AS k FROM (SELECT p_partkey, {_K} AS k FROM part)")
def n5(t):
    return t.part.select("p_partkey", B.strip_alias(F.expr(_K), _ALIASES).alias("k"))


@query("n6_alias_reject", f"SELECT p_partkey FROM (SELECT p_partkey, lower({_K}) AS k FROM part) WHERE k IN ('brand', 'brand#2', 'eco') OR starts_with(k, 'brand-') OR starts_with(k, 'brand#2-') OR starts_with(k, 'eco-')")
def n6(t):
    return t.part.where(B.is_alias(F.lower(F.expr(_K)), _ALIASES)).select("p_partkey")


_BUILTIN = {"Brand#1": "First", "Brand#3": "Third"}


@query("n7_alias_lookup", "SELECT p_partkey, CASE p_brand WHEN 'Brand#1' THEN 'One' WHEN 'Brand#3' THEN 'Third' WHEN 'Brand#5' THEN 'Five' ELSE p_brand END AS product FROM part")
def n7(t):
    table = t.spark.createDataFrame([("Brand#1", "One"), ("Brand#5", "Five")], "alias string, canonical string")
    return B.lookup_alias(t.part.select("p_partkey", F.col("p_brand").alias("product")), table, _BUILTIN).select("p_partkey", "product")


@query("n8_product_cascade", """WITH r AS (SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN lower(p_name) WHEN 1 THEN p_name || ' set' WHEN 2 THEN upper(p_type) ELSE p_name || ' big set of ' || p_type END AS raw FROM part UNION SELECT 'Other' UNION SELECT ''),
k AS (SELECT DISTINCT p_name AS name FROM part WHERE p_partkey % 3 = 0),
rt AS (SELECT raw, list_filter(list_distinct(regexp_split_to_array(lower(raw), '[^a-z0-9]+')), lambda x: x NOT IN ('', 'the', 'brand')) AS a FROM r WHERE raw <> '' AND raw <> 'Other'),
kt AS (SELECT name, list_filter(list_distinct(regexp_split_to_array(lower(name), '[^a-z0-9]+')), lambda x: x NOT IN ('', 'the', 'brand')) AS b FROM k),
p AS (SELECT raw, name, len(list_intersect(a, b)) AS i, len(a) AS na, len(b) AS nb FROM rt, kt),
c AS (SELECT raw, name, CASE WHEN lower(raw) = lower(name) THEN 1 WHEN i > 0 AND (i = na OR i = nb) THEN 2 WHEN i::DOUBLE / (na + nb - i) >= 0.6 THEN 3 END AS rule, CASE WHEN i = na OR i = nb OR lower(raw) = lower(name) THEN 0 ELSE i::DOUBLE / (na + nb - i) END AS score FROM p),
b AS (SELECT raw, name FROM (SELECT *, row_number() OVER (PARTITION BY raw ORDER BY rule, score DESC, name) AS rn FROM c WHERE rule IS NOT NULL) WHERE rn = 1)
SELECT r.raw, coalesce(b.name, r.raw) AS product FROM r LEFT JOIN b USING (raw)""")
def n8(t):
    raw = F.expr("CASE p_partkey % 4 WHEN 0 THEN lower(p_name) WHEN 1 THEN p_name || ' set' WHEN 2 THEN upper(p_type) ELSE p_name || ' big set of ' || p_type END")
    names = t.part.select(raw.alias("raw")).union(t.spark.createDataFrame([("Other",), ("",)], "raw string"))
    return B.normalize_products(names, t.part.where("p_partkey % 3 = 0").select(F.col("p_name").alias("name")).distinct())


_SIGNALS = [("Gateway", ["ring"]), ("Unknown", ["cog"]), ("Network", ["red", "blue"])]


@query("n9_cross_product_override", "SELECT p_partkey, CASE WHEN contains(lower(p_name), 'ring') THEN 'Gateway' WHEN contains(lower(p_name), 'red') OR contains(lower(p_name), 'blue') THEN 'Network' END AS product FROM part")
def n9(t):
    return t.part.select("p_partkey", B.override_product(F.col("p_brand"), F.col("p_name"), ["gateway", "Network"], _SIGNALS).alias("product"))


_SITE = "CASE page_id % 5 WHEN 0 THEN 'https://LEARN.microsoft.com/a?u=github.com' WHEN 1 THEN 'https://StackOverflow.com/q/1' WHEN 2 THEN 'https://gist.github.com/x' WHEN 3 THEN NULL ELSE url END"


@query("n10_source_classifier", "SELECT page_id, CASE page_id % 5 WHEN 1 THEN 'so' WHEN 2 THEN 'github' ELSE 'msqa' END AS source FROM pages")
def n10(t):
    return t.pages.select("page_id", N.source_of(F.expr(_SITE)).alias("source"))


_PARSE = r"regexp_replace(regexp_replace(trim(output), '^```[a-zA-Z]*\s*', ''), '\s*```$', '')"
_OK = "json_valid(t) AND json_type(t) = 'OBJECT'"


@query("t29_parse_object", f"SELECT thread_id, CASE WHEN t = '' THEN 'empty_model_output' WHEN {_OK} THEN NULL WHEN json_valid(t) THEN 'json_not_object' ELSE 'json_parse_failed' END AS error FROM (SELECT thread_id, {_PARSE} AS t FROM annotations)")
def t29(t):
    return t.annotations.select("thread_id", A.parse_object(F.col("output"))["error"].alias("error"))


_J = "json_extract_string(j, '$.{}')"


@query("n11_annotation_mapping", f"""WITH p AS (SELECT thread_id, {_PARSE} AS t FROM annotations), q AS (SELECT thread_id, t, CASE WHEN t <> '' AND json_valid(t) THEN CASE WHEN json_type(t) = 'OBJECT' THEN t END END AS j FROM p),
m AS (SELECT thread_id, j, coalesce(nullif({_J.format('product')}, ''), 'Other') AS product, {_J.format('is_emergent')} = 'true' AS e FROM q),
k AS (SELECT *, coalesce(nullif({_J.format('topic_cluster_key')}, ''), product || ':unknown') AS topic FROM m), s AS (SELECT *, coalesce(nullif({_J.format('scenario_cluster_key')}, ''), topic) AS scenario FROM k)
SELECT thread_id, CASE WHEN j IS NOT NULL THEN CASE WHEN {_J.format('language')} IN ('en', 'zh', 'ja', 'ko', 'es', 'fr', 'de', 'pt', 'ru', 'other') THEN {_J.format('language')} ELSE 'other' END END AS language,
CASE WHEN j IS NOT NULL THEN product END AS product, CASE WHEN j IS NOT NULL AND {_J.format('classification')} IN ('faq', 'emergent_issue') THEN {_J.format('classification')} ELSE 'not_usable' END AS classification,
CASE WHEN j IS NOT NULL AND {_J.format('resolution_status')} = 'solved' THEN 'solved' ELSE 'unknown' END AS resolution_status, CASE WHEN j IS NOT NULL THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, json_extract(j, '$.solution_usefulness')::DOUBLE)) ELSE 0.0::DOUBLE END AS usefulness,
coalesce(e, false) AS is_emergent, CASE WHEN e THEN 0.5::DOUBLE END AS emergent_signal, CASE WHEN j IS NOT NULL THEN topic ELSE '' END AS topic_key, CASE WHEN j IS NOT NULL THEN scenario ELSE '' END AS scenario_key,
CASE WHEN j IS NOT NULL THEN scenario || '__unknown' ELSE '' END AS leaf_key FROM s""")
def n11(t):
    return A.annotation_columns(t.annotations).select("thread_id", "language", "product", "classification", "resolution_status", "usefulness", "is_emergent", "emergent_signal", "topic_key", "scenario_key", "leaf_key")


@query("n12_failure_fallback", f"SELECT thread_id, 'not_usable' AS classification, '' AS topic_key FROM (SELECT thread_id, {_PARSE} AS t FROM annotations) WHERE NOT (t <> '' AND json_valid(t) AND coalesce(json_type(CASE WHEN json_valid(t) THEN t END), '') = 'OBJECT')")
def n12(t):
    return A.annotation_columns(t.annotations).where("parse_error is not null").select("thread_id", "classification", "topic_key")


@query("t30_json_strings", "SELECT cluster_id, json_array_length(steps)::INT AS n FROM solutions")
def t30(t):
    return t.solutions.select("cluster_id", F.size(F.from_json("steps", "array<string>")).alias("n"))


@query("n17_keep_gate", "WITH h AS (SELECT nugget_id FROM nuggets), k AS (SELECT nugget_id FROM nuggets WHERE action = 'keep') SELECT nugget_id FROM h WHERE (SELECT count(*) FROM k) < floor((SELECT count(*) FROM h) * 0.85) OR nugget_id IN (SELECT nugget_id FROM k)")
def n17(t):
    ids = t.nuggets.select("nugget_id")
    none = ids.limit(0)
    return V.refine(ids, none, t.nuggets.where("action = 'keep'").select("nugget_id"), none, "nugget_id")


@query("n19_slim_catalog", "SELECT c.cluster_id, p.cluster_key AS parent_key, left(c.signature_text, 8) AS signature_text FROM catalog c LEFT JOIN catalog p ON p.cluster_id = c.parent_id")
def n19(t):
    up = t.catalog.select(F.col("cluster_id").alias("_i"), F.col("cluster_key").alias("parent_key"))
    return t.catalog.join(up, F.col("parent_id") == F.col("_i"), "left").select("cluster_id", "parent_key", F.substring("signature_text", 1, 8).alias("signature_text"))


@query("n23_sanitize_name", "SELECT p_partkey, left(regexp_replace(lower(p_brand || ' ' || p_name), '[^a-z0-9_-]', '_', 'g'), 60) AS name FROM part")
def n23(t):
    return t.part.select("p_partkey", N.sanitize_name(F.concat("p_brand", F.lit(" "), "p_name")).alias("name"))


@query("v5_parameter_clamps", """SELECT p_partkey, greatest(1, least(25, p_size * 2 - 40)) AS batch_size, greatest(200, least(2500, p_size * 90 - 100)) AS slice_limit, greatest(10, least(1440, p_partkey::INT)) AS stale_minutes, greatest(0.0::DOUBLE, least(1.0::DOUBLE, p_retailprice / 1000 - 1)) AS min_usefulness FROM part""")
def v5(t):
    size = F.col("p_size")
    return t.part.select(
        "p_partkey", L.bounded_column("assign", "batch_size", size * 2 - 40).alias("batch_size"), L.bounded_column("catalog", "slice_limit", size * 90 - 100).alias("slice_limit"),
        L.bounded_column("emergent_assign", "stale_minutes", F.col("p_partkey").cast("int")).alias("stale_minutes"), L.bounded_column("variants", "min_usefulness", F.col("p_retailprice") / 1000 - 1).alias("min_usefulness"))


_ALIASED = "SELECT DISTINCT p_brand AS name, 'The ' || p_brand || '!' AS alias FROM part WHERE p_size % 2 = 0 UNION SELECT DISTINCT p_brand, lower(p_type) FROM part WHERE p_size = 7"
_LISTED = "SELECT DISTINCT p_brand AS name, 'b' || substr(p_brand, 7) AS slug FROM part WHERE p_size % 5 = 0 AND p_brand LIKE '%2'"
_KEYS = "CASE p_partkey % 5 WHEN 0 THEN 'the-brand-' || substr(p_brand, 7) || '-' || p_size WHEN 1 THEN 'brand-' || substr(p_brand, 7) WHEN 2 THEN 'B' || substr(p_brand, 7) || '-down' WHEN 3 THEN 'brand-' || substr(p_brand, 7) || '-' ELSE 'other-' || p_size END"
_SLUG = "trim(regexp_replace(lower({}), '[^a-z0-9]+', '-', 'g'), '-')"


@query("n25_alias_slugs", f"""WITH own AS (SELECT DISTINCT p_brand AS name, {_SLUG.format('p_brand')} AS slug FROM part UNION SELECT name, {_SLUG.format('alias')} FROM ({_ALIASED})), l AS ({_LISTED}),
s AS (SELECT * FROM l UNION SELECT name, slug FROM own WHERE name NOT IN (SELECT name FROM l)), k AS (SELECT p_partkey, p_brand, {_KEYS} AS key FROM part),
f AS (SELECT p_partkey, key, max(CASE WHEN starts_with(lower(key), slug || '-') AND length(key) > length(slug) + 1 THEN length(slug) END) AS n, bool_or(key = slug OR starts_with(key, slug || '-')) AS is_alias FROM k JOIN s ON s.name = p_brand GROUP BY ALL)
SELECT p_partkey, CASE WHEN n IS NULL THEN key ELSE substr(key, n + 2) END AS key, is_alias FROM f""")
def n25b(t):
    slugs = B.slug_table(t.part.select(F.col("p_brand").alias("name")).distinct(), t.sql(_ALIASED), t.sql(_LISTED))
    rows = t.part.select("p_partkey", F.col("p_brand").alias("name"), F.expr(_KEYS).alias("key")).join(slugs, "name")
    told = rows.withColumn("is_alias", B.is_slug(F.col("key"), F.col("slugs")))  # alone: in one select, lambdas would see the new key
    return told.select("p_partkey", B.strip_slug(F.col("key"), F.col("slugs")).alias("key"), "is_alias")


@query("n25_seed_products", "SELECT name, thread_count FROM products UNION ALL SELECT DISTINCT p_name, 0::BIGINT FROM part WHERE p_name NOT IN (SELECT name FROM products)")
def n25(t):
    from ..operators.mutations import insert_absent

    seeds = t.part.select(F.col("p_name").alias("name")).union(t.part.select("p_brand")).withColumn("thread_count", F.lit(0).cast("long"))
    return insert_absent(t.products.select("name", "thread_count"), seeds, "name")


@query("s9a_ancestor_paths", "SELECT DISTINCT array_to_string(list_slice(p, 1, i), '/') AS path FROM (SELECT string_split(regexp_replace(url, '^https?:/', ''), '/') AS p FROM pages), range(2, 8) r(i) WHERE i < len(list_filter(p, lambda x: x <> '')) + 1 AND len(p) >= i")
def s9a(t):
    path = F.regexp_replace("url", "^https?:/", "")
    return t.pages.select(F.explode(N.ancestors(path)).alias("path")).distinct()


@query("s10_patch_fields", "SELECT incident_id, 'Title=' || incident_key || CASE WHEN wiki_path IS NOT NULL THEN '; Path=' || wiki_path ELSE '' END || '; Tags=' || product || '; ' || status AS patch FROM incidents")
def s10(t):
    fields = F.create_map(F.lit("Title"), F.col("incident_key"), F.lit("Path"), F.col("wiki_path"), F.lit("Tags"), F.array_join(F.filter(F.array("product", F.lit(" "), "status"), lambda x: F.trim(x) != ""), "; "))
    full = F.map_filter(fields, lambda k, v: v.isNotNull() & (v != ""))
    return t.incidents.select("incident_id", F.array_join(F.transform(F.map_entries(full), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ").alias("patch"))


_QUESTION = "CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN 'https://q.site/en-us/answers/questions/' || page_id || '/how-to' ELSE 'https://q.site/questions/x' || page_id || '/questions/7' || page_id || '?a=1' END"


@query("t17_question_id", "SELECT page_id, CASE page_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'qa' || page_id ELSE 'qa7' || page_id END AS question_id FROM pages")
def t17(t):
    return t.pages.select("page_id", N.question_id(F.expr(_QUESTION)).alias("question_id"))


@query("t37_wiki_path", """SELECT l.cluster_id, '/kb/' || lower(l.product) || '/' || coalesce(s3, 'unknown-topic') || '/' || coalesce(s2, 'unknown-scenario') || '/' || coalesce(s1, 'unknown-variant') || '/' || s0 AS path FROM (
SELECT l.cluster_id, l.product, regexp_replace(l.cluster_key, '[^a-z0-9]+', '-', 'g') AS s0, regexp_replace(a1.cluster_key, '[^a-z0-9]+', '-', 'g') AS s1, regexp_replace(a2.cluster_key, '[^a-z0-9]+', '-', 'g') AS s2, regexp_replace(a3.cluster_key, '[^a-z0-9]+', '-', 'g') AS s3
FROM catalog l LEFT JOIN catalog a1 ON a1.cluster_id = l.parent_id AND a1.is_active LEFT JOIN catalog a2 ON a2.cluster_id = a1.parent_id AND a2.is_active LEFT JOIN catalog a3 ON a3.cluster_id = a2.parent_id AND a3.is_active WHERE l.cluster_level = 4) l""")
def t37(t):
    from ..operators.rollup import with_ancestors

    rows = with_ancestors(t.catalog.where("cluster_level = 4"), t.catalog)
    up = lambda k, n: F.when(F.col(f"up{k}_key").isNull(), F.lit(f"unknown-{n}")).otherwise(N.slug(F.col(f"up{k}_key")))
    return rows.select("cluster_id", F.concat_ws("/", F.lit("/kb"), N.slug(F.col("product")), up(3, "topic"), up(2, "scenario"), up(1, "variant"), N.slug(F.col("cluster_key"))).alias("path"))
