"""The domain tables, derived from the star-schema test data by SQL that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations"]

_TE = """
SELECT cast(l_orderkey AS STRING) || '-' || cast(l_linenumber AS STRING) || '-' || cast(l_partkey AS STRING) || '-' || cast(l_suppkey AS STRING) || '-' || cast(cast(l_shipdate AS DATE) AS STRING) AS thread_id,
  CASE WHEN l_partkey % 97 = 0 THEN '' WHEN l_partkey % 89 = 0 THEN 'Other' WHEN l_partkey % 83 = 0 THEN NULL ELSE c_mktsegment END AS product,
  CASE l_returnflag WHEN 'A' THEN 'emergent_issue' WHEN 'R' THEN 'common_issue' ELSE CASE WHEN l_suppkey % 5 = 0 THEN 'not_usable' WHEN l_suppkey % 5 = 1 THEN NULL ELSE 'faq' END END AS classification,
  CASE WHEN l_quantity = 13 THEN NULL ELSE cast(l_discount * 10 AS DECIMAL(4,3)) END AS usefulness,
  l_returnflag = 'A' AND l_linestatus = 'F' AS is_emergent,
  CASE WHEN l_returnflag = 'A' AND l_partkey % 3 <> 0 THEN cast(l_tax * 10 AS DECIMAL(4,2)) END AS emergent_signal,
  'b' || cast(year(l_shipdate) AS STRING) AS batch_id,
  cast(l_shipdate AS DATE) AS created_on,
  lower(r_name) AS topic_key, lower(n_name) AS scenario_key, lower(c_name) AS variant_key, 'o' || cast(o_orderkey AS STRING) AS leaf_key,
  CASE WHEN l_quantity % 5 = 0 THEN NULL ELSE 1000000000 + cast(r_regionkey AS BIGINT) * 10 + seg END AS topic_id,
  CASE WHEN l_quantity % 5 = 0 THEN NULL ELSE 2000000000 + cast(n_nationkey AS BIGINT) * 10 + seg END AS scenario_id,
  CASE WHEN l_quantity % 5 = 0 THEN NULL ELSE 3000000000 + c_custkey END AS variant_id,
  CASE WHEN l_quantity % 5 = 0 THEN NULL ELSE 4000000000 + o_orderkey END AS leaf_id,
  CASE WHEN l_partkey % 17 = 0 THEN NULL WHEN l_partkey % 19 = 0 THEN ' ' ELSE 'sig ' || l_returnflag || ' ' || cast(l_partkey AS STRING) END AS signature_text,
  CASE WHEN l_partkey % 3 = 0 THEN cast(l_shipdate AS DATE) END AS checked_on,
  CASE WHEN l_suppkey % 4 = 0 THEN cast(l_shipdate AS DATE) END AS started_on,
  CASE WHEN l_suppkey % 8 = 0 THEN cast(l_shipdate AS DATE) END AS completed_on,
  CASE WHEN l_partkey % 7 = 0 THEN cast(l_shipdate AS DATE) END AS mined_on
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN segments ON c_mktsegment = segments.product
"""

_NODES = """
SELECT 1000000000 + cast(r_regionkey AS BIGINT) * 10 + seg AS cluster_id, 1 AS cluster_level, product, lower(r_name) AS cluster_key, cast(NULL AS BIGINT) AS parent_id FROM region CROSS JOIN segments
UNION ALL SELECT 2000000000 + cast(n_nationkey AS BIGINT) * 10 + seg, 2, product, lower(n_name), 1000000000 + cast(n_regionkey AS BIGINT) * 10 + seg FROM nation CROSS JOIN segments
UNION ALL SELECT 3000000000 + c_custkey, 3, c_mktsegment, lower(c_name), 2000000000 + cast(c_nationkey AS BIGINT) * 10 + seg FROM customer JOIN segments ON c_mktsegment = product
UNION ALL SELECT 4000000000 + o_orderkey, 4, c_mktsegment, 'o' || cast(o_orderkey AS STRING), 3000000000 + o_custkey FROM orders JOIN customer ON o_custkey = c_custkey
"""

#: name -> SQL; a table may use those above it and the base tables.
TABLES = {
    "segments": "SELECT * FROM (VALUES ('AUTOMOBILE', 0), ('BUILDING', 1), ('FURNITURE', 2), ('HOUSEHOLD', 3), ('MACHINERY', 4)) AS v(product, seg)",
    "threads": _TE,
    "nodes": _NODES,
    "catalog": """
SELECT cluster_id, cluster_level, product, cluster_key, parent_id,
  CASE WHEN cluster_id % 6 = 0 THEN '' WHEN cluster_id % 7 = 0 THEN NULL ELSE 'about ' || cluster_key END AS signature_text,
  CASE WHEN cluster_id % 5 = 0 THEN NULL ELSE 'fix ' || cluster_key END AS resolution_text,
  cast(cluster_id % 23 AS INT) AS member_count, cast(cast(cluster_id % 11 AS DOUBLE) / 10 AS DECIMAL(4,3)) AS max_usefulness,
  date '2024-01-01' - cast(cluster_id % 300 AS INT) AS last_seen, cluster_id % 13 <> 0 AS is_active,
  CASE cluster_id % 3 WHEN 0 THEN 'phase1b' WHEN 1 THEN 'phase2e' END AS created_by,
  CASE WHEN cluster_id % 4 = 0 THEN '/kb/' || cluster_key END AS wiki_path FROM nodes""",
    "solutions": """
SELECT 4000000000 + o_orderkey AS cluster_id, 'Fix ' || cast(o_orderkey AS STRING) AS title, 'Status ' || o_orderstatus AS problem,
  '["check ' || o_orderstatus || '","","apply ' || cast(o_custkey AS STRING) || '"]' AS steps, o_orderkey % 3 = 0 AS pushed FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "memberships": "SELECT thread_id, leaf_id, created_on AS assigned_on FROM threads WHERE leaf_id IS NOT NULL",
    "incident_threads": """
SELECT user_id * 1000 + cast(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS incident_id, 'e' || cast(event_id AS STRING) AS thread_id,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE cast(ts AS DATE) END AS created_on, cast(ts AS DATE) + 1 AS added_on,
  cast(value AS DECIMAL(10,2)) AS value FROM events WHERE event_type = 'error'""",
    "incidents": """
SELECT incident_id, 'inc-' || cast(incident_id AS STRING) AS incident_key, 'p' || cast(incident_id % 5 AS STRING) AS product,
  CASE incident_id % 4 WHEN 1 THEN 'possibly_resolved' WHEN 2 THEN 'resolved' WHEN 3 THEN 'archived' ELSE 'active' END AS status,
  cast(incident_id % 10 AS DECIMAL(4,2)) / 10 AS confidence, min(added_on) AS first_seen, CASE WHEN incident_id % 11 = 0 THEN NULL ELSE min(added_on) END AS last_seen,
  cast(1 AS BIGINT) AS thread_count, CASE WHEN incident_id % 4 = 2 THEN min(added_on) END AS resolved_on, 'sum ' || cast(incident_id % 7 AS STRING) AS summary,
  CASE WHEN incident_id % 8 = 0 THEN '/inc/' || cast(incident_id AS STRING) END AS wiki_path, max(added_on) AS updated_on FROM incident_threads GROUP BY incident_id""",
    "raw_threads": r"""
SELECT 'qa' || cast(doc_id AS STRING) AS question_id, CASE WHEN doc_id % 10 = 0 THEN NULL ELSE date '2024-01-01' + cast(doc_id % 60 AS INT) END AS created_on, source AS asker,
  CASE WHEN doc_id % 31 = 0 THEN NULL ELSE replace(text, '. ', '.' || chr(13) || chr(10)) || chr(10) || 'Add comment' || chr(10) || '  12 votes ' || chr(10) || chr(10) || chr(10) || chr(10) || 'follow' || chr(9)
   || chr(10) || 'tail   ' || lang || chr(10) || 'Copy' || chr(10) || 'keep  this' || chr(10) || CASE WHEN doc_id % 2 = 0 THEN 'Additional resources' ELSE 'No more' END || chr(10) || 'after' END AS content FROM documents""",
    "annotations": """
SELECT 'p' || cast(p_partkey AS STRING) AS thread_id, CASE WHEN p_partkey % 11 = 0 THEN 'oops {not json' WHEN p_partkey % 13 = 0 THEN '[1, 2]' WHEN p_partkey % 17 = 0 THEN '' ELSE
  CASE WHEN p_partkey % 5 = 0 THEN '```json' || chr(10) ELSE '' END || '{"language":"' || CASE p_size % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'xx' WHEN 2 THEN 'de' ELSE 'zh' END
  || '","product":"' || p_brand || '","classification":"' || CASE p_size % 3 WHEN 0 THEN 'faq' WHEN 1 THEN 'emergent_issue' ELSE 'strange' END
  || '","resolution_status":"' || CASE p_size % 2 WHEN 0 THEN 'solved' ELSE 'none' END || '","solution_usefulness":' || cast(p_size - 20 AS STRING) || '.25,"is_emergent":' || CASE WHEN p_size % 3 = 1 THEN 'true' ELSE 'false' END
  || ',"emergent_signal":0.5,"topic_cluster_key":"' || CASE WHEN p_partkey % 7 = 0 THEN '' ELSE lower(p_type) END || '","scenario_cluster_key":"' || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE replace(p_name, ' ', '-') END
  || '","signature_text":"' || p_name || '"}' || CASE WHEN p_partkey % 5 = 0 THEN chr(10) || '```' ELSE '' END END AS output FROM part""",
    "products": "SELECT p_brand AS name, count(*) AS thread_count, cast(max(p_size) AS INT) AS seen FROM part GROUP BY p_brand",
    "nuggets": """
SELECT 'n' || cast(p_partkey AS STRING) AS nugget_id, p_brand AS product, CASE p_partkey % 3 WHEN 0 THEN 'discard' ELSE 'keep' END AS action, CASE WHEN p_partkey % 6 = 1 THEN 'x' ELSE cast(1000000000 + p_partkey % 60 AS STRING) END AS cluster_ref,
  cast(p_size AS DECIMAL(4,2)) / 100 AS score, p_name AS title, lower(p_type) AS topic_key FROM part""",
    "mutes": "SELECT thread_id, leaf_key FROM threads WHERE leaf_id IS NULL",
}


def closure(sql: str, base_sql=None) -> list[tuple[str, str]]:
    """The tables that a statement needs, in order of definition."""
    need, todo = set(), [sql]
    while todo:
        words = set(re.findall(r"[a-z_]+", todo.pop()))
        for name in TABLES:
            if name in words and name not in need:
                need.add(name)
                todo.append(TABLES[name])
        if base_sql:
            need |= words & set(BASE)
    parts = [(n, base_sql(n)) for n in BASE if n in need] if base_sql else []
    return parts + [(n, s) for n, s in TABLES.items() if n in need]


def with_tables(sql: str, base_sql=None) -> str:
    """`sql` preceded by the definitions that it needs."""
    parts = ", ".join(f"{n} AS ({s})" for n, s in closure(sql, base_sql))
    body = sql.strip()
    if not parts:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {parts}, {body[5:]}"
    return f"WITH {parts} {body}"


class Tables:
    """The domain and base tables of a data folder as DataFrames: t.threads, t.catalog, t.documents."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in TABLES:
            return self.sql(f"SELECT * FROM {name}")
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(with_tables(text, lambda n: f"SELECT * FROM parquet.`{self.sf_dir}/{n}.parquet`"))
