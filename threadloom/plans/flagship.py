"""The flagship: roll the catalog up, choose publishable leaves, give each its breadcrumb."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rollup as R
from ..operators.selection import leaf_candidates
from ..registry import query
from .aggregates import ROLLUP


@query("flagship_publishable_leaves", ROLLUP + """, k AS (SELECT * FROM rolled WHERE cluster_level = 4 AND is_active AND ((c >= 2 AND u >= 0.6) OR u >= 0.9) AND cluster_id NOT IN (SELECT cluster_id FROM solutions)
ORDER BY u DESC, c DESC, last_seen DESC, cluster_id LIMIT 200)
SELECT k.cluster_id, k.c AS member_count, CAST(k.u AS DECIMAL(4,3)) AS max_usefulness, concat_ws('/', '/kb', lower(k.product), coalesce(a3.cluster_key, 'unknown-topic'), coalesce(a2.cluster_key, 'unknown-scenario'), coalesce(a1.cluster_key, 'unknown-variant'), k.cluster_key) AS path
FROM k LEFT JOIN catalog a1 ON a1.cluster_id = k.parent_id AND a1.is_active LEFT JOIN catalog a2 ON a2.cluster_id = a1.parent_id AND a2.is_active LEFT JOIN catalog a3 ON a3.cluster_id = a2.parent_id AND a3.is_active""")
def flagship(t):
    rolled = R.rollup_levels(t.threads, t.catalog)
    chosen = leaf_candidates(rolled, t.solutions, 2, 0.6, 200)
    named = R.with_ancestors(chosen, t.catalog)
    up = lambda k, n: F.coalesce(f"up{k}_key", F.lit(f"unknown-{n}"))
    path = F.concat_ws("/", F.lit("/kb"), F.lower("product"), up(3, "topic"), up(2, "scenario"), up(1, "variant"), "cluster_key")
    return named.select("cluster_id", "member_count", "max_usefulness", path.alias("path"))
