"""Incremental queries; streams are compared with what the batch form gives."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import annotations as A
from ..registry import query
from ..sources.scratch import new_folder
from ..streaming import ingest as S
from ..streaming import stateful as T
from ..streaming.branches import fold_branches
from ..streaming.high_water import HighWater

_DAYS = "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, sum(cast(value AS DECIMAL(18,2)))::DECIMAL(28,2) AS total FROM events GROUP BY ALL"


@query("w1_incremental_ingest", "SELECT event_id, event_type FROM events WHERE event_type <> 'view'")
def w1(t):
    run = new_folder(t.spark, "stream")
    events = t.events
    S.run_available(t.spark, f"{t.sf_dir}/events.parquet*", events.schema, lambda s: s.where("event_type <> 'view'").select("event_id", "event_type"), f"{run}/out", f"{run}/state")
    return t.spark.read.schema("event_id long, event_type string").parquet(f"{run}/out")


@query("w1_bounded_runs", "SELECT run, count(*) AS taken, min(question_id) AS first, CASE WHEN run = max(max(run)) OVER () THEN 'ok' ELSE 'partial' END AS status FROM (SELECT question_id, 1 + (row_number() OVER (ORDER BY coalesce(created_on, date '1900-01-01'), question_id) - 1) // (SELECT (count(*) + 3) // 4 FROM documents) AS run FROM raw_threads) GROUP BY run")
def w1_bounded(t):
    # Four runs of a quarter of the rows each, and a fifth that finds nothing new.
    source = t.raw_threads.select("question_id", "created_on")
    water = HighWater(t.spark, new_folder(t.spark, "high-water"), "created_on", "question_id")
    most = -(-source.count() // 4)
    runs = [water.run(source, most, lambda rows, k=k: rows.withColumn("run", F.lit(k + 1).cast("long"))) for k in range(5)]
    taken = water.taken("question_id string, created_on date, run long")
    told = t.spark.createDataFrame([(r.run, r.status) for r in runs if r.taken], "run long, status string")
    return taken.groupBy("run").agg(F.count("*").alias("taken"), F.min("question_id").alias("first")).join(told, "run").select("run", "taken", "first", "status")


@query("w2_incremental_crawl", "SELECT page_id FROM pages WHERE page_id % 4 <> 1")
def w2(t):
    return S.unseen(t.pages, t.pages.where("page_id % 4 = 1"), "page_id").select("page_id")


@query("w3_event_windows", _DAYS)
def w3(t):
    return S.event_windows(t.events)


_ACTION = "CASE event_type WHEN 'purchase' THEN 'complete' WHEN 'error' THEN 'release' ELSE 'claim' END"


@query("w3_claim_queue", f"""WITH RECURSIVE e AS (SELECT user_id * 4 + (date_part('day', ts)::BIGINT - 1) // 8 AS thread_id, ts, event_id, 'w' || (event_id % 3) AS worker, {_ACTION} AS action,
row_number() OVER (PARTITION BY user_id * 4 + (date_part('day', ts)::BIGINT - 1) // 8 ORDER BY ts, event_id) AS rn FROM events),
s AS (SELECT thread_id, 0::BIGINT AS rn, 'free' AS status, NULL::VARCHAR AS holder, NULL::TIMESTAMP AS since, NULL::TIMESTAMP AS ended, NULL::VARCHAR AS ended_by, NULL::TIMESTAMP AS "at", NULL::BIGINT AS event_id, NULL::VARCHAR AS worker, NULL::VARCHAR AS result FROM e WHERE rn = 1
UNION ALL SELECT thread_id, rn, CASE WHEN result = 'claimed' THEN 'claimed' WHEN result = 'completed' THEN 'done' WHEN result = 'released' THEN 'free' ELSE status END, CASE WHEN result = 'claimed' THEN worker WHEN result IN ('completed', 'released') THEN NULL ELSE holder END,
CASE WHEN result = 'claimed' THEN ts WHEN result IN ('completed', 'released') THEN NULL ELSE since END, ended, ended_by, ts, event_id, worker, result
FROM (SELECT *, CASE WHEN action = 'claim' AND status = 'free' THEN 'claimed' WHEN action = 'claim' THEN 'denied' WHEN status = 'claimed' AND holder = worker THEN action || 'd' ELSE 'ignored' END AS result
FROM (SELECT e.thread_id, e.rn, e.ts, e.event_id, e.worker, e.action, CASE WHEN s.since + interval 12 hour <= e.ts THEN 'free' ELSE s.status END AS status, CASE WHEN s.since + interval 12 hour <= e.ts THEN NULL ELSE s.holder END AS holder, CASE WHEN s.since + interval 12 hour <= e.ts THEN NULL ELSE s.since END AS since,
CASE WHEN s.since + interval 12 hour <= e.ts THEN s.since + interval 12 hour END AS ended, CASE WHEN s.since + interval 12 hour <= e.ts THEN s.holder END AS ended_by FROM s JOIN e ON e.thread_id = s.thread_id AND e.rn = s.rn + 1)))
SELECT thread_id, "at", event_id, worker, result FROM s WHERE rn > 0 UNION ALL SELECT thread_id, ended, NULL, ended_by, 'timeout' FROM s WHERE ended IS NOT NULL
UNION ALL SELECT thread_id, since + interval 12 hour, NULL, holder, 'timeout' FROM (SELECT *, row_number() OVER (PARTITION BY thread_id ORDER BY rn DESC) AS back FROM s) WHERE back = 1 AND status = 'claimed' AND since + interval 12 hour < (SELECT max(ts) FROM events)""")
def w3_claims(t):
    # The events come in three parts; the query is started anew on its checkpoint for each.
    thread = F.col("user_id") * 4 + F.floor((F.dayofmonth("ts") - 1) / 8)
    rows = t.events.select(thread.cast("long").alias("thread_id"), F.col("ts").cast("timestamp").alias("at"), "event_id", F.concat(F.lit("w"), F.col("event_id") % 3).alias("worker"), F.expr(_ACTION).alias("action"))
    parts = [rows.where("at < '2024-01-11'"), rows.where("at >= '2024-01-11' and at < '2024-01-21'"), rows.where("at >= '2024-01-21'")]
    schema = "thread_id long, at timestamp, event_id long, worker string, action string"
    out = T.run_parts(parts, schema, lambda s: T.claim_results(s, dt.timedelta(hours=12)), T.CLAIM_RESULT, new_folder(t.spark, "claims"))
    return out.withColumn("at", F.col("at").cast("timestamp_ntz"))


def _live_step(k: int, day: str, before: str) -> str:
    """One monitor's run in SQL: threads up to a day, then ageing and revival as of the watermark."""
    last = f"(SELECT max(added_on) FROM incident_threads WHERE added_on <= date '{day}')"
    return f"""m{k} AS (SELECT incident_id, status, greatest(last_seen, l) AS last_seen FROM {before} LEFT JOIN (SELECT incident_id, max(added_on) AS l FROM incident_threads WHERE added_on <= date '{day}' GROUP BY 1) USING (incident_id)),
s{k} AS (SELECT incident_id, CASE WHEN status IN ('active', 'possibly_resolved') AND last_seen < {last} - 12 THEN 'resolved' WHEN status = 'active' AND last_seen < {last} - 5 THEN 'possibly_resolved' WHEN status = 'resolved' AND last_seen >= {last} - 5 THEN 'active' ELSE status END AS status, last_seen FROM m{k})"""


_LIVE_DAYS = ["2024-01-08", "2024-01-16", "2024-01-24", "2024-02-02"]


@query("w4_liveness_stream", "WITH s0 AS (SELECT incident_id, status, NULL::DATE AS last_seen FROM incidents), " + ", ".join(_live_step(k + 1, day, f"s{k}") for k, day in enumerate(_LIVE_DAYS)) + " SELECT incident_id, status, last_seen FROM s4")
def w4_stream(t):
    # Statuses of the incidents first, then their threads by days; the query is started anew for each part.
    links = t.incident_threads.select("incident_id", F.col("added_on").cast("timestamp").alias("at"), F.col("added_on").cast("timestamp").alias("seen"), F.lit(None).cast("string").alias("status"))
    begin = t.incidents.select("incident_id", F.lit(dt.datetime(2023, 12, 1)).cast("timestamp").alias("at"), F.lit(None).cast("timestamp").alias("seen"), "status")
    parts, before = [], "2023-12-31"
    for day in _LIVE_DAYS:
        parts.append(links.where(f"at > '{before}' and at <= '{day}'"))
        before = day
    schema = "incident_id long, at timestamp, seen timestamp, status string"
    states = T.run_parts([begin, *parts], schema, lambda s: T.live_states(s, dt.timedelta(days=5), dt.timedelta(days=12)), T.LIVE_RESULT, new_folder(t.spark, "liveness"))
    return T.latest(states).select("incident_id", "status", F.col("last_seen").cast("date").alias("last_seen"))


@query("w4_liveness", "SELECT incident_id, CASE WHEN max(added_on) < date '2024-01-06' THEN 'resolved' WHEN max(added_on) < date '2024-01-22' THEN 'possibly_resolved' ELSE 'active' END AS state FROM incident_threads GROUP BY 1")
def w4(t):
    last = t.incident_threads.groupBy("incident_id").agg(F.max("added_on").alias("last"))
    return last.select("incident_id", F.when(F.col("last") < F.lit("2024-01-06").cast("date"), "resolved").when(F.col("last") < F.lit("2024-01-22").cast("date"), "possibly_resolved").otherwise("active").alias("state"))


@query("w5_sessions", """WITH g AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + interval 3 hour THEN 1 ELSE 0 END AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, ts, sum(b) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM g)
SELECT user_id, count(*) AS n, min(ts) AS first, max(ts) AS last FROM s GROUP BY user_id, s""")
def w5(t):
    return S.sessions(t.events.select("user_id", "ts"), ["user_id"], "3 hours")


@query("w6_load_per_minute", "SELECT event_id, sum(cast(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type ORDER BY cast(floor(epoch(ts)) AS BIGINT) RANGE BETWEEN 60 PRECEDING AND CURRENT ROW)::DECIMAL(28,2) AS load FROM events")
def w6(t):
    return S.load_per_minute(t.events).select("event_id", "load")


@query("w7_branch_state", "SELECT incident_id, count(*) AS n, max(s)::BIGINT AS stretches FROM (SELECT incident_id, sum(b) OVER (PARTITION BY incident_id ORDER BY added_on, thread_id) AS s FROM (SELECT incident_id, added_on, thread_id, CASE WHEN added_on - lag(added_on) OVER (PARTITION BY incident_id ORDER BY added_on, thread_id) > 3 THEN 1 ELSE 0 END AS b FROM incident_threads)) GROUP BY 1")
def w7(t):
    rows = S.split_by_silence(t.incident_threads)
    return rows.groupBy("incident_id").agg(F.count("*").alias("n"), F.max("stretch").alias("stretches"))


def _join_or_open(branch, state, rows):
    """A thread joins its incident if that had one at most three days before, else opens one, which later threads can join."""
    state = state or {"last": {}, "number": {}, "opened": 0}
    out = []
    for r in rows:
        last = state["last"].get(r["incident_id"])
        opens = last is None or (r["added_on"] - last).days > 3
        if opens:
            state["opened"] += 1
            state["number"][r["incident_id"]] = state["opened"]
        state["last"][r["incident_id"]] = r["added_on"]
        out.append({"thread_id": r["thread_id"], "branch": branch, "number": state["number"][r["incident_id"]], "opens": opens})
    return state, out


@query("w7_fold_branches", """WITH g AS (SELECT thread_id, incident_id, added_on, 'p' || (incident_id % 5) AS branch, coalesce(added_on - lag(added_on) OVER (PARTITION BY incident_id ORDER BY added_on, thread_id) > 3, true) AS opens FROM incident_threads),
n AS (SELECT *, sum(opens::INT) OVER (PARTITION BY branch ORDER BY added_on, thread_id) AS k FROM g)
SELECT thread_id, branch, (max(CASE WHEN opens THEN k END) OVER (PARTITION BY incident_id ORDER BY added_on, thread_id))::BIGINT AS number, opens FROM n""")
def w7_fold(t):
    rows = t.incident_threads.select("thread_id", "incident_id", "added_on", F.concat(F.lit("p"), (F.col("incident_id") % 5).cast("string")).alias("branch"))
    return fold_branches(rows, "branch", ["added_on", "thread_id"], _join_or_open, "thread_id string, branch string, number long, opens boolean")


@query("annotator_rules", """WITH w AS (SELECT nugget_id AS thread_id, list_distinct(list_filter(regexp_split_to_array(lower(title), '[^a-z0-9]+'), lambda x: x <> '')) AS a FROM nuggets), k AS (SELECT k AS topic_key, list_distinct(list_filter(regexp_split_to_array(lower(k), '[^a-z0-9]+'), lambda x: x <> '')) AS b FROM (VALUES ('red ring'), ('big bolt'), ('small widget')) v(k)),
s AS (SELECT thread_id, topic_key, len(list_intersect(a, b))::DOUBLE / (len(a) + len(b) - len(list_intersect(a, b))) AS score FROM w, k), b AS (SELECT thread_id, arg_max(topic_key, (round(score, 9), topic_key)) AS topic_key FROM s WHERE score >= 0.2 GROUP BY 1)
SELECT w.thread_id, '{"topic_cluster_key":"' || coalesce(topic_key, 'NO_MATCH') || '"}' AS output FROM w LEFT JOIN b USING (thread_id)""")
def annotator(t):
    topics = t.spark.createDataFrame([("red ring", None), ("big bolt", None), ("small widget", None)], "topic_key string, signature_text string")
    return A.annotate_by_rules(t.nuggets.select(F.col("nugget_id").alias("thread_id"), F.col("title").alias("signature_text")), topics)

