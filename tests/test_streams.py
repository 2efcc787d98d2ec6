"""Streams with state, branch folds and bounded runs, over restarts and odd rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from threadloom.streaming import stateful as T
from threadloom.streaming.branches import fold_branches
from threadloom.streaming.high_water import HighWater

DAY = dt.datetime(2024, 1, 1)
CLAIMS = "thread_id long, at timestamp, event_id long, worker string, action string"


def at(hours):
    return DAY + dt.timedelta(hours=hours)


def test_claims_over_a_restart(spark, tmp_path):
    rows = [
        [(1, at(0), 1, "a", "claim"), (1, at(1), 2, "b", "claim"), (2, at(2), 3, "a", "claim"), (3, at(0), 4, "a", "claim"), (3, at(1), 5, "b", "complete"), (3, at(2), 6, "a", "release"), (None, at(2), 7, "a", "what")],
        [(2, at(30), 8, "a", "complete"), (3, at(5), 9, "b", "claim"), (3, at(6), 10, "b", "complete"), (3, at(40), 11, "a", "claim")],
    ]
    parts = [spark.createDataFrame(part, CLAIMS) for part in rows]
    out = T.run_parts(parts, CLAIMS, lambda s: T.claim_results(s, dt.timedelta(hours=12)), T.CLAIM_RESULT, f"file://{tmp_path}")
    got = sorted(((r.thread_id or 0, r.at, r.event_id or 0, r.worker, r.result) for r in out.collect()))
    assert got == sorted([
        (0, at(2), 7, "a", "ignored"), (1, at(0), 1, "a", "claimed"), (1, at(1), 2, "b", "denied"), (1, at(12), 0, "a", "timeout"),
        (2, at(2), 3, "a", "claimed"), (2, at(14), 0, "a", "timeout"), (2, at(30), 8, "a", "ignored"),
        (3, at(0), 4, "a", "claimed"), (3, at(1), 5, "b", "ignored"), (3, at(2), 6, "a", "released"), (3, at(5), 9, "b", "claimed"), (3, at(6), 10, "b", "completed"), (3, at(40), 11, "a", "denied")])


def test_liveness_is_that_of_the_monitor(spark, tmp_path):
    """At every watermark the stream's states are those of the batch monitor, run after each part."""
    from threadloom.operators.mutations import incident_lifecycle

    rng = random.Random(6)
    first = dt.date(2024, 1, 1)
    start = [(i, s) for i, s in enumerate(["active", "possibly_resolved", "resolved", "archived"] * 6)]
    links = [(rng.randrange(24), first + dt.timedelta(days=rng.choice([*range(10), *range(30, 34), *range(50, 70)]))) for _ in range(70)]
    ends = [first + dt.timedelta(days=k) for k in (9, 32, 55, 69)]
    schema = "incident_id long, at timestamp, seen timestamp, status string"
    day = lambda d: dt.datetime.combine(d, dt.time())
    parts, low = [spark.createDataFrame([(i, dt.datetime(2023, 1, 1), None, s) for i, s in start], schema)], dt.date(2020, 1, 1)
    for end in ends:
        parts.append(spark.createDataFrame([(i, day(d), day(d), None) for i, d in links if low < d <= end], schema))
        low = end
    states = T.run_parts(parts, schema, lambda s: T.live_states(s, dt.timedelta(days=14), dt.timedelta(days=30)), T.LIVE_RESULT, f"file://{tmp_path}")
    got = {r.incident_id: (r.status, r.last_seen and r.last_seen.date()) for r in T.latest(states).collect()}

    want = {i: (s, None) for i, s in start}
    low = dt.date(2020, 1, 1)
    for end in ends:
        seen = [(i, d) for i, d in links if d <= end]
        if not [d for _, d in seen if d > low]:
            continue
        low = end
        now = max(d for _, d in seen)
        rows = [(i, "k", s, max([d for j, d in seen if j == i], default=last), None, 1, None) for i, (s, last) in want.items()]
        table = spark.createDataFrame(rows, "incident_id long, incident_key string, status string, last_seen date, first_seen date, thread_count long, resolved_on date")
        none = spark.createDataFrame([], "incident_id long, thread_id string, created_on date, added_on date")
        after = incident_lifecycle(table, none, now - dt.timedelta(days=14), now - dt.timedelta(days=30))
        want = {r.incident_id: (r.status, r.last_seen) for r in after.collect()}
    assert got == want
    assert {s for s, _ in want.values()} == {"active", "possibly_resolved", "resolved", "archived"}


@pytest.mark.parametrize("size,parts", [(1, 1), (7, 3), (10_000, 8)])
def test_branches_keep_their_state(spark, size, parts):
    rows = [(k, ["a", "a", "a", "b", None][k % 5], (k * 37) % 101) for k in range(400)]
    df = spark.createDataFrame(rows, "id long, g string, v int").repartition(parts)

    def step(branch, state, held):
        assert 0 < len(held) <= size
        total, steps = state or (0, 0)
        out = []
        for r in held:
            total += r["v"]
            out.append({"id": r["id"], "g": branch, "total": total})
        return (total, steps + 1), out

    got = sorted(map(tuple, fold_branches(df, "g", ["v", "id"], step, "id long, g string, total long", size).collect()))
    want, sums = [], {}
    for k, g, v in sorted(rows, key=lambda r: (r[2], r[0])):
        sums[g] = sums.get(g, 0) + v
        want.append((k, g, sums[g]))
    assert got == sorted(want)
    assert fold_branches(df.limit(0), "g", ["v"], step, "id long").count() == 0


def test_bounded_runs_take_each_row_once(spark, tmp_path):
    rows = [(f"q{k:03d}", None if k % 9 == 0 else DAY.date() + dt.timedelta(days=k % 6)) for k in range(50)]
    schema = "id string, on date"
    source = spark.createDataFrame(rows, schema)
    water = HighWater(spark, f"file://{tmp_path}/w", "on", "id")
    assert water.last().run == 0 and water.taken(schema).count() == 0
    assert (water.run(source, 20).status, water.last().taken) == ("partial", 20)
    with pytest.raises(RuntimeError):  # the rows are written, the mark isn't
        water.run(source, 20, fail_before_commit=True)
    assert water.taken(schema).count() == 20
    again = HighWater(spark, f"file://{tmp_path}/w", "on", "id")  # after a restart
    assert again.run(source, 20).status == "partial" and again.run(source, 20).status == "ok"
    assert again.run(source, 20).status == "no_new_rows"
    more = source.union(spark.createDataFrame([("q900", DAY.date() + dt.timedelta(days=9))], schema))
    assert (again.run(more, 20).taken, again.last().status) == (1, "ok")
    assert sorted(r.id for r in again.taken(schema).collect()) == sorted([r[0] for r in rows] + ["q900"])
    assert again.taken(schema).where(F.col("on").isNull()).count() == 6
