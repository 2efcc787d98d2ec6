"""Staged answers of batches: the registered query deals its lines once; the operator against a second computation."""

import random
from collections import defaultdict

from conftest import SF

from threadloom import registry
from threadloom.operators import validation as V
from threadloom.plans import validation as P
from threadloom.plans.fixtures import Tables


def test_lines_are_dealt_once_and_without_texts(spark):
    """Each dealing of all answers with their thread ids costs several times the input on disk."""
    plan = registry.queries()["v6_group_limits"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange")  # exactly one
    assert "l_orderkey" in below and "concat" in above and "concat" not in below and "Join" not in plan


def test_query_is_the_operator_over_five_tables(spark):
    t = Tables(spark, SF)
    tables = (t.sql(f"{P._WITH} SELECT * FROM {n}") for n in ("asks", "topics", "scenarios", "leaves", "fulls"))
    assert sorted(registry.queries()["v6_group_limits"](spark, SF).collect()) == sorted(V.staged_assign(*tables).collect())


def last(answers):
    """{thread: answer}; one without a place doesn't count, but speaks of its thread."""
    out = {}
    for thread, pos, *keys in sorted(answers, key=lambda a: (a[1] is not None, a[1])):
        out[thread] = keys if pos is not None else None
    return out


def text(key):
    return (key or "").strip(" ")


def assigned(threads, topics, scenarios, leaves, full, most_topics, most_scenarios):
    """{thread: (*keys, source)} of one batch; scenarios and leaves begin with the group asked."""
    def stands(asked, answers):
        got = last(answers)
        return got if None not in asked and set(got) == asked and None not in got.values() else None

    threads, whole = set(threads), stands(set(threads), full)
    topic, fails = stands(threads, topics) or whole, {t: (None,) * 4 + ("full_validation_failed",) for t in threads}
    if topic is None:
        return {t: (None,) * 4 + ("fallback_full_validation_failed",) for t in threads}
    at_once = {t: (*map(text, whole[t]), "full") for t in threads} if whole else fails
    keys = {t: [text(topic[t][0]), "", "", ""] for t in threads}
    if len({k[0] for k in keys.values()}) > most_topics:
        return at_once
    for level, answers in ((0, scenarios), (1, leaves)):
        groups = defaultdict(set)
        for t in threads:
            groups[keys[t][level]].add(t)
        for group, asked in groups.items():
            if group and (got := stands(asked, [a[1:] for a in answers if a[0] == group])):
                for t in asked:
                    keys[t][level + 1 : level + 1 + len(got[t])] = map(text, got[t])
        if level == 0 and len({k[1] for k in keys.values()} - {""}) > most_scenarios:
            return at_once
    return {t: (*k, "stages") for t, k in keys.items()}


def test_staged_assign_against_second_computation(spark):
    r = random.Random(4)
    tables, want, places = [[], [], [], [], []], [], iter(range(10**6))
    place = lambda: None if r.random() < 0.02 else next(places)
    seldom = lambda share, *values: list(values) if r.random() < share else []
    for b in range(400):
        ids = [f"{b}-{i}" for i in range(r.choice([1, 2, 4, 8]))] + seldom(0.02, None)
        some = lambda share: [i for i in ids if r.random() > share for _ in range(2 if r.random() < 0.1 else 1)] + seldom(0.05, "x", None)[: r.randint(1, 2)]  # noqa: E731, B023
        n, m = r.randint(1, 5), r.randint(1, 4)
        topics = [(i, place(), r.choice(seldom(0.05, "", " ", None) or [f" t{j}" for j in range(n)])) for i in some(0.02)]
        full = [(i, place(), r.choice(["t0", "t1", None]), r.choice(["fs ", None]), "fv", "fl") for i in some(0.02) if n != 3]
        group = {i: text(k) for i, _, k in topics}
        scenarios = [(r.choice(seldom(0.03, "t0", "t1", "zz", None) or [group.get(i, "t0")]), i, place(), r.choice(seldom(0.05, "", None) or [f"s{j}" for j in range(m)]) ) for i in some(0.03)]
        group = {i: k for _, i, _, k in scenarios}
        leaves = [(r.choice(seldom(0.03, "s0", "s1", None) or [group.get(i, "s0")]), i, place(), r.choice(["v0", " v1", None]), r.choice(["l0", None])) for i in some(0.03)]
        for rows, new in zip(tables, [[(i,) for i in ids * 2], topics, scenarios, leaves, full], strict=True):
            rows += [(b, *x) for x in new]
        want += [(b, t, *x) for t, x in assigned(ids, topics, scenarios, leaves, full, 3, 3).items()]
    shapes = ["thread_id string", "thread_id string, pos long, topic_key string", "asked string, thread_id string, pos long, scenario_key string",
              "asked string, thread_id string, pos long, variant_key string, leaf_key string", "thread_id string, pos long, topic_key string, scenario_key string, variant_key string, leaf_key string"]
    frames = [spark.createDataFrame(rows, f"batch long, {shape}") for rows, shape in zip(tables, shapes, strict=True)]
    got = [tuple(x) for x in V.staged_assign(*frames, 3, 3).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {x[-1] for x in got} == {"stages", "full", "full_validation_failed", "fallback_full_validation_failed"}
    assert all(any(x[k] for x in got if x[-1] == "stages") for k in (2, 3, 4, 5))
