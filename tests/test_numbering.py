"""Numbers of rows are those of whole-table windows, however rows and ranges fall."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from threadloom.functions.html import ordered_urls
from threadloom.operators import mutations as M
from threadloom.operators import numbering as N
from threadloom.operators import selection as K


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(2)
    out = [(i, rng.choice(["a", "a", "a", "a", "b", "c", None]), rng.choice([None, *range(9)])) for i in range(700)]
    rng.shuffle(out)
    return out, spark.createDataFrame(out, "id long, g string, v int")


@pytest.mark.parametrize("parts,ranges", [(1, 1), (3, 7), (8, None)])
def test_numbers(rows, parts, ranges):
    plain, df = rows
    df = df.repartition(parts)
    got = {r.id: r.rn for r in N.numbered(df, [F.desc_nulls_last("v"), "id"], ranges=ranges).collect()}
    order = sorted(plain, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
    assert got == {r[0]: k + 1 for k, r in enumerate(order)}
    got = {r.id: r.rn for r in N.numbered_by(df, ["g"], ["v", "id"], ranges=ranges).collect()}
    want = {}
    by = lambda r: (r[1] is not None, r[1] or "")
    for _, group in itertools.groupby(sorted(plain, key=lambda r: (by(r), r[2] is not None, r[2] or 0, r[0])), by):
        want |= {r[0]: k + 1 for k, r in enumerate(group)}
    assert got == want
    got = {r.id: r["rank"] for r in N.dense_rank_by(df, ["g"], "v", ranges=ranges).collect()}
    values = {g: sorted({r[2] for r in plain if r[1] == g}, key=lambda v: (v is not None, v or 0)) for g in {r[1] for r in plain}}
    assert got == {r[0]: values[r[1]].index(r[2]) + 1 for r in plain}
    assert N.numbered(df.limit(0), ["id"]).count() == 0


def test_no_task_sees_all_rows(rows):
    """The only exchange into one partition is that of the ranges' sizes."""
    _, df = rows
    for made in (K.pages_of(df, ["id"], 9), K.circular_window(df, ["id"], 5, 9), M.surrogate_ids(df.drop("g"), ["id"], df.select(F.col("id").alias("x")), "x"), ordered_urls(df.selectExpr("g as url", "v as pos", "g as title"))):
        plan = made._jdf.queryExecution().executedPlan().toString()
        lines = plan.split("\n")
        for k, line in enumerate(lines):
            if "SinglePartition" in line:
                below = lines[k + 1]
                assert "_size" in below or "partial_" in below or "HashAggregate" in below, below
