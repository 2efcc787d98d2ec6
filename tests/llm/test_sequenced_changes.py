"""Operator 13 against the contract followed change by change."""

import datetime
import math
import random
import zlib

import pytest
from conftest import SF

from threadloom.llm import sequenced_changes as sc

SCHEMA = "change_id long, client_id long, seq long, op string, valid_at timestamp_ntz, source string, segment string, city string, balance double, `N` int"


def brute(rows, batches=10, wait=8):
    """rows: dicts of sc.COLUMNS."""
    rows = list({tuple(r[c] for c in sc.COLUMNS): r for r in rows}.values())
    low = lambda x: (x is not None, x if x is not None else 0)
    seqs = {}
    for r in rows:
        seqs.setdefault(r["client_id"], set()).add(r["seq"])
    rank = {c: {s: k + 1 for k, s in enumerate(sorted(v, key=low))} for c, v in seqs.items()}
    cut = {}
    for r in rows:
        if r["valid_at"] is None or r["change_id"] is None:
            continue
        h = zlib.crc32(str(r["change_id"]).encode())
        if h % 11 == 0:
            continue
        day = (r["valid_at"].date() - datetime.date(1970, 1, 1)).days + 5 * (h % 4)
        b = max(1, min(batches, 1 + math.floor((day - 19723) * batches / 160)))
        cut.setdefault(b, []).append((day, r["change_id"], rank[r["client_id"]][r["seq"]], r))
    out, nxt, held, state, final = [], {}, {}, {}, {}

    def drain(c, batch, missed):
        while held.get(c) and nxt[c] in held[c]:
            day, change_id, n, r = held[c].pop(nxt[c])
            city, balance = state.get(c, (None, None))
            if r["op"] == "D":
                city = balance = None
            elif r["op"] == "I":
                city, balance = r["city"], r["balance"]
            elif r["op"] == "U":
                city, balance = r["city"] if r["city"] is not None else city, r["balance"] if r["balance"] is not None else balance
            state[c] = city, balance
            out.append([change_id, c, "applied", batch, missed, city, None if balance is None else math.floor(100 * balance + 0.5), False])
            final[c] = (len(out) - 1, r["op"])
            nxt[c] += 1
            missed = 0

    seen = None
    for b in range(1, batches + 2):
        for c in list(held):
            while held[c] and (b > batches or seen is not None and min(x[0] for x in held[c].values()) + wait <= seen):
                least = min(held[c])
                missed, nxt[c] = least - nxt[c], least
                drain(c, b, missed)
        for day, change_id, n, r in sorted(cut.get(b, []), key=lambda x: x[:2]):
            c = r["client_id"]
            nxt.setdefault(c, 1)
            own = held.setdefault(c, {})
            if n in own or n < nxt[c]:
                out.append([change_id, c, "rejected", b, 0, None, None, False])
            else:
                own[n] = (day, change_id, n, r)
                drain(c, b, 0)
        days = [x[0] for x in cut.get(b, [])] + ([seen] if seen is not None else [])
        seen = max(days) if days else None
    for k, op in final.values():
        out[k][-1] = op != "D"
    return sorted(map(tuple, out), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("change_id", "client_id", "status", "batch", "missed", "city", "cents", "current").collect()), key=repr)


def test_query(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF}/client_changes.parquet").collect()]
    assert result(sc.op13_sequenced_changes(spark, SF)) == brute(rows)


@pytest.mark.parametrize("compact,shard_rows", [(1, 10), (3, 1000)])
def test_hard_rows(spark, compact, shard_rows):
    rng = random.Random(compact)
    begin = datetime.datetime(2024, 1, 1)
    rows = []
    for k in range(900):
        client = rng.choice([7, 7, 7, 1, 2, 3, None])
        seq = rng.choice([None, *range(0, 120)]) if rng.random() < 0.5 else k // 8
        at = None if rng.random() < 0.03 else begin + datetime.timedelta(days=min(k // 8 + rng.choice([0, 0, 0, 1, 20]), 80), hours=rng.randint(0, 23))
        rows.append((k if rng.random() > 0.01 else None, client, seq, rng.choice(["I", "U", "U", "D", "?", None]), at, "s", None, rng.choice(["a", "b", None]), rng.choice([None, 1.005, -2.5, 3.0]), k % 3))
    rows += rows[::9]  # repeated
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    cut = sc.cut(df)
    got = sc.with_current(sc.apply_changes(cut, compact=compact, shard_rows=shard_rows))
    assert result(got) == brute([dict(zip([*sc.COLUMNS, "N"], r, strict=True)) for r in rows])


def test_empty(spark):
    assert sc.with_current(sc.apply_changes(sc.cut(spark.createDataFrame([], SCHEMA)), batches=2)).count() == 0
