"""Operator 11 against all scores, computed one by one."""

import collections
import math
import random
import re

import pytest
from conftest import SF

from threadloom.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    counted = [(d, collections.Counter(terms(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    queries = collections.defaultdict(collections.Counter)
    for i, t in set(items):
        queries[i].update(terms(t))
    out = []
    for item, q in queries.items():
        found = []
        for d, c, n in counted:
            m = 100 - 75 + (75 * n * n_docs) // total
            s = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, times in q.items() if c[t])
            if s > 0:
                found.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefgh") + rng.choice(["x", "é", "Z9", ""]) * (rng.random() < 0.7)
    text = lambda n: "".join(word() + rng.choice([" ", "\n", "-", "\x00", "  ", "."]) for _ in range(n))
    docs = [(i, text(rng.randint(1, 60))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)] + [docs[3], docs[3], (None, docs[9][1]), (5000, None), (5001, ""), (5002, " .-"), (5003, text(30_000))]
    items = [(i, text(rng.randint(1, 30))) for i in range(60)] + [(100, None), (101, ""), (102, "nowhere"), (None, "a b"), (103, docs[7][1]), (103, docs[7][1]), (104, "a"), (104, "b c"), (105, "a " * 50)]
    return docs, items


@pytest.mark.parametrize("queries,size,few,docs_together", [(2048, 1 << 18, 32, 8192), (9, 1 << 18, 2, 64), (2048, 8, 32, 8192)])
def test_blocks(spark, corpus, monkeypatch, queries, size, few, docs_together):
    monkeypatch.setattr(ls, "QUERIES", queries)
    monkeypatch.setattr(ls, "TERMS", size if size > 8 else 40)
    monkeypatch.setattr(ls, "FEW", few)
    monkeypatch.setattr(ls, "DOCS", docs_together)
    docs, items = corpus
    if queries < 2048:
        items = items[40:]
    d = spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, score int").repartition(5)
    q = spark.createDataFrame(items[:25] if size == 8 else items, "item_id long, text string")
    assert result(ls.search(d, q)) == brute(docs, items[:25] if size == 8 else items)


def test_empty(spark, corpus):
    docs, items = corpus
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert ls.search(d.limit(0), q).count() == 0 and ls.search(d, q.limit(0)).count() == 0
    assert ls.search(d.where("text is null or text = ''"), q).count() == 0


def test_query(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert result(ls.op11_lexical_search(spark, SF)) == brute(docs, items)
