"""The pipeline over the smallest data: each stage against what it should leave of its own input."""

import re

import corpus_pipeline
import pytest
from conftest import SF

from threadloom.llm.common import materialize


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("input", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name.replace(" ", "-"))
        out.append((name, docs))
    return out


def test_columns(steps):
    columns = steps[0][1].columns
    for _, df in steps[1:-1]:
        assert df.columns == columns and df.dtypes == steps[0][1].dtypes
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_quality_keeps_good_documents(spark, steps):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in steps[1][1].select("doc_id").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.95 * len(good)
    bad = [i for i, q in labels.items() if q == 0]
    assert bad and sum(i not in kept for i in bad) >= 0.9 * len(bad)


def test_near_duplicates_go(steps):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    before = {r["doc_id"]: shingles(r["text"]) for r in steps[1][1].collect()}
    kept = sorted(r["doc_id"] for r in steps[2][1].collect())
    alike = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    assert not any(alike(before[a], before[b]) for a in kept for b in kept if a < b)
    assert all(any(alike(before[i], before[j]) for j in before if j < i) for i in before if i not in set(kept))


def test_repeats_only_shrink(steps):
    before = {r["doc_id"]: r["text"] for r in steps[2][1].collect()}
    for r in steps[3][1].collect():
        assert r["n_chars"] == len(r["text"]) <= len(before[r["doc_id"]])


def test_repeated_runs_go_and_nothing_else(steps):
    """Every run of 20 words that an earlier kept document holds is cut, to the word."""
    from test_advice import without_repeated_runs

    before = dict(sorted((r["doc_id"], r["text"]) for r in steps[2][1].collect()))
    want = without_repeated_runs(list(before.values()), 20)
    got = {r["doc_id"]: r["text"] for r in steps[3][1].collect()}
    assert got == {i: want[k] for k, i in enumerate(before)}
    assert sum(got[i] != t for i, t in before.items()) > 0


def test_mix_takes_whole_documents(steps):
    before = {r["doc_id"]: r["text"] for r in steps[3][1].collect()}
    times: dict = {}
    for r in steps[4][1].collect():
        assert r["text"] == before[r["doc_id"]]
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert max(times.values()) <= 3


def test_encoding_round_trips(steps):
    import hashlib

    texts = {r["doc_id"]: r["text"] for r in steps[4][1].collect()}
    rows = steps[5][1].collect()
    assert len(rows) == steps[4][1].count()
    for r in rows:
        assert r["n_tokens"] == len(r["token_ids"]) and r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_run(spark, steps):
    assert corpus_pipeline.run(spark, SF).count() == steps[5][1].count()
