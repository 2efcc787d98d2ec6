"""The stored index gives what a search over all texts gives, reads its terms' folders alone, and grows by segments."""

import random

import pytest
from pyspark.sql import functions as F

from threadloom.sources import search_index as I
from threadloom.sources.search import search

SCHEMA = "doc_id long, product string, url string, text string"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(60)]
    rows = [(i, rng.choice(["a", "b", None]), f"u{i}", " ".join(rng.choices(words, weights=range(1, 61), k=rng.randint(0, 60)))) for i in range(300)]
    rows += [(900, "a", "u900", None), (901, "a", "u901", ""), (902, "b", "u902", "W7, W7! " * 900), (None, "a", "x", "w1")]
    return spark.createDataFrame(rows, SCHEMA)


def test_segments(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "PART", 16)  # many parts, so that bounds have something to skip
    monkeypatch.setattr(I, "TRIAL", 2)
    index = I.SearchIndex(spark, f"file://{tmp_path}/index")
    assert index.search("w1").count() == 0
    assert [index.extend(docs.where("doc_id < 100 or doc_id > 800")), index.extend(docs.where("doc_id < 250")), index.extend(docs), index.extend(docs)] == [1, 2, 3, 0]
    for query in ("w7", "w1 W2 w3 nothing", "W59-w58;w57", "nothing"):
        want = [(r.doc_id, r.score) for r in search(docs.where("doc_id is not null"), query, 10).collect()]
        got = [(r.doc_id, r.score) for r in index.search(query, 10).collect()]
        assert got == want
        # Of one product: the same scores, the ranks anew.
        every = search(docs.where("doc_id is not null"), query, 10).select("doc_id", "score")
        mine = {r.doc_id: r.score for r in index.search(query, 10, "a").collect()}
        for r in every.join(docs.where("product = 'a'"), "doc_id").collect():
            assert mine[r.doc_id] == r.score
        assert set(mine) <= {r.doc_id for r in docs.where("product = 'a'").collect()}
    hit = index.search("w7", 1, docs=docs).first()
    assert (hit.doc_id, hit.url, len(hit.title)) == (902, "u902", 200)


def test_a_search_reads_its_terms(spark, docs, tmp_path):
    index = I.SearchIndex(spark, f"file://{tmp_path}/index")
    index.extend(docs)
    plan = index.postings(["w1"])._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.split("\n") if "FileScan parquet" in x)
    assert "bucket" in line.split("PartitionFilters: ")[1].split("PushedFilters")[0] and "EqualTo(term,w1)" in line
    assert index.postings(["w1"]).inputFiles() and index.postings(["w1"]).where(F.col("term") != "w1").count() == 0


def test_an_uncommitted_segment_is_not_read(spark, docs, tmp_path):
    import shutil

    index = I.SearchIndex(spark, f"file://{tmp_path}/index")
    index.extend(docs.where("doc_id < 50"))
    index.extend(docs)
    shutil.rmtree(f"{tmp_path}/index/segment-2/facts")
    assert index.segments() == [1] and index.search("w59", 3).where("doc_id >= 50").count() == 0
    assert index.extend(docs) == 2 and index.segments() == [1, 2]
