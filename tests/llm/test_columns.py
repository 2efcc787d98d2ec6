"""Further columns, whatever their names and types, pass through the operators that keep rows, and break none."""

import datetime as dt

import corpus_pipeline
import pytest
from conftest import SF
from pyspark.sql import functions as F

from threadloom.llm import QUERIES, fingerprints, licenses, mixing, ngram_join, toxicity, warc

NAMES = ["doc", "key", "again", "a", "b", "x", "y", "size", "h", "rank", "copies", "n", "pos", "spot", "low", "high", "rep", "own", "target", "bucket", "kind", "shard", "items", "id", "component", "node", "d", "top", "folder", "pieces", "words", "my column.1"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40")
    more = [F.lit(k).alias(name) for k, name in enumerate(NAMES)]
    return df.select("*", *more, F.lit(dt.datetime(2024, 1, 1)).alias("at"), F.array(F.lit(None).cast("string")).alias("list"), F.lit(None).cast("map<string,int>").alias("map"), F.create_map(F.lit("k"), F.lit(1.5)).alias("m2"))


def test_stages_keep_columns(spark, docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert out.limit(1).count() == 1
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_others_ignore_columns(spark, docs):
    n = docs.count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").withColumn("y", F.lit(1)).withColumn("text", F.lit(""))
    assert toxicity.score_toxicity(docs, labels).count() == n
    assert fingerprints.fingerprint_documents(docs).count() == n
    assert licenses.scan_licenses(docs.withColumn("path", F.concat(F.lit("a/"), F.col("doc_id").cast("string")))).count() == n
    assert ngram_join.ngram_classes(docs).count() == n
    assert mixing.plan_mix(docs.select("*", mixing.size_of(F.col("text")).alias("size_")).drop("size").withColumnRenamed("size_", "size")).count() == n
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    from threadloom.llm.common import scratch_path

    assert warc.write_archives(pages.select("*", *(F.lit(1).alias(c) for c in ("d", "n", "top", "kind", "spot", "shard", "refers_to"))), scratch_path(spark, "w")).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run(spark, name):
    out = QUERIES[name](spark, SF)
    key = next(c for c in ("doc_id", "vec_id", "page_id") if c in out.columns)
    table = {"doc_id": "documents", "vec_id": "embeddings", "page_id": "pages"}[key]
    assert out.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
    assert out.select(key).distinct().count() == out.count()


@pytest.mark.parametrize("name", ["op5_document_fingerprints", "op7_warc", "op9_mixing"])
def test_against_sql(spark, name):
    import math

    import duckdb

    from threadloom.llm import ORACLE_SQL

    c = duckdb.connect()
    for t in ("documents", "pages"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    out = QUERIES[name](spark, SF)
    cols = sorted(out.columns)
    plain = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    rel = c.sql(ORACLE_SQL[name])
    want = sorted((tuple(plain(r[rel.columns.index(k)]) for k in cols) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(plain(r[k]) for k in cols) for r in out.collect()), key=repr) == want


CLASHES = ["_score", "_chars", "_words", "_repeats", "_runs", "_asked", "_doc", "_chunks_repeated", "_chars_removed", "_spans_removed", "_mix_size", "_mix_key", "_kept", "_mark", "_turn", "c0", "c1", "c7", "a`b", "a.b", "a․b", "n_tokens", "mark"]


def test_stages_keep_clashing_columns(spark, docs):
    some = docs.select("doc_id", "text", "lang", "source", "n_chars", *(F.concat(F.lit(f"{k}-"), F.col("doc_id").cast("string")).alias(name) for k, name in enumerate(CLASHES)))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, some, SF)
        assert out.columns == some.columns and out.dtypes == some.dtypes, name
        for r in out.collect():
            assert list(r)[5:] == [f"{k}-{r['doc_id']}" for k in range(len(CLASHES))], name
    out = corpus_pipeline.STAGES[-1][1](spark, some, SF)
    assert out.count() == some.count() and dict(out.dtypes)["n_tokens"] == "bigint"


def test_near_duplicates_leave_one_row(spark):
    t = " ".join(f"w{k}" for k in range(40))
    u = " ".join(f"v{k}" for k in range(40))
    rows = [(1, t), (1, t), (2, t + " more"), (2, u), (3, u), (3, t), (4, None), (4, None), (5, ""), (None, t), (None, t)]
    out = ngram_join.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=repr) == sorted([(1, t), (2, u), (4, None), (4, None), (5, ""), (None, t), (None, t)], key=repr)


def test_vectors_of_repeated_ids_and_other_columns(spark):
    from threadloom.llm import embedding_dedup

    a, b, c = [1.0, 0.0, 0.0], [0.999, 0.01, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, a), (1, a), (2, b), (3, c), (3, a), (None, a), (4, None), (5, [0.0, 0.0, 0.0]), (6, [1.0, float("nan"), 0.0]), (7, [2.0, 0.0]), (8, []), (9, [1.0, None, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    clashes = ["id", "dim", "v", "n", "key", "weight", "component", "block", "_n", "_c", "a.b", "n_links", "component_id"]
    out = embedding_dedup.near_vectors(df.select("*", *(F.lit("x").alias(x) for x in clashes)))
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    # The vector of id 1 is there twice and that of a row of id 3 once more: each counts as a vector of its own.
    assert got == sorted([(1, 6, 1, True)] * 2 + [(2, 3, 1, False)] + [(3, 3, 1, False)] * 2 + [(None, 0, None, None)] + [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9)], key=repr)
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_quality_of_hard_rows(spark):
    from threadloom.llm import quality

    rng_words = ["alpha", "beta", "gamma", "delta", "of", "the"]
    rows = [(i, " ".join(rng_words[(i * k) % 6] for k in range(1, 30)) + ("." if i % 2 else "$$$ ###")) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(5, None), (None, 1)], "doc_id long, quality int")
    hard = [(100, None), (101, ""), (102, "x" * 200_000), (None, "no id"), rows[7], rows[7]]
    df = spark.createDataFrame(rows + hard, "doc_id long, text string").repartition(3)
    model = quality.fit_quality(df, labels)
    out = quality.score_quality(df, model).collect()
    assert len(out) == len(rows) + len(hard) and all(0 <= r["_score"] <= 1 for r in out)
    by_id: dict = {}
    for r in out:
        by_id.setdefault(r["doc_id"], set()).add(r["_score"])
    assert all(len(v) == 1 for v in by_id.values()) and by_id[100] == by_id[101]
    empty = df.limit(0)
    assert quality.score_quality(empty, model).count() == 0
    none = quality.fit_quality(empty, labels)
    assert none == {"bias": 0.0, "rules": []} and quality.score_quality(df, none).where("_score <> 0.5").count() == 0
    assert quality.keep_quality(df, model, 0.0).count() == df.count() and quality.keep_quality(df, model, 0.3).columns == df.columns
