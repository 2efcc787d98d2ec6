"""Operator 11: ranked lexical search, score at a time over impact-ordered postings.

A stated set of queries is put to all documents, in blocks of queries of bounded size. A first pass over the texts counts,
for a block's terms, the documents that hold them, and the facts of the whole corpus. In the second, each task turns its
documents into an inverted index of the queries' terms, whose postings lie by term and descending impact, those of equal
impact together. A query takes whole groups of equal impact in descending order of what they add to a score. It stops only
when the documents that may still reach the k-th score, by what all terms can add at most from here, are a handful: these
are proven to hold the best. Their scores are completed from the documents' own terms. The k-th score of earlier documents
of the task is carried on, so that most later parts of a task are passed over by their bounds alone. What a task returns is
k documents for each query, of which the k best are taken in two steps.

Texts never move: only counts by term and the tasks' best do. Terms are compared by 64-bit hashes.

Defined cases: a null or empty text has no terms and doesn't count as a document, nor is a query without terms answered; a
null doc_id is the last of equal scores; a null item_id is a query like others; a repeated row of documents is a document of
its own; a repeated row of queries counts once, and different texts of one item_id are one query; empty tables give an empty
result; other columns aren't read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHasher, column, lean, slabs, table, utf8

#: Queries and terms of queries in a block that is sent to all tasks.
QUERIES, TERMS = 2048, 1 << 18
#: Documents and postings of one index in a task.
DOCS, POSTINGS = 8192, 1 << 20
#: Of the largest next group: the part down to which groups are taken before bounds are looked at again.
STEP = 3, 4
#: Documents whose scores are completed after a stop.
FEW = 32

TERM_FOLD = np.full(256, 32, np.uint8)  # what isn't in a term separates terms
TERM_FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
TERM_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
TERM_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
TERM_FOLD[0x80:] = np.arange(0x80, 0x100)


def _term_rows(batches):
    """(item_id, term) of queries, a row for each occurrence."""
    hasher = WordHasher(TERM_FOLD)
    for batch in batches:
        data, offsets, _ = utf8(batch.column(1))
        for i, j in slabs(offsets):
            terms, firsts = hasher(data, offsets[i : j + 1])
            rows = np.repeat(np.arange(i, j), np.diff(firsts))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(terms.view(np.int64))], names=["item_id", "term"])


def _parsed(batches, vocabulary: np.ndarray):
    """For slabs of documents: their ids, their numbers of terms, and (term, document) of the terms in the vocabulary."""
    hasher = WordHasher(TERM_FOLD)
    for batch in batches:
        data, offsets, _ = utf8(batch.column(1))
        for i, j in slabs(offsets):
            terms, firsts = hasher(data, offsets[i : j + 1])
            sizes = np.diff(firsts)
            at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
            hit = vocabulary[at] == terms
            yield batch.column(0).slice(i, j - i), sizes, at[hit], np.repeat(np.arange(j - i), sizes)[hit]


def _counted(vocabulary):
    """(term, count): documents that hold each term of the vocabulary; at -1 documents with terms, at -2 all terms."""

    def run(batches):
        words = vocabulary.value
        df = np.zeros(len(words), np.int64)
        documents = terms = 0
        for _, sizes, at, doc in _parsed(batches, words):
            df += np.bincount(np.unique(at * len(sizes) + doc) // len(sizes), minlength=len(words))
            documents += int((sizes > 0).sum())
            terms += int(sizes.sum())
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(found, [-1, -2])), pa.array(np.append(df[found], [documents, terms]))], names=["term", "count"])

    return run


class ImpactIndex:
    """Postings of some documents: by term and descending impact, and by document."""

    def __init__(self, sizes: np.ndarray, term: np.ndarray, doc: np.ndarray, n_terms: int, documents: int, terms: int):
        n = len(sizes)
        key, tf = np.unique(term * n + doc, return_counts=True)
        term, doc = key // n, key % n
        m = 100 - 75 + (75 * sizes.astype(np.int64) * documents) // terms
        impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
        order = np.lexsort((-impact, term))
        self.first = np.searchsorted(term, np.arange(n_terms + 1))
        self.doc, self.fall = doc[order], -impact[order]  # ascending, for searches
        order = np.argsort(doc, kind="stable")
        self.doc_first = np.searchsorted(doc[order], np.arange(n + 1))
        self.doc_term, self.doc_impact = term[order], impact[order]
        self.weight = np.zeros(n_terms, np.int64)
        self.n = n

    def score(self, doc: int) -> int:
        a, b = self.doc_first[doc], self.doc_first[doc + 1]
        return int(self.weight[self.doc_term[a:b]] @ self.doc_impact[a:b])

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, least: int) -> list[tuple[int, int]]:
        """(score, document) of all that may be among the k best scores and reach `least`, which is 1 or more."""
        at, end = self.first[terms], self.first[terms + 1]
        there = (at < end) & (weights > 0)
        at, end, terms, weights = at[there], end[there], terms[there], weights[there]
        adds = -weights * self.fall[at]
        rest = int(adds.sum())
        if rest < least:
            return []
        got = np.zeros(self.n, np.int64)
        few = max(FEW, 2 * k)
        while rest:
            level = max(1, int(adds.max()) * STEP[0] // STEP[1])
            for i in np.flatnonzero(adds >= level).tolist():
                a, b, w = int(at[i]), int(end[i]), int(weights[i])
                to = a + int(np.searchsorted(self.fall[a:b], -(-(-level // w)), "right"))
                got[self.doc[a:to]] -= w * self.fall[a:to]
                at[i] = to
                adds[i] = -w * self.fall[to] if to < b else 0
            rest = int(adds.sum())
            if self.n > k:
                least = max(least, int(np.partition(got, self.n - k)[self.n - k]))
            if rest < least and np.count_nonzero(got + rest >= least) <= few:
                break
        chosen = np.flatnonzero(got + rest >= least)
        if not rest:
            return [(int(got[d]), int(d)) for d in chosen]
        self.weight[terms] = weights
        out = [(self.score(d), d) for d in chosen.tolist()]
        self.weight[terms] = 0
        return out


LAST = (1 << 63) - 1


def _searched(sent, k: int):
    """(item_id, doc_id, score): of each query the k best documents of a task."""

    def run(batches):
        words, ids, queries, documents, terms = sent.value
        best: list[list[tuple[int, int, bool]]] = [[] for _ in queries]  # heaps, the worst of the k first

        def search(parts):
            sizes = np.concatenate([p[1] for p in parts])
            base = np.cumsum([0, *(len(p[1]) for p in parts)])
            index = ImpactIndex(sizes, np.concatenate([p[2] for p in parts]), np.concatenate([p[3] + b for p, b in zip(parts, base, strict=False)]), len(words), documents, terms)
            names = pa.concat_arrays([p[0] for p in parts])
            known = np.asarray(names.is_valid())
            name = names.fill_null(LAST).to_numpy(zero_copy_only=False)
            for heap, (own, weights) in zip(best, queries, strict=True):
                least = heap[0][0] if len(heap) == k else 1
                for score, d in index.best(own, weights, k, least):
                    row = (score, -int(name[d]), bool(known[d]))
                    if score <= 0:
                        continue
                    if len(heap) < k:
                        heapq.heappush(heap, row)
                    elif row > heap[0]:
                        heapq.heapreplace(heap, row)

        parts, rows, size = [], 0, 0
        for part in _parsed(batches, words):
            parts.append(part)
            rows, size = rows + len(part[1]), size + len(part[2])
            if rows >= DOCS or size >= POSTINGS:
                search(parts)
                parts, rows, size = [], 0, 0
        if parts:
            search(parts)
        found = [(i, -d if valid else None, s) for i, heap in enumerate(best) for s, d, valid in heap]
        yield pa.RecordBatch.from_arrays([ids.take(pa.array([i for i, _, _ in found], pa.int64())), pa.array([d for _, d, _ in found], pa.int64()), pa.array([s for _, _, s in found], pa.int64())], names=["item_id", "doc_id", "score"])

    return run


def _query_blocks(items: DataFrame):
    """Arrow tables (item_id, term, n) of queries, whole queries in each: at most QUERIES of them and about TERMS terms."""
    kind = items.schema["item_id"].dataType
    texts = items.select("item_id", "text").where("text is not null").distinct()
    terms = texts.mapInArrow(lean(_term_rows), T.StructType([T.StructField("item_id", kind), T.StructField("term", T.LongType())]))
    terms = terms.groupBy("item_id", "term").agg(F.count("*").alias("n"))
    n, distinct = items.select("item_id").distinct().count(), terms.count()
    blocks = max(1, math.ceil(n / QUERIES), math.ceil(distinct / TERMS))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    sizes = terms.groupBy(block.alias("b")).agg(F.count("*").alias("n")).orderBy("b").collect()  # two numbers a block
    for b, size in sizes:
        own = terms.where(block == b)
        if size <= 4 * TERMS:
            yield own.toArrow()
            continue
        parts = math.ceil(size / TERMS) * 4  # chance, or very long queries
        for p in range(parts):
            yield own.where(F.pmod(F.xxhash64("item_id", F.lit(1)), F.lit(parts)) == p).toArrow()


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item (item_id, text) its k best of docs (doc_id: an integer, text)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    kind = items.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    found = None
    for block in _query_blocks(items):
        if not block.num_rows:
            continue
        words, own = np.unique(column(block, "term").view(np.uint64), return_inverse=True)
        ids = block.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
        ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
        item = ids.indices.to_numpy(zero_copy_only=False)
        # At most 4 * TERMS hashes, and the counts of so many terms.
        counts = {r["term"]: r["n"] for r in rows.mapInArrow(lean(_counted(spark.sparkContext.broadcast(words))), "term long, count long").groupBy("term").agg(F.sum("count").alias("n")).collect()}
        documents, terms = counts.get(-1) or 0, counts.get(-2) or 0
        if not terms:
            continue
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * counts.get(t, 0) + 1))) for t in range(len(words))], np.int64)
        order = np.argsort(item, kind="stable")
        cuts = np.searchsorted(item[order], np.arange(1, len(ids.dictionary)))
        times = column(block, "n").astype(np.int64)
        queries = [(own[part], weight[own[part]] * times[part]) for part in np.split(order, cuts)]
        sent = spark.sparkContext.broadcast((words, ids.dictionary, queries, documents, terms))
        part = rows.mapInArrow(lean(_searched(sent, k)), schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], schema)
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    few = found.withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
    few = few.withColumn("_n", F.row_number().over(Window.partitionBy("item_id", "_part").orderBy(*best))).where(F.col("_n") <= k)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*best))).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


_TERMS = r"unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))"
ORACLE_SQL = f"""WITH tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, {_TERMS} AS t FROM documents) GROUP BY ALL),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY 1),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM n),
w AS (SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY t, docs),
q AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, {_TERMS} AS t FROM benchmark) GROUP BY ALL),
x AS (SELECT item_id, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // l))))::BIGINT AS score
FROM q JOIN tf USING (t) JOIN w USING (t) JOIN n USING (doc_id), s GROUP BY ALL)
SELECT * FROM (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM x WHERE score > 0) WHERE rank <= 10"""
