"""A stored inverted index over documents, by segments: BM25 searches read the postings of their own terms alone.

Below a folder, for each segment: parts, a row for each 8,192 documents or so (their ids and lengths); postings, a row for
each term and part (which of its documents hold the term, how often, and the part's largest count and least length), in
folders by a hash of the term; docs, the product and url of each, in folders by a hash of the id; facts, one row, whose presence
commits the segment. `extend` adds a segment of documents that aren't indexed yet. Texts are dealt once, by part, and counted
and grouped where they lie; what is dealt by term are postings, six bytes or so for a document.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.limits import bounded
from .scratch import written
from .search import B, K1

#: Folders of postings by term and of documents by id, and documents of a part.
BUCKETS, SLOTS, PART = 64, 64, 8192
#: Parts of the largest bounds that are scored first, for the score that other parts must be able to reach.
TRIAL = 8

POSTINGS = "term string, pk string, part int, held int, top_tf int, least_n int, places array<short>, tfs array<int>, bucket int"
PARTS = "pk string, part int, doc_ids array<long>, ns array<int>"
DOCS = "doc_id long, product string, url string, slot int"
FACTS = "docs long, terms long"


def _key(product):
    """A product as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), product.cast("string")), F.lit("-"))


def _slot(doc_id, slots: int = SLOTS):
    return F.pmod(F.xxhash64(doc_id), F.lit(slots)).cast("int")


def _bucket(term):
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


class SearchIndex:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def segments(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "facts/_SUCCESS"))]
        return sorted(int(n[8:]) for n in names if n.startswith("segment-"))

    def _read(self, what: str, schema: str) -> DataFrame:
        """A table of all committed segments, with the segment's number."""
        out = None
        for k in self.segments():
            part = self.spark.read.schema(schema).parquet(f"{self.root}/segment-{k}/{what}").withColumn("segment", F.lit(k))
            out = part if out is None else out.unionByName(part)
        return out if out is not None else self.spark.createDataFrame([], f"{schema}, segment int")

    def extend(self, docs: DataFrame) -> int:
        """Indexes the documents (doc_id, product, url, text) whose id isn't there yet; the segment's number, 0 for none.

        doc_id names one document; the documents are read several times and must stay as they are meanwhile.
        """
        known = self.segments()
        new = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "product", "url", "text").where("doc_id is not null")
        words = F.filter(F.split(F.lower("text"), "[^a-z0-9]+"), lambda w: w != "")
        lengths = new.select("doc_id", _key(F.col("product")).alias("pk"), F.coalesce(F.size(words), F.lit(0)).alias("n"))
        if known:
            have = self._read("parts", PARTS).select(F.explode("doc_ids").alias("doc_id"))
            lengths = lengths.join(have, "doc_id", "left_anti")
        lengths = written(lengths, "lengths")
        n_docs = lengths.count()
        if not n_docs:
            return 0
        number = max(known, default=0) + 1
        at = f"{self.root}/segment-{number}"
        wide = math.ceil(n_docs / PART)
        part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(wide)).cast("int").alias("part")
        entries = lengths.select("doc_id", "pk", "n", part).groupBy("pk", "part").agg(F.sort_array(F.collect_set(F.struct("doc_id", "n"))).alias("e"))  # the documents of a part
        entries.select("pk", "part", F.col("e.doc_id").alias("doc_ids"), F.col("e.n").alias("ns")).write.mode("overwrite").option("compression", "zstd").parquet(f"{at}/parts")
        parts = self.spark.read.schema(PARTS).parquet(f"{at}/parts")

        texts = new.select("doc_id", _key(F.col("product")).alias("pk"), "text", part).repartition("pk", "part")
        own = texts.join(parts.hint("merge"), ["pk", "part"])
        place = F.array_position("doc_ids", F.col("doc_id")).cast("int")
        own = own.select("pk", "part", place.alias("place"), F.expr("ns[int(array_position(doc_ids, doc_id)) - 1]").alias("n"), words.alias("w")).where("place > 0")
        terms = own.select("pk", "part", "place", "n", F.explode("w").alias("term"))
        tf = terms.groupBy("pk", "part", "term", "place", "n").agg(F.count("*").cast("int").alias("tf"))
        lists = tf.groupBy("pk", "part", "term").agg(F.sort_array(F.collect_list(F.struct((F.col("place") - 1).cast("short").alias("place"), "tf"))).alias("p"), F.max("tf").alias("top_tf"), F.min("n").alias("least_n"))
        postings = lists.select("term", "pk", "part", F.size("p").alias("held"), "top_tf", "least_n", F.col("p.place").alias("places"), F.col("p.tf").alias("tfs"), _bucket("term").alias("bucket"))
        dealt = postings.repartition(F.col("bucket"), F.pmod("part", F.lit(8))).sortWithinPartitions("bucket", "term", "pk", "part")
        dealt.write.mode("overwrite").option("compression", "zstd").partitionBy("bucket").parquet(f"{at}/postings")

        shown = new.select("doc_id", "product", "url", _slot("doc_id").alias("slot"))
        shown = shown.join(lengths.select("doc_id").distinct(), "doc_id", "left_semi") if known else shown
        shown.repartition(F.col("slot")).write.mode("overwrite").option("compression", "zstd").partitionBy("slot").parquet(f"{at}/docs")
        facts = parts.select(F.explode("ns").alias("n")).agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms"))
        facts.coalesce(1).write.mode("overwrite").parquet(f"{at}/facts")
        return number

    def postings(self, words: list[str]) -> DataFrame:
        """The postings of some terms: their folders, and there their rows, are all that is read."""
        buckets = sorted({r[0] for r in self.spark.createDataFrame([(w,) for w in words], "w string").select(_bucket("w")).collect()}) if words else []
        return self._read("postings", POSTINGS).where(F.col("bucket").isin(*buckets) & F.col("term").isin(*words))

    def search(self, query: str, top: int = 5, product: str | None = None, docs: DataFrame | None = None) -> DataFrame:
        """(doc_id, score, url), and with `docs` (doc_id, text) title and content, of the best documents, of one product or all; how rare a term is, and how long
        documents are, is told from all. Parts of documents whose terms can't add up to the score of the last hit aren't scored."""
        top = bounded("search", top=top)["top"]
        words = sorted({w for w in re.split("[^a-z0-9]+", query.lower()) if w})
        facts = self._read("facts", FACTS).agg(F.sum("docs").alias("docs"), (F.sum("terms") / F.sum("docs")).alias("mean"))  # one row
        every = self.postings(words)
        rare = every.groupBy("term").agg(F.sum("held").alias("df")).crossJoin(F.broadcast(facts))
        rare = rare.select("term", F.log1p((F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"), "mean")  # a row for each term
        own = every.where(F.col("pk") == f"={product}") if product is not None else every
        own = own.join(F.broadcast(rare), "term")
        weight = lambda tf, n: F.col("idf") * tf * (K1 + 1) / (tf + K1 * (1 - B + B * n / F.col("mean")))
        key = ["segment", "pk", "part"]
        members = self._read("parts", PARTS)
        bounds = own.groupBy(*key).agg(F.sum(weight(F.col("top_tf"), F.col("least_n"))).alias("bound"))

        def scored(parts: DataFrame) -> DataFrame:
            rows = own.join(parts, key).join(members.join(parts, key, "left_semi"), key)
            rows = rows.select("idf", "mean", "doc_ids", "ns", F.explode(F.arrays_zip("places", "tfs")).alias("x"))
            rows = rows.select(F.expr("doc_ids[x.places]").alias("doc_id"), weight(F.col("x.tfs"), F.expr("ns[x.places]")).alias("s"))
            return rows.groupBy("doc_id").agg(F.round(F.sum("s"), 6).alias("score")).orderBy(F.desc("score"), "doc_id").limit(top)

        trial = scored(bounds.orderBy(F.desc("bound"), *key).limit(TRIAL))
        least = trial.agg(F.count("*").alias("n"), F.min("score").alias("least"))  # one row
        parts = bounds.crossJoin(F.broadcast(least)).where((F.col("n") < top) | (F.col("bound") >= F.col("least") - 1e-5)).select(*key)
        best = scored(parts).withColumn("slot", _slot("doc_id"))
        shown = self._read("docs", DOCS).drop("segment")
        out = shown.join(F.broadcast(best), ["slot", "doc_id"])  # at most ten rows
        if docs is None:
            return out.select("doc_id", "score", "url").orderBy(F.desc("score"), "doc_id")
        out = docs.select("doc_id", "text").join(F.broadcast(out.select("doc_id", "score", "url")), "doc_id")  # at most ten rows
        return out.select("doc_id", "score", F.substring("text", 1, 200).alias("title"), F.substring("text", 1, 1400).alias("content"), "url").orderBy(F.desc("score"), "doc_id")
