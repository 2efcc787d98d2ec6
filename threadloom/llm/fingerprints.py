"""Operator 5: Merkle fingerprints of documents, by built-in column functions alone.

A text is a sequence of sections (split at blank lines), a section one of paragraphs (split at line breaks), and a
paragraph one of pieces, which end behind a blank that follows one of the characters in ENDS, so that cuts depend on the
content there alone. A piece's digest is of its text, a paragraph's of its pieces' digests, a section's of its
paragraphs', and the root's, the fingerprint, of its sections': equal roots mean equal texts, and the branches that differ
locate an edit. Likeness of two trees is 1 if their roots are equal, else the Jaccard index of their leaves, the digests
of the pieces.

Defined cases: a null text is the empty text (one empty section, paragraph and piece); a null doc_id is an id, before
all others; of rows that repeat an id with different texts, the one with the smallest digest is the "next document"
of the id before, and each row has its own fingerprints; a lone document is next to itself; an empty table gives an
empty table; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, table


ENDS = "s.,;:!?"


def leaf_tree(text: Column) -> Column:
    """The digests of pieces, by section and paragraph."""
    piece = lambda x: F.sha2(F.concat(F.lit("l"), x), 256)
    pieces = lambda p: F.split(F.regexp_replace(p, f"([{ENDS}] )", "$1\x01"), "\x01", -1)
    return F.transform(F.split(text, "\n\n", -1), lambda s: F.transform(F.split(s, "\n", -1), lambda p: F.transform(pieces(p), piece)))


def _node(kind: str, children: Column) -> Column:
    return F.sha2(F.concat(F.lit(kind), F.array_join(children, "")), 256)


def paragraph_digests(tree: Column) -> Column:
    """Of each section the digests of its paragraphs."""
    return F.transform(tree, lambda s: F.transform(s, lambda p: _node("p", p)))


def root_of(paragraphs: Column) -> Column:
    return _node("r", F.transform(paragraphs, lambda s: _node("s", s)))


def merkle_root(text: Column) -> Column:
    return root_of(paragraph_digests(leaf_tree(text)))


def leaves(tree: Column) -> Column:
    return F.array_distinct(F.transform(F.flatten(F.flatten(tree)), lambda x: F.xxhash64(x)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two arrays of distinct leaves."""
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Numbers, from 0, of the paragraphs of one tree (by line) whose digests aren't at the same place in another."""
    pairs = F.arrays_zip(F.flatten(a).alias("x"), F.flatten(b).alias("y"))
    marked = F.transform(pairs, lambda p, i: F.when(~p["x"].eqNullSafe(p["y"]) & p["x"].isNotNull(), i))
    return F.array_compact(marked)


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id) of distinct ids in ascending order, the last one's next being the first.

    Ids are range-partitioned and written once; a partition's last id is followed by the first of the next partition,
    taken from a table with a row for each partition.
    """
    placed = ids.repartitionByRange("doc_id").withColumn("part", F.spark_partition_id())
    placed = materialize(placed, "ids")
    inner = F.lead(F.struct("doc_id")).over(Window.partitionBy("part").orderBy(F.asc_nulls_first("doc_id")))
    firsts = placed.groupBy("part").agg(F.min_by(F.struct("doc_id"), F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("first"))
    order = Window.orderBy("part")
    after = firsts.select("part", F.lead("first").over(order).alias("after"), F.first("first").over(order).alias("top"))
    out = placed.withColumn("inner", inner).join(after, "part")
    return out.select("doc_id", F.coalesce("inner", "after", "top")["doc_id"].alias("next_id"))


def edited(text: Column, head: Column) -> Column:
    """The last half of the code points (rounded down) replaced by as many of the next document's first."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(head, F.lit(1), half))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = texts.groupBy("doc_id").agg(F.min(F.sha2("text", 256)).alias("pick"), F.floor(F.max(F.length("text")) / 2).cast("int").alias("need"), F.count("*").alias("copies"))
    ids = materialize(ids, "picks")
    after = next_ids(ids.select("doc_id"))
    # Of each id: which id comes before it, and how many code points that one needs.
    before = after.join(ids.select(F.col("doc_id").alias("k"), "need"), F.col("doc_id").eqNullSafe(F.col("k"))).select(F.col("next_id").alias("id"), F.col("doc_id").alias("to"), "need")
    before = before.join(ids.select(F.col("doc_id").alias("k"), "pick"), F.col("id").eqNullSafe(F.col("k"))).drop("k")
    heads = texts.join(before, texts["doc_id"].eqNullSafe(F.col("id")))
    # Only ids that repeat need their pick; as a filter it would become a join key and shuffle the texts once more.
    repeated = ids.where("copies > 1").limit(1).count() > 0
    if repeated:
        heads = heads.where(F.sha2("text", 256) == F.col("pick"))
    heads = heads.select("to", F.substring("text", F.lit(1), F.col("need")).alias("head"), leaves(leaf_tree(F.col("text"))).alias("next_leaves"))
    # Rows that repeat an id and a text give the same head more than once; where there are any, one stays.
    if repeated:
        heads = heads.groupBy("to").agg(F.first("head").alias("head"), F.first("next_leaves").alias("next_leaves"))
    joined = texts.join(heads, texts["doc_id"].eqNullSafe(heads["to"]))
    whole = joined.select("doc_id", "text", edited(F.col("text"), F.col("head")).alias("new"), "next_leaves")
    whole = whole.withColumns({"tree": leaf_tree(F.col("text")), "new_tree": leaf_tree(F.col("new"))})
    whole = whole.withColumns({"own": leaves(F.col("tree")), "paragraphs": paragraph_digests(F.col("tree")), "new_paragraphs": paragraph_digests(F.col("new_tree"))})
    whole = whole.withColumns({"root": root_of(F.col("paragraphs")), "new_root": root_of(F.col("new_paragraphs"))})
    return whole.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("new", 256).alias("edited_sha256"),
        F.col("root").alias("fingerprint"),
        F.col("new_root").alias("edited_fingerprint"),
        F.when(F.col("root") == F.col("new_root"), F.lit(1.0)).otherwise(likeness(F.col("own"), leaves(F.col("new_tree")))).alias("near_edited"),
        likeness(F.col("own"), F.col("next_leaves")).alias("near_next"),
        F.when(F.col("root") != F.col("new_root"), F.try_element_at(differing_paragraphs(F.col("paragraphs"), F.col("new_paragraphs")), F.lit(1))).alias("first_edited_paragraph"),
    )


def op5_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def _tree_sql(text: str) -> str:
    piece = f"list_transform(string_split(regexp_replace(p, '([{ENDS}] )', '\\1' || chr(1), 'g'), chr(1)), lambda x: sha256('l' || x))"
    return f"list_transform(string_split({text}, chr(10) || chr(10)), lambda s: list_transform(string_split(s, chr(10)), lambda p: {piece}))"


_PARAGRAPHS = "list_transform({0}, lambda s: list_transform(s, lambda p: sha256('p' || array_to_string(p, ''))))"
_ROOT = "sha256('r' || array_to_string(list_transform({0}, lambda s: sha256('s' || array_to_string(s, ''))), ''))"

ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id), first_value(t) OVER (ORDER BY doc_id)) AS u FROM d),
e AS (SELECT doc_id, t, u, left(t, length(t) - length(t) // 2) || left(u, length(t) // 2) AS w FROM n),
l AS (SELECT doc_id, t, w, {_tree_sql('t')} AS a, {_tree_sql('w')} AS b, {_tree_sql('u')} AS c FROM e),
p AS (SELECT doc_id, t, w, {_PARAGRAPHS.format('a')} AS x, {_PARAGRAPHS.format('b')} AS y, list_distinct(flatten(flatten(a))) AS a, list_distinct(flatten(flatten(b))) AS b, list_distinct(flatten(flatten(c))) AS c FROM l),
r AS (SELECT *, {_ROOT.format('x')} AS fingerprint, {_ROOT.format('y')} AS edited_fingerprint, flatten(x) AS fx, flatten(y) AS fy FROM p)
SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(w) AS edited_sha256, fingerprint, edited_fingerprint,
  len(list_intersect(a, b))::DOUBLE / (len(a) + len(b) - len(list_intersect(a, b))) AS near_edited,
  len(list_intersect(a, c))::DOUBLE / (len(a) + len(c) - len(list_intersect(a, c))) AS near_next,
  CASE WHEN fingerprint <> edited_fingerprint THEN list_min(list_filter(range(0, len(fx)), lambda i: fx[i + 1] IS DISTINCT FROM fy[i + 1]))::INT END AS first_edited_paragraph
FROM r
"""
