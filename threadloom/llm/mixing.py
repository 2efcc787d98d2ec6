"""Operator 9: mixing sources to target weights along a time-varying curriculum.

Targets share the words of all sources by weight, at most `most` times a source's own words; the excess is shared
again by weight. A source is read in a fixed order (md5 of the id), whole passes first and then as much of a last
pass as the target leaves. Its weight schedule, a piecewise linear function of training time, is integrated; the
words demanded before a document, as a share of all that the source gives, are put through the inverse of that
integral, which is the document's training position; the mix is range-sorted by position.

Running sums take two levels (sums of hash buckets of a source, then sums inside a bucket), so that no task holds a
whole source. The tables of sources (a row each) pass through one task; nothing is collected.

Defined cases: a null text has size 0, and size 0 is never taken; null is a source of its own, the last; a null
doc_id is an id like others; repeated rows (same id, source and size) are taken together; an empty table gives an
empty mix; other columns pass through `mix_documents`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, plain_names, table

WORDS = r"[^\x20\x09-\x0D]+"
MOST = 3
#: Schedules by rank of the source modulo 3: knots (time, weight), of integral 1 over [0, 1].
SCHEDULES = [[(0.0, 1.5), (1.0, 0.5)], [(0.0, 1.0), (1.0, 1.0)], [(0.0, 0.5), (1.0, 1.5)]]


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def inverse_demand(schedule: list[tuple[float, float]], share: Column) -> Column:
    """Time at which the integral of the schedule reaches `share` of its whole."""
    area = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False)]
    whole, before, out = sum(area), 0.0, None
    for ((t0, w0), (t1, w1)), a in zip(zip(schedule, schedule[1:], strict=False), area, strict=True):
        slope, rest = (w1 - w0) / (t1 - t0), share * F.lit(whole) - F.lit(before)
        t = F.lit(t0) + ((F.sqrt(F.lit(w0 * w0) + F.lit(2 * slope) * rest) - F.lit(w0)) / F.lit(slope) if slope else rest / F.lit(w0))
        before += a
        out = F.when(share * F.lit(whole) < F.lit(before), t) if out is None else out.when(share * F.lit(whole) < F.lit(before), t)
    return out.otherwise(F.lit(1.0))


def source_targets(items: DataFrame, most: int = MOST) -> DataFrame:
    """(_mix_key, source_size, rank, target) of items (_mix_key, mass); keys ascend by source, null last."""
    sums = items.groupBy("_mix_key").agg(F.sum("mass").alias("source_size"))
    ranked = sums.withColumn("rank", F.row_number().over(Window.orderBy("_mix_key")) - 1).withColumn("weight", F.col("rank") % 3 + 1)
    ratio = F.col("source_size") * most / F.col("weight")
    before = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    out = ranked.withColumn("ratio", ratio)
    out = out.withColumn("spent", F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0)))
    out = out.withColumn("used", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    out = out.withColumn("level", (F.sum("source_size").over(every) - F.col("spent")) / (F.sum("weight").over(every) - F.col("used")))
    out = out.withColumn("full", F.col("level") > F.col("ratio"))
    out = out.withColumn("line", F.max(F.when(~F.col("full"), F.col("level"))).over(every))
    target = F.when(F.col("full"), (F.col("source_size") * most).cast("double")).otherwise(F.col("line") * F.col("weight"))
    return out.select("_mix_key", "source_size", "rank", target.alias("target"))


def _keyed(docs: DataFrame) -> DataFrame:
    source = F.col("source").cast("string")
    return docs.withColumn("_mix_key", F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))).withColumn("_mix_id", F.coalesce(F.concat(F.lit("#"), F.col("doc_id").cast("string")), F.lit("")))


def plan_mix(sizes: DataFrame, most: int = MOST, schedules=SCHEDULES) -> DataFrame:
    """Of each item (_mix_id, _mix_key, size: n repeated rows): source_size, target, copies, first_position.

    `sizes` (doc_id, source, size) is read more than once: pass a written table.
    """
    items = _keyed(sizes).groupBy("_mix_id", "_mix_key", "size").agg(F.count("*").alias("n"), F.first("doc_id").alias("doc_id"))
    items = items.withColumn("mass", F.col("size") * F.col("n")).withColumn("h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    items = items.withColumn("bucket", F.substring("h", 1, 3))
    targets = source_targets(items, most)
    upto = Window.partitionBy("_mix_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = items.groupBy("_mix_key", "bucket").agg(F.sum("mass").alias("own")).withColumn("earlier", F.coalesce(F.sum("own").over(upto), F.lit(0))).drop("own")
    inside = Window.partitionBy("_mix_key", "bucket").orderBy("h", "_mix_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    out = items.withColumn("inner", F.coalesce(F.sum("mass").over(inside), F.lit(0)))
    out = out.join(buckets.join(targets, "_mix_key"), ["_mix_key", "bucket"]).withColumn("before", F.col("earlier") + F.col("inner"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    out = out.withColumn("passes", passes.cast("long")).withColumn("left", F.col("target") - F.col("passes") * F.col("source_size"))
    more = (2 * F.col("before") + F.col("mass") < 2 * F.col("left")) & (F.col("mass") > 0)
    out = out.withColumn("copies", F.when(F.col("mass") > 0, F.col("passes")).otherwise(F.lit(0)) + more.cast("long"))
    return out.select("_mix_id", "_mix_key", "size", "n", "doc_id", "rank", "source_size", "target", "before", "copies", position(F.col("before"), schedules).alias("first_position"))


def position(words_before: Column, schedules=SCHEDULES) -> Column:
    """Training time of what comes after so many words of a source; needs target, rank and copies."""
    share = F.least(words_before / F.col("target"), F.lit(1.0))
    out = F.lit(None).cast("double")
    for k, s in enumerate(schedules):
        out = F.when(F.col("rank") % len(schedules) == k, inverse_demand(s, share)).otherwise(out)
    return F.when(F.col("copies") > 0, out)


def mix_documents(docs: DataFrame, most: int = MOST, schedules=SCHEDULES) -> DataFrame:
    """The rows of `docs` as often as the mix takes them, range-sorted by training position."""
    rows, names = plain_names(docs)
    named = {c: F.col(names[c]) for c in ("doc_id", "source")}
    sized = rows.withColumns({**named, "_mix_size": size_of(F.col(names["text"]))})
    sizes = materialize(sized.select("doc_id", "source", F.col("_mix_size").alias("size")), "sizes")
    plan = plan_mix(sizes, most, schedules).where("copies > 0")
    turn = F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("_mix_turn")
    turns = plan.select("_mix_id", "_mix_key", F.col("size").alias("_mix_size"), "target", "rank", "copies", "before", "source_size", turn)
    turns = turns.withColumn("_mix_position", position(F.col("before") + F.col("_mix_turn") * F.col("source_size"), schedules))
    turns = turns.select("_mix_id", "_mix_key", "_mix_size", "_mix_turn", "_mix_position")
    mixed = _keyed(sized).join(turns, ["_mix_id", "_mix_key", "_mix_size"])
    order = ["_mix_position", "_mix_id", "_mix_turn"]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).select(*names.values()).toDF(*docs.columns)


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sizes = materialize(docs.select("doc_id", "source", size_of(F.col("text")).alias("size")), "sizes")
    plan = plan_mix(sizes).withColumn("_", F.explode(F.sequence(F.lit(1), F.col("n"))))
    out = plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "first_position")
    return out.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk FROM d GROUP BY source),
w AS (SELECT *, rnk % 3 + 1 AS weight, source_size * 3 / (rnk % 3 + 1)::DOUBLE AS ratio FROM s),
b AS (SELECT *, coalesce(sum(source_size * 3) OVER o, 0) AS spent, coalesce(sum(weight) OVER o, 0) AS used,
        sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
      FROM w WINDOW o AS (ORDER BY ratio, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - spent)::DOUBLE / (weights - used)::DOUBLE AS level FROM b),
m AS (SELECT *, max(CASE WHEN level <= ratio THEN level END) OVER () AS line FROM l),
t AS (SELECT source, source_size, rnk, CASE WHEN level > ratio THEN (source_size * 3)::DOUBLE ELSE line * weight END AS target FROM m),
c AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.rnk,
        coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(d.doc_id::VARCHAR), d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before,
        CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS passes
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN size > 0 THEN passes + CASE WHEN 2 * before + size < 2 * (target - passes * source_size) THEN 1 ELSE 0 END ELSE 0 END AS copies,
        least(before / target, 1.0::DOUBLE) AS share FROM c)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken,
  CASE WHEN copies > 0 THEN CASE WHEN share >= 1 THEN 1.0::DOUBLE
    WHEN rnk % 3 = 0 THEN (sqrt(2.25::DOUBLE + -2.0::DOUBLE * share) - 1.5::DOUBLE) / -1.0::DOUBLE
    WHEN rnk % 3 = 1 THEN share ELSE (sqrt(0.25::DOUBLE + 2.0::DOUBLE * share) - 0.5::DOUBLE) / 1.0::DOUBLE END END AS first_position
FROM e
"""
