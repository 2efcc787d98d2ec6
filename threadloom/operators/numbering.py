"""Numbers of rows and of groups in an order, without a task that sees all rows.

Rows are dealt by ranges of the order and sorted in each; a row's place in its range is what its task counts, and where a
range begins is the sum of the ranges before it. Only the ranges' sizes, a row for each, meet in one place. The dealt rows
are written once, since ranges are found by sampling and might fall elsewhere when computed again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written

#: monotonically_increasing_id(): the partition in the upper bits, the place in it in the lower 33.
_PLACE = 33


def numbered(rows: DataFrame, order: list[str | Column], name: str = "rn", ranges: int | None = None) -> DataFrame:
    """`rows` with their number in the order, from 1: row_number() over the whole table.

    The order should end in a key; rows that are equal in all of it get numbers in no defined order, as with row_number(), but
    lie in one range, so a table whose order is one value is one range. `name` takes the place of a column of that name.
    """
    rows = rows.drop(name)
    dealt = rows.repartitionByRange(ranges, *order) if ranges else rows.repartitionByRange(*order)
    placed = written(dealt.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    range_ = F.shiftright("_at", _PLACE)
    sizes = placed.groupBy(range_.alias("_range")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))  # a row for each range
    out = placed.withColumn("_range", range_).join(F.broadcast(starts), "_range")
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE) - 1))
    return out.withColumn(name, F.col("_before") + place + 1).drop("_at", "_range", "_before")


def numbered_by(rows: DataFrame, by: list[str], order: list[str | Column], name: str = "rn", ranges: int | None = None) -> DataFrame:
    """row_number() for each value of `by` (null is one), whose rows may lie in several ranges: a frequent value is no one task's."""
    out = numbered(rows, [*by, *order], "_rn", ranges)
    first = out.groupBy(*by).agg(F.min("_rn").alias("_first")).select(*(F.col(b).alias(f"_by{i}") for i, b in enumerate(by)), "_first")
    same = [F.col(b).eqNullSafe(F.col(f"_by{i}")) for i, b in enumerate(by)]
    joined = out.join(first, same, "left").withColumn(name, F.col("_rn") - F.col("_first") + 1)
    return joined.drop("_rn", "_first", *(f"_by{i}" for i in range(len(by))))


def dense_rank_by(rows: DataFrame, by: list[str], value: str, name: str = "rank", ranges: int | None = None) -> DataFrame:
    """dense_rank() of `value` for each value of `by`; nulls are values, before all others."""
    keys = [*by, value]
    ranks = numbered_by(rows.select(*keys).distinct(), by, [F.asc_nulls_first(value)], name, ranges)
    ranks = ranks.select(*(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)), name)
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return rows.drop(name).join(ranks, same, "left").drop(*(f"_key{i}" for i in range(len(keys))))
