"""Filters shared by the stages. Thresholds differ by stage; they are named here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CATALOG_MIN, ASSIGN_MIN, ORPHAN_MIN, NUGGET_MIN, SIGNAL_MIN = 0.4, 0.3, 0.4, 0.2, 0.5
EXCLUDED = ("emergent_issue", "not_usable", "learn_microsoft")


def non_blank(c: str | Column) -> Column:
    """Not null and not made of blanks alone; null counts as false."""
    return F.coalesce(F.trim(F.col(c) if isinstance(c, str) else c) != "", F.lit(False))


def usefulness_from(least: float) -> Column:
    return F.coalesce(F.col("usefulness"), F.lit(0).cast("decimal(4,3)")) >= F.lit(str(least)).cast("decimal(4,3)")


def common_eligible(least: float, product: str | None = None) -> Column:
    """Threads that can enter the catalog. Naming a product drops the test against 'Other'."""
    named = (F.col("product") == product) if product is not None else non_blank("product") & (F.col("product") != "Other")
    usable = F.col("classification").isNull() | ~F.col("classification").isin(*EXCLUDED)
    return named & non_blank("signature_text") & usable & usefulness_from(least)


def catalog_eligible(product: str | None = None, force: bool = False) -> Column:
    return common_eligible(CATALOG_MIN, product) & (F.lit(force) | F.col("checked_on").isNull())


def assign_eligible(product: str | None = None, force: bool = False) -> Column:
    waiting = F.col("checked_on").isNotNull() & F.col("started_on").isNull() & (F.lit(force) | F.col("completed_on").isNull())
    return common_eligible(ASSIGN_MIN, product) & waiting


def emergent_eligible() -> Column:
    flagged = (F.col("classification") == "emergent_issue") | F.col("is_emergent")
    return flagged & (F.coalesce(F.col("emergent_signal"), F.lit(0)) >= SIGNAL_MIN)


def nugget_eligible() -> Column:
    return (F.col("usefulness") >= F.lit(str(NUGGET_MIN)).cast("decimal(4,3)")) & F.col("mined_on").isNull() & non_blank("product") & (F.col("product") != "Other")


def in_batch(batch: str | None = None, product: str | None = None, since=None, until=None, on: str = "created_on") -> Column:
    """Whichever of the optional restrictions are given."""
    out = F.lit(True)
    if batch is not None:
        out = out & (F.col("batch_id") == batch)
    if product is not None:
        out = out & (F.col("product") == product)
    if since is not None:
        out = out & (F.col(on) >= since)
    if until is not None:
        out = out & (F.col(on) <= until)
    return out


def beyond_watermark(on: str, id_: str, mark_on, mark_id: str, strict: bool = False) -> Column:
    """Newer date OR larger id, ids as strings; `strict`: the comparison of (date, id) as a pair."""
    later = F.col(on) > F.lit(mark_on)
    if strict:
        return later | ((F.col(on) == F.lit(mark_on)) & (F.col(id_) > mark_id))
    return later | (F.col(id_) > mark_id)


def page_after(on: str, id_: str, cursor_on, cursor_id) -> Column:
    """Rows after a cursor in the order (on desc, id desc)."""
    return (F.col(on) < F.lit(cursor_on)) | ((F.col(on) == F.lit(cursor_on)) & (F.col(id_) < cursor_id))
