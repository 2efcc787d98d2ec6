"""Catalog reads."""

from __future__ import annotations

from pyspark.sql import DataFrame


def capped_catalog(catalog: DataFrame, cap: int) -> DataFrame:
    """The first `cap` active nodes of all products: the cap comes before any filter by product."""
    return catalog.where("is_active").orderBy("cluster_level", "cluster_id").limit(cap)
