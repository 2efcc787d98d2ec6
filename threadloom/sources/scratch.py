"""Where jobs put what all executors must see."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a local one, gone when the driver ends, only in local mode, where there is
    but one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="threadloom-"))
        atexit.register(shutil.rmtree, _OWN[0], True)
    return f"file://{_OWN[0]}"


def new_folder(spark: SparkSession, tag: str) -> str:
    """A folder below the shared one that no other call gets."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def written(rows: DataFrame, tag: str) -> DataFrame:
    """`rows`, computed once and written to the shared folder, where their lineage begins anew."""
    path = new_folder(rows.sparkSession, tag)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
