"""Incremental runs: files and rows that are new since the last run, exactly once by the checkpoint's offsets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def run_available(spark: SparkSession, source: str, schema, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, files_per_batch: int = 50) -> None:
    """Takes in the Parquet files that are new below `source` and appends what `transform` makes of them to `target`."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    run = transform(rows).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()


def unseen(stream: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows of a stream whose id a table doesn't have."""
    return stream.join(known.select(key), key, "left_anti")


def event_windows(rows: DataFrame, late: str = "1 hour", size: str = "1 day") -> DataFrame:
    """Counts and sums by event type and window; rows later than `late` are left out of a stream."""
    return rows.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.round(F.sum(F.col("value").cast("decimal(18,2)")), 2).alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(rows: DataFrame, keys: list[str], gap: str) -> DataFrame:
    """Runs of events of a key without a gap of `gap` between them."""
    return rows.groupBy(*keys, F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last")).drop("w")


def load_per_minute(rows: DataFrame, key: str = "event_type") -> DataFrame:
    """What of each key's amounts falls in the 60 seconds up to each event.

    A key's rows are dealt by the hour, so that a frequent key isn't one task's; a row of an hour's last 60 seconds is also
    read with the next hour, where it adds to others and doesn't stand itself.
    """
    at = F.col("ts").cast("timestamp").cast("long")
    hour = F.floor(at / 3600)
    spread = rows.withColumn("_at", at).withColumn("_hour", F.explode(F.array_distinct(F.array(hour, F.floor((at + 60) / 3600)))))
    w = Window.partitionBy(key, "_hour").orderBy("_at").rangeBetween(-60, 0)
    out = spread.withColumn("load", F.sum(F.col("value").cast("decimal(18,2)")).over(w))
    return out.where(F.col("_hour") == F.floor(F.col("_at") / 3600)).drop("_at", "_hour")


def split_by_silence(rows: DataFrame, key: str = "incident_id", at: str = "added_on", days: int = 3) -> DataFrame:
    """Numbers the stretches of each key's rows that more than `days` without any row separate: state that a branch
    carries from row to row, as a window over the branch."""
    w = Window.partitionBy(key).orderBy(at, "thread_id")
    gap = F.coalesce(F.datediff(F.col(at), F.lag(at).over(w)) > days, F.lit(False)).cast("int")
    return rows.withColumn("_gap", gap).withColumn("stretch", F.sum("_gap").over(w)).drop("_gap")
