"""Runs of at most n rows behind a stored high-water mark, each committed once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import numbered

STATE = "run int, on timestamp, id string, taken long, status string"


@dataclass
class Run:
    """A run's number, mark, rows taken, and status: partial (rows are left), ok, or no_new_rows."""

    run: int
    on: object
    id: str | None
    taken: int
    status: str


class HighWater:
    """A source table read by (on, id), from the oldest, with what runs took below a folder: out/run=k and state/run=k.

    A run writes its rows, then its mark. One that ended between the two is not committed: the next writes the same folder
    anew, and readers of `taken` see committed runs alone, so each row is taken once. A row without a date is the oldest, one
    without an id the first of its date. Rows that come in with a key behind the mark aren't seen, as behind any mark.
    """

    def __init__(self, spark: SparkSession, root: str, on: str, id_: str):
        self.spark, self.root, self.on, self.id = spark, root, on, id_

    def _runs(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/state")
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        found = [s.getPath() for s in fs.listStatus(path)]
        return sorted(int(p.getName()[4:]) for p in found if p.getName().startswith("run=") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def last(self) -> Run:
        """The last committed run; number 0 before any."""
        runs = self._runs()
        if not runs:
            return Run(0, None, None, 0, "none")
        r = self.spark.read.schema(STATE).parquet(f"{self.root}/state/run={runs[-1]}").first()  # one row
        return Run(r["run"], r["on"], r["id"], r["taken"], r["status"])

    def run(self, source: DataFrame, most: int, transform=lambda rows: rows, fail_before_commit: bool = False) -> Run:
        """Takes the next `most` rows, or what there is, and commits."""
        before = self.last()
        on = F.coalesce(F.col(self.on).cast("timestamp"), F.lit("1900-01-01").cast("timestamp"))
        id_ = F.coalesce(F.col(self.id).cast("string"), F.lit(""))
        rows = source.withColumns({"_on": on, "_id": id_})
        if before.on is not None:
            mark = F.lit(before.on).cast("timestamp")
            rows = rows.where((F.col("_on") > mark) | ((F.col("_on") == mark) & (F.col("_id") > F.lit(before.id))))
        placed = numbered(rows, ["_on", "_id"], "_rn")
        own = placed.where(F.col("_rn") <= most)
        end = own.agg(F.max(F.struct("_on", "_id")).alias("m"), F.count("*").alias("n")).first()
        more = placed.where(F.col("_rn") == most + 1).limit(1).count() > 0
        status = "no_new_rows" if not end["n"] else "partial" if more else "ok"
        now = Run(before.run + 1, end["m"]["_on"] if end["n"] else before.on, end["m"]["_id"] if end["n"] else before.id, end["n"], status)
        transform(own.drop("_on", "_id", "_rn")).write.mode("overwrite").parquet(f"{self.root}/out/run={now.run}")
        if fail_before_commit:
            raise RuntimeError("ended before the mark was written")
        self.spark.createDataFrame([(now.run, now.on, now.id, now.taken, now.status)], STATE).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/state/run={now.run}")
        return now

    def taken(self, schema) -> DataFrame:
        """What all committed runs took."""
        runs = self._runs()
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/out/run={k}" for k in runs))
