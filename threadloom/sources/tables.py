"""Tables in parts whose upserts rewrite only the parts that changes touch, and that are whole at every moment.

Below a folder: data/version=v/<part>=p holds rows, manifest/v says which version of each part counts after version v, a row
for each part. A writer puts its parts into a new version's folders and then its manifest, whose presence commits the version;
readers take the last committed manifest, so they see a table before or after a write, never without a part. Two writers of
one version collide at the manifest: the second fails and starts over. `vacuum` deletes what older manifests alone name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.mutations import upsert
from .scratch import written


class PartedTable:
    def __init__(self, spark: SparkSession, root: str, schema, part: str):
        self.spark, self.root, self.part = spark, root.rstrip("/"), part
        fields = T.StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
        self.schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])
        self._kind = self.schema[part].dataType

    # Parts are stored by a text of their value, so that null and empty are two parts.
    def _key(self, column=None) -> Column:
        c = F.col(self.part) if column is None else column
        return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        p, fs = self._fs(f"{self.root}/manifest")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n) for n in names if n.isdigit() and fs.exists(self._fs(f"{self.root}/manifest/{n}/_SUCCESS")[0]))

    def manifest(self, version: int | None = None) -> DataFrame:
        """(_part, version), a row for each part of a committed version, the last if none is given."""
        known = self.versions()
        schema = "_part string, version int"
        if not known:
            return self.spark.createDataFrame([], schema)
        # A comparison makes the planner prune folders by the manifest's rows where both are joined.
        return self.spark.read.schema(schema).parquet(f"{self.root}/manifest/{version or known[-1]}").where("version > 0")

    def _stored(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("version", T.IntegerType()), T.StructField("_part", T.StringType())])
        return self.spark.read.schema(schema).parquet(f"{self.root}/data")

    def read(self, version: int | None = None) -> DataFrame:
        if not self.versions():
            return self.spark.createDataFrame([], self.schema)
        live = self.manifest(version)
        return self._stored().join(F.broadcast(live), ["version", "_part"], "left_semi").select(*self.schema.names)  # a row for each part

    def _commit(self, rows: DataFrame, live: DataFrame, version: int) -> None:
        """`live`: the parts of the version before that aren't written anew."""
        out = f"{self.root}/data/version={version}"
        rows.withColumn("_part", self._key()).repartition(F.col("_part")).write.mode("overwrite").partitionBy("_part").parquet(out)
        schema = T.StructType([*self.schema.fields, T.StructField("_part", T.StringType())])
        own = self.spark.read.schema(schema).parquet(out).select("_part").distinct().withColumn("version", F.lit(version))
        live.unionByName(own).coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/manifest/{version}")

    def replace(self, rows: DataFrame) -> int:
        """Writes all rows anew; the new version's number."""
        version = max(self.versions(), default=0) + 1
        self._commit(rows.select(*self.schema.names), self.manifest().limit(0), version)
        return version

    def upsert(self, changes: DataFrame, key: str | list[str], keep: dict[str, Column] | None = None) -> int:
        """Rows of `changes` replace or join those with their key in the same part, as `operators.mutations.upsert` does; parts
        without changes are neither read nor written. The part belongs to the key. The new version's number."""
        keys = [key] if isinstance(key, str) else list(key)
        version = max(self.versions(), default=0) + 1
        changes = written(changes, "changes")
        touched = changes.select(self._key().alias("_part")).distinct()
        live = self.manifest()
        base = self._stored().join(F.broadcast(live.join(touched, "_part")), ["version", "_part"], "left_semi").select(*self.schema.names) if self.versions() else self.spark.createDataFrame([], self.schema)
        rows = upsert(base, changes, list(dict.fromkeys([self.part, *keys])), keep)
        self._commit(rows, live.join(touched, "_part", "left_anti"), version)
        return version

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes parts that none of the last `keep` manifests names, and older manifests; no reader may use those any more."""
        known = self.versions()
        kept = known[-keep:]
        named = {(r["_part"], r["version"]) for v in kept for r in self.manifest(v).collect()}  # a row for each part
        gone = []
        p, fs = self._fs(f"{self.root}/data")
        for v in fs.listStatus(p) if fs.exists(p) else []:
            number = int(v.getPath().getName().partition("=")[2])
            if number > max(known, default=0):
                continue  # being written
            for part in fs.listStatus(v.getPath()):
                name = part.getPath().getName()
                if name.startswith("_part=") and (_unescaped(name[6:]), number) not in named:
                    fs.delete(part.getPath(), True)
                    gone.append(f"{number}/{name}")
        for v in known[:-keep]:
            fs.delete(self._fs(f"{self.root}/manifest/{v}")[0], True)
        return gone


def _unescaped(name: str) -> str:
    """A folder's name as Spark reads it."""
    import re

    return re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), name)
