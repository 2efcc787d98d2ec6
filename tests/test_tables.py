"""Parted tables during writes, and page writes into a store that conflicts."""

import json
import os
import sys
import threading

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from threadloom.sources import wiki
from threadloom.sources.tables import PartedTable

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the store's code goes with the jobs
SCHEMA = "product string, id long, text string"


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/data") for f in names if f.endswith(".parquet")}


def test_upserts_write_only_their_parts(spark, tmp_path):
    table = PartedTable(spark, f"file://{tmp_path}/t", SCHEMA, "product")
    assert table.read().count() == 0
    rows = {(p, i): f"{p}{i}" for p in ["a", "b", "x/y %=z", "", None] for i in range(20)}
    table.replace(spark.createDataFrame([(*k, v) for k, v in rows.items()], SCHEMA))
    before = files(f"{tmp_path}/t")
    changes = {("b", 3): "new", ("b", 99): "more", (None, 1): "none", ("c", 1): "first"}
    assert table.upsert(spark.createDataFrame([(*k, v) for k, v in changes.items()], SCHEMA), "id") == 2
    got = {(r.product, r.id): r.text for r in table.read().collect()}
    assert got == rows | changes
    made = {f.split("_part=")[1].split("/")[0] for f in files(f"{tmp_path}/t") - before}
    assert made == {"%3Db", "%3Dc", "null"}
    assert {(r.product, r.id): r.text for r in table.read(1).collect()} == rows  # the version before is still whole
    assert len(table.vacuum(keep=1)) == 2  # b and null of version 1
    assert {(r.product, r.id): r.text for r in table.read().collect()} == rows | changes
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_readers_see_whole_tables(spark, tmp_path):
    table = PartedTable(spark, f"file://{tmp_path}/t", SCHEMA, "product")
    table.replace(spark.createDataFrame([(f"p{i % 3}", i, "0") for i in range(30)], SCHEMA))
    done, odd, reads = threading.Event(), [], 0

    def write():
        try:
            for k in range(1, 4):
                table.upsert(table.read().where("product <> 'p2'").withColumn("text", F.lit(str(k))), "id")
        finally:
            done.set()

    writer = threading.Thread(target=write)
    writer.start()
    while not done.is_set():
        texts = {}
        for r in table.read().collect():
            texts.setdefault(r.product, []).append(r.text)
        reads += 1
        if {p: len(v) for p, v in texts.items()} != {"p0": 10, "p1": 10, "p2": 10} or len(set(texts["p0"] + texts["p1"])) != 1:
            odd.append(texts)
    writer.join()
    assert reads and not odd and table.versions() == [1, 2, 3, 4]


def test_writers_collide(spark, tmp_path):
    table = PartedTable(spark, f"file://{tmp_path}/t", SCHEMA, "product")
    table.replace(spark.createDataFrame([("a", 1, "x")], SCHEMA))
    stale = table.manifest()
    table.upsert(spark.createDataFrame([("a", 2, "y")], SCHEMA), "id")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        table._commit(table.read(), stale.limit(0), 2)


class FileStore:
    """Pages as files; `odd` pages change under every first writer's hands."""

    def __init__(self, root, odd=()):
        self.root, self.odd = root, set(odd)

    def _file(self, path):
        return os.path.join(self.root, path.replace("/", "~"))

    def get(self, path):
        try:
            with open(self._file(path)) as f:
                page = json.load(f)
        except FileNotFoundError:
            return None
        return page["content"], page["tag"]

    def put(self, path, content, tag):
        if path in self.odd:
            self.odd.discard(path)
            self._write(path, "by another", -1 if not path.endswith("always") else None)
            if path.endswith("always"):
                self.odd.add(path)
        there = self.get(path)
        if (there is None) != (tag is None) or there is not None and there[1] != tag:
            raise wiki.Conflict(path)
        self._write(path, content, (tag or 0) + 1)

    def _write(self, path, content, tag):
        own = f"{self._file(path)}.{os.getpid()}.{threading.get_ident()}"
        with open(own, "w") as f:
            json.dump({"content": content, "tag": tag if tag is not None else int.from_bytes(os.urandom(4), "big")}, f)
        os.replace(own, self._file(path))


def test_pages_under_tags(spark, tmp_path):
    root = str(tmp_path / "pages")
    os.makedirs(root)
    pages = [("/kb/a/b", "B"), ("/kb/a", "A"), ("/kb/new/deep/page?x=1", "P"), ("/kb/odd", "O"), ("/kb/always", "N"), (None, "?"), ("/kb//a/b", "B")]
    df = spark.createDataFrame(pages, "path string, content string").repartition(3)
    got = {r.path: r.result for r in wiki.push_pages(df, lambda: FileStore(root, ["/kb/odd", "/kb/always"])).collect()}
    # Where one task makes a stub for a page that another puts, the page is updated.
    assert got.pop("/kb/a") in ("created", "updated")
    assert got == {"/kb/a/b": "created", "/kb/new/deep/page": "created", "/kb/odd": "updated", "/kb/always": "failed"}
    store = FileStore(root)
    assert store.get("/kb/a")[0] == "A" and store.get("/kb/odd")[0] == "O" and store.get("/kb/new")[0] == "# new\n" and store.get("/kb")[0] == "# kb\n"
    again = {r.path: r.result for r in wiki.push_pages(df.where("path <> '/kb/always'"), lambda: FileStore(root)).collect()}
    assert set(again.values()) == {"unchanged"}


def test_pages_of_a_stream(spark, tmp_path):
    root = str(tmp_path / "pages")
    os.makedirs(root)
    told = []
    for text in ("one", "two"):
        spark.createDataFrame([("/s/a", text)], "path string, content string").write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema("path string, content string").parquet(f"{tmp_path}/in")
        wiki.push_stream(stream, lambda: FileStore(root), f"{tmp_path}/state", lambda r: told.extend(map(tuple, r.collect()))).awaitTermination()
    assert told == [("/s/a", "created"), ("/s/a", "updated")] and FileStore(root).get("/s/a")[0] == "two"
