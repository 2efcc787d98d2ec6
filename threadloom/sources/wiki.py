"""What a wiki sink writes, and the hook that writes it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import ancestors, single_slashes
from ..operators.rollup import first_of


def sanitize(path):
    """Without a query, from / on."""
    return single_slashes(F.regexp_replace(path, r"(\?|&api-version=).*$", ""))


def upsert_plan(pages: DataFrame) -> DataFrame:
    """(path, content, stub, depth): the pages and a stub for each missing ancestor, parents first by depth."""
    own = first_of(pages.select(sanitize(F.col("path")).alias("path"), "content"), ["path"])
    stubs = own.select(F.explode(ancestors(F.col("path"))).alias("path")).distinct().join(own.select("path"), "path", "left_anti")
    every = own.withColumn("stub", F.lit(False)).unionByName(stubs.select("path", F.lit("").alias("content"), F.lit(True).alias("stub")))
    return every.withColumn("depth", F.size(F.split("path", "/")) - 1)


def push(plan: DataFrame, put: Callable[[str, str], None]) -> None:
    """Calls `put(path, content)` for every row, depth by depth, in the tasks."""
    depths = [r[0] for r in plan.select("depth").distinct().orderBy("depth").collect()]

    def each(rows):
        for r in rows:
            put(r["path"], r["content"])

    for d in depths:
        plan.where(F.col("depth") == d).foreachPartition(each)


class Conflict(Exception):
    """A store's answer where a page has changed since its tag was read, or is there though it was to be made (409, 412)."""


def stub_text(path: str) -> str:
    """What a page holds that was made only because a page below it needed it."""
    return f"# {path.rsplit('/', 1)[-1]}\n"


def put_page(store, path: str, content: str, known: set[str]) -> str:
    """Makes or changes a page under its tag: created, updated, unchanged (it already holds the content), or failed.

    `store.get(path)` gives (content, tag) or None; `store.put(path, content, tag)` with a tag changes that version and without
    one makes the page, and raises Conflict where it can't. Ancestors that aren't there are made first, from the top; that
    another writer was faster is no error. After a conflict the tag is read once more and the page put once more.
    """
    parts = [p for p in path.split("/") if p]
    for k in range(1, len(parts)):
        above = "/" + "/".join(parts[:k])
        if above not in known:
            if store.get(above) is None:
                try:
                    store.put(above, stub_text(above), None)
                except Conflict:
                    pass
            known.add(above)
    for _ in range(2):
        there = store.get(path)
        if there is not None and there[0] == content:
            return "unchanged"
        try:
            store.put(path, content, None if there is None else there[1])
            return "created" if there is None else "updated"
        except Conflict:
            continue
    return "failed"


def push_pages(pages: DataFrame, open_store: Callable[[], object]) -> DataFrame:
    """(path, result) of putting pages (path, content), each path once, in the tasks, in one pass; the results are written once.

    A task that runs again finds its pages as it left them and says unchanged, so replays do no harm.
    """
    import pyarrow as pa

    from .scratch import written

    named = pages.where("trim(path) <> ''")
    own = first_of(named.select(sanitize(F.col("path")).alias("path"), F.coalesce("content", F.lit("")).alias("content")), ["path"])

    def run(batches):
        store, known = open_store(), set()
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.RecordBatch.from_pydict({"path": [r["path"] for r in rows], "result": [put_page(store, r["path"], r["content"], known) for r in rows]})

    return written(own.mapInArrow(run, "path string, result string"), "pushed")


def push_stream(pages: DataFrame, open_store: Callable[[], object], checkpoint: str, told: Callable[[DataFrame], None] | None = None):
    """Pushes the pages of a stream batch by batch; a batch that is run again after a failure changes nothing twice."""

    def batch(rows: DataFrame, _: int) -> None:
        results = push_pages(rows, open_store)
        if told is not None:
            told(results)

    return pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
