"""Operator 13: applies numbered changes in order, out of a buffer of sorted runs that waits for missing numbers.

A stateful streaming query holds, for each client, the next number and the changes that came before their turn. Clients are
dealt to shards, which are the keys of the state. As in an LSM tree, a batch appends what it can't apply yet as one run, sorted
by client and number, to a ListState, an element for each client, and leaves older runs as they are; a cursor for each
element says how much of it was taken. What is applied comes from a k-way heap merge of a client's runs: as long as the next
number is there, or, once its earliest held change has waited long enough, from the smallest held number on. Every few
batches the runs are compacted: each client's remaining changes become one element, and cursors start anew.

Of the changes of one batch with the same client and number only the first can be taken: whether it is or not, the others are
rejected. They are told by an aggregate before the stream's shuffle and go to shards of their own, spread by change, so that
one task meets a row for each of a client's distinct numbers in a batch at most. A client's numbers themselves pass through
its shard, in order.

Every batch, and an end after the last, brings a row for each shard, with the largest day of all earlier batches; so every
shard looks for changes that have waited long enough at the start of a batch, even of an empty one.

Defined cases: rows are compared in the columns named in COLUMNS, and those equal in all count once; seq null is a number
before all others; a null client_id is a client like others; rows with a null change_id vanish; of rows with the same change_id
the order goes on by op, city and balance; an op other than I, U and D changes nothing; a balance that is NaN or infinite gives
no cents; days before the first batch belong to it; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.numbering import dense_rank_by
from ..streaming.stateful import state_session
from .common import scratch_path, table

COLUMNS = ["change_id", "client_id", "seq", "op", "valid_at", "source", "segment", "city", "balance"]
FIRST_DAY, DAYS, BATCHES, WAIT = 19723, 160, 10, 8
#: Changes in all for each shard, about; batches between compactions.
SHARD_ROWS, COMPACT = 10_000, 4

FED = "shard long, batch int, seen long, last boolean, spare boolean, client_id long, n long, day long, change_id long, op string, city string, balance double"
RESULT = "change_id long, client_id long, n long, status string, batch int, missed long, op string, city string, cents long"
RUN = "client_id long, n array<long>, day array<long>, change_id array<long>, op array<string>, city array<string>, balance array<double>"


def cut(changes: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Distinct changes with their number n of the client, day, batch and spare (not the batch's first of its number)."""
    rows = dense_rank_by(changes.select(*COLUMNS).distinct(), ["client_id"], "seq", "n")
    h = F.crc32(F.col("change_id").cast("string").cast("binary"))
    rows = rows.where("valid_at is not null").where(h % 11 != 0)
    rows = rows.withColumn("day", (F.unix_date(F.col("valid_at").cast("date")) + 5 * (h % 4)).cast("long"))
    number = F.floor((F.col("day") - FIRST_DAY) * batches / DAYS) + 1
    rows = rows.withColumn("batch", F.greatest(F.lit(1), F.least(F.lit(batches), number)).cast("int"))
    keys = ["client_id", "n", "batch"]
    own = F.struct("day", "change_id", "op", "city", "balance", "source", "segment", "valid_at")
    first = rows.groupBy(*keys).agg(F.min(own).alias("_first")).select(*(F.col(k).alias(f"_{k}") for k in keys), "_first")
    same = F.col("client_id").eqNullSafe(F.col("_client_id")) & (F.col("n") == F.col("_n")) & (F.col("batch") == F.col("_batch"))
    rows = rows.join(first, same).withColumn("spare", ~own.eqNullSafe(F.col("_first")))
    return rows.select("client_id", "n", "day", "change_id", "op", "city", "balance", "batch", "spare")


class Client:
    """A client's progress, and its held changes: runs with cursors."""

    def __init__(self, progress=(1, None, None)):
        self.next, self.city, self.balance = progress
        self.runs: list[tuple] = []  # (element or None for this batch's run, columns)
        self.at: list[int] = []

    def hold(self, element, columns, at: int = 0) -> None:
        self.runs.append((element, columns))
        self.at.append(at)

    def numbers(self) -> set[int]:
        return {n for (_, c), at in zip(self.runs, self.at, strict=True) for n in c[0][at:]}

    def heap(self) -> list[tuple[int, int]]:
        heap = [(c[0][at], r) for r, ((_, c), at) in enumerate(zip(self.runs, self.at, strict=True)) if at < len(c[0])]
        heapq.heapify(heap)
        return heap

    def take(self, heap, missed: int = 0):
        """The changes from the next number on, as far as they are there."""
        while heap and heap[0][0] == self.next:
            n, r = heap[0]
            c, at = self.runs[r][1], self.at[r]
            self.at[r] = at + 1
            if at + 1 < len(c[0]):
                heapq.heapreplace(heap, (c[0][at + 1], r))
            else:
                heapq.heappop(heap)
            op = c[3][at]
            if op == "D":
                self.city = self.balance = None
            elif op == "I" or op == "U":
                self.city = c[4][at] if op == "I" or c[4][at] is not None else self.city
                self.balance = c[5][at] if op == "I" or c[5][at] is not None else self.balance
            self.next = n + 1
            cents = None if self.balance is None or not math.isfinite(self.balance) else math.floor(100 * self.balance + 0.5)
            yield c[2][at], n, missed, op, self.city, cents
            missed = 0

    def expired(self, wait: int, seen: int | None, last: bool):
        """What is taken because its turn will not come: all at the end, else as long as the earliest held day is `wait` back."""
        heap = self.heap()
        days = [] if last else [(day, n) for (_, c), at in zip(self.runs, self.at, strict=True) for day, n in zip(c[1][at:], c[0][at:], strict=True)]
        heapq.heapify(days)
        while heap:
            while days and days[0][1] < self.next:
                heapq.heappop(days)
            if not last and (seen is None or days[0][0] + wait > seen):
                return
            missed, self.next = heap[0][0] - self.next, heap[0][0]
            yield from self.take(heap, missed)

    def rest(self):
        """All that is held, sorted by number: a merge of the runs."""
        heap, rows = self.heap(), []
        while heap:
            _, r = heap[0]
            c, at = self.runs[r][1], self.at[r]
            rows.append([x[at] for x in c])
            self.at[r] = at + 1
            if at + 1 < len(c[0]):
                heapq.heapreplace(heap, (c[0][at + 1], r))
            else:
                heapq.heappop(heap)
        return [list(x) for x in zip(*rows, strict=True)]


class Applier(StatefulProcessor):
    def __init__(self, wait: int = WAIT, compact: int = COMPACT):
        self.wait, self.compact = wait, compact

    def init(self, handle) -> None:
        self.progress = handle.getValueState("progress", "client_id array<long>, next array<long>, city array<string>, balance array<double>")
        self.runs = handle.getListState("runs", RUN)
        self.cursors = handle.getValueState("cursors", "at array<int>")

    def handleInputRows(self, key, rows, timerValues):
        new, batch, seen, last, began = {}, None, None, False, False
        out = Row(*(f.split()[0] for f in RESULT.split(", ")))
        for r in rows:
            batch = r.batch
            if r.change_id is None:
                began, seen, last = True, r.seen, r.last
            elif r.spare:
                yield out(r.change_id, r.client_id, r.n, "rejected", batch, 0, r.op, None, None)
            else:
                new.setdefault(r.client_id, []).append((r.n, r.day, r.change_id, r.op, r.city, r.balance))
        if key[0] < 0:  # spare changes only
            return

        stored = self.progress.get()
        clients = {c: Client(p) for c, *p in zip(*stored, strict=True)} if stored else {}
        at = self.cursors.get()
        cursors = list(at[0]) if at else []
        holding = {}
        if cursors:
            for element, (client_id, *columns) in enumerate(self.runs.get()):
                if cursors[element] < len(columns[0]):
                    clients[client_id].hold(element, columns, cursors[element])
                    holding[client_id] = clients[client_id]

        if began:
            for client_id, client in holding.items():
                for change_id, n, missed, op, city, cents in client.expired(self.wait, seen, last):
                    yield out(change_id, client_id, n, "applied", batch, missed, op, city, cents)
        appended = []
        for client_id in sorted(new, key=lambda c: (c is None, c)):
            client = clients.setdefault(client_id, Client())
            held = client.numbers()
            run = []
            for row in sorted(new[client_id], key=lambda r: r[:3]):
                if row[0] < client.next or row[0] in held:
                    yield out(row[2], client_id, row[0], "rejected", batch, 0, row[3], None, None)
                else:
                    run.append(row)
                    held.add(row[0])
            if not run:
                continue
            client.hold(None, [list(c) for c in zip(*run, strict=True)])
            for change_id, n, missed, op, city, cents in client.take(client.heap()):
                yield out(change_id, client_id, n, "applied", batch, missed, op, city, cents)
            columns, at = client.runs[-1][1], client.at[-1]
            if at < len(columns[0]):
                appended.append((client_id, *(c[at:] for c in columns)))
                holding[client_id] = client

        if new or holding:
            names = list(clients)
            self.progress.update((names, [clients[c].next for c in names], [clients[c].city for c in names], [clients[c].balance for c in names]))
        if batch % self.compact == 0 and (cursors or appended):
            left = [(c, *client.rest()) for c, client in sorted(holding.items(), key=lambda x: (x[0] is None, x[0])) if client.heap()]
            self.runs.put(left) if left else self.runs.clear()
            self.cursors.update(([0] * len(left),))
        elif cursors or appended:
            for client in holding.values():
                for (element, _), at in zip(client.runs, client.at, strict=True):
                    if element is not None:
                        cursors[element] = at
            if appended:
                self.runs.appendList(appended)
            self.cursors.update((cursors + [0] * len(appended),))

    def close(self) -> None:
        pass


def run_batch(session: SparkSession, root: str, wait: int = WAIT, compact: int = COMPACT) -> None:
    """Starts the query on its checkpoint below `root`, takes in what was added to root/feed, and ends."""
    fed = session.readStream.schema(FED).parquet(f"{root}/feed")
    out = fed.groupBy("shard").transformWithState(Applier(wait, compact), RESULT, "Append", "None")
    query = out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    query.awaitTermination()


def apply_changes(rows: DataFrame, batches: int = BATCHES, wait: int = WAIT, compact: int = COMPACT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """What `cut` gave, fed batch by batch to the query, started anew for each and once more to end; its results: RESULT."""
    spark = rows.sparkSession
    root = scratch_path(spark, "changes")
    rows.write.partitionBy("batch").parquet(f"{root}/batches")
    schema = "client_id long, n long, day long, change_id long, op string, city string, balance double, spare boolean, batch int"
    stored = spark.read.schema(schema).parquet(f"{root}/batches")
    facts = {r["batch"]: (r["n"], r["day"]) for r in stored.groupBy("batch").agg(F.count("*").alias("n"), F.max("day").alias("day")).collect()}  # a row for each batch
    shards = max(1, math.ceil(sum(n for n, _ in facts.values()) / shard_rows))
    session = state_session(spark, shards)
    spread = lambda c: F.pmod(F.xxhash64(c), F.lit(shards))
    shard = F.when(F.col("spare"), -1 - spread("change_id")).otherwise(spread("client_id"))
    seen = None
    for b in range(1, batches + 2):
        start = spark.range(shards).select(F.col("id").alias("shard"), F.lit(b).alias("batch"), F.lit(seen).cast("long").alias("seen"), F.lit(b > batches).alias("last"))
        own = stored.where(F.col("batch") == b).withColumn("shard", shard)
        own.unionByName(start, allowMissingColumns=True).select(*(f.split()[0] for f in FED.split(", "))).write.mode("append").parquet(f"{root}/feed")
        run_batch(session, root, wait, compact)
        if b in facts:
            seen = max(x for x in (seen, facts[b][1]) if x is not None)
    return spark.read.schema(RESULT).parquet(f"{root}/out")


def with_current(results: DataFrame) -> DataFrame:
    """Marks each client's applied change of the largest number, unless it deletes."""
    final = results.where("status = 'applied'").groupBy("client_id").agg(F.max("n").alias("_n")).withColumnRenamed("client_id", "_client")
    joined = results.join(final, F.col("client_id").eqNullSafe(F.col("_client")) & (F.col("n") == F.col("_n")), "left")
    current = (F.col("status") == "applied") & F.col("_n").isNotNull() & ~F.col("op").eqNullSafe("D")
    return joined.withColumn("current", current).drop("_client", "_n")


def op13_sequenced_changes(spark, sf_dir: str) -> DataFrame:
    out = with_current(apply_changes(cut(table(spark, sf_dir, "client_changes"))))
    return out.select("change_id", "client_id", "status", "batch", "missed", "city", "cents", "current")
