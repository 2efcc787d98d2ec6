"""Streams with state: claims that time out, and incidents that age and come back, by timers of event time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

_CLAIMS = "thread_id long, at long, event_id long, worker string, result string"
_STATES = "incident_id long, turn long, status string, last_seen long"
CLAIM_RESULT = "thread_id long, at timestamp, event_id long, worker string, result string"
LIVE_RESULT = "incident_id long, turn long, status string, last_seen timestamp"
def state_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session beside the user's, with its settings for shuffles and times, and a state store that timers and lists need.

    `partitions`: of the state at most. Each start of a query opens a store for each of them. A task closes its store when it
    has committed, so an executor holds as many stores as it runs tasks, however many partitions and starts there are; the
    stores of an executor share their buffers and caches, and don't reserve disk ahead.
    """
    out = spark.newSession()
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out.conf.set("spark.sql.shuffle.partitions", min(most, partitions or most))
    out.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    store = "spark.sql.streaming.stateStore"
    out.conf.set(f"{store}.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    out.conf.set(f"{store}.rocksdb.changelogCheckpointing.enabled", "true")
    out.conf.set(f"{store}.rocksdb.allowFAllocate", "false")
    out.conf.set(f"{store}.maintenanceInterval", "10s")
    out.conf.set(f"{store}.unloadOnCommit", "true")
    out.conf.set(f"{store}.rocksdb.boundedMemoryUsage", "true")
    out.conf.set(f"{store}.rocksdb.maxMemoryUsageMB", "128")
    return out


class ClaimQueue(StatefulProcessor):
    """A thread is free, claimed by a worker since a time, or done. A claim holds against other workers until it is completed or
    released by its worker, or is `stale` old: then it ends at that time, whether a timer tells or a later event finds it."""

    def __init__(self, stale: dt.timedelta):
        self.stale = stale // dt.timedelta(microseconds=1)

    def init(self, handle) -> None:
        self.handle = handle
        self.claim = handle.getValueState("claim", "status string, worker string, since long, due long")

    def handleInputRows(self, key, rows, timerValues):
        out = Row("thread_id", "at", "event_id", "worker", "result")
        status, worker, since, due = self.claim.get() or ("free", None, None, None)
        before = due
        for r in sorted(rows, key=lambda r: (r.micros, r.event_id)):
            at = r.micros
            if status == "claimed" and since + self.stale <= at:
                yield out(key[0], since + self.stale, None, worker, "timeout")
                status, worker, since = "free", None, None
            if r.action == "claim":
                result = "claimed" if status == "free" else "denied"
                if status == "free":
                    status, worker, since = "claimed", r.worker, at
            elif status == "claimed" and worker == r.worker and r.action in ("complete", "release"):
                result = f"{r.action}d"
                status, worker, since = "done" if r.action == "complete" else "free", None, None
            else:
                result = "ignored"
            yield out(key[0], at, r.event_id, r.worker, result)
        due = None if status != "claimed" else (since + self.stale) // 1000 + 1
        if before != due:
            if before is not None:
                self.handle.deleteTimer(before)
            if due is not None:
                self.handle.registerTimer(due)
        self.claim.update((status, worker, since, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        status, worker, since, due = self.claim.get()
        if status == "claimed" and due <= expiredTimerInfo.getExpiryTimeInMs():
            yield Row("thread_id", "at", "event_id", "worker", "result")(key[0], since + self.stale, None, worker, "timeout")
            self.claim.update(("free", None, None, None))

    def close(self) -> None:
        pass


def claim_results(events: DataFrame, stale: dt.timedelta, late: str = "0 seconds") -> DataFrame:
    """What comes of each event (thread_id, at, event_id, worker, action: claim, complete or release) of a stream, and timeouts.

    Events that come later than `late` behind the latest are left out, as in any stream with a watermark.
    """
    grouped = events.withWatermark("at", late).withColumn("micros", F.unix_micros("at")).groupBy("thread_id")
    out = grouped.transformWithState(ClaimQueue(stale), _CLAIMS, "Append", "EventTime")
    return out.withColumn("at", F.timestamp_micros("at"))


class Liveness(StatefulProcessor):
    """Ages incidents by their last thread: over `stale` back possibly resolved, over `resolved` back resolved; a resolved one
    with a thread no more than `stale` back is active again. Other statuses stay. Time is the watermark."""

    def __init__(self, stale: dt.timedelta, resolved: dt.timedelta):
        self.stale, self.resolved = stale // dt.timedelta(milliseconds=1), resolved // dt.timedelta(milliseconds=1)

    def init(self, handle) -> None:
        self.handle = handle
        self.incident = handle.getValueState("incident", "status string, last long, turn long, due long")

    def _told(self, key, status, last, turn):
        return Row("incident_id", "turn", "status", "last_seen")(key[0], turn, status, last)

    def _due(self, status, last):
        wait = {"active": self.stale, "possibly_resolved": self.resolved}.get(status)
        return None if wait is None or last is None else last + wait + 1

    def _set(self, status, last, turn, before, due) -> None:
        if before != due:
            if before is not None:
                self.handle.deleteTimer(before)
            if due is not None:
                self.handle.registerTimer(due)
        self.incident.update((status, last, turn, due))

    def handleInputRows(self, key, rows, timerValues):
        status, last, turn, before = self.incident.get() or ("active", None, 0, None)
        for r in rows:
            status = r.status or status
            if r.millis is not None:
                last = max(x for x in (last, r.millis) if x is not None)
        # Whether a resolved incident is back is decided when the watermark has come to the thread.
        due = last - 1 if status == "resolved" and last is not None else self._due(status, last)
        yield self._told(key, status, last, turn + 1)
        self._set(status, last, turn + 1, before, due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        status, last, turn, due = self.incident.get()
        if due is None or due > expiredTimerInfo.getExpiryTimeInMs():
            return
        now = timerValues.getCurrentWatermarkInMs()
        old = last < now - self.stale
        over = last < now - self.resolved
        new = status
        if status in ("active", "possibly_resolved"):
            new = "resolved" if over else "possibly_resolved" if old else status
        elif status == "resolved" and not old:
            new = "active"
        if new != status:
            turn += 1
            yield self._told(key, new, last, turn)
        self._set(new, last, turn, None, self._due(new, last))

    def close(self) -> None:
        pass


def live_states(rows: DataFrame, stale: dt.timedelta, resolved: dt.timedelta) -> DataFrame:
    """States of incidents, one after the other by `turn`, from a stream of (incident_id, at, seen, status): a thread of an
    incident seen at a time, or, with a status, what an incident is set to."""
    grouped = rows.withWatermark("at", "0 seconds").withColumn("millis", F.unix_millis("seen")).groupBy("incident_id")
    out = grouped.transformWithState(Liveness(stale, resolved), _STATES, "Append", "EventTime")
    return out.withColumn("last_seen", F.timestamp_millis("last_seen"))


def run_parts(parts: list[DataFrame], schema: str, transform, result: str, root: str) -> DataFrame:
    """Feeds parts of a table one after the other to a query that is started anew for each on one checkpoint; its results."""
    spark = parts[0].sparkSession
    session = state_session(spark)
    names = [x.split()[0] for x in schema.split(", ")]
    for part in parts:
        part.select(*names).write.mode("append").parquet(f"{root}/feed")
        made = transform(session.readStream.schema(schema).parquet(f"{root}/feed"))
        made.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(result).parquet(f"{root}/out")


def latest(states: DataFrame, key: str = "incident_id", turn: str = "turn") -> DataFrame:
    """Of each key the last state."""
    rest = [c for c in states.columns if c not in (key, turn)]
    best = states.groupBy(key).agg(F.max_by(F.struct(*rest), turn).alias("_s"))
    return best.select(key, *(F.col(f"_s.{c}").alias(c) for c in rest))
