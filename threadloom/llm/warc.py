"""Operator 7: a deterministic sharded WARC writer, and its reader.

Shards are ranges of page ids, cut where the running sum of payload bytes in id order passes multiples of
`shard_bytes` (or of a SHARDS-th of all bytes, if that is more), so they depend on the data alone, however ids are
spread. A task sorts whole shards by id, writes each record as its own gzip member and rolls to a new file at a
compressed size; headers and digests are made anew. Files are written under temporary names, renamed when complete, and
count only once the manifest, a table written when all tasks are done, lists them: a task that runs again writes the
same bytes to the same names. Of equal payloads of at least `least` bytes, the largest id's is a response and the others
are revisits of it.

Defined cases: a null html is an empty payload; a null url becomes about:blank; a null page_id sorts first and is
always a response; rows that repeat an id are written once each and stand in one shard, each a revisit or response by
its own payload, and both responses if they repeat the payload, too, and theirs is the largest id; an empty table gives
an empty manifest and no file; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lean, materialize, release, remove_path, scratch_path, table

SHARD_BYTES, ROLL_BYTES, LEVEL = 16 << 20, 8 << 20, 4
#: Shards at most: their first ids (1 MB) are sent to all tasks. Larger inputs have larger shards.
SHARDS = 65_536
#: Tasks that read archives back, at most.
READERS = 20_000
DATE = "2024-01-01T00:00:00Z"
_ID = "urn:x-page:"


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, record_id: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC/1.1 record as a gzip member."""
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE), *headers]
    lines += [("WARC-Block-Digest", "sha1:" + sha1_32(block)), ("Content-Length", str(len(block)))]
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def page_record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url) if url else "about:blank"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    own = f"{_ID}{'' if page_id is None else page_id}"
    headers = [("WARC-Target-URI", target), ("WARC-Payload-Digest", "sha1:" + sha1_32(payload)), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is None:
        return record("response", own, headers, http + payload)
    # The payload's length isn't in a revisit's block; readers skip header fields that they don't know.
    headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<{_ID}{refers_to}>"), ("X-Payload-Length", str(len(payload)))]
    return record("revisit", own, headers, http)


_MANIFEST = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


def _write(out_dir: str, roll: int):
    """Over rows sorted by (shard, page_id, kind): the files of whole shards; one manifest row for each."""

    def run(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(out_dir)
        store.create_dir(base, recursive=True)
        stream = None
        name = temp = ""
        shard = turn = count = size = 0
        digest = hashlib.sha256()
        page, revisits = None, {}  # the page whose rows go on, and of its payloads' digests the pages they refer to

        def put(data):
            nonlocal size
            stream.write(data)
            digest.update(data)
            size += len(data)

        def close():
            stream.close()
            store.move(f"{base}/{temp}", f"{base}/{name}")
            return pa.RecordBatch.from_pylist([{"file": name, "records": count, "bytes": size, "sha256": digest.hexdigest()}], schema=_MANIFEST)

        for batch in batches:
            rows = [batch.column(batch.schema.get_field_index(k)) for k in ("shard", "page_id", "kind", "url", "html", "digest", "refers_to")]
            for i in range(batch.num_rows):
                own, page_id, kind = rows[0][i].as_py(), rows[1][i].as_py(), rows[2][i].as_py()
                if own != shard:
                    if stream is not None:
                        yield close()
                        stream = None
                    shard, turn = own, 0
                if page_id != page:
                    page, revisits = page_id, {}
                if kind == 0:  # comes before its page
                    revisits[rows[5][i].as_py()] = rows[6][i].as_py()
                    continue
                if stream is None or size >= roll:
                    if stream is not None:
                        yield close()
                    name = f"part-{shard:05d}-{turn:05d}.warc.gz"
                    temp = f".{name}.{uuid.uuid4().hex}.tmp"
                    turn, count, size, digest = turn + 1, 0, 0, hashlib.sha256()
                    stream = store.open_output_stream(f"{base}/{temp}")
                    put(record("warcinfo", f"urn:x-file:{name}", [("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                payload = (rows[4][i].as_py() or "").encode()
                refers = revisits.get(hashlib.sha1(payload).digest()) if revisits else None
                put(page_record(page_id, rows[3][i].as_py(), payload, refers))
                count += 1
        if stream is not None:
            yield close()

    return run


def shard_starts(sizes: DataFrame, shard_bytes: int) -> np.ndarray:
    """The first page_id of every shard but the first, ascending, of a written table (page_id, bytes).

    Running sums take two levels: ids are range-partitioned, and a partition's rows follow the sums of those before it,
    from a table with a row for each partition. The result doesn't depend on the partitions.
    """
    spark = sizes.sparkSession
    total = sizes.where("page_id is not null").agg(F.sum("bytes")).first()[0] or 0
    step = max(1, shard_bytes, -(-total // SHARDS))
    by_id = sizes.where("page_id is not null").groupBy("page_id").agg(F.sum("bytes").alias("bytes"))
    placed = materialize(by_id.repartitionByRange("page_id").withColumn("part", F.spark_partition_id()), "sizes")
    sums = placed.groupBy("part").agg(F.sum("bytes").alias("own"))
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("own").over(upto(Window.orderBy("part"))), F.lit(0)).alias("earlier"))
    inner = F.coalesce(F.sum("bytes").over(upto(Window.partitionBy("part").orderBy("page_id"))), F.lit(0))
    shard = F.floor((F.col("earlier") + F.col("inner")) / step)
    found = placed.withColumn("inner", inner).join(sums, "part").groupBy(shard.alias("shard")).agg(F.min("page_id").alias("first")).where("shard > 0")
    out = np.sort(np.array([r["first"] for r in found.select("first").collect()], np.int64))
    release(placed)
    return out


def write_archives(pages: DataFrame, out_dir: str, least: int = 0, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes `pages` (page_id, url, html) below out_dir and returns the manifest (file, records, bytes, sha256)."""
    spark = pages.sparkSession
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    sizes = materialize(rows.select("page_id", F.octet_length("html").cast("long").alias("payload"), F.unhex(F.sha1("html")).alias("digest")), "digests")
    starts = spark.sparkContext.broadcast(shard_starts(sizes.select("page_id", (F.col("payload") + 400).alias("bytes")), shard_bytes))

    @F.pandas_udf("int")
    def shard_of(page_id: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts.value, page_id.to_numpy(np.int64), "right").astype(np.int32))

    digests = sizes.where((F.col("payload") >= least) & F.col("page_id").isNotNull())
    tops = digests.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    flags = digests.join(tops, "digest").where("page_id < refers_to").select("page_id", "digest", "refers_to").distinct()
    no_text = F.lit(None).cast("string")
    flags = flags.select("page_id", F.lit(0).alias("kind"), no_text.alias("url"), no_text.alias("html"), "digest", "refers_to")
    every = rows.select("page_id", F.lit(1).alias("kind"), "url", "html", F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("long").alias("refers_to")).union(flags)
    every = every.withColumn("shard", shard_of(F.coalesce("page_id", F.lit(-(1 << 63)))))  # no nulls: they would turn ids into doubles
    ordered = every.repartition(len(starts.value) + 1, "shard").sortWithinPartitions("shard", F.asc_nulls_first("page_id"), "kind", "url", "html", "digest")
    files = ordered.mapInArrow(lean(_write(out_dir, roll_bytes)), "file string, records long, bytes long, sha256 string")
    files.write.mode("overwrite").parquet(f"{out_dir}/_manifest")
    release(sizes)
    return spark.read.schema("file string, records long, bytes long, sha256 string").parquet(f"{out_dir}/_manifest")


def _records(stream):
    """(headers, block) of every record of a gzip-per-record archive, one in memory at a time."""
    left = b""
    while True:
        z, parts = zlib.decompressobj(31), []
        while not z.eof:
            data = left or stream.read(1 << 20)
            left = b""
            if not data:
                if parts:
                    raise ValueError("an archive ends inside a record")
                return
            parts.append(z.decompress(data))
        left = z.unused_data
        raw = b"".join(parts)
        head, _, rest = raw.partition(b"\r\n\r\n")
        headers = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        block = rest[: int(headers["Content-Length"])]
        if headers["WARC-Block-Digest"] != "sha1:" + sha1_32(block) or rest[len(block) :] != b"\r\n\r\n":
            raise ValueError(f"{headers['WARC-Record-ID']} is damaged")
        yield headers, block


_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("html", pa.string())])


def _read(out_dir: str, with_html: bool):
    def run(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(out_dir)
        number = lambda x: int(x) if (x := x.strip("<>").removeprefix(_ID)) else None
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with store.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for h, block in _records(stream):
                        kind = h["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and digest != sha1_32(payload):
                            raise ValueError(f"{h['WARC-Record-ID']}: the payload isn't the one of the digest")
                        size = len(payload) if kind == "response" else int(h["X-Payload-Length"])
                        refers = number(h["WARC-Refers-To"]) if kind == "revisit" else None
                        text = payload.decode() if with_html and kind == "response" else None
                        rows.append((number(h["WARC-Record-ID"]), h["WARC-Target-URI"], size, digest, kind, refers, text))
                        held += len(block) + 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ)

    return run


def read_archives(spark: SparkSession, out_dir: str, with_html: bool = True) -> DataFrame:
    """The records of the archives that the manifest lists, a file a task; html of responses where asked for."""
    files = spark.read.schema("file string").parquet(f"{out_dir}/_manifest").select("file")
    files = files.repartition(max(1, min(READERS, files.count())))
    fields = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"
    return files.mapInArrow(lean(_read(out_dir, with_html)), fields)


def op7_warc(spark, sf_dir: str) -> DataFrame:
    """What the archives of `pages` hold; they are deleted when they have been read back."""
    out_dir = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), out_dir)
    read = read_archives(spark, out_dir, with_html=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    out = materialize(read, "records")
    remove_path(spark, out_dir)
    return out


ORACLE_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS d FROM pages),
q AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, max(page_id) OVER (PARTITION BY h) AS top,
        array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * strpos('0123456789abcdef', substr(d, i, 1)) - 3, 4)), '') AS bits FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT
    + 4 * substr(bits, 5 * i + 3, 1)::INT + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id < top THEN top END AS refers_to
FROM q
"""
