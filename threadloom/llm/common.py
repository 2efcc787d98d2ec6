"""Shared pieces of the corpus operators: inputs, scratch tables, Arrow text views, hashing, grouping, components."""

from __future__ import annotations

import atexit
import math
import re
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OWN_DIR: list[str] = []

#: Bytes of text handled at once by the vectorised kernels; a longer document is handled alone.
SLAB = 1 << 19
#: Edges per task when components are contracted locally.
EDGES_PER_TASK = 500_000
#: Bytes of text whose hashes make one range, where hashes are dealt by ranges.
RANGE_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(col):
    """crc32 of the id as text, modulo 5; fold 0 is held out."""
    return F.crc32(col.cast("string").cast("binary")) % 5


# ---------------------------------------------------------------- scratch tables


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Where that is unset: a local one, in local mode alone."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _OWN_DIR:
            _OWN_DIR.append("file://" + tempfile.mkdtemp(prefix="threadloom-"))
            atexit.register(shutil.rmtree, _OWN_DIR[0][7:], True)
        base = _OWN_DIR[0]
    return base.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Writes df once to the shared folder and returns the written table, which cuts the lineage there."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes scratch tables that nothing reads any more."""
    for t in tables:
        if path := getattr(t, "_scratch", None):
            remove_path(t.sparkSession, path)


def schema_with(df: DataFrame, more: str, without=()) -> T.StructType:
    """The schema of `df` less some names, all nullable, with further fields."""
    fields = [T.StructField(f.name, f.dataType, True) for f in df.schema if f.name not in without]
    return T.StructType(fields + T.StructType.fromDDL(more).fields)


def lean(f):
    """f for mapInArrow; when it is done, the worker, which Spark keeps for other tasks, gives free memory back."""

    def run(batches):
        import ctypes

        try:
            yield from f(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return run


def map_arrow(df: DataFrame, f, schema: T.StructType) -> DataFrame:
    """df.mapInArrow, also for column names with dots and quotes, which mapInArrow takes for paths."""
    safe = {c: c if re.fullmatch(r"\w+", c, re.ASCII) else f"\u2024{k}" for k, c in enumerate(df.columns)}
    plain = T.StructType([T.StructField(safe.get(x.name, x.name), x.dataType, x.nullable) for x in schema])
    return df.toDF(*safe.values()).mapInArrow(lean(f), plain).toDF(*schema.names)


def without(df: DataFrame, names) -> DataFrame:
    """df without the columns of these (lower-case) names, however their letters are cased."""
    every = df.toDF(*(f"c{k}" for k in range(len(df.columns))))
    kept = [k for k, c in enumerate(df.columns) if c.lower() not in names]
    return every.select(*(f"c{k}" for k in kept)).toDF(*(df.columns[k] for k in kept)) if len(kept) < len(df.columns) else df


def plain_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with columns c0, c1, ... and the new name of each: names that no column of an operator clashes with."""
    names = {c: f"c{k}" for k, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names


# ---------------------------------------------------------------- Arrow views of text


def utf8(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """UTF-8 bytes, n + 1 offsets and a validity mask of an Arrow string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    valid = np.asarray(column.is_valid())
    if column.null_count:
        column = column.fill_null("")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_, offsets, valid


def slabs(offsets: np.ndarray, size: int = SLAB):
    """Row ranges [i, j) whose texts hold about `size` bytes."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


WS = np.zeros(256, bool)
WS[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(h: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def distinct(a: np.ndarray) -> np.ndarray:
    """The distinct values, ascending, by sorting: for integers several times faster than np.unique."""
    if not len(a):
        return a
    s = np.sort(a)
    new = np.empty(len(s), bool)
    new[0] = True
    np.not_equal(s[1:], s[:-1], out=new[1:])
    return s[new]


BYTE_KEYS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    if n:
        p[0] = 1
    return np.multiply.accumulate(p)


class WordHasher:
    """64-bit hashes of the words of a slab of texts (words: runs without \\x20 and \\x09-\\x0D; A-Z lower-cased by default)."""

    def __init__(self, fold: np.ndarray = LOWER):
        self.up = self.down = np.zeros(0, np.uint64)
        self.fold = fold

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """Word hashes, and for each document the index of its first word (n + 1 entries)."""
        return self.places(data, offsets)[:2]

    def places(self, data: np.ndarray, offsets: np.ndarray):
        """The same, and where in the slab each word starts."""
        base = int(offsets[0])
        b = self.fold[data[base : int(offsets[-1])]]
        n = len(b)
        if len(self.up) < n + 1:
            self.up, self.down = _powers(_BASE, n + 1), _powers(_INVERSE, n + 1)
        word = ~WS[b]
        first = np.zeros(n + 1, bool)
        first[offsets[:-1] - base] = True
        first = first[:n]
        prev = np.empty(n, bool)
        prev[:1] = False
        prev[1:] = word[:-1]
        starts = np.flatnonzero(word & (~prev | first))
        nxt = np.empty(n, bool)
        nxt[-1:] = False
        nxt[:-1] = word[1:] & ~first[1:]
        ends = np.flatnonzero(word & ~nxt) + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_KEYS[b] * self.up[:n], out=total[1:])
        h = mix64((total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        return h, np.searchsorted(starts, offsets - base), starts


_SHINGLE_BASE = np.uint64(0xA24BAED4963EE407)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Distinct hashes of the k-word shingles of one document, ascending; fewer words make one shingle; none: empty."""
    n = len(words)
    if n == 0:
        return words
    w = min(n, k)
    h = np.full(n - w + 1, np.uint64(w), np.uint64)
    for j in range(w):
        h = h * _SHINGLE_BASE + words[j : n - w + 1 + j]
    return distinct(mix64(h))


# ---------------------------------------------------------------- streams of sorted groups


def grouped(batches, key: str):
    """Record batches that end where the key (a column the rows are sorted by) changes: whole groups, never split."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        k = batch.column(batch.schema.get_field_index(key))
        last = k[len(k) - 1].as_py()
        if k[0].as_py() == last:
            if held and held[-1].column(held[-1].schema.get_field_index(key))[0].as_py() != last:
                yield _joined(held)
                held = []
            held.append(batch)
            continue
        keys = k.to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1
        head = batch.slice(0, cut)
        yield _joined([*held, head])
        held = [batch.slice(cut)]
    if held:
        yield _joined(held)


def _joined(batches):
    return pa.Table.from_batches(batches).combine_chunks()


def column(table_, name: str) -> np.ndarray:
    c = table_.column(name)
    c = c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
    if isinstance(c, pa.ChunkedArray):
        c = c.chunk(0) if c.num_chunks else pa.array([], c.type)
    return c.to_numpy(zero_copy_only=False)


def batch_of(schema: pa.Schema, *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)


# ---------------------------------------------------------------- packed arrays


def pack(*arrays) -> bytes:
    """Arrays by planes of bytes, compressed, behind their lengths."""
    raw = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes() for a in arrays)
    return np.array([len(raw), *map(len, arrays)], "<i8").tobytes() + pa.Codec("zstd").compress(raw, asbytes=True)


def unpack(packed: bytes, *kinds) -> list[np.ndarray]:
    size, *lengths = np.frombuffer(packed, "<i8", len(kinds) + 1).tolist()
    raw, at, out = pa.Codec("zstd").decompress(packed[8 * len(kinds) + 8 :], size, asbytes=True) if size else b"", 0, []
    for kind, n in zip(kinds, lengths, strict=True):
        wide = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * wide, at).reshape(wide, n).T).view(kind).ravel())
        at += n * wide
    return out


# ---------------------------------------------------------------- connected components


def _forest(batches):
    """Union-find over the edges of one task: each node that isn't a root, with its root (the smallest id)."""
    parent: dict[int, int] = {}

    def find(x):
        root = x
        while parent.get(root, root) != root:
            root = parent[root]
        while parent.get(x, x) != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ra, rb = find(a), find(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                parent.setdefault(min(ra, rb), min(ra, rb))
    nodes = [x for x in parent if find(x) != x]
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for i in range(0, len(nodes), 50_000):
        part = nodes[i : i + 50_000]
        yield batch_of(schema, part, [find(x) for x in part])


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b: long) but the roots; component: the smallest reachable id.

    Tasks of bounded size contract their edges to forests; large-star and small-star rounds join the forests of
    several tasks, each round written to the shared folder. Stars keep their centre's rows in partial minima.
    """
    e = edges.where("a is not null and b is not null and a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct()
    now = materialize(e, "edges")
    parts = max(1, math.ceil(now.count() / EDGES_PER_TASK))
    forest = materialize(now.repartition(parts).mapInArrow(lean(_forest), "a long, b long"), "forest")
    release(now)
    now = forest

    def mark(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = None if parts > 1 else mark(now)
    while seen is None or parts > 1 and mark(now) != seen:
        seen = mark(now)
        both = now.union(now.selectExpr("b as a", "a as b"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").selectExpr("b as a", "m as b")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").selectExpr("b as a", "m as b").union(low.selectExpr("a", "m as b"))
        new = materialize(small.where("a <> b").selectExpr("greatest(a, b) as a", "least(a, b) as b").distinct(), "stars")
        release(now)
        now = new
    out = now.selectExpr("a as node", "b as component")
    out._scratch = now._scratch
    return out
