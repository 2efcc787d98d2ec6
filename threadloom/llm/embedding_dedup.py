"""Operator 1: near-duplicate vectors by sorted projection passes.

Equal vectors form a class. In each pass, vectors are ordered by the concatenated bits of random hyperplane hashes,
and each is compared with the next `window` vectors; windows that cross task borders are completed from the borders'
rows. Vectors that in a quarter of the passes are still alike (cosine `DENSE`) to the last one of their window lie too
dense for it: they are cut into blocks, and block pairs are compared whole unless the blocks' centres and radii rule
links out, so a dense range loses no pair. Verified pairs (cosine in double precision) are joined to components. A component's links are
then counted whole: its members are dealt to blocks, and block pairs are multiplied, so that dense groups, whose
links no bounded window shows, lose none and no pair of a group is written out.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing and are
their own component; vectors of different lengths never link; a null vec_id links with nothing and has a null
component; rows that repeat an id and a vector count as one vector each time they occur; rows that repeat an id with
different vectors share a component, and each has the links of all of them; an empty table gives an empty table; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, column, components, grouped, lean, materialize, release, table

PASSES, WINDOW, BITS, THRESHOLD, SEED = 20, 12, 62, 0.95, 20_240
#: Cosine to the last vector of a window from which the window is too small for its range.
DENSE = 0.6
#: Vectors of a block when a component's links are counted.
BLOCK = 8192
STEP = 1024


def _unit(column_, dim: int) -> np.ndarray:
    """Unit vectors, in double precision, of a column of packed floats or doubles."""
    packed = b"".join(column_.to_pylist())
    v = np.frombuffer(packed, "<f4" if len(packed) == 4 * dim * len(column_) else "<f8").reshape(-1, dim).astype(float)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _vectors(kind: str):
    """(vec_id, dim, v): usable vectors, packed little-endian."""
    schema = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("v", pa.binary())])

    def run(batches):
        for batch in batches:
            out = []
            for i, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if i is None or not x.is_valid or not len(x.values) or x.values.null_count:
                    continue
                v = x.values.to_numpy(zero_copy_only=False).astype(kind)
                if np.isfinite(v).all() and v.any():
                    out.append((i, len(v), (v + v.dtype.type(0)).tobytes()))
            if out:
                yield batch_of(schema, *zip(*out, strict=True))

    return run


def _keys(passes: int, bits: int, seed: int):
    """Of each vector and pass the sort key: the bits of random hyperplanes, first bit first."""
    schema = pa.schema([("dim", pa.int32()), ("pass", pa.int32()), ("key", pa.int64()), ("id", pa.int64()), ("v", pa.binary())])
    weights = np.int64(1) << np.arange(bits - 1, -1, -1, dtype=np.int64)

    def run(batches):
        planes: dict = {}
        for batch in batches:
            ids, dims = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for k in range(0, len(rows), STEP):
                    some = rows[k : k + STEP]
                    v = batch.column(2).take(pa.array(some))
                    unit = _unit(v, int(dim))
                    for p in range(passes):
                        if (dim, p) not in planes:
                            planes[dim, p] = np.random.default_rng([seed, p, int(dim)]).standard_normal((int(dim), bits))
                        key = (unit @ planes[dim, p] > 0) @ weights
                        n = len(some)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, dim, np.int32)), pa.array(np.full(n, p, np.int32)), pa.array(key), pa.array(ids[some]), v], schema=schema)

    return run


_SEEN = pa.schema([("dim", pa.int32()), ("pass", pa.int32()), ("part", pa.int32()), ("spot", pa.int64()), ("size", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("v", pa.binary())])


def _forest_of(pairs) -> list[tuple[int, int]]:
    """A spanning forest of the pairs, so that a dense window sends no more edges than it has vectors."""
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            root[max(ra, rb)] = min(ra, rb)
            out.append((a, b))
    return out


def _near(ids, unit, window: int, threshold: float, apart=None):
    """Pairs at most `window` places apart that link; apart: places and groups whose pairs alone count."""
    out = []
    for d in range(1, min(window, len(ids) - 1) + 1):
        hit = (unit[:-d] * unit[d:]).sum(1) >= threshold
        if apart is not None:
            spot, part = apart
            hit &= (spot[d:] - spot[:-d] <= window) & (part[d:] != part[:-d])
        k = np.flatnonzero(hit)
        out += zip(ids[k].tolist(), ids[k + d].tolist(), strict=True)
    return out


def _windows(window: int, threshold: float):
    """Over vectors sorted by (dim, pass, key, id) in each task: linked pairs, and the rows at the task's borders."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        state = None  # (dim, pass), rows so far, held ids, held units, tail of raw rows

        def border(s, spots, ids, raw, size):
            n = len(ids)
            return batch_of(_SEEN, [s[0]] * n, [s[1]] * n, [part] * n, spots, [size] * n, ids, [None] * n, raw)

        def close(s):
            seen, ids, raw = s["n"], s["tail_ids"], s["tail"]
            first = max(seen - len(ids), window)  # the first rows went out already
            k = len(ids) - (seen - first)
            return border(s["of"], list(range(first, seen)), ids[k:], raw[k:], seen) if seen > window else border(s["of"], [-1], [0], [None], seen)

        for batch in batches:
            dims, passes, ids = (batch.column(k).to_numpy() for k in (0, 1, 3))
            cuts = [0, *(np.flatnonzero((dims[1:] != dims[:-1]) | (passes[1:] != passes[:-1])) + 1).tolist(), len(ids)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if s == e:
                    continue
                of = (int(dims[s]), int(passes[s]))
                if state is None or state["of"] != of:
                    if state is not None:
                        yield close(state)
                    state = {"of": of, "n": 0, "tail_ids": [], "tail": [], "units": np.zeros((0, of[0]))}
                raw = batch.column(4).slice(s, e - s)
                own_raw, own_ids = raw.to_pylist(), ids[s:e].tolist()
                unit = _unit(raw, of[0])
                both = np.array(state["tail_ids"] + own_ids)
                units = np.concatenate([state["units"], unit])
                # Pairs among the held rows were compared before; comparing these few again changes nothing.
                pairs = _forest_of(_near(both, units, window, threshold))
                if pairs:
                    n = len(pairs)
                    none = [None] * n
                    yield batch_of(_SEEN, [of[0]] * n, [of[1]] * n, [part] * n, [-2] * n, [0] * n, *zip(*pairs, strict=True), none)
                far = (units[:-window] * units[window:]).sum(1) >= DENSE if len(units) > window else np.zeros(0, bool)
                if far.any():
                    n = int(far.sum())
                    yield batch_of(_SEEN, [of[0]] * n, [of[1]] * n, [part] * n, [-3] * n, [0] * n, both[:-window][far], [None] * n, [None] * n)
                if state["n"] < window:
                    k = min(window - state["n"], e - s)
                    yield border(of, list(range(state["n"], state["n"] + k)), own_ids[:k], own_raw[:k], -1)
                state["n"] += e - s
                state["tail_ids"] = (state["tail_ids"] + own_ids)[-window:]
                state["tail"] = (state["tail"] + own_raw)[-window:]
                state["units"] = units[-window:]
        if state is not None:
            yield close(state)

    return run


def _borders(window: int, threshold: float):
    """Over the border rows sorted by (pass, part, spot): pairs of neighbouring tasks within the window."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for t in grouped(batches, "lane"):
            dim, lane_pass, part, spot, size, ids = (column(t, k) for k in ("dim", "pass", "part", "spot", "size", "a"))
            raw = t.column("v").combine_chunks() if isinstance(t.column("v"), pa.ChunkedArray) else t.column("v")
            whole: dict = {}
            for d, p, q, n in zip(dim, lane_pass, part, size, strict=True):
                whole[d, p, q] = max(whole.get((d, p, q), 0), n)
            start, at = {}, {}
            for d, p, q in sorted(whole):
                start[d, p, q] = at.get((d, p), 0)
                at[d, p] = start[d, p, q] + whole[d, p, q]
            rows = np.flatnonzero(spot >= 0)
            place = np.array([start[dim[r], lane_pass[r], part[r]] for r in rows], np.int64) + spot[rows]
            for d, p in sorted(at):
                own = rows[(dim[rows] == d) & (lane_pass[rows] == p)]
                where = place[(dim[rows] == d) & (lane_pass[rows] == p)]
                order = np.argsort(where, kind="stable")
                own, where = own[order], where[order]
                if len(own) < 2:
                    continue
                unit = _unit(raw.take(pa.array(own)), int(d))
                pairs = _forest_of(_near(ids[own].astype(np.int64), unit, window, threshold, (where, part[own])))
                if pairs:
                    yield batch_of(schema, *zip(*pairs, strict=True))

    return run


def _blocks(size: int):
    """Over vectors sorted by (dim, key): (block, id, dim, v), and for each block a row without id that holds its centre."""
    schema = pa.schema([("block", pa.int64()), ("id", pa.int64()), ("dim", pa.int32()), ("radius", pa.float64()), ("v", pa.binary())])

    def run(batches):
        from pyspark import TaskContext

        number, held, of = TaskContext.get().partitionId() << 32, [], None

        def close(rows, n, dim):
            raw = pa.array([v for _, v in rows], pa.binary())
            unit = _unit(raw, dim)
            centre = unit.sum(0)
            length = np.sqrt((centre * centre).sum())
            centre = centre / length if length > 0 else unit[0]
            radius = float(np.arccos(np.clip((unit @ centre).min(), -1, 1)))
            yield batch_of(schema, [n] * len(rows), [i for i, _ in rows], [dim] * len(rows), [0.0] * len(rows), raw)
            yield batch_of(schema, [n], [None], [dim], [radius], [centre.tobytes()])

        for batch in batches:
            for dim, i, v in zip(*(batch.column(k).to_pylist() for k in (0, 3, 4)), strict=True):
                if held and (dim != of or len(held) == size):
                    yield from close(held, number, of)
                    number, held = number + 1, []
                of = dim
                held.append((i, v))
        if held:
            yield from close(held, number, of)

    return run


def _dense_links(threshold: float):
    """Over the vectors of pairs of blocks, sorted by (work, side): a spanning forest of the links of each pair."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for t in grouped(batches, "work"):
            work, side, ids, dim = (column(t, k) for k in ("work", "side", "id", "dim"))
            raw = t.column("v")
            raw = raw.combine_chunks() if isinstance(raw, pa.ChunkedArray) else raw
            begins = np.flatnonzero(np.concatenate([[True], work[1:] != work[:-1]]))
            for s, e in zip(begins, np.append(begins[1:], len(work)), strict=True):
                unit, own = _unit(raw.slice(s, e - s), int(dim[s])), ids[s:e]
                m = int(np.searchsorted(side[s:e], 1))
                low = 0 if m == e - s else m  # a block with itself
                root, out = np.arange(e - s), []
                for k in range(0, m, STEP):
                    rows = np.arange(k, min(k + STEP, m))
                    hit = (unit[rows] @ unit[low:].T) >= threshold
                    while True:
                        new = hit & (root[rows][:, None] != root[low:][None, :])
                        some = np.flatnonzero(new.any(1))
                        if not len(some):
                            break
                        for r, c in zip(rows[some].tolist(), (low + new[some].argmax(1)).tolist(), strict=True):
                            a, b = root[r], root[c]
                            if a != b:
                                root[root == max(a, b)] = min(a, b)
                                out.append((own[r], own[c]))
                if out:
                    yield batch_of(schema, *zip(*out, strict=True))

    return run


def _links_of_dense(classes: DataFrame, dense: DataFrame, threshold: float, seed: int) -> DataFrame:
    """Links that join the vectors of dense ranges, by whole comparison of the blocks that can hold any."""
    spark = classes.sparkSession
    rows = classes.join(dense, "id").select("id", "dim", "v").mapInArrow(lean(_keys(1, BITS, seed)), "dim int, pass int, key long, id long, v binary")
    rows = rows.repartitionByRange("dim", "key", "id").sortWithinPartitions("dim", "key", "id")
    rows = materialize(rows.mapInArrow(lean(_blocks(BLOCK)), "block long, id long, dim int, radius double, v binary"), "dense")
    centres = rows.where("id is null").orderBy("block").collect()
    pairs = []
    for k, x in enumerate(centres):
        same = [y for y in centres[k:] if y["dim"] == x["dim"]]
        c = np.stack([np.frombuffer(y["v"]) for y in same]) @ np.frombuffer(x["v"])
        apart = np.arccos(np.clip(c, -1, 1)) - x["radius"] - np.array([y["radius"] for y in same])
        pairs += [(x["block"], y["block"]) for y, d in zip(same, apart, strict=True) if y is x or d <= np.arccos(threshold) + 1e-6]
    # Both sides of a pair of blocks come in by their own row of the pair.
    sides = [(n, b, k) for n, p in enumerate(pairs) for k, b in enumerate(p if p[0] != p[1] else p[:1])]
    sides = spark.createDataFrame(sides, "work long, block long, side int")
    work = rows.where("id is not null").join(sides, "block").select("work", "side", "id", "dim", "v")
    work = work.repartition("work").sortWithinPartitions("work", "side", "id")
    out = materialize(work.mapInArrow(lean(_dense_links(threshold)), "a long, b long"), "dense-links")
    release(rows)
    return out


def _counts(threshold: float):
    """Over members sorted by (work, side): of each vector the weight of those of the other side that it links to."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for t in grouped(batches, "work"):
            work, side, ids, dim, weight = (column(t, k) for k in ("work", "side", "id", "dim", "weight"))
            raw = t.column("v")
            raw = raw.combine_chunks() if isinstance(raw, pa.ChunkedArray) else raw
            begins = np.flatnonzero(np.concatenate([[True], work[1:] != work[:-1]]))
            for s, e in zip(begins, np.append(begins[1:], len(work)), strict=True):
                unit = _unit(raw.slice(s, e - s), int(dim[s]))
                own, w, sd = ids[s:e], weight[s:e].astype(float), side[s:e]
                if sd[-1] == 0:  # a block with itself
                    n = np.concatenate([((unit[k : k + STEP] @ unit.T) >= threshold) @ w for k in range(0, e - s, STEP)])
                    n -= w  # itself
                else:
                    m = int(np.searchsorted(sd, 1))
                    n = np.zeros(e - s)
                    for k in range(0, m, STEP):
                        hit = (unit[k : min(k + STEP, m)] @ unit[m:].T) >= threshold
                        n[k : min(k + STEP, m)] = hit @ w[m:]
                        n[m:] += w[k : min(k + STEP, m)] @ hit
                yield batch_of(schema, own, np.rint(n).astype(np.int64))

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, passes: int = PASSES, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """One row per row of `vectors` (vec_id, embedding): vec_id, n_links, component_id, kept."""
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    usable = materialize(rows.mapInArrow(lean(_vectors("<f4" if kind == "float" else "<f8")), "vec_id long, dim int, v binary"), "vectors")
    classes = materialize(usable.groupBy("dim", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight")).select("id", "dim", "v", "weight"), "classes")

    sorted_ = classes.select("id", "dim", "v").mapInArrow(lean(_keys(passes, BITS, seed)), "dim int, pass int, key long, id long, v binary")
    order = ["dim", "pass", "key", "id"]
    sorted_ = sorted_.repartitionByRange(*order).sortWithinPartitions(*order)
    seen = materialize(sorted_.mapInArrow(lean(_windows(window, threshold)), "dim int, pass int, part int, spot long, size long, a long, b long, v binary"), "windows")
    border = seen.where("spot > -2").withColumn("lane", F.col("pass").cast("long"))
    border = border.repartition("lane").sortWithinPartitions("lane", "dim", "part", "spot").mapInArrow(lean(_borders(window, threshold)), "a long, b long")
    links = seen.where("spot = -2").select("a", "b").union(border)
    dense = seen.where("spot = -3").groupBy(F.col("a").alias("id")).agg(F.count("*").alias("n")).where(F.col("n") * 4 >= passes).select("id")
    whole = None
    if dense.limit(1).count():
        whole = _links_of_dense(classes, dense, threshold, seed + 1)
        links = links.union(whole)
    groups = components(links)

    inside = groups.select(F.col("component").alias("id")).distinct().selectExpr("id", "id as component").union(groups.selectExpr("node as id", "component"))
    inside = materialize(inside, "groups")
    release(seen, *([whole] if whole is not None else []))
    blocks = inside.groupBy("component").agg(F.count("*").alias("m")).select("component", F.ceil(F.col("m") / BLOCK).cast("long").alias("blocks"))
    members = classes.join(inside, "id").join(blocks, "component").withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    work = members.withColumn("work", F.xxhash64("component", low, high, "dim")).withColumn("side", (F.col("block") > F.col("other")).cast("int"))
    # Both sides of a pair of blocks come in by their own row of the pair.
    work = work.repartition("work").sortWithinPartitions("work", "side", "id").select("work", "side", "id", "dim", "weight", "v")
    linked = work.mapInArrow(lean(_counts(threshold)), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))

    found = classes.join(linked, "id", "left").join(inside, "id", "left")
    found = found.select("dim", "v", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n"), F.coalesce("component", "id").alias("component"))
    own = usable.join(found, ["dim", "v"]).groupBy("vec_id").agg(F.sum("n").alias("_n"), F.min("component").alias("_c"), F.count("*").alias("_times"))
    out = rows.select("vec_id").join(own, "vec_id", "left")
    component = F.coalesce("_c", "vec_id")
    return out.select("vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))


def op1_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
