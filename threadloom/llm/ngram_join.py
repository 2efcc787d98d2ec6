"""Operator 10: exact Jaccard self-join of documents on word n-grams, with set-relation skipping.

Documents of one shingle set form a class and are handled once. Each class puts the prefix of its set in inverted
lists. When pairs are made, a list is sorted by set size and cut into blocks with headers, so that blocks of sets which are
too large, or whose positions all leave too few shingles, are skipped whole; parities of the items over a small bitmap, which bound how much two sets
differ, drop most pairs that would fail before any set is moved. Answers are shared between similar sets: first each
list links its sets to one leader only, then, in a few rounds, to one neighbour of another group. Verified links join
sets to groups, a set takes over its group's answers, and only pairs of different groups, of lists with three sets or
more, are generated and verified in the end. Every pair that passes the prefix, size, position and parity bounds is
thus verified or implied, so components are exact.

Prefixes take rare shingles first. The order is any fixed one; a bounded table of the most frequent shingles (merged
from per-task counts over all documents) moves these to the end, which keeps lists short. It never changes results.

Defined cases: a null or empty text, or one of white space only, has no shingles and links with nothing; fewer words
than n make one shingle; a null doc_id links with nothing and has a null component; repeated rows of an id stay, as
one member each of the class of their own text, so rows of one id and different texts are different documents; an empty table gives an empty table; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHasher, batch_of, column, components, grouped, lean, materialize, plain_names, release, shingle_hashes, slabs, table, utf8

#: Frequent shingles that a task reports, and those kept of all (the table that is sent to the tasks: 1 MB at most).
HEAVY_PER_TASK, HEAVY = 8192, 65_536
NO_ID = -(1 << 63)
BLANK = r"[\x20\x09-\x0D]+"
#: Entries of a list that are compared among themselves in one task.
LIST_BLOCK = 8192
#: Entries of a block that is skipped whole.
SKIP = 64
#: Sets of a block when links are counted.
LINK_BLOCK = 256
#: Rounds of neighbours before what is left of pairs is compared whole.
ROUNDS = 3
#: In these rounds a set is compared in so many of its lists, the first; the pass over all pairs left takes every list.
NEAR_LISTS = 32


def need(a, b, percent: int):
    """Least overlap of sets of a and b shingles with 100 * overlap >= percent * union."""
    return -(-(percent * (a + b)) // (100 + percent))


def _sets(batch, n: int, hasher, text: str):
    """(row, distinct shingles) of a batch."""
    data, offsets, _ = utf8(batch.column(batch.schema.get_field_index(text)))
    for i, j in slabs(offsets):
        words, first = hasher(data, offsets[i : j + 1])
        for r in range(i, j):
            yield r, shingle_hashes(words[first[r - i] : first[r - i + 1]], n)


def _heavy(n: int):
    def run(batches):
        hasher, kept, counts = WordHasher(), np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def merge(parts, times):
            u, inv = np.unique(np.concatenate(parts), return_inverse=True)
            t = np.bincount(inv, np.concatenate(times), len(u)).astype(np.int64)
            if len(u) > 4 * HEAVY_PER_TASK:
                best = np.sort(np.argsort(-t, kind="stable")[: 4 * HEAVY_PER_TASK])
                u, t = u[best], t[best]
            return u, t

        for batch in batches:
            held, size = [], 0
            for _, s in _sets(batch, n, hasher, "text"):
                held.append(s)
                size += len(s)
                if size > 1 << 20:
                    u, t = np.unique(np.concatenate(held), return_counts=True)
                    kept, counts = merge([kept, u[t > 1]], [counts, t[t > 1]])
                    held, size = [], 0
            if held:
                u, t = np.unique(np.concatenate(held), return_counts=True)
                kept, counts = merge([kept, u[t > 1]], [counts, t[t > 1]])
        best = np.argsort(-counts, kind="stable")[:HEAVY_PER_TASK]
        yield batch_of(pa.schema([("h", pa.int64()), ("c", pa.int64())]), kept[best].view(np.int64), counts[best])

    return run


def _digest(s: np.ndarray) -> tuple[int, int]:
    d = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
    return int(d[0]), int(d[1])


def text_mark(text) -> bytes:
    """The same 8 bytes as `_mark` of a text (a binary Arrow scalar)."""
    return xxhash.xxh64_digest(text.as_buffer() if text.is_valid else b"\0", 42)


def _mark(text):
    return F.unhex(F.lpad(F.hex(F.xxhash64(F.coalesce(text.cast("string"), F.lit("\0")))), 16, "0"))


def parity(s: np.ndarray) -> bytes:
    """Parities of the set's items over two to four times as many bits as it has items (a power of two, 64 to 32768)."""
    bits = min(32_768, max(64, 2 << (len(s) - 1).bit_length()))
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded(p: np.ndarray, words: int) -> np.ndarray:
    """Parities over fewer bits: the items of equal low bits meet, halves are added modulo 2."""
    while len(p) > words:
        p = p[: len(p) // 2] ^ p[len(p) // 2 :]
    return p


def may_match(own: np.ndarray, others: list[np.ndarray], own_size: int, sizes: np.ndarray, percent: int) -> np.ndarray:
    """False for sets that differ from `own` in more parities than a match leaves items to differ in. Never wrong."""
    low = min(len(own), min(map(len, others)))
    differ = np.bitwise_count(np.stack([_folded(o, low) for o in others]) ^ _folded(own, low)).sum(1)
    return differ <= own_size + sizes - 2 * need(own_size, sizes, percent)


def _postings(n: int, percent: int, heavy):
    """(x, y, c, doc, par): of each document its class (digest, size, text mark and parities), and once for each set and
    task its prefix."""

    def run(batches):
        table = heavy.value
        hashes, times = table
        hasher, seen = WordHasher(), set()
        schema = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("c", pa.int64()), ("doc", pa.int64()), ("par", pa.binary())])
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary())
            out, held, rows, bits = [], 0, [], []

            def flush():
                x = np.concatenate([o[0] for o in out]).view(np.int64) if out else np.zeros(0, np.int64)
                y = np.concatenate([np.full(len(o[0]), o[1], np.int64) for o in out]) if out else x
                c = np.concatenate([(o[2] << 32) + np.arange(len(o[0]), dtype=np.int64) for o in out]) if out else x
                r = np.array(rows, np.int64).reshape(-1, 4)
                return batch_of(schema, np.concatenate([x, r[:, 0]]), np.concatenate([y, r[:, 1]]), np.concatenate([c, r[:, 2]]), np.concatenate([np.zeros(len(x), np.int64), r[:, 3]]), [None] * len(x) + bits)

            for r, s in _sets(batch, n, hasher, "text"):
                size = len(s)
                high, low = _digest(s)
                rows.append((high, low, (size << 32) + 0xFFFFFFFF, NO_ID if ids[r] is None else ids[r]))
                bits.append(text_mark(texts[r]) + (parity(s) if size else b""))
                if size and ids[r] is not None and (high, low) not in seen:
                    seen.add((high, low))
                    keep = size - (percent * size + 99) // 100 + 1
                    if len(hashes):
                        at = np.minimum(np.searchsorted(hashes, s), len(hashes) - 1)
                        hot = hashes[at] == s
                        light = s[~hot]
                        if len(light) < keep and hot.any():
                            hs = s[hot]
                            s = np.concatenate([light, hs[np.lexsort((hs, times[at[hot]]))]])
                        else:
                            s = light
                    out.append((s[:keep], low, size))
                    held += keep
                if held > 200_000 or len(rows) > 50_000:
                    yield flush()
                    out, rows, bits, held = [], [], [], 0
            yield flush()

    return run


_FOUND = pa.schema([("kind", pa.int8()), ("x", pa.int64()), ("y", pa.int64()), ("c", pa.int64()), ("doc", pa.int64()), ("par", pa.binary())])


def _stars(percent: int):
    """Over lists sorted by (x, y): kind 0 sets with their list's leader, 1 classes of documents, 2 entries of longer lists.

    Lists are streamed: of the one that a batch ends in, only its leader, its length and two entries are held.
    """

    def run(batches):
        now = last_y = None  # the list that goes on, and its last set
        count, leader, held = 0, None, None
        for t in batches:
            x, y, c, doc = (column(t, k) for k in ("x", "y", "c", "doc"))
            whole = (c & 0xFFFFFFFF) == 0xFFFFFFFF
            if whole.any():
                k = int(whole.sum())
                yield batch_of(_FOUND, np.ones(k, np.int8), x[whole], y[whole], c[whole] >> 32, doc[whole], column(t, "par")[whole])
                x, y, c = x[~whole], y[~whole], c[~whole]
            if not len(x):
                continue
            # Copies of a set reach a list once for each task that read one.
            new = np.ones(len(x), bool)
            new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            new[0] = (x[0], y[0]) != (now, last_y)
            x, y, c = x[new], y[new], c[new]
            if not len(x):
                continue
            begins = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
            lengths = np.diff(np.append(begins, len(x)))
            goes_on = x[0] == now
            # A list's leader is the set of the smallest digest: in the lists of similar sets, mostly the same one.
            heads = np.stack([y[begins], c[begins]], 1)
            totals = lengths.copy()
            if goes_on:
                heads[0] = leader
                totals[0] += count
            ly, lc = np.repeat(heads[:, 0], lengths), np.repeat(heads[:, 1], lengths)
            a, b = c >> 32, lc >> 32
            room = np.minimum(a - (c & 0xFFFFFFFF), b - (lc & 0xFFFFFFFF))
            ok = (y != ly) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b)) & (room >= need(a, b, percent))
            if ok.any():
                pairs = np.unique(np.stack([y[ok], ly[ok]], 1), axis=0)
                z = np.zeros(len(pairs), np.int64)
                yield batch_of(_FOUND, z.astype(np.int8), pairs[:, 0], pairs[:, 1], z, z, [None] * len(z))
            long = np.repeat(totals > 2, lengths)
            ex, ey, ec = x[long], y[long], c[long]
            if goes_on and totals[0] > 2 and held is not None:
                ex, ey, ec = np.append(ex, held[0]), np.append(ey, held[1]), np.append(ec, held[2])
            if len(ex):
                k = len(ex)
                yield batch_of(_FOUND, np.full(k, 2, np.int8), ex, ey, ec, np.zeros(k, np.int64), [None] * k)
            tail = begins[-1]
            only = goes_on and len(begins) == 1
            kept = (x[tail:], y[tail:], c[tail:])
            if totals[-1] > 2:
                held = None
            elif only and held is not None:
                held = tuple(np.append(h, k) for h, k in zip(held, kept, strict=True))
            else:
                held = kept
            now, last_y, count, leader = x[-1], y[-1], int(totals[-1]), heads[-1].copy()

    return run


def _neighbours(percent: int):
    """Over lists sorted by x and a common random order of sets: pairs of neighbours of different groups that may match."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        last = None
        for batch in batches:
            rows = list(zip(*(batch.column(batch.schema.get_field_index(k)).to_pylist() for k in ("x", "grp", "rep", "size", "par")), strict=True))
            out = set()
            for row in rows:
                if last is not None and last[0] == row[0] and last[1] != row[1]:
                    small, large = sorted((last[3], row[3]))
                    pair = (min(last[2], row[2]), max(last[2], row[2]))
                    if 100 * small >= percent * large and pair not in out:
                        own, other = np.frombuffer(last[4], np.uint64), np.frombuffer(row[4], np.uint64)
                        if may_match(own, [other], last[3], np.array([row[3]]), percent)[0]:
                            out.add(pair)
                last = row
            if out:
                yield batch_of(schema, *zip(*sorted(out), strict=True))

    return run


def _crossings(percent: int):
    """Over blocks of lists sorted by (work, x, size): pairs of different groups that the size, position and parity
    bounds leave; in a block pair, those of different blocks."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for t in grouped(batches, "work"):
            x, side, rep, size, pos, group = (column(t, k) for k in ("x", "side", "rep", "size", "pos", "grp"))
            begins = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
            raw = column(t, "par")
            for s, e in zip(begins, np.append(begins[1:], len(x)), strict=True):
                apart = side[s:e].min() != side[s:e].max()
                own = {k: np.frombuffer(raw[k], np.uint64) for k in range(s, e)}
                # Headers of the list's blocks: the least size, and the most shingles that a set has from its position on.
                edges = np.arange(s, e, SKIP)
                least, room = size[edges], np.maximum.reduceat((size - pos)[s:e], edges - s)
                for i in range(s, e - 1):
                    # The list ascends by size: later blocks hold sets that are too large, and of the others those are
                    # skipped whole whose positions leave every set too few shingles.
                    own_room = size[i] - pos[i]
                    upto = int(np.searchsorted(least, size[i] * 100 // percent, "right"))
                    first = (i + 1 - s) // SKIP
                    need_of = need(size[i], np.maximum(least[first:upto], size[i]), percent)
                    read = first + np.flatnonzero(np.minimum(own_room, room[first:upto]) >= need_of)
                    k = (edges[read][:, None] + np.arange(SKIP)).ravel()
                    k = k[(k > i) & (k < e)]
                    k = k[(group[k] != group[i]) & (rep[k] != rep[i]) & (100 * size[i] >= percent * size[k]) & (np.minimum(own_room, size[k] - pos[k]) >= need(size[i], size[k], percent))]
                    if apart:
                        k = k[side[k] != side[i]]
                    if len(k):
                        k = k[may_match(own[i], [own[o] for o in k.tolist()], size[i], size[k], percent)]
                    if len(k):
                        yield batch_of(schema, np.minimum(rep[i], rep[k]), np.maximum(rep[i], rep[k]))

    return run


def _likely(percent: int):
    """Over pairs of classes (a, b, their sizes and parities): those that may match."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for batch in batches:
            a, b, na, nb, pa_, pb = (c.to_pylist() for c in batch.columns)
            nb = np.array(nb, np.int64)
            keep = [k for k in range(len(a)) if may_match(np.frombuffer(pa_[k], np.uint64), [np.frombuffer(pb[k], np.uint64)], na[k], nb[k : k + 1], percent)[0]]
            yield batch_of(schema, [a[k] for k in keep], [b[k] for k in keep])

    return run


def _contents(n: int):
    """(id, items) of rows whose text is still the one of the class."""
    schema = pa.schema([("id", pa.int64()), ("items", pa.binary())])

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            ids, high, low = (batch.column(batch.schema.get_field_index(k)).to_pylist() for k in ("id", "high", "low"))
            out = []
            for r, s in _sets(batch, n, hasher, "text"):
                if _digest(s) == (high[r], low[r]):
                    out.append((ids[r], s.tobytes()))
                if len(out) >= 500:
                    yield batch_of(schema, *zip(*out, strict=True))
                    out = []
            if out:
                yield batch_of(schema, *zip(*out, strict=True))

    return run


def _verify(percent: int):
    """Over rows sorted by (a, b), the set of a itself first (b null): the pairs that link."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        now, own = None, None
        for batch in batches:
            hits = []
            for a, b, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                s = np.frombuffer(items.as_buffer(), np.uint64)
                if b is None:
                    now, own = a, s.copy()
                elif now == a:
                    at = np.searchsorted(own, s)
                    common = int((own[np.minimum(at, len(own) - 1)] == s).sum())
                    if 100 * common >= percent * (len(own) + len(s) - common):
                        hits.append((a, b))
            if hits:
                yield batch_of(schema, *zip(*hits, strict=True))

    return run


def ngram_classes(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id (smallest id with the same set), component_id."""
    return _classes(docs, n, percent).drop("mark", "high", "low")


def _classes(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The same, with a mark of the text and the digest of the set."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(lean(_heavy(n)), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    top = counted.orderBy(F.desc("c"), "h").limit(HEAVY).collect()
    hashes = np.array([r["h"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    heavy = spark.sparkContext.broadcast((hashes[order], np.array([r["c"] for r in top], np.int64)[order]))

    lists = texts.mapInArrow(lean(_postings(n, percent, heavy)), "x long, y long, c long, doc long, par binary")
    dealt = lists.repartition("x").sortWithinPartitions("x", "y", "c")
    found = materialize(dealt.mapInArrow(lean(_stars(percent)), "kind byte, x long, y long, c long, doc long, par binary"), "lists")

    members = found.where("kind = 1").selectExpr("doc", "x as high", "y as low", "c as size", "substring(par, 1, 8) as mark", "substring(par, 9) as par")
    classes = materialize(members.where(f"size > 0 and doc <> {NO_ID}").groupBy("high", "low").agg(F.min("doc").alias("first_doc"), F.min("size").alias("size"), F.first("par").alias("par")).withColumn("rep", F.col("low")), "classes")

    by_low = classes.select("low", "rep", "size", "par")
    near = found.where("kind = 0").select("x", "y").distinct()
    near = near.join(by_low.toDF("x", "a", "na", "pa"), "x").join(by_low.toDF("y", "b", "nb", "pb"), "y").where("a <> b")
    near = near.select("a", "b", "na", "nb", "pa", "pb").mapInArrow(lean(_likely(percent)), "a long, b long")
    near = near.distinct()

    def contents(ids: DataFrame) -> DataFrame:
        """(id, items) of the classes named in a column `id`."""
        wanted = ids.distinct().join(classes.select(F.col("rep").alias("id"), "high", "low", F.col("first_doc").alias("doc_id")), "id")
        # The build side has at most a row of 40 bytes for each text that stands in the same partition.
        sets = texts.join(wanted.hint("shuffle_hash"), "doc_id")
        return materialize(sets.mapInArrow(lean(_contents(n)), "id long, items binary"), "sets")

    def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        sides = pairs.join(sets.withColumnRenamed("id", "b"), "b").select("a", "b", "items")
        own = sets.withColumnRenamed("id", "a").join(pairs.select("a").distinct(), "a").selectExpr("a", "cast(null as long) as b", "items")
        rows = sides.union(own).repartition("a").sortWithinPartitions("a", F.asc_nulls_first("b"))
        return materialize(rows.mapInArrow(lean(_verify(percent)), "a long, b long").distinct(), "links")

    def grouped_by(rows: DataFrame) -> DataFrame:
        """Entries with their present group, of lists that hold several."""
        own = rows.join(groups.withColumnRenamed("node", "rep"), "rep", "left").withColumn("grp", F.coalesce("component", "rep")).drop("component")
        mixed = own.groupBy("x").agg(F.min("grp").alias("g0"), F.max("grp").alias("g1"), F.count("*").alias("in_list")).where("g0 <> g1")
        return own.join(mixed.select("x", "in_list"), "x")

    near = materialize(near, "pairs")
    sets = contents(near.selectExpr("a as id").union(near.selectExpr("b as id")))
    links = verified(near, sets)
    release(near, sets)
    groups = components(links)

    entries = found.where("kind = 2").select("x", F.col("y").alias("low"), (F.col("c").bitwiseAND(0xFFFFFFFF)).alias("pos")).join(by_low.select("low", "rep", "size"), "low").drop("low")
    entries = materialize(grouped_by(entries).select("x", "rep", "size", "pos"), "entries")
    parities = by_low.select("rep", "par")
    if not entries.isEmpty():
        sets = contents(entries.select(F.col("rep").alias("id")))
        # A few rounds of neighbours let the sets of a dense family take over each other's group, so that few pairs are left.
        for k in range(ROUNDS):
            dealt = grouped_by(entries).where(F.col("pos") < NEAR_LISTS).join(parities, "rep").withColumn("turn", F.xxhash64("rep", F.lit(k))).repartition("x").sortWithinPartitions("x", "turn", "rep")
            pairs = materialize(dealt.mapInArrow(lean(_neighbours(percent)), "a long, b long").distinct(), "pairs")
            links = links.union(verified(pairs, sets))
            release(pairs)
            groups = components(links)
        # Whatever pairs of groups are left: all of them. Long lists are dealt as pairs of blocks.
        left = grouped_by(entries).withColumn("blocks", F.ceil(F.col("in_list") / LIST_BLOCK).cast("long")).withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
        left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        work = F.xxhash64("x", F.least("block", "other"), F.greatest("block", "other"))
        left = left.select(work.alias("work"), "x", (F.col("block") > F.col("other")).cast("int").alias("side"), "rep", "size", "pos", "grp").join(parities, "rep")
        crossed = left.repartition("work").sortWithinPartitions("work", "x", "size", "rep").mapInArrow(lean(_crossings(percent)), "a long, b long").distinct()
        crossed = materialize(crossed, "crossed")
        if not crossed.isEmpty():
            links = links.union(verified(crossed, sets))
            groups = components(links)
        release(sets, entries, crossed)

    reps = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select("high", "low", "first_doc", F.coalesce("component", "rep").alias("group"))
    least = reps.groupBy("group").agg(F.min("first_doc").alias("component"))
    named = members.join(reps.join(least, "group").drop("group"), ["high", "low"], "left")
    doc = F.when(F.col("doc") != NO_ID, F.col("doc"))
    alone = (F.col("size") == 0) | F.col("doc").eqNullSafe(NO_ID)
    return named.select(doc.alias("doc_id"), F.col("size").alias("n_shingles"), F.when(alone, doc).otherwise(F.col("first_doc")).alias("class_id"), F.when(alone, doc).otherwise(F.col("component")).alias("component_id"), "mark", "high", "low")


def _link_counts(percent: int):
    """Over sets of a component sorted by (work, side): of each the weight of the sets of the other side that it links to."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def common(sets, m):
        """Sizes of the intersections of the first m sets with the others (or of all with all), by matrix products."""
        items = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        number = np.unique(items, return_inverse=True)[1]
        order = np.argsort(number, kind="stable")
        number, owner = number[order], owner[order]
        low = 0 if m == len(sets) else m
        out = np.zeros((m, len(sets) - low), np.float32)
        for k in range(0, int(number[-1]) + 1, 4096):
            s, e = np.searchsorted(number, [k, k + 4096])
            has = np.zeros((len(sets), 4096), np.float32)
            has[owner[s:e], number[s:e] - k] = 1
            out += has[:m] @ has[low:].T
        return out.astype(np.int64)

    def run(batches):
        for t in grouped(batches, "work"):
            work, side, key, weight = (column(t, k) for k in ("work", "side", "key", "weight"))
            raw = t.column("items").to_pylist()
            begins = np.flatnonzero(np.concatenate([[True], work[1:] != work[:-1]]))
            for s, e in zip(begins, np.append(begins[1:], len(work)), strict=True):
                sets, w = [np.frombuffer(x, np.uint64) for x in raw[s:e]], weight[s:e]
                m = int(np.searchsorted(side[s:e], 1))
                size = np.array([len(x) for x in sets])
                low = 0 if m == e - s else m
                both = common(sets, m)
                hit = 100 * both >= percent * (size[:m, None] + size[None, low:] - both)
                if low:
                    n = np.concatenate([hit @ w[m:], w[:m] @ hit])
                else:
                    np.fill_diagonal(hit, False)
                    n = hit @ w
                yield batch_of(schema, key[s:e], n)

    return run


def _keyed_sets(n: int):
    """(key, items) of texts."""
    schema = pa.schema([("key", pa.int64()), ("items", pa.binary())])

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("key")).to_pylist()
            for k in range(0, batch.num_rows, 500):
                some = batch.slice(k, 500)
                yield batch_of(schema, *zip(*((keys[k + r], s.tobytes()) for r, s in _sets(some, n, hasher, "text")), strict=True))

    return run


def ngram_links(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """`ngram_classes` with n_links, the number of other documents that each one links to directly.

    Copies of a set link to each other. Links of different sets are counted inside components: their members are dealt
    to blocks, and pairs of blocks are intersected by matrix products, so no pair is written out and none is left out.
    """
    found = materialize(_classes(docs, n, percent).withColumn("key", F.xxhash64("high", "low")), "members")
    own = found.where("n_shingles > 0 and doc_id is not null").groupBy("component_id", "key").agg(F.count("*").alias("weight"), F.min(F.struct("doc_id", "mark")).alias("one"))
    several = own.groupBy("component_id").agg(F.count("*").alias("m")).where("m > 1").select("component_id", F.ceil(F.col("m") / LINK_BLOCK).cast("long").alias("blocks"))
    wanted = materialize(own.join(several, "component_id").select("component_id", "blocks", "key", "weight", "one.doc_id", "one.mark"), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    picked = texts.withColumn("mark", _mark(F.col("text"))).join(wanted.select("doc_id", "mark", "key").distinct(), ["doc_id", "mark"]).select("key", "text")
    sets = materialize(picked.mapInArrow(lean(_keyed_sets(n)), "key long, items binary").dropDuplicates(["key"]), "sets")
    rows = wanted.select("component_id", "blocks", "key", "weight").join(sets, "key").withColumn("block", F.pmod(F.xxhash64("key", F.lit(1)), "blocks"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    work = F.xxhash64("component_id", F.least("block", "other"), F.greatest("block", "other"))
    # Both sides of a pair of blocks come in by their own row of the pair.
    dealt = rows.select(work.alias("work"), (F.col("block") > F.col("other")).cast("int").alias("side"), "key", "weight", "items").repartition("work").sortWithinPartitions("work", "side", "key")
    linked = dealt.mapInArrow(lean(_link_counts(percent)), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    copies = own.groupBy("key").agg(F.sum("weight").alias("weight"))
    out = found.join(copies, "key", "left").join(linked, "key", "left")
    none = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    n_links = F.when(none, F.lit(0)).otherwise(F.col("weight") - 1 + F.coalesce("n", F.lit(0))).cast("long")
    return out.select("doc_id", "n_shingles", "class_id", "component_id", n_links.alias("n_links"))


def drop_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Keeps one row of each component: the smallest id, of its rows the text of the smallest mark, and of equal texts any.

    Rows without an id stay, and so do texts without words.
    """
    found = materialize(_classes(docs, n, percent).where("doc_id is not null"), "members")
    rank = F.struct("doc_id", "mark")
    first = found.where("n_shingles > 0").groupBy("component_id").agg(F.min(rank).alias("k")).select("k.*")
    keep = first.union(found.where("n_shingles = 0").select("doc_id", "mark")).groupBy(F.col("doc_id").alias("_kept"), F.col("mark").alias("_mark")).agg(F.lit(1).alias("_"))
    rows, names = plain_names(docs)
    id_, text = F.col(names["doc_id"]), F.col(names["text"])
    own = _mark(text)
    kept = rows.join(keep, (id_ == F.col("_kept")) & (own == F.col("_mark")), "left_semi")
    if found.groupBy("doc_id", "mark").count().where("count > 1").limit(1).count():
        plain = [F.col(f.name) for f in rows.schema if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
        turn = F.row_number().over(Window.partitionBy(id_, own).orderBy(F.xxhash64(*plain)))
        kept = kept.withColumn("_turn", F.when(F.length(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANK, "")) > 0, turn).otherwise(F.lit(1))).where("_turn = 1").drop("_turn")
    return kept.union(rows.where(id_.isNull())).toDF(*docs.columns)


def op10_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return ngram_classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id")
