"""Operator 3: removal of repeated passages by content-defined chunks, to the word.

`remove_runs` (the query and the pipeline's stage): a gear hash rolls over the words of a text, and each word where it
is the least of some four neighbours starts a chunk, so cuts depend on the two words there and their neighbours alone
and an insertion shifts no other cut. A chunk ends at the first cut that is `min_words` less 8 words on; chunks overlap.
They are deduplicated by an 80-bit digest: a chunk is a repeat if its digest stood `min_words` words or more before it
in its own text, or in another document with a smaller (doc_id, position). Repeats that stand alike in the same two texts form
a run, which is extended word by word to its ends, by the CONTEXT words on either side of the place that it repeats.
Runs of `min_words` words or more are cut out, with the white space behind them. Every run of `min_words` words that
occurred before holds a whole chunk that did, so none is missed; a run is compared with one earlier place for each of
its chunks, so where copies differ nearby, a part of less than `min_words` may stay. Words are compared as they are
written, white space between them isn't.

Chunks are dealt by ranges of their digests as packed blocks. A task sends a digest on once for every block of its
chunks and reports further occurrences itself, so the most frequent chunk reaches its reducer once for each block. The
number of ranges grows with the text. Places that runs repeat are asked for their contexts once for all runs that share
them (SALTS times at most), over the one shuffle of the texts that also brings the runs to them.

`remove_repeats` works on whole chunks: texts are cut behind white space where the gear hash of the last 32 bytes is
zero in its top bits, so cuts depend on the content near them alone and an insertion shifts no later cut. Chunks are
deduplicated by a 128-bit digest: the first occurrence, by (doc_id, position), stays. A later one goes if the run of
repeated chunks it stands in holds at least `min_words` words. It sees a passage only where whole chunks lie in it.

Defined cases: null and empty texts and rows without doc_id come back unchanged and take no part; in `remove_repeats` a
text without white space is cut every `most` bytes; repeated rows of one id and text count as one document, so both keep
the first occurrence, and in `remove_runs` rows of one id and different texts are different documents, in the order of a
hash of the text; further columns, whatever their names, pass through; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_KEYS, RANGE_BYTES, WS, WordHasher, batch_of, column, grouped, lean, materialize, mix64, pack, plain_names, schema_with, slabs, table, unpack, utf8

LEAST, MOST, BITS, MIN_WORDS = 32, 1024, 3, 20
STATS = ["_chunks_repeated", "_chars_removed", "_spans_removed"]
#: Chunks that a task compares among themselves before it sends them on.
BLOCK = 200_000
#: The same for chunks of words, and the bytes of text whose chunks make one range.
WINDOWS, RANGE = 300_000, RANGE_BYTES // 4
#: Rows whose texts are cut at once.
ROWS = 500


def cut_points(data: np.ndarray, offsets: np.ndarray, least: int, most: int, bits: int):
    """For each document of a slab the ends of its chunks, as byte positions in the document."""
    base = int(offsets[0])
    b = data[base : int(offsets[-1])]
    h = (BYTE_KEYS[b] >> np.uint64(32)).astype(np.uint32)
    for k in (1, 2, 4, 8, 16):  # the gear hash of 32 bytes, by doubling
        longer = h.copy()
        longer[k:] += h[:-k] << np.uint32(k)
        h = longer
    cand = np.flatnonzero(WS[b] & (h >> np.uint32(32 - bits) == 0)) + 1
    edges = np.searchsorted(cand, offsets - base, "right")
    for i in range(len(offsets) - 1):
        start, end = int(offsets[i]) - base, int(offsets[i + 1]) - base
        ends, last = [], start
        for c in [*cand[edges[i] : edges[i + 1]].tolist(), end]:
            while c - last > most:
                cut = last + most
                while cut > last + 1 and b[cut] & 0xC0 == 0x80:
                    cut -= 1
                ends.append(cut - start)
                last = cut
            if c - last >= least and c < end:
                ends.append(c - start)
                last = c
        if end > last:
            ends.append(end - start)
        yield i, ends


def _chunks(batch, least: int, most: int, bits: int, rows=None):
    """(row, bytes, chunk starts, chunk ends, digests as two longs) of the documents of a batch."""
    data, offsets, _ = utf8(batch.column(batch.schema.get_field_index("text")))
    for i, j in slabs(offsets):
        for r, ends in cut_points(data, offsets[i : j + 1], least, most, bits):
            if not ends or rows is not None and i + r not in rows:
                continue
            own = memoryview(data[offsets[i + r] : offsets[i + r + 1]])
            starts = [0, *ends[:-1]]
            digest = np.frombuffer(b"".join([xxhash.xxh3_128_digest(own[s:e]) for s, e in zip(starts, ends, strict=True)]), np.int64).reshape(-1, 2)
            yield i + r, own, starts, ends, digest


_SENT = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("doc", pa.int64()), ("pos", pa.int64()), ("again", pa.bool_())])


def _occurrences(least: int, most: int, bits: int):
    def run(batches):
        held, size = [], 0

        def flush():
            d1, d2, doc, pos = (np.concatenate([h[k] for h in held]) for k in range(4))
            order = np.lexsort((pos, doc, d2, d1))
            d1, d2, doc, pos = d1[order], d2[order], doc[order], pos[order]
            same = np.zeros(len(d1), bool)
            same[1:] = (d1[1:] == d1[:-1]) & (d2[1:] == d2[:-1])
            twin = np.zeros(len(d1), bool)
            twin[1:] = same[1:] & (doc[1:] == doc[:-1]) & (pos[1:] == pos[:-1])
            first = np.maximum.accumulate(np.where(~same, np.arange(len(d1)), 0))
            again = same & ~((doc == doc[first]) & (pos == pos[first]))
            keep = ~twin
            return batch_of(_SENT, d1[keep], d2[keep], doc[keep], pos[keep], again[keep])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = {r for r, x in enumerate(ids) if x is not None}
            for r, _, starts, _, digest in _chunks(batch, least, most, bits, rows):
                n = len(starts)
                held.append((digest[:, 0], digest[:, 1], np.full(n, ids[r], np.int64), np.array(starts, np.int64)))
                size += n
                if size >= BLOCK:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def _repeats():
    """Over occurrences sorted by (key, again, d1, d2, doc, pos): (doc, pos, d1) of all but the first of each digest."""
    schema = pa.schema([("doc", pa.int64()), ("pos", pa.int64()), ("d1", pa.int64())])

    def run(batches):
        for t in grouped(batches, "key"):
            d1, d2, doc, pos, sent = (column(t, k) for k in ("d1", "d2", "doc", "pos", "again"))
            sent = sent.astype(bool)
            same = np.zeros(len(d1), bool)
            same[1:] = (d1[1:] == d1[:-1]) & (d2[1:] == d2[:-1]) & ~sent[1:]
            first = np.maximum.accumulate(np.where(~same, np.arange(len(d1)), 0))
            again = sent | same & ~((doc == doc[first]) & (pos == pos[first]))
            if again.any():
                yield batch_of(schema, doc[again], pos[again], d1[again])

    return run


def _cleaned(least: int, most: int, bits: int, min_words: int):
    def run(batches):
        for batch in batches:
            at = {n: batch.schema.get_field_index(n) for n in ("text", "_repeats")}
            found = batch.column(at["_repeats"]).to_pylist()
            marked = {r: {(x["pos"], x["d1"]) for x in f} for r, f in enumerate(found) if f}
            n = batch.num_rows
            stats = np.zeros((3, n), np.int64)
            spans = [""] * n
            new: dict[int, str] = {}
            for r, own, starts, ends, digest in _chunks(batch, least, most, bits, marked):
                hit = [(s, d) in marked[r] for s, d in zip(starts, digest[:, 0].tolist(), strict=True)]
                stats[0, r] = sum(hit)
                parts, cut, k = [], [], 0
                while k < len(hit):
                    e = k
                    while e < len(hit) and hit[e] == hit[k]:
                        e += 1
                    piece = bytes(own[starts[k] : ends[e - 1]])
                    if hit[k] and len(piece.split()) >= min_words:
                        cut.append(f"{starts[k]}-{ends[e - 1]}")
                        stats[1, r] += len(piece.decode())
                    else:
                        parts.append(piece)
                    k = e
                if cut:
                    new[r] = b"".join(parts).decode()
                    spans[r] = ",".join(cut)
            text = batch.column(at["text"])
            if new:
                text = pa.array([new.get(r, x) for r, x in enumerate(text.to_pylist())], pa.string())
            columns = [text if i == at["text"] else c for i, c in enumerate(batch.columns) if i != at["_repeats"]]
            names = [f.name for f in batch.schema if f.name != "_repeats"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(stats[0]), pa.array(stats[1]), pa.array(spans)], names=[*names, "_chunks_repeated", "_chars_removed", "_spans_removed"])

    return run


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, least: int = LEAST, most: int = MOST, bits: int = BITS) -> DataFrame:
    """`docs` with repeated passages removed from text, and _chunks_repeated, _chars_removed, _spans_removed.

    _spans_removed: the byte spans cut from the UTF-8 text, "from-to" joined by commas.
    """
    texts = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sent = texts.mapInArrow(lean(_occurrences(least, most, bits)), "d1 long, d2 long, doc long, pos long, again boolean")
    # What a task saw before is known to be a repeat; such rows are dealt by their place, not by their digest.
    place = F.when(F.col("again"), F.xxhash64("doc", "pos")).otherwise(F.col("d1"))
    dealt = sent.withColumn("key", place).repartition("key").sortWithinPartitions("key", "again", "d1", "d2", "doc", "pos")
    again = dealt.mapInArrow(lean(_repeats()), "doc long, pos long, d1 long")
    by_doc = again.distinct().groupBy(F.col("doc").alias("_repeats_of")).agg(F.collect_list(F.struct("pos", "d1")).alias("_repeats"))
    rows, names = plain_names(docs)
    rows = rows.withColumnRenamed(names["text"], "text")
    joined = rows.join(by_doc, F.col(names["doc_id"]) == F.col("_repeats_of"), "left").drop("_repeats_of")
    more = "_chunks_repeated long, _chars_removed long, _spans_removed string"
    fields = schema_with(rows, more)
    out = joined.mapInArrow(lean(_cleaned(least, most, bits, min_words)), fields)
    kept = [c for c in docs.columns if c not in STATS]
    return out.withColumnRenamed("text", names["text"]).select(*(names[c] for c in kept), *STATS).toDF(*kept, *STATS)




# ---------------------------------------------------------------- runs of words

_PACKED = pa.schema([("key", pa.int32()), ("again", pa.bool_()), ("packed", pa.binary())])
_PACKED_DDL = "key int, again boolean, packed binary"
_NO_FOLD = np.arange(256, dtype=np.uint8)
#: Words on each side of a place that runs are compared with, and rows that the runs at one place are spread over.
CONTEXT, SALTS = 64, 64


def gear_cuts(words: np.ndarray, first: np.ndarray, near: int) -> np.ndarray:
    """True at each word of a slab that starts a text, or where the gear hash of it and the next word is the least of
    some `near` neighbours of its text (of equal ones, the last)."""
    n = len(words)
    cut = np.zeros(n + 1, bool)
    cut[first] = True
    if n > near:
        gear = ((words[:-1] << np.uint64(32)) + words[1:]) >> np.uint64(32)
        m = n - near  # a window's hashes take in the word behind it
        ranked = np.stack([gear[j : j + m] * np.uint64(near) + np.uint64(near - 1 - j) for j in range(near)])
        place = np.arange(m) + ranked.argmin(0)
        whole = np.arange(m) + near < np.repeat(first[1:], np.diff(first))[:m]
        cut[place[whole]] = True
    return cut[:-1]


def _widths(min_words: int) -> tuple[int, int]:
    """Neighbours of a cut, and the least words of a chunk: any run of `min_words` words holds a chunk of its own cuts."""
    near = max(1, min(4, min_words // 5))
    return near, max(1, min_words - 2 * near)


def _gear_chunks(hasher: WordHasher, data, offsets, min_words: int):
    """(digest, second digest, first word, words) of the chunks of a slab, the index of each text's first chunk and word,
    and the words' hashes and starts."""
    near, least = _widths(min_words)
    words, first, starts = hasher.places(data, offsets)
    at = np.flatnonzero(gear_cuts(words, first, near))
    end = np.repeat(first[1:], np.diff(np.searchsorted(at, first)))
    to = np.append(at, len(words))[np.searchsorted(at, at + least)]
    to = np.minimum(to, end)
    ok = to - at >= least
    at, to = at[ok], to[ok]
    up, down = hasher.up[: len(words)], hasher.down
    out = []
    for w in (words, mix64(words + np.uint64(0x9E3779B97F4A7C15))):
        total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(w * up, out=total[1:])
        out.append(mix64((total[to] - total[at]) * down[at] + (to - at).astype(np.uint64)))
    return out[0], (out[1] >> np.uint64(48)).astype(np.uint16), at, to - at, np.searchsorted(at, first), first, words, starts


def _named(rank: np.ndarray, ids, marks):
    """Packed form of documents given by rank: the ids and text hashes of those that occur, and each one's place there."""
    some, place = np.unique(rank, return_inverse=True)
    return np.diff(ids[some], prepend=np.int64(0)), marks[some], place.astype(np.uint32)


def _ranked(tables):
    """The distinct documents (id, text hash) of some tables in order, and of each table its documents' ranks."""
    ids, marks = (np.concatenate([t[k] for t in tables]) for k in (0, 1))
    order = np.lexsort((marks, ids))
    new = np.ones(len(ids), bool)
    new[1:] = (ids[order][1:] != ids[order][:-1]) | (marks[order][1:] != marks[order][:-1])
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.cumsum(new) - 1
    cuts = np.cumsum([0, *(len(t[0]) for t in tables)])
    return ids[order][new], marks[order][new], [rank[s:e] for s, e in zip(cuts, cuts[1:], strict=False)]


def _origins(h, g, doc, pos, least: int):
    """Order of chunks by (h, g, doc, pos) and, in that order, the row that each one repeats (-1: none) and which are
    met twice: the last one at least `least` words before it in its own text, or else the first one of all, if that is of
    another text."""
    order = np.lexsort((pos, doc, g, h)) if ((s := np.sort(h))[1:] == s[:-1]).any() else np.argsort(h)
    h, g, doc, pos = h[order], g[order], doc[order], pos[order]
    n = np.arange(len(h))
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (g[1:] == g[:-1])
    own = same.copy()
    own[1:] &= doc[1:] == doc[:-1]
    twin = own.copy()
    twin[1:] &= pos[1:] == pos[:-1]
    first, begin = (np.maximum.accumulate(np.where(x, 0, n)) for x in (same, own))
    place = (begin << 32) + pos
    before = np.searchsorted(place, place - least, "right") - 1
    origin = np.where(before >= begin, before, np.where(doc[first] != doc, first, -1))
    return order, np.where(twin, -1, origin), twin


def _replies(ranges: int, ids, marks, doc, pos, size, odoc, opos):
    """Repeats and the places that they repeat as packed rows, dealt by their documents."""
    place = (mix64(ids.view(np.uint64))[doc] % np.uint64(ranges)).astype(np.int32)
    order = np.lexsort((pos, doc, place))
    doc, pos, size, odoc, opos, place = (a[order] for a in (doc, pos, size, odoc, opos, place))
    cuts = [0, *(np.flatnonzero(place[1:] != place[:-1]) + 1).tolist(), len(place)]
    for s, e in zip(cuts, cuts[1:], strict=False):
        if s < e:
            packed = pack(*_named(doc[s:e], ids, marks), pos[s:e], size[s:e], *_named(odoc[s:e], ids, marks), opos[s:e])
            yield batch_of(_PACKED, [place[s]], [True], [packed])


_REPLY = ("i8", "u8", "u4", "i4", "u1", "i8", "u8", "u4", "i4")


def _sent_chunks(ranges: int, min_words: int):
    def run(batches):
        hasher, held, count = WordHasher(_NO_FOLD), [], 0

        def flush():
            ids, marks, ranks = _ranked([(np.array([x[0] for x in held], np.int64), np.array([x[1] for x in held], np.uint64))])
            h, g, pos, size = (np.concatenate([x[c] for x in held]) for c in (2, 3, 4, 5))
            doc = np.repeat(ranks[0], [len(x[2]) for x in held])
            order, origin, twin = _origins(h, g, doc, pos, min_words)
            h, g, doc, pos, size = (a[order] for a in (h, g, doc, pos, size))
            again = np.flatnonzero(origin >= 0)
            yield from _replies(ranges, ids, marks, doc[again], pos[again], size[again], doc[origin[again]], pos[origin[again]])
            left = (origin < 0) & ~twin
            h, g, doc, pos, size = (a[left] for a in (h, g, doc, pos, size))
            key = ((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
            cuts = np.searchsorted(key, np.arange(ranges + 1))
            for r in np.flatnonzero(np.diff(cuts)):
                s, e = cuts[r], cuts[r + 1]
                packed = pack(*_named(doc[s:e], ids, marks), np.diff(h[s:e], prepend=np.uint64(0)), g[s:e], pos[s:e], size[s:e])
                yield batch_of(_PACKED, [r], [False], [packed])

        for batch in batches:
            rows = batch.column(0).to_pylist()
            data, offsets, _ = utf8(batch.column(1))
            for i, j in slabs(offsets):
                h, g, at, size, own, first, _, _ = _gear_chunks(hasher, data, offsets[i : j + 1], min_words)
                for r in range(j - i):
                    s, e = own[r], own[r + 1]
                    if e > s:
                        mark = xxhash.xxh3_64_intdigest(memoryview(data[offsets[i + r] : offsets[i + r + 1]]))
                        held.append((rows[i + r], mark, h[s:e].copy(), g[s:e].copy(), (at[s:e] - first[r]).astype(np.int32), size[s:e].astype(np.uint8)))
                        count += e - s
                if count >= WINDOWS:
                    yield from flush()
                    held, count = [], 0
        if held:
            yield from flush()

    return run


def _chunk_repeats(ranges: int, min_words: int):
    """Over packed chunks sorted by key: packed repeats. Those that a task found itself pass through."""

    def run(batches):
        for t in grouped(batches, "key"):
            parts = [unpack(x, "i8", "u8", "u4", "u8", "u2", "i4", "u1") for x in t.filter(pc.invert(t.column("again"))).column("packed").to_pylist()]
            for row in t.filter(t.column("again")).to_batches():
                yield row.select(_PACKED.names).cast(_PACKED)
            if not parts:
                continue
            ids, marks, ranks = _ranked([(np.cumsum(x[0]), x[1]) for x in parts])
            doc = np.concatenate([k[x[2]] for k, x in zip(ranks, parts, strict=True)])
            h = np.concatenate([np.cumsum(x[3], dtype=np.uint64) for x in parts])
            g, pos, size = (np.concatenate([x[c] for x in parts]) for c in (4, 5, 6))
            del parts
            order = np.argsort(h)
            met = np.zeros(len(h), bool)
            met[1:] = h[order][1:] == h[order][:-1]
            met[:-1] |= met[1:]
            h, g, doc, pos, size = (a[order[met]] for a in (h, g, doc, pos, size))  # only digests met more than once
            if len(h):
                order, origin, _ = _origins(h, g, doc, pos, min_words)
                doc, pos, size = doc[order], pos[order], size[order]
                again = np.flatnonzero(origin >= 0)
                yield from _replies(ranges, ids, marks, doc[again], pos[again], size[again], doc[origin[again]], pos[origin[again]])

    return run


_EDGES_DDL = "doc long, mark long, run int, side int, odoc long, omark long, at int, salt int, low int, high int"
_EDGES = pa.schema([(x.split()[0], {"long": pa.int64(), "int": pa.int32()}[x.split()[1]]) for x in _EDGES_DDL.split(", ")])


def _edges(batches):
    """Over packed repeats sorted by key: the two ends of each run of a document, with the place that each repeats."""
    for t in grouped(batches, "key"):
        parts = [unpack(x, *_REPLY) for x in t.column("packed").to_pylist()]
        ids, marks, ranks = _ranked([(np.cumsum(x[k]), x[k + 1]) for x in parts for k in (0, 5)])
        doc, odoc = (np.concatenate([k[x[c]] for k, x in zip(ranks[o::2], parts, strict=True)]) for o, c in ((0, 2), (1, 7)))
        pos, size, opos = (np.concatenate([x[c] for x in parts]).astype(np.int64) for c in (3, 4, 8))
        order = np.lexsort((pos, pos - opos, odoc, doc))
        doc, odoc, pos, size, opos = (a[order] for a in (doc, odoc, pos, size, opos))
        apart = np.ones(len(doc), bool)
        apart[1:] = (doc[1:] != doc[:-1]) | (odoc[1:] != odoc[:-1]) | ((pos - opos)[1:] != (pos - opos)[:-1]) | (pos[1:] > (pos + size)[:-1])
        a = np.flatnonzero(apart)
        z = np.append(a[1:], len(doc)) - 1
        doc, odoc, low, high = doc[a], odoc[a], pos[a], (pos + size)[z]
        number = (np.arange(len(a)) - np.searchsorted(doc, doc)).astype(np.int32)
        salt = (mix64(marks[doc] ^ number.astype(np.uint64)) % np.uint64(SALTS)).astype(np.int32)
        for side, at in ((0, opos[a]), (1, (opos + size)[z])):
            for s in range(0, len(a), 50_000):
                k = slice(s, s + 50_000)
                d, o = doc[k], odoc[k]
                n = len(d)
                columns = [ids[d], marks[d].view(np.int64), number[k], np.full(n, side), ids[o], marks[o].view(np.int64), at[k], salt[k], low[k], high[k]]
                yield batch_of(_EDGES, *(c.astype(f.type.to_pandas_dtype()) for c, f in zip(columns, _EDGES, strict=True)))


_ANSWERS_DDL = "odoc long, omark long, side int, at int, salt int, context binary"


def _texts_of(hasher, batch, text: str, wanted: str):
    """(row, what is wanted of it, text, hash of the text, word hashes, word starts) of rows that anything is wanted of."""
    listed = batch.column(batch.schema.get_field_index(wanted))
    rows = np.flatnonzero(np.asarray(listed.is_valid()))
    data, offsets, _ = utf8(batch.column(batch.schema.get_field_index(text)).take(pa.array(rows)))
    for i, j in slabs(offsets):
        words, first, starts = hasher.places(data, offsets[i : j + 1])
        for r in range(j - i):
            own = memoryview(data[offsets[i + r] : offsets[i + r + 1]])
            s, e = first[r], first[r + 1]
            mark = np.uint64(xxhash.xxh3_64_intdigest(own)).view(np.int64)
            row = int(rows[i + r])
            yield row, listed[row].as_py(), own, int(mark), words[s:e].astype(np.uint32), starts[s:e] - (offsets[i + r] - offsets[i])


def _answers(text: str, id_: str):
    """Of each place that is asked for, the words before it (side 0, outwards) or from it on."""
    schema = pa.schema([("odoc", pa.int64()), ("omark", pa.int64()), ("side", pa.int32()), ("at", pa.int32()), ("salt", pa.int32()), ("context", pa.binary())])

    def run(batches):
        hasher = WordHasher(_NO_FOLD)
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            ids, out = batch.column(batch.schema.get_field_index(id_)), []
            for row, asked, _, mark, words, _ in _texts_of(hasher, batch, text, "_asked"):
                for x in asked:
                    if x["omark"] == mark:
                        at = x["at"]
                        near = words[max(0, at - CONTEXT) : at][::-1] if x["side"] == 0 else words[at : at + CONTEXT]
                        out.append((ids[row].as_py(), mark, x["side"], at, x["salt"], near.tobytes()))
                if len(out) > 5000:
                    yield batch_of(schema, *zip(*out, strict=True))
                    out = []
            if out:
                yield batch_of(schema, *zip(*out, strict=True))

    return run


def _alike(words: np.ndarray, context: bytes | None) -> int:
    """How many words are the context's from its start."""
    c = np.frombuffer(context or b"", np.uint32)
    n = min(len(words), len(c))
    return int(np.append(words[:n] != c[:n], True).argmax())


def _without_runs(text: str, min_words: int):
    near, _ = _widths(min_words)

    def run(batches):
        hasher = WordHasher(_NO_FOLD)
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            at = {n: batch.schema.get_field_index(n) for n in (text, "_runs")}
            n = batch.num_rows
            stats, spans, new = np.zeros((2, n), np.int64), [""] * n, {}
            for row, listed, own, mark, words, starts in _texts_of(hasher, batch, text, "_runs"):
                ends: dict[int, list] = {}
                for x in listed:
                    if x["mark"] == mark:
                        ends.setdefault(x["run"], [None, None])[x["side"]] = x
                depth = np.zeros(len(words) + 1, np.int64)
                for left, right in ends.values():
                    low, high = left["low"], left["high"]
                    before = _alike(words[:low][::-1], left["context"])
                    after = _alike(words[high:], right["context"])
                    start, stop = low - before, high + after
                    if stop - start >= min_words:
                        depth[start] += 1
                        depth[stop] -= 1
                cut = np.cumsum(depth)[:-1] > 0
                if not cut.any():
                    continue
                edges = np.flatnonzero(np.diff(cut.astype(np.int8), prepend=0, append=0))
                to = np.append(starts, len(own))
                # A run goes with the white space behind it.
                cuts = [(int(to[a]), int(to[b])) for a, b in edges.reshape(-1, 2)]
                parts, last = [], 0
                for a, b in cuts:
                    parts.append(own[last:a])
                    stats[1, row] += len(bytes(own[a:b]).decode())
                    last = b
                new[row] = b"".join([*parts, own[last:]]).decode()
                spans[row] = ",".join(f"{a}-{b}" for a, b in cuts)
                full = hasher.places(np.frombuffer(own, np.uint8), np.array([0, len(own)]))[0]
                stats[0, row] = int((gear_cuts(full, np.array([0, len(full)]), near) & cut).sum())
            column_ = batch.column(at[text])
            if new:
                column_ = pa.array([new.get(r, x) for r, x in enumerate(column_.to_pylist())], pa.string())
            columns = [column_ if i == at[text] else c for i, c in enumerate(batch.columns) if i != at["_runs"]]
            names = [f.name for f in batch.schema if f.name != "_runs"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(stats[0]), pa.array(stats[1]), pa.array(spans)], names=[*names, "_chunks_repeated", "_chars_removed", "_spans_removed"])

    return run


def remove_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with every repeated run of `min_words` words or more removed from text, to the word.

    _chunks_repeated: the cuts of the text that lie in what was removed; _chars_removed; _spans_removed as those of
    `remove_repeats`. These take the place of columns of the same names.
    """
    kept = [c for c in docs.columns if c not in STATS]
    out, names = _without(docs, min_words)
    return out.select(*(names[c] for c in kept), *STATS).toDF(*kept, *STATS)


def drop_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` without repeated runs, all columns as they are; a column n_chars is counted anew."""
    out, names = _without(docs, min_words)
    if "n_chars" in names:
        out = out.withColumn(names["n_chars"], F.length(names["text"]).cast(docs.schema["n_chars"].dataType))
    return out.select(*names.values()).toDF(*docs.columns)


def _without(docs: DataFrame, min_words: int):
    """`docs` with plain names, less the runs, and STATS; and the plain names."""
    texts = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranges = max(8, math.ceil((texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / RANGE))
    sent = texts.mapInArrow(lean(_sent_chunks(ranges, min_words)), _PACKED_DDL)
    again = sent.repartitionById(ranges, F.col("key")).mapInArrow(lean(_chunk_repeats(ranges, min_words)), _PACKED_DDL)
    edges = materialize(again.repartitionById(ranges, F.col("key")).mapInArrow(lean(_edges), _EDGES_DDL), "edges")

    # Both joins take all columns of `docs`, so that they share one shuffle of the texts.
    plain, names = plain_names(docs)
    id_, text = names["doc_id"], names["text"]
    asked = edges.where("side = 1 or at > 0").select("odoc", "omark", "side", "at", "salt").distinct()
    asked = asked.groupBy(F.col("odoc").alias("_doc")).agg(F.collect_list(F.struct("omark", "side", "at", "salt")).alias("_asked"))
    answers = plain.join(asked, F.col(id_) == F.col("_doc"), "left").drop("_doc").mapInArrow(lean(_answers(text, id_)), _ANSWERS_DDL)
    place = ["odoc", "omark", "side", "at", "salt"]
    told = edges.join(answers, place, "left").groupBy(F.col("doc").alias("_doc"))
    runs = told.agg(F.collect_list(F.struct("mark", "run", "side", "low", "high", "context")).alias("_runs"))
    joined = plain.join(runs, F.col(id_) == F.col("_doc"), "left").drop("_doc")
    more = "_chunks_repeated long, _chars_removed long, _spans_removed string"
    return joined.mapInArrow(lean(_without_runs(text, min_words)), schema_with(plain, more)), names


def op3_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document with what is left of its text."""
    out = remove_runs(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", F.col("_chunks_repeated").alias("chunks_repeated"), F.col("_chars_removed").alias("chars_removed"), F.col("_spans_removed").alias("spans_removed"))
