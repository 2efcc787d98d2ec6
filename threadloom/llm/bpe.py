"""Operator 6: byte-level BPE encoding and decoding with reuse of content-defined chunks.

Texts are cut at rolling-hash points that lie between a non-space and a white-space byte. No token of a byte-level
pre-tokenizer spans such a point, so a chunk's ids don't depend on its neighbours: each chunk that documents share is
encoded and decoded once in a task (a table of bounded size holds them) and its ids are reused. A chunk that had to
be cut elsewhere (long runs without such a point) is joined again: the span between the nearest safe points around
the join is re-encoded, and the ids kept on both sides must agree with an encoding of those sides alone, or the
repair widens to the next safe points, up to the whole text.

Defined cases: a null text is the empty text, which has no ids; strings of special tokens in a text become their ids,
as in the library; a tokenizer for which such cuts aren't safe (a normaliser, another pre-tokenizer, a prefix space, special
tokens that take in white space) encodes whole texts; a null doc_id is an id like others; repeated rows are encoded alike;
an empty table gives an empty table; other columns pass through `encode`, whose own, named below, take the place of any of
the same name.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import BYTE_KEYS, WS, map_arrow, schema_with, slabs, table, utf8

LEAST, MOST, BITS = 96, 4096, 4
#: Bytes of chunk texts whose ids a task keeps at most.
KEPT = 16 << 20
#: Rows whose ids are sent on at once.
ROWS = 500

#: Fixed value: the pre-tokenization pattern of byte-level BPE.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The letters that stand for the 256 bytes in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Codec:
    """Encodes and decodes spans of UTF-8 text as the tokenizers library does with the given tokenizer file."""

    def __init__(self, definition: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_str(definition)
        spec = json.loads(definition)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces: dict[int, bytes] = {i: t.encode() for t, i in special.items()}
        ranks = {}
        for t, i in vocab.items():
            if i not in self.pieces and not t.strip("".join(letters)):
                self.pieces[i] = bytes(letters[c] for c in t)
                ranks[self.pieces[i]] = i
        self.special = [t.encode() for t in special]
        self.quick = None
        pre = spec["pre_tokenizer"] or {}
        # Ids that follow the order of the merges: a rank table is the same model, and several times faster.
        joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"]]
        ids = [vocab[m] for m in joined]
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex") and spec["normalizer"] is None
        # Chunks are safe where white space starts a piece and nothing is changed or added around it; else texts are whole.
        loose = any(t.get("lstrip") or t.get("rstrip") or t.get("normalized") and spec["normalizer"] or any(c.isspace() for c in t["content"]) for t in spec["added_tokens"])
        byte_level = (spec["decoder"] or {}).get("type") == "ByteLevel" and spec["model"].get("type") == "BPE" and len(letters.keys() - vocab.keys()) == 0
        self.cuttable = plain and byte_level and not loose
        if self.cuttable and ids == sorted(ids) and len(set(joined)) == len(joined) == len(ranks) - 256:
            self.quick = tiktoken.Encoding("byte level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: bytes) -> list[int]:
        s = text.decode()
        # Letters whose classes all Unicode versions share go the quick way; specials and the rest, the library's.
        if self.quick is not None and (s.isascii() or max(s) < "ɐ") and not any(t in text for t in self.special):
            return self.quick.encode_ordinary(s)
        return self.exact.encode(s, add_special_tokens=False).ids

    def decode(self, ids: list[int]) -> bytes:
        if not self.cuttable:
            return self.exact.decode(ids, skip_special_tokens=False).encode()
        return b"".join(map(self.pieces.__getitem__, ids))


def safe_points(b: np.ndarray) -> np.ndarray:
    """True at i if a cut before byte i separates an ASCII non-space from ASCII white space."""
    out = np.zeros(len(b) + 1, bool)
    out[1:-1] = WS[b[1:]] & ~WS[b[:-1]] & (b[:-1] < 128)
    return out


def cuts(data: np.ndarray, offsets: np.ndarray, least: int, most: int, bits: int):
    """(document, ends of its chunks, which of the inner ends are safe) of a slab."""
    base = int(offsets[0])
    b = data[base : int(offsets[-1])]
    h = (BYTE_KEYS[b] >> np.uint64(32)).astype(np.uint32)
    for k in (1, 2, 4, 8, 16):
        longer = h.copy()
        longer[k:] += h[:-k] << np.uint32(k)
        h = longer
    safe = safe_points(b)
    cand = np.flatnonzero(safe[1:] & (h >> np.uint32(32 - bits) == 0)) + 1
    edges = np.searchsorted(cand, offsets - base, "right")
    for i in range(len(offsets) - 1):
        start, end = int(offsets[i]) - base, int(offsets[i + 1]) - base
        ends, good, last = [], [], start
        for c in [*cand[edges[i] : edges[i + 1]].tolist(), end]:
            if c > end:
                break
            while c - last > most:
                cut = last + most
                while cut > last + 1 and b[cut] & 0xC0 == 0x80:
                    cut -= 1
                ends.append(cut - start)
                good.append(bool(safe[cut]))
                last = cut
            if c < end and c - last >= least:
                ends.append(c - start)
                good.append(True)
                last = c
        if end > last:
            ends.append(end - start)
            good.append(True)
        yield i, ends, good


def _repair(codec: Codec, text: bytes, points: list[int], joins: list[int], parts: list) -> list[int]:
    """Ids of `text` from parts (start, end, ids) whose joins at the given positions may be wrong."""
    spots = [0, *points, len(text)]
    spans = []
    for j in joins:
        k = int(np.searchsorted(spots, j, "right"))
        s, e = spots[k - 1], spots[min(k, len(spots) - 1)]
        if spans and spans[-1][1] >= s:
            spans[-1] = (spans[-1][0], max(e, spans[-1][1]))
        else:
            spans.append((s, e))
    out: list[int] = []
    at = 0
    for s, e in [*spans, (len(text), len(text))]:
        for a, b, ids in parts:  # what of the parts lies in [at, s)
            lo, hi = max(a, at), min(b, s)
            if lo >= hi:
                continue
            own = ids
            if (lo, hi) != (a, b):
                own = codec.encode(text[lo:hi])
                agrees = ids[: len(own)] == own if lo == a else ids[len(ids) - len(own) :] == own if hi == b else True
                if not agrees:
                    return codec.encode(text)
            out += own
        if s < e:
            out += codec.encode(text[s:e])
        at = e
    return out


def _encoded(definition, least: int, most: int, bits: int, with_ids: bool):
    def run(batches):
        codec = Codec(definition.value)  # in a third of a second; kept, it would hold 50 MB of every worker
        known: dict[bytes, tuple[list[int], bytes]] = {}
        held = 0
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            data, offsets, _ = utf8(batch.column(batch.schema.get_field_index("text")))
            count, hashes, plain, lists = [], [], [], []
            for i, j in slabs(offsets):
                for r, ends, good in cuts(data, offsets[i : j + 1], least, most, bits):
                    if not codec.cuttable and ends:
                        ends, good = ends[-1:], good[-1:]
                    text = data[offsets[i + r] : offsets[i + r + 1]].tobytes()
                    parts, start, decoded = [], 0, []
                    for e in ends:
                        chunk = text[start:e]
                        key = xxhash.xxh3_128_digest(chunk)
                        hit = known.get(key)
                        if hit is None:
                            ids = codec.encode(chunk)
                            if held > KEPT:
                                known, held = {}, 0
                            hit = known[key] = (ids, codec.decode(ids))
                            held += len(chunk) * 8 + 200
                        parts.append((start, e, hit[0]))
                        decoded.append(hit[1])
                        start = e
                    joins = [e for e, ok in zip(ends[:-1], good[:-1], strict=True) if not ok]
                    if joins:
                        points = np.flatnonzero(safe_points(np.frombuffer(text, np.uint8))).tolist()
                        ids = _repair(codec, text, points, joins, parts)
                        decoded = [codec.decode(ids)]
                    else:
                        ids = [x for p in parts for x in p[2]]
                    count.append(len(ids))
                    packed = np.array(ids, "<u4")
                    hashes.append(hashlib.sha256(packed.tobytes()).hexdigest())
                    plain.append(hashlib.sha256(b"".join(decoded).decode("utf-8", "replace").encode()).hexdigest())
                    if with_ids:
                        lists.append(packed.astype(np.int32))
            extra = [pa.array(count, pa.int64()), pa.array(hashes, pa.string()), pa.array(plain, pa.string())]
            names = ["n_tokens", "ids_sha256", "decoded_sha256"]
            columns = [c for c, f in zip(batch.columns, batch.schema, strict=True) if f.name not in names]
            kept = [f.name for f in batch.schema if f.name not in names]
            if with_ids:
                extra.append(pa.array(lists, pa.list_(pa.int32())))
                names = [*names, "token_ids"]
            yield pa.RecordBatch.from_arrays([*columns, *extra], names=[*kept, *names])

    return run


def encode(docs: DataFrame, tokenizer: str | None = None, with_ids: bool = True, least: int = LEAST, most: int = MOST, bits: int = BITS) -> DataFrame:
    """`docs` with n_tokens, ids_sha256, decoded_sha256 and, if asked for, token_ids; tokenizer: path of its JSON file."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    with open(tokenizer, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["token_ids"] if with_ids else [])]
    own = ["n_tokens long", "ids_sha256 string", "decoded_sha256 string", *(["token_ids array<int>"] if with_ids else [])]
    return map_arrow(docs, _encoded(definition, least, most, bits, with_ids), schema_with(docs, ", ".join(own), names))


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    out = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), with_ids=False)
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
