"""Operator 12: token counts at every prefix, by dynamic programming over the last token.

Greedy merging has this property: a sequence of pieces is the encoding of its text exactly if each two neighbours are the
encoding of theirs. So every prefix has one last piece, the one that fits behind the last piece of what is left without it,
and count(prefix) = count(prefix without its last piece) + 1. One pass over a text gives the counts of all its prefixes;
whether two pieces fit is asked of the library once for each pair. No piece reaches over a place whose two characters stand
side by side in no piece; a text is cut at such places (before every first space of a run and around line ends, for two), and
what lies between is counted once for all texts of a task that hold it, within a bound. The counts are stored with the document, so truncation
and budget questions (`truncate`, `count_at`) read them and never encode again.

Defined cases: a null text is the empty text, which has no tokens; strings of special tokens are ordinary text, as in the
library; a prefix is counted in code points and as a text of its own; a null doc_id is an id like others; repeated rows are
counted alike; an empty table gives an empty table; other columns pass through, but those with the names of the operator's
own, which are compared without case.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, pack, schema_with, table, unpack, without

SPACE = "▁"
#: Spans whose prefix counts a task keeps, bits of its table of pairs, and the length of a span that is cut further.
KEPT, PAIR_BITS, LONG = 400_000, 20, 48
#: Rows that are handled at once, and spans that are counted side by side.
ROWS, TOGETHER = 500, 20_000
#: The number of a character without a piece; the base of the hash of spans, its inverse, and the factor that spreads it.
NONE, BASE, SPREAD = 0xFFFFFFFE, 0x5851F42D4C957F2D, 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


class Pairs:
    """Whether two pieces fit, by their numbers: a table with open addresses, filled as pairs are met."""

    def __init__(self, ask, bits: int = PAIR_BITS):
        self.ask, self.shift, self.mask = ask, np.uint64(64 - bits), (1 << bits) - 1
        self.clear()

    def clear(self) -> None:
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.fits = np.zeros(self.mask + 1, bool)
        self.held = 0

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.held > self.mask >> 1:
            self.clear()
        key = (a.astype(np.int64) << 32) | b
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)
        seen = self.keys[slot]
        open_ = np.flatnonzero((seen != key) & (seen != -1))
        while len(open_):  # the next places, where others stand
            slot[open_] = (slot[open_] + 1) & self.mask
            seen = self.keys[slot[open_]]
            open_ = open_[(seen != key[open_]) & (seen != -1)]
        for k in np.flatnonzero(self.keys[slot] == -1).tolist():  # not met yet
            pair, at = int(key[k]), int(slot[k])
            while self.keys[at] not in (-1, pair):
                at = (at + 1) & self.mask
            if self.keys[at] == -1:
                self.keys[at], self.fits[at] = pair, self.ask(pair >> 32, pair & 0xFFFFFFFF)
                self.held += 1
            slot[k] = at
        return self.fits[slot]


class PrefixCounter:
    """Prefix counts of texts under a sentencepiece BPE model without normalisation."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        plain = [i for i in range(self.sp.vocab_size()) if not (self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i) or self.sp.is_unused(i))]
        names = [self.sp.id_to_piece(i) for i in plain]
        letters = {c for p in names for c in p}
        self.mark = next(c for c in "\n\x01\x02\x03\x04" if c not in letters)  # merges with nothing
        self.lead = len(self.sp.encode(self.mark))
        self.beside = {a + b for p in names for a, b in zip(p, p[1:], strict=False)}
        # Pieces that merges can't reach are never in an encoding.
        self.pieces = [p for p, i in zip(names, plain, strict=True) if self.sp.encode(self.mark + p)[self.lead :] == [i]]
        self.longest = max(map(len, self.pieces))
        self.bytes = self.sp.is_byte(self.sp.piece_to_id("<0x00>"))
        self.prefix = self.sp.encode("a", out_type=str)[0].startswith(SPACE)
        # Spans: a run of spaces with what follows up to a space or a character that stands beside none; or such a character.
        paired = {c for x in self.beside for c in x}
        alone = "".join(re.escape(chr(c)) for c in range(127) if chr(c) not in paired)
        if not alone or any(x[1] == SPACE != x[0] for x in self.beside):
            raise ValueError("the model's pieces reach over spaces")
        self.words = re.compile(f"{SPACE}*[^{SPACE}{alone}]+|{SPACE}+|[{alone}]")
        if self.sp.encode("  ﬁ  ", out_type=str) != self.sp.encode("  ﬁ  ".replace(" ", SPACE), out_type=str) or self.sp.decode(self.sp.encode("  ﬁ  ")) != "  ﬁ  ":
            raise ValueError("the model normalises texts: counts of prefixes need texts as they are")
        hashes = np.array([self._hash(p) for p in self.pieces], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order
        self.near = np.zeros(1 << 18, bool)  # by the first bits: whether there may be a piece
        self.near[hashes >> np.uint64(46)] = True
        self.fit = Pairs(self._fit)
        self.known: dict[str, bytes] = {}

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * BASE + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h * SPREAD & 0xFFFFFFFFFFFFFFFF

    def _fit(self, a: int, b: int) -> bool:
        """Whether the encoding of a + b is (a, b)."""
        if a == NONE:
            return True
        x, y = self.pieces[a], self.pieces[b]
        return x[-1] + y[0] not in self.beside or self.sp.encode(self.mark + x + y, out_type=str)[self.lead :] == [x, y]

    def spans(self, spans: list[str]) -> np.ndarray:
        """The counts of the prefixes of each span, a column for each; they are counted side by side, so they come by length, the
        longest first."""
        n, width = len(spans), len(spans[0])
        sizes = np.fromiter(map(len, spans), np.int64, n)
        codes = np.frombuffer("".join(spans).encode("utf-32-le"), "<u4")
        starts = np.cumsum(sizes) - sizes
        hashes = np.zeros((width + 1, n), np.uint64)
        last = np.full((width + 1, n), NONE, np.int64)
        count = np.zeros((width + 1, n), np.int64)
        for i in range(1, width + 1):
            live = int(np.searchsorted(-sizes, -i, "right"))
            code = codes[starts[:live] + i - 1]
            hashes[i, :live] = hashes[i - 1, :live] * np.uint64(BASE) + code + np.uint64(1)
            left = np.arange(live)  # spans whose last piece isn't found yet
            power = pow(BASE, min(self.longest, i), 1 << 64)
            for size in range(min(self.longest, i), 0, -1):
                h = (hashes[i, left] - hashes[i - size, left] * np.uint64(power)) * np.uint64(SPREAD)
                power = power * INVERSE & 0xFFFFFFFFFFFFFFFF
                maybe = np.flatnonzero(self.near[h >> np.uint64(46)])
                if not len(maybe):
                    continue
                at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
                there = self.hashes[at] == h[maybe]
                maybe, piece = maybe[there], self.numbers[at[there]]
                if size < i and len(maybe):
                    fits = self.fit(last[i - size, left[maybe]], piece)
                    maybe, piece = maybe[fits], piece[fits]
                if not len(maybe):
                    continue
                at = left[maybe]
                last[i, at] = piece
                count[i, at] = count[i - size, at] + 1
                left = np.delete(left, maybe)
                if not len(left):
                    break
            if len(left):  # a character without a piece stands alone, as its bytes
                c = code[left]
                count[i, left] = count[i - 1, left] + (1 + (c > 0x7F).astype(np.int64) + (c > 0x7FF) + (c > 0xFFFF) if self.bytes else 1)
        return count[1:]

    def _long(self, span: str) -> np.ndarray:
        """The counts of a span too long to be kept, cut where two characters stand side by side in no piece."""
        ends = [k for k in range(1, len(span)) if span[k - 1 : k + 1] not in self.beside] + [len(span)]
        parts, start, base = [], 0, 0
        for e in ends:
            parts.append(self.spans([span[start:e]])[:, 0] + base)
            start, base = e, int(parts[-1][-1])
        return np.concatenate(parts)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """For each text an array: at k the tokens of its first k + 1 characters."""
        split = [self.words.findall((SPACE if self.prefix else "") + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.known) > KEPT:
            self.known.clear()
        known = self.known
        new = sorted((w for w in set().union(*split) - known.keys() if len(w) <= LONG), key=len, reverse=True)
        for k in range(0, len(new), TOGETHER):
            part = new[k : k + TOGETHER]
            width = len(part[0])
            rows = self.spans(part).T.astype(np.uint8).tobytes()  # at most LONG characters of four bytes: below 256
            known.update({w: rows[j * width : j * width + len(w)] for j, w in enumerate(part)})
        out = []
        for words in split:
            if not words:
                out.append(np.zeros(0, np.int64))
                continue
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            if sizes.max() > LONG:
                own = np.concatenate([np.frombuffer(known[w], np.uint8) if len(w) <= LONG else self._long(w) for w in words])
            else:
                own = np.frombuffer(b"".join([known[w] for w in words]), np.uint8)
            totals = own[np.cumsum(sizes) - 1].astype(np.int64)
            counts = own + np.repeat(np.cumsum(totals) - totals, sizes)
            out.append(counts[1:] if self.prefix else counts)
        return out


def pack_counts(counts: np.ndarray) -> bytes:
    """Prefix counts as the steps between them, a byte each where they fit."""
    steps = np.diff(counts, prepend=0)
    narrow = not len(steps) or (-128 <= steps.min() and steps.max() <= 127)
    return bytes([1 if narrow else 4]) + pack(steps.astype("<i1" if narrow else "<i4"))


def unpack_counts(packed: bytes) -> np.ndarray:
    (steps,) = unpack(packed[1:], "<i1" if packed[0] == 1 else "<i4")
    return np.cumsum(steps.astype(np.int64))


def _texts(batch):
    return batch.column(batch.schema.get_field_index("text")).to_pylist()


def _counted(model):
    def run(batches):
        counter = PrefixCounter(model.value)
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            totals, stored = [], []
            for counts in counter([t or "" for t in _texts(batch)]):
                totals.append(int(counts[-1]) if len(counts) else 0)
                stored.append(pack_counts(counts))
            extra = [pa.array(totals, pa.int64()), pa.array(stored, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "n_tokens", "prefix_counts"])

    return run


def count_tokens(docs: DataFrame, model: str | None = None) -> DataFrame:
    """`docs` with n_bytes, n_tokens and prefix_counts (packed); model: path of a sentencepiece BPE model."""
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    with open(model, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())  # a file of the library's user, half a megabyte
    rows = without(docs, {"n_bytes", "n_tokens", "prefix_counts"})
    out = map_arrow(rows, _counted(sent), schema_with(rows, "n_tokens long, prefix_counts binary"))
    return out.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))


def truncate(counted: DataFrame, budget: int) -> DataFrame:
    """What `count_tokens` gave, with the longest prefix of each text that has at most `budget` tokens, in n_kept (code points) and
    kept_text; n_tokens stays that of the whole text. Read from the stored counts."""
    rows = without(counted, {"n_kept", "kept_text"})

    def run(batches):
        for batch in batches:
            kept = []
            for packed in batch.column(batch.schema.get_field_index("prefix_counts")).to_pylist():
                within = np.flatnonzero(unpack_counts(packed) <= budget)
                kept.append(int(within[-1]) + 1 if len(within) else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kept, pa.int64())], names=[*batch.schema.names, "n_kept"])

    out = map_arrow(rows, run, schema_with(rows, "n_kept long"))
    return out.withColumn("kept_text", F.substring(F.coalesce("text", F.lit("")), F.lit(1), F.col("n_kept").cast("int")))


def count_at(counted: DataFrame, at: str) -> DataFrame:
    """What `count_tokens` gave, with tokens_at: the tokens of each text's first `at` code points (a column; beyond the end, all;
    null or below 1, none). Read from the stored counts."""
    rows = without(counted, {"tokens_at"})

    def run(batches):
        for batch in batches:
            found = []
            names = batch.schema.names
            for packed, k in zip(batch.column(names.index("prefix_counts")).to_pylist(), batch.column(names.index(at)).to_pylist(), strict=True):
                counts = unpack_counts(packed)
                found.append(int(counts[min(k, len(counts)) - 1]) if len(counts) and k is not None and k > 0 else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=[*names, "tokens_at"])

    return map_arrow(rows, run, schema_with(rows, "tokens_at long"))


#: Tokens beyond which the query marks a document.
LIMIT = 4096


def op12_token_counts(spark, sf_dir: str) -> DataFrame:
    out = count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
