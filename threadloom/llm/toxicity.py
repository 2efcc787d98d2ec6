"""Toxicity by significant expressions alone: an earlier form of operator 2, which class_models.py replaces in the query.

An expression is six characters of the lower-cased text (what sorts before "0", such as spaces and marks, counts as a
space), known by a 64-bit hash: the vocabulary is the corpus's own and grows with it. Each class has an
absolute-discount model whose discounted mass goes to a shared backoff: the Kneser-Ney continuation counts, in how
many documents of the whole corpus an expression occurs. Expressions that aren't significantly more frequent in the
toxic class are too rare to tell the classes apart; both models take them from the shared counts alone. A text's
evidence is the difference of its two log-likelihoods divided by its number of expressions; a logistic curve turns it
into a score. The curve is fitted to evidence from models of the other half of the labelled rows.

Counts are made by task, dealt by ranges of the hash (as many as the text asks for) and added there; only the significant
expressions, which the labelled sample bounds, are sent to the tasks.

Labels come from folds 1 to 4 (crc32 of the id as text, modulo 5), at most `sample` rows, those with the smallest
hash of the id: a parameter, and the only bound. The shared counts cover every document.

Defined cases: null and empty texts have no evidence (0) and the score of that; a null doc_id is never labelled and is
scored like others; without labels of both kinds every score is the share of label 1 (0.5 without any label); null
labels are no labels, any above 0 is 1, and of an id with several the largest counts; repeated rows count as often as
they occur and are scored alike; other columns are ignored, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RANGE_BYTES, batch_of, crc_fold, distinct, lean, materialize, mix64, pack, release, unpack

ORDER, SIGNIFICANT, SAMPLE = 6, 3.0, 250_000
#: Expressions that a task holds before it sends their counts on.
HELD = 1_000_000
FLOOR, BINS = 1e-4, 4000


def _expressions(texts: list[str | None]):
    """(first document, codes, bounds) in slabs: codes of document k of a slab are codes[bounds[k, 0]:bounds[k, 1]]."""
    i = 0
    while i < len(texts):
        parts, size, j = [], 0, i
        while j < len(texts) and (not parts or size < 1 << 20):
            own = " " + (texts[j] or "").lower() + " " * ORDER
            parts.append(own)
            size += len(own)
            j += 1
        ends = np.cumsum([len(p) for p in parts])
        c = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        c = np.where(c < 48, np.uint64(32), c) * np.uint64(0x9E3779B97F4A7C15)
        n = len(c) - ORDER + 1
        h = np.zeros(n, np.uint64)
        for k in range(ORDER):
            h = (h * np.uint64(0x100000001B3)) ^ c[k : k + n]
        starts = np.concatenate([[0], ends[:-1]])
        empty = np.array([not (texts[k] or "") for k in range(i, j)])
        yield i, mix64(h), np.stack([starts, np.where(empty, starts, ends - ORDER + 1)], 1)
        i = j


def _labelled(ids: list, known) -> np.ndarray:
    """Of each id 2 * half + label, or -1."""
    keys, values = known
    out = np.full(len(ids), -1)
    at = np.array([-(1 << 63) if x is None else x for x in ids], np.int64)
    if len(keys) and len(at):
        k = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
        hit = (keys[k] == at) & np.array([x is not None for x in ids])
        out[hit] = values[k[hit]]
    return out


def _summed(codes: np.ndarray, counts: np.ndarray):
    """Distinct codes, ascending, with the sums of their rows of counts."""
    order = np.argsort(codes)
    codes = codes[order]
    begins = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[begins], np.add.reduceat(counts[order], begins, axis=0)


_COUNTS = pa.schema([("range", pa.int32()), ("counts", pa.binary())])
_KINDS = ("u8", *["u4"] * 5)


def _count(known, ranges: int):
    """Of each task's documents, by ranges of codes: documents with an expression, and counts by half and class."""

    def run(batches):
        parts, size = [], 0

        def merged():
            return _summed(np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts]))

        def sent(codes, counts):
            cuts = np.searchsorted(((codes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64), np.arange(ranges + 1))
            for r in np.flatnonzero(np.diff(cuts)):
                s, e = cuts[r], cuts[r + 1]
                yield batch_of(_COUNTS, [r], [pack(np.diff(codes[s:e], prepend=np.uint64(0)), *(counts[s:e, k].astype(np.uint32) for k in range(5)))])

        for batch in batches:
            kinds = _labelled(batch.column(0).to_pylist(), known.value)
            for first, codes, bounds in _expressions(batch.column(1).to_pylist()):
                lengths = bounds[:, 1] - bounds[:, 0]
                owner = np.repeat(np.arange(len(lengths)), lengths)
                if not len(owner):
                    continue
                at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                own = codes[np.arange(len(owner)) - np.repeat(at, lengths) + np.repeat(bounds[:, 0], lengths)]
                order = np.argsort(own)
                own = own[order]
                new = np.concatenate([[True], own[1:] != own[:-1]])
                number = np.empty(len(own), np.int64)
                number[order] = np.cumsum(new) - 1
                total = np.zeros((int(number[order[-1]]) + 1, 5), np.int32)
                total[:, 0] = np.bincount(distinct(number << 32 | owner) >> 32, minlength=len(total))
                kind = kinds[first + owner]
                for k in range(4):
                    if (some := kind == k).any():
                        total[:, k + 1] = np.bincount(number[some], minlength=len(total))
                parts.append((own[new], total))
                size += len(total)
                if size > 2 * HELD:
                    parts = [merged()]
                    size = len(parts[0][0])
                    if size > HELD:
                        yield from sent(*parts[0])
                        parts, size = [], 0
        if parts:
            yield from sent(*merged())

    return run


def _add(batches):
    """Sums of the counts of each range, with what the models need to know of the whole."""
    schema = pa.schema([("range", pa.int32()), ("counts", pa.binary()), ("facts", pa.list_(pa.int64()))])
    held: dict = {}
    for batch in batches:
        for r, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(r, []).append(counts)
    for r in sorted(held):
        parts = [unpack(x, *_KINDS) for x in held.pop(r)]
        codes = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in parts])
        codes, c = _summed(codes, np.stack([np.concatenate([x[k] for x in parts]).astype(np.int64) for k in range(1, 6)], 1))
        facts = [int(c[:, 0].sum())]
        for m in _models(c.T):
            facts += [int(x) for x in (m.sum(), (m > 0).sum(), (m == 1).sum(), (m == 2).sum())]
        yield batch_of(schema, [r], [pack(np.diff(codes, prepend=np.uint64(0)), *c.T)], [facts])


def _models(c):
    """Counts of class 0 and 1 learnt from half 0, from half 1, and from both."""
    return [c[1], c[2], c[3], c[4], c[1] + c[3], c[2] + c[4]]


def _evidence(facts: list[int]):
    """(model, code, evidence) of the expressions that are significantly toxic."""
    schema = pa.schema([("model", pa.int32()), ("code", pa.int64()), ("evidence", pa.float64())])

    def run(batches):
        for batch in batches:
            for counts in batch.column(0).to_pylist():
                steps, *c = unpack(counts, "u8", *["i8"] * 5)
                codes = np.cumsum(steps, dtype=np.uint64)
                shared = c[0] / max(1, facts[0])
                models = _models(c)
                for m in range(3):
                    logs = []
                    for k in (0, 1):
                        n, types, once, twice = facts[1 + 4 * (2 * m + k) : 5 + 4 * (2 * m + k)]
                        discount = once / (once + 2 * twice) if once else 0.5
                        own = models[2 * m + k]
                        logs.append(np.maximum(own - discount, 0) / max(1, n) + (discount * types + 1) / max(1, n + 1) * shared)
                    n0, n1 = facts[1 + 8 * m], facts[5 + 8 * m]
                    due = (models[2 * m] + models[2 * m + 1]) * (n1 / max(1, n0 + n1))
                    strong = np.flatnonzero((models[2 * m + 1] - due) / np.sqrt(due + 1) > SIGNIFICANT)
                    if len(strong):
                        e = np.log(logs[1][strong]) - np.log(logs[0][strong])
                        yield batch_of(schema, np.full(len(strong), m), codes[strong].view(np.int64), e)

    return run


class _Weights:
    """Evidence by code: a table of bits finds the few codes that may have any, a search their value."""

    def __init__(self, codes: np.ndarray, evidence: np.ndarray):
        self.codes, self.evidence = codes, evidence
        self.bits = max(16, int(8 * len(codes)).bit_length())
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[codes >> np.uint64(64 - self.bits)] = True

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(codes))
        if len(self.codes):
            some = np.flatnonzero(self.maybe[codes >> np.uint64(64 - self.bits)])
            at = np.minimum(np.searchsorted(self.codes, codes[some]), len(self.codes) - 1)
            out[some] = np.where(self.codes[at] == codes[some], self.evidence[at], 0)
        return out


def _means(texts, weights):
    """Evidence of each text divided by its number of expressions."""
    out = np.zeros(len(texts))
    for first, codes, bounds in _expressions(texts):
        total = np.zeros(len(codes) + 1)
        np.cumsum(weights(codes), out=total[1:])
        n = bounds[:, 1] - bounds[:, 0]
        out[first : first + len(n)] = np.maximum(total[bounds[:, 1]] - total[bounds[:, 0]], 0) / np.maximum(n, 1)
    return out


def _feature(mean):
    return np.log(FLOOR + mean)


def _calibration(known, models):
    """Counts of labelled documents by bin of their evidence, each from the model of the other half."""
    schema = pa.schema([("bin", pa.int32()), ("label", pa.int32()), ("n", pa.int64())])
    low, high = math.log(FLOOR), math.log(20.0)

    def run(batches):
        weights = [_Weights(*m) for m in models.value[:2]]
        total = np.zeros((2, BINS + 1), np.int64)
        for batch in batches:
            kinds = _labelled(batch.column(0).to_pylist(), known.value)
            for half in (0, 1):
                rows = np.flatnonzero((kinds >= 0) & (kinds // 2 == half))
                if len(rows):
                    x = _feature(_means(batch.column(1).take(pa.array(rows)).to_pylist(), weights[1 - half]))
                    b = np.clip(((x - low) / (high - low) * BINS), 0, BINS).astype(int)
                    np.add.at(total, (kinds[rows] % 2, b), 1)
        y, b = np.nonzero(total)
        if len(b):
            yield batch_of(schema, b, y, total[y, b])

    return run


def _scored(models, slope: float, bias: float):
    def run(batches):
        weights = _Weights(*models.value[2])
        for batch in batches:
            x = slope * _feature(_means(batch.column(batch.schema.get_field_index("text")).to_pylist(), weights)) + bias
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(x, -50, 50))))], names=["doc_id", "score"])

    return run


def fit_curve(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Logistic slope (not negative) and intercept of weighted points."""
    mean = float((x * n).sum() / n.sum())
    a, b = 0.0, math.log((y * n).sum() / ((1 - y) * n).sum())
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * (x - mean) + b, -50, 50)))
        v = n * p * (1 - p) + 1e-9
        g = np.array([(n * (y - p) * (x - mean)).sum() - 0.01 * a, (n * (y - p)).sum()])
        h = np.array([[(v * (x - mean) ** 2).sum() + 0.01, (v * (x - mean)).sum()], [(v * (x - mean)).sum(), v.sum()]])
        da, db = np.linalg.solve(h, g)
        a, b = a + max(-2, min(2, da)), b + max(-2, min(2, db))
    if a <= 0:
        return 0.0, math.log((y * n).sum() / ((1 - y) * n).sum())
    return float(a), float(b - a * mean)


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """doc_id and score of every document."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    ids = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id")) != 0))
    ids = ids.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max(label) > 0).cast("int").alias("y"))
    ids = ids.select("doc_id", (2 * (crc_fold(F.col("doc_id")) > 2).cast("int") + F.col("y")).alias("kind"))
    rows = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toPandas().sort_values("doc_id")
    keys, kinds = rows["doc_id"].to_numpy(np.int64), rows["kind"].to_numpy(np.int64)
    y = kinds % 2
    if not len(y) or y.min() == y.max():
        return texts.select("doc_id", F.lit(float(y.mean()) if len(y) else 0.5).alias("score"))
    known = spark.sparkContext.broadcast((keys, kinds))
    ranges = max(8, math.ceil((texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / RANGE_BYTES))
    counted = texts.mapInArrow(lean(_count(known, ranges)), "range int, counts binary").repartitionById(ranges, F.col("range"))
    summed = materialize(counted.mapInArrow(lean(_add), "range int, counts binary, facts array<bigint>"), "counts")
    facts = [r["n"] for r in summed.select(F.posexplode("facts")).groupBy("pos").agg(F.sum("col").alias("n")).orderBy("pos").collect()]
    strong = summed.select("counts").mapInArrow(lean(_evidence(facts)), "model int, code long, evidence double").toPandas()
    release(summed)
    models = []
    for m in range(3):
        own = strong[strong["model"] == m]
        codes, evidence = own["code"].to_numpy(np.int64).view(np.uint64), own["evidence"].to_numpy(float)
        order = np.argsort(codes)
        models.append((codes[order], evidence[order]))
    models = spark.sparkContext.broadcast(models)
    bins = texts.mapInArrow(lean(_calibration(known, models)), "bin int, label int, n long").groupBy("bin", "label").agg(F.sum("n").alias("n")).toPandas()
    low, high = math.log(FLOOR), math.log(20.0)
    x = low + (bins["bin"].to_numpy(float) + 0.5) / BINS * (high - low)
    slope, bias = fit_curve(x, bins["label"].to_numpy(float), bins["n"].to_numpy(float))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(lean(_scored(models, slope, bias)), f"doc_id {kind}, score double")
