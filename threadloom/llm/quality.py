"""Operator 4: quality scores by a sparse rule ensemble.

Shallow trees are grown on statistics of labelled texts; every path from a root is a conjunctive rule; a logistic
model with an L1 penalty weighs the rules, most of which drop out; the rest are compiled into one Spark column
expression over the statistics. Labels are learnt from rows of folds 1 to 4 (crc32 of the id as text, modulo 5), at
most `sample` of them (those with the smallest hash of the id): the one bound of this module, and a parameter.

Defined cases: null and empty texts have all statistics 0 and are scored like any other; without labels of both
kinds every score is the share of label 1 (0.5 without any label); null labels are no labels; repeated rows are
scored alike; a null doc_id is never labelled and is scored like others; an empty table gives an empty table; other
columns pass through whatever their names, but for one named _score, whose place `score_quality` takes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WS, WordHasher, crc_fold, distinct, map_arrow, plain_names, schema_with, slabs, table, utf8

STATS = ["chars", "words", "word_length", "word_spread", "upper", "digits", "symbols", "points", "wide", "lines", "distinct", "phrases", "marked_ends", "line_words", "short_words", "line_repeats"]
SAMPLE = 20_000

_KIND = np.zeros(256, np.uint8)
for _i in range(33, 127):
    _KIND[_i] = 4
for _c in b".,;:'\"()-!?":
    _KIND[_c] = 5
for _i in range(48, 58):
    _KIND[_i] = 3
for _i in range(65, 91):
    _KIND[_i], _KIND[_i + 32] = 1, 2
_LEAD = np.ones(256, bool)
_LEAD[128:192] = False


def text_statistics(data: np.ndarray, offsets: np.ndarray, hasher: WordHasher) -> np.ndarray:
    """The STATS of a slab of texts, one row each, from their UTF-8 bytes."""
    base, n = int(offsets[0]), len(offsets) - 1
    off = offsets - base
    b = data[base : int(offsets[-1])]

    def per_doc(flags):
        total = np.zeros(len(b) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return (total[off[1:]] - total[off[:-1]]).astype(float)

    kind = _KIND[b]
    chars = per_doc(_LEAD[b])
    upper, lower, digits, symbols, points = (per_doc(kind == k) for k in (1, 2, 3, 4, 5))
    wide, breaks = per_doc(b >= 192), per_doc(b == 10)
    word = ~WS[b]
    first = np.zeros(len(b) + 1, bool)
    first[off[:-1]] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | first[1:-1]
    starts = np.flatnonzero(start)
    end = word.copy()
    end[:-1] &= ~word[1:] | first[1:-1]
    ends = np.flatnonzero(end)
    lengths = (ends - starts + 1).astype(float)
    at = np.searchsorted(starts, off)
    words = np.diff(at).astype(float)
    some = np.maximum(words, 1)
    run = lambda x: np.diff(np.concatenate([[0.0], np.cumsum(x)])[at])
    mean = run(lengths) / some
    spread = np.sqrt(np.maximum(run(lengths * lengths) / some - mean * mean, 0))
    marked = run((kind[ends] == 4) | (b[ends] == 33)) / some
    short = run(lengths <= 3) / some
    hashes, where = hasher(data, offsets)
    different, phrases, again = np.zeros(n), np.zeros(n), np.zeros(n)
    newline = np.flatnonzero(b == 10)
    for i in range(n):
        w = hashes[where[i] : where[i + 1]]
        if len(w):
            different[i] = len(distinct(w)) / len(w)
        if len(w) > 2:
            phrase = w[:-2] * np.uint64(0x9E3779B97F4A7C15) + w[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + w[2:]
            phrases[i] = len(distinct(phrase)) / len(phrase)
        cuts = newline[np.searchsorted(newline, off[i]) : np.searchsorted(newline, off[i + 1])]
        if len(cuts):
            own = b[off[i] : off[i + 1]].tobytes().split(b"\n")
            again[i] = 1 - len(set(own)) / len(own)
    c = np.maximum(chars, 1)
    letters = np.maximum(upper + lower, 1)
    lines = breaks + (chars > 0)
    return np.stack([np.log1p(chars), np.log1p(words), mean, spread, upper / letters, digits / c, symbols / c, points / c, wide / c, np.log1p(lines), different, phrases, marked, words / np.maximum(lines, 1), short, again], 1)


def _with_statistics():
    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            data, offsets, _ = utf8(batch.column(batch.schema.get_field_index("text")))
            parts = [text_statistics(data, offsets[i : j + 1], hasher) for i, j in slabs(offsets)]
            x = np.concatenate(parts) if parts else np.zeros((0, len(STATS)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x[:, k]) for k in range(len(STATS)))], names=[*batch.schema.names, *(f"_{s}" for s in STATS)])

    return run


def with_statistics(docs: DataFrame) -> DataFrame:
    """`docs` with the columns _<name> for the names in STATS."""
    return map_arrow(docs, _with_statistics(), schema_with(docs, ", ".join(f"_{s} double" for s in STATS)))


# ---------------------------------------------------------------- learning, on a bounded sample


def _tree(x, y, rows, features, depth, least, rule, rules):
    """Splits by the largest drop of squared error; every node below the root adds its path to `rules`."""
    if depth == 0 or len(rows) < 2 * least:
        return
    best = (1e-9, None, None)
    own = y[rows]
    total, count = own.sum(), len(rows)
    for f in features:
        order = np.argsort(x[rows, f], kind="stable")
        v, s = x[rows, f][order], np.cumsum(own[order])
        k = np.arange(1, count)
        ok = (v[1:] > v[:-1]) & (k >= least) & (count - k >= least)
        if ok.any():
            gain = np.where(ok, s[:-1] ** 2 / k + (total - s[:-1]) ** 2 / (count - k) - total**2 / count, -1)
            g = int(gain.argmax())
            if gain[g] > best[0]:
                best = (gain[g], f, (v[g] + v[g + 1]) / 2)
    _, f, cut = best
    if f is None:
        return
    left = x[rows, f] <= cut
    for side, part in ((0, rows[left]), (1, rows[~left])):
        path = (*rule, (int(f), side, float(cut)))
        rules.add(path)
        _tree(x, y, part, features, depth - 1, least, path, rules)


def _holds(x, rule):
    ok = np.ones(len(x), bool)
    for f, side, cut in rule:
        ok &= (x[:, f] > cut) if side else (x[:, f] <= cut)
    return ok


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, penalty: float = 0.002, seed: int = 7) -> dict:
    """Rules with non-zero weights and the intercept of an L1-penalised logistic model."""
    if not len(y) or y.min() == y.max():
        p = min(max(float(y.mean()), 1e-3), 1 - 1e-3) if len(y) else 0.5
        return {"bias": math.log(p / (1 - p)), "rules": []}
    rng, rules = np.random.default_rng(seed), set()
    residual, least = y - y.mean(), max(3, len(y) // 400)
    for _ in range(trees):
        rows = np.sort(rng.choice(len(y), max(1, len(y) // 2), replace=False))
        features = np.sort(rng.choice(x.shape[1], max(1, x.shape[1] // 2), replace=False))
        _tree(x, residual, rows, features, depth, least, (), rules)
    rules = sorted(rules)
    m = np.stack([_holds(x, r) for r in rules], 1).astype(np.float32) if rules else np.zeros((len(y), 0), np.float32)
    _, kept = np.unique(m, axis=1, return_index=True)
    kept = [k for k in np.sort(kept) if 0 < m[:, k].mean() < 1]
    rules, m = [rules[k] for k in kept], m[:, kept]
    scale = np.sqrt(m.var(0) + 1e-6)
    z = (m - m.mean(0)) / scale
    w, bias = np.zeros(z.shape[1]), math.log(y.mean() / (1 - y.mean()))
    step = 4 / (1 + np.linalg.norm(z, 2) ** 2 / len(y))
    v, t = w.copy(), 1.0
    for _ in range(400):  # accelerated proximal gradient
        p = 1 / (1 + np.exp(-(z @ v + bias)))
        g = z.T @ (p - y) / len(y)
        new = v - step * g
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        t, old = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        v, w = new + (old - 1) / t * (new - w), new
        bias -= float((p - y).mean()) * 2
    w = w / scale
    bias -= float(w @ m.mean(0))
    return {"bias": float(bias), "rules": [(r, float(a)) for r, a in zip(rules, w, strict=True) if abs(a) > 1e-6]}


def rule_column(model: dict):
    """The score as one Spark column over the statistics."""
    total = F.lit(model["bias"])
    for rule, weight in model["rules"]:
        hit = F.lit(True)
        for f, side, cut in rule:
            c = F.col(f"_{STATS[f]}")
            hit = hit & ((c > cut) if side else (c <= cut))
        total = total + F.when(hit, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> dict:
    ids = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id")) != 0))
    ids = ids.groupBy("doc_id").agg(F.max(label).cast("int").alias("_y"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = with_statistics(docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")).drop("text").toPandas()
    rows = rows.sort_values(["doc_id", *(f"_{s}" for s in STATS)])
    x = rows[[f"_{s}" for s in STATS]].to_numpy(float).reshape(-1, len(STATS))
    return fit_rules(x, rows["_y"].to_numpy(float))


def _scored(docs: DataFrame, model: dict):
    """`docs` with plain names, their statistics and _score, and the plain names."""
    rows, names = plain_names(docs)
    text = names["text"]
    out = with_statistics(rows.withColumnRenamed(text, "text")).withColumnRenamed("text", text)
    return out.withColumn("_score", rule_column(model)), names


def score_quality(docs: DataFrame, model: dict) -> DataFrame:
    """`docs` with the column _score."""
    out, names = _scored(docs, model)
    kept = [c for c in docs.columns if c != "_score"]
    return out.select(*(names[c] for c in kept), "_score").toDF(*kept, "_score")


def keep_quality(docs: DataFrame, model: dict, least: float) -> DataFrame:
    """The rows of `docs` that score `least` or more."""
    out, names = _scored(docs, model)
    return out.where(F.col("_score") >= least).select(*names.values()).toDF(*docs.columns)


def op4_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (crc_fold(F.col("doc_id")) == 0).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= 0.3).cast("int").alias("predicted"))
