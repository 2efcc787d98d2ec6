"""Operator 2's query against a second computation of both whole models by dictionaries."""

import collections
import math
import zlib

import numpy as np
import pytest

from threadloom import llm


def models_by_hand(rows, labels):
    """score of rows (id, text), with plain and word evidence, by dictionaries of strings."""
    from threadloom.llm import class_models

    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    y = {}
    for i, v in labels:
        if i is not None and v is not None and fold(i):
            y[i] = max(y.get(i, 0), int(v > 0))
    half = {i: int(fold(i) > 2) for i in y}

    def grams(t):
        t = "".join(" " if c < "0" else c for c in " " * 5 + t.lower() + " ") if t else ""
        return [t[k : k + 6] for k in range(len(t) - 5)]

    own = [(i, grams(t)) for i, t in rows]

    def discounts(counts):
        n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
        if not all(n):
            return [0.0, 0.5, 0.5, 0.5]
        d = n[0] / (n[0] + 2 * n[1])
        return [0.0, *(min(max(k - (k + 1) * d * n[k] / n[k - 1], 0.01), k) for k in (1, 2, 3))]

    def order(counts, below):
        """Probabilities of grams by a discounted order on the one below."""
        d = discounts(counts.values())
        total, mass = collections.Counter(), collections.Counter()
        for g, c in counts.items():
            total[g[:-1]] += c
            mass[g[:-1]] += d[min(c, 3)]

        def p(g):
            t = total[g[:-1]]
            return (counts[g] - d[min(counts[g], 3)] + mass[g[:-1]] * below(g[1:])) / t if t else below(g[1:])

        return p

    seen = {g for _, gs in own for g in gs}
    levels = {}
    for n in range(5, 0, -1):
        levels[n] = collections.Counter(g[1:] for g in seen)
        seen = set(levels[n])
    shared = lambda g: 1 / len(levels[1])
    for n in range(1, 6):
        shared = order(levels[n], shared)

    def model(halves):
        counts = [collections.Counter(g for i, gs in own if y.get(i) == k and half[i] in halves for g in gs) for k in (0, 1)]
        p = [order(c, shared) for c in counts]
        return lambda g: math.log(p[1](g) / p[0](g))

    def evidence(m, gs):
        if not gs:
            return [0.0, 0.0]
        e, words, run = [m(g) for g in gs], [], 0
        for k, g in enumerate(gs):
            if k == 0 or g[-1] != " " and gs[k - 1][-1] == " ":
                run = 0
            if run % 32 == 0:
                words.append(0.0)
            words[-1] += e[k]
            run += 1
        top = max(words)
        return [sum(e) / len(e), top + math.log(sum(math.exp(w - top) for w in words) / len(words))]

    x = []
    for h in (0, 1):
        m = model({1 - h})
        x += [(*(math.floor(min(max(v, -b), b) / c) * c + c / 2 for v, b, c in zip(evidence(m, gs), (2, 60), (0.005, 0.05))), y[i]) for i, gs in own if i in y and half[i] == h]
    x = np.array(x)
    weights, bias = class_models.fit_plane(x[:, :2], x[:, 2], np.ones(len(x)))
    m = model({0, 1})
    every = [evidence(m, gs) for _, gs in own]
    return [1 / (1 + math.exp(-(np.array(e) @ weights + bias))) for e in every], every


@pytest.mark.parametrize("held", [None, 500])
def test_toxicity_compares_whole_models(spark, tmp_path, monkeypatch, held):
    """Ordinary evidence and expressions that aren't significant count; continuations are of distinct contexts."""
    if held:
        from threadloom.llm import class_models

        monkeypatch.setattr(class_models, "HELD", held)
    rng = np.random.default_rng(31)
    rows, labels = [], []
    for i in range(200):
        w = [f"w{rng.integers(150)}x" for _ in range(int(rng.integers(3, 40)))]
        if i % 3 == 0:
            w[int(rng.integers(len(w)))] = ["Idiotic!", "moronic", "vílest"][i % 7 % 3]
        elif i % 2:
            w[int(rng.integers(len(w)))] = "kindly"
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 3 == 0)))
    rows += [(900, None), (901, ""), (902, "moronic " * 2000), (None, "moronic"), rows[3], rows[3], (7, "other words of the same id"), (903, "日本 moronic 語"), (904, "x" * 999), (905, " "), (906, "kindly"), (907, "w1x w2x")]
    labels += [(5, None), (None, 1), (6, 0), (6, 2), (12_345, 1)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = sorted((str(r["doc_id"]), r["score"]) for r in llm.QUERIES["op2_toxicity"](spark, str(tmp_path)).collect())
    scores, evidence = models_by_hand(rows, labels)
    want = sorted(zip((str(i) for i, _ in rows), scores, strict=True))
    assert len({round(s, 9) for s in scores}) > 150
    assert [a for a, _ in got] == [a for a, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], atol=1e-4)
    by_id = {i: (s, e) for (i, _), s, e in zip(rows, scores, evidence, strict=True)}
    assert by_id[906][1][0] < by_id[907][1][0] < by_id[None][1][0]  # evidence for the ordinary class counts too


def test_toxicity_classes_and_empty_tables(spark):
    from threadloom.llm import class_models

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    assert {r["score"] for r in class_models.compare_classes(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert {r["score"] for r in class_models.compare_classes(docs, labels.limit(0)).collect()} == {0.5}
    assert class_models.compare_classes(docs.limit(0), labels).count() == 0
    assert class_models.compare_classes(docs.selectExpr("doc_id", "cast(null as string) as text"), labels).count() == 20
    assert class_models.compare_classes(docs.selectExpr("doc_id", "text", "doc_id as gram", "text as score"), labels).count() == 20
