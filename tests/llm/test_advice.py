"""What the review of round 1 found missing: the whole job of the operators it named."""

import re

import numpy as np
import pytest

from threadloom.llm import embedding_dedup, licenses, substring_dedup


def words(rng, n, size):
    return " ".join(f"w{rng.integers(size)}x" for _ in range(n))


def without_repeated_runs(texts, k):
    """By hand: every run of k words whose first occurrence is in an earlier text or wholly before it, cut to the word."""
    first, out = {}, {}
    for i, t in enumerate(texts):
        at = [(m.start(), m[0]) for m in re.finditer(r"[^\x20\x09-\x0D]+", t or "")]
        cut = set()
        for p in range(len(at) - k + 1):
            j, q = first.setdefault(tuple(w for _, w in at[p : p + k]), (i, p))
            if j < i or p - q >= k:
                cut |= set(range(p, p + k))
        ends = [*(s for s, _ in at[1:]), len(t or "")]
        out[i] = t and t[: at[0][0] if at else len(t)] + "".join(t[s:e] for n, ((s, _), e) in enumerate(zip(at, ends)) if n not in cut)
    return out


@pytest.mark.parametrize("block", [None, 150])
def test_op3_finds_every_repeated_run(spark, tmp_path, monkeypatch, block):
    rng = np.random.default_rng(11)
    texts = [words(rng, int(rng.integers(1, 90)), 5000) for _ in range(40)]
    for n in (19, 20, 21, 51, 51, 55, 60, 100) * 4:
        passage = words(rng, n, 5000)
        texts += [f"{words(rng, int(rng.integers(0, 30)), 5000)} {passage} {words(rng, int(rng.integers(0, 30)), 5000)}" for _ in range(2)]
    texts += [texts[3] + "\n" + texts[50], "a " * 90, "x " * 30 + texts[60].replace(" ", " \n"), None, "", "  ", "é ü " * 50 + "end", texts[0].upper()]
    if block:
        monkeypatch.setattr(substring_dedup, "WINDOWS", block)
    rows = [*enumerate(texts), (None, texts[45]), (50, texts[50])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    df.write.parquet(f"file://{tmp_path}/documents.parquet")
    want = without_repeated_runs(texts, 20)
    got = substring_dedup.op3_substring_dedup(spark, f"file://{tmp_path}").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["text"] == (texts[45] if r["doc_id"] is None else want[r["doc_id"]]), r
        if r["doc_id"] is not None and r["text"] is not None:
            assert r["chars_removed"] == len(texts[r["doc_id"]]) - len(r["text"]) and (r["chunks_repeated"] > 0) == (r["chars_removed"] > 0) == bool(r["spans_removed"])
    # Of rows that share an id and not a text, each keeps what is its own.
    both = spark.createDataFrame([(1, texts[50]), (2, texts[50]), (2, texts[52])], "doc_id long, text string")
    assert sorted(r["text"] for r in substring_dedup.remove_runs(both).collect()) == sorted(["", texts[50], texts[52]])
    assert substring_dedup.remove_runs(df.limit(0)).count() == 0


def cone(rng, n, cosine, dims=64):
    """Vectors about one axis, of that mean cosine to each other."""
    axis = np.zeros(dims)
    axis[0] = np.sqrt(cosine)
    side = rng.standard_normal((n, dims))
    side[:, 0] = 0
    return axis + side * np.sqrt((1 - cosine) / (dims - 1))


@pytest.mark.parametrize("block", [8192, 700])
def test_op1_loses_no_link_of_a_hot_cone(spark, monkeypatch, block):
    rng = np.random.default_rng(12)
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    v = np.concatenate([cone(rng, 3000, 0.9), rng.standard_normal((1000, 64))])
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    hit = (u @ u.T) >= 0.95
    root = np.arange(len(v))
    for a, b in zip(*np.nonzero(np.triu(hit, 1)), strict=True):
        root[root == max(root[a], root[b])] = min(root[a], root[b])
    df = spark.createDataFrame(list(enumerate(v.tolist())), "vec_id long, embedding array<double>").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_vectors(df).collect()}
    assert hit.sum() > len(v) and got == {i: (int(hit[i].sum()) - 1, int(root[i])) for i in range(len(v))}


LGPL = """ * Copyright (C) 2020 A. Author
 *
 * This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 3 of the License, or any later version.
 *
int f(void);"""


@pytest.mark.parametrize("text, name", [
    ("// SPDX-License-Identifier: MIT\n\nint x;", "MIT"), ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"), ("Licensed under GPL-3.0", "GPL-3.0"), ("Mozilla Public License Version 2.0", "MPL-2.0"),
    ("   GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nEveryone may copy it.", "GPL-3.0"), (LGPL, "LGPL-3.0"), (LGPL.replace("Lesser", "Affero").replace("library", "program"), "AGPL-3.0"), ("see the licence of the shop", None)])
def test_op8_reads_tags_titles_and_wrapped_headers(spark, text, name):
    row = licenses.scan_licenses(spark.createDataFrame([(1, "a/x.c", text)], "doc_id long, path string, text string")).first()
    assert (row["license"], row["origin"]) == (name, "header" if name else "none")
