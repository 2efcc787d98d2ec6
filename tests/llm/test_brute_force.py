"""Operators that SQL can't express against a plain second computation of the whole result."""

import collections
import math
import zlib

import numpy as np
import pytest

from threadloom.llm import toxicity


def words(rng, n, size):
    return " ".join(f"w{rng.integers(size)}x" for _ in range(n))


def toxicity_by_hand(rows, labels):
    """Scores of rows (id, text) by dictionaries: two discounted models on the whole corpus's continuation counts."""
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    y = {}
    for i, v in labels:
        if i is not None and v is not None and fold(i):
            y[i] = max(y.get(i, 0), int(v > 0))
    half = {i: int(fold(i) > 2) for i in y}

    def grams(t):
        t = "".join(" " if c < "0" else c for c in " " + (t or "").lower() + " " * 6)
        return [t[k : k + 6] for k in range(len(t) - 5)] if len(t) > 7 else []

    own = [(i, grams(t)) for i, t in rows]
    shared = collections.Counter(g for _, gs in own for g in set(gs))
    whole = sum(shared.values())

    def model(halves):
        counts = [collections.Counter(g for i, gs in own if y.get(i) == k and half[i] in halves for g in gs) for k in (0, 1)]
        total = [sum(c.values()) for c in counts]
        out = {}
        for g in counts[1]:
            due = (counts[0][g] + counts[1][g]) * total[1] / sum(total)
            if (counts[1][g] - due) / math.sqrt(due + 1) > 3:
                logs = []
                for c, n in zip(counts, total):
                    once, twice = (sum(x == k for x in c.values()) for k in (1, 2))
                    d = once / (once + 2 * twice) if once else 0.5
                    logs.append(math.log(max(c[g] - d, 0) / max(1, n) + (d * len(c) + 1) / max(1, n + 1) * shared[g] / whole))
                out[g] = logs[1] - logs[0]
        return out

    evidence = lambda m, gs: max(sum(m.get(g, 0) for g in gs), 0) / max(len(gs), 1)
    feature = lambda e: math.log(1e-4 + e)
    low, high = math.log(1e-4), math.log(20)
    bins = collections.Counter()
    for h in (0, 1):
        m = model({1 - h})
        for i, gs in own:
            if i in y and half[i] == h:
                bins[min(4000, max(0, int((feature(evidence(m, gs)) - low) / (high - low) * 4000))), y[i]] += 1
    x, v, n = (np.array(a, float) for a in zip(*((low + (b + 0.5) / 4000 * (high - low), k, c) for (b, k), c in sorted(bins.items()))))
    slope, bias = toxicity.fit_curve(x, v, n)
    m = model({0, 1})
    return [1 / (1 + math.exp(-(slope * feature(evidence(m, gs)) + bias))) for _, gs in own]


@pytest.mark.parametrize("held", [None, 500])
def test_toxicity(spark, monkeypatch, held):
    if held:
        monkeypatch.setattr(toxicity, "HELD", held)
    rng = np.random.default_rng(21)
    rows, labels = [], []
    for i in range(240):
        w = words(rng, int(rng.integers(3, 60)), 200).split(" ")
        if i % 3 == 0:
            w[int(rng.integers(len(w)))] = ["Idiotic!", "moronic", "vílest"][i % 7 % 3]
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 3 == 0)))
    rows += [(900, None), (901, ""), (902, "moronic " * 4000), (None, "moronic"), rows[3], rows[3], (7, "other words of the same id"), (903, "日本 moronic 語")]
    labels += [(5, None), (None, 1), (6, 0), (6, 2), (12_345, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((str(r["doc_id"]), round(r["score"], 9)) for r in toxicity.score_toxicity(df, spark.createDataFrame(labels, "doc_id long, toxic int")).collect())
    want = sorted((str(i), round(s, 9)) for (i, _), s in zip(rows, toxicity_by_hand(rows, labels), strict=True))
    assert len({s for _, s in want}) > 50
    assert [a for a, _ in got] == [a for a, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], atol=1e-7)


@pytest.mark.parametrize("ids", ["dense", "spread"])
def test_warc_revisits_everywhere(spark, tmp_path, ids):
    """Copies in every place of many shards, ids far apart, and ids that repeat with other payloads."""
    import base64
    import hashlib

    from threadloom.llm import warc

    rng = np.random.default_rng(22)
    place = lambda k: k if ids == "dense" else int(k) ** 9 - 5 * 10**17
    pages = [(place(k), f"http://x/{k}", f"<p>{rng.integers(12)}</p>" * int(rng.integers(1, 4)) if k % 3 else None) for k in range(90)]
    pages += [(place(4), "u", "other"), (place(5), "u", "other"), (place(5), "v", "<p>3</p>"), (place(89), "w", "x" * 3000), (place(88), "w", "x" * 3000), (None, "n", "other"), (None, "n", None)]
    df = spark.createDataFrame([pages[k] for k in rng.permutation(len(pages))], "page_id long, url string, html string").repartition(5)
    out = f"file://{tmp_path}/w"
    manifest = warc.write_archives(df, out, shard_bytes=1500, roll_bytes=700).collect()
    assert len({m["file"].split("-")[1] for m in manifest}) > 10
    top = {}
    for i, _, h in pages:
        if i is not None:
            top[h or ""] = max(top.get(h or "", i), i)
    want = []
    for i, u, h in pages:
        b = (h or "").encode()
        again = i is not None and i < top[h or ""]
        want.append((i, u, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", top[h or ""] if again else None, None if again else h or ""))
    got = [tuple(r) for r in warc.read_archives(spark, out).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    starts = warc.shard_starts(df.selectExpr("page_id", "cast(400 + length(coalesce(html, '')) as long) as bytes"), 1500)
    other = warc.shard_starts(df.repartition(2).selectExpr("page_id", "cast(400 + length(coalesce(html, '')) as long) as bytes"), 1500)
    assert starts.tolist() == other.tolist()


def licences_by_hand(files):
    """doc_id -> (license, score, origin, given_by) by dictionaries and loops."""
    import re

    from threadloom.llm import licenses as L

    def model(templates):
        counted = [(n, collections.Counter(L.terms(t))) for n, t in templates]
        df = collections.Counter(t for _, c in counted for t in c)
        idf = collections.defaultdict(lambda: math.log(1 + len(counted)) + 1, {t: math.log((1 + len(counted)) / (1 + k)) + 1 for t, k in df.items()})
        return idf, sorted(counted, key=lambda x: x[0])

    def best(text, m):
        idf, counted = m
        own = {t: k * idf[t] for t, k in collections.Counter(L.terms(text)).items()}
        norm = lambda w: math.sqrt(sum(x * x for x in w.values()))
        top = (0.0, "")
        for name, c in counted:
            w = {t: k * idf[t] for t, k in c.items()}
            score = round(sum(own.get(t, 0) * x for t, x in w.items()) / (norm(own) * norm(w)), 9) if own else 0.0
            if score > top[0]:
                top = (score, name)
        return top

    n_words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    speaks = lambda t: re.search(L.SPEAKS, t)
    headers, whole_files = model(L.TEMPLATES), model(L.FILES)
    own = []
    for i, path, text in files:
        t, hits, found, is_file = text or "", [], None, False
        if speaks(t):
            if re.search(L.FILE_SPEAKS, t) and n_words(t) <= L.FILE_WORDS:
                found = best(t, whole_files)
                is_file = found[0] >= L.FILE_THRESHOLD
            if not is_file:
                for b in re.split(r"\r?\n[ \t*/#;!%<>-]*\r?\n", t):
                    if not speaks(b):
                        continue
                    parts = []
                    for p in re.split(r"\n|(?<=\.) ", b):
                        w = re.findall(r"[^\x20\x09-\x0D]+", p)
                        for k in range(0, len(w), 300):
                            part = " ".join(w[k : k + 300])
                            if speaks(part) and (s := best(part, headers))[0] >= 0.6:
                                parts.append((s, len(w[k : k + 300])))
                    block = best(b, headers) if n_words(b) <= 300 else (0.0, "")
                    hits += [(block, n_words(b)), *((s, 0) for s, _ in parts if s[1] == block[1])] if block[0] >= 0.6 else parts
        if not is_file:
            found = min((s for s, _ in hits), key=lambda s: (-s[0], s[1])) if hits else None
        folder = None if path is None else path.rpartition("/")[0]
        gives = path is not None and (re.search(L.LICENSE_NAME, path.rpartition("/")[2]) or is_file or n_words(t) and 2 * sum(n for _, n in hits) >= n_words(t))
        own.append((i, path, folder, found, gives))
    givers = {}
    for _, path, folder, found, gives in own:
        if found and gives:
            givers[folder] = min(givers.get(folder, (0, "~", "")), (-found[0], path, found[1]))
    out = []
    for i, path, folder, found, _ in own:
        if found:
            out.append((i, path, found[1], found[0], "header", None))
            continue
        up = folder
        while up is not None and up not in givers:
            up = up.rpartition("/")[0] if up else None
        g = givers.get(up) if up is not None else None
        out.append((i, path, g[2], -g[0], "inherited", g[1]) if g else (i, path, None, None, "none", None))
    return out


def test_licences(spark):
    from threadloom.llm import licenses as L

    rng = np.random.default_rng(23)
    lesser = "# This library is free software; you can redistribute it and/or\n# modify it under the terms of the GNU Lesser General Public\n# License as published by the Free Software Foundation; either\n# version {} of the License, or (at your option) any later version.\n"
    general = lesser.replace("library", "program").replace("Lesser ", "")
    texts = {
        "LGPL-2.1": lesser.format("2.1") + "\ncode", "LGPL-3.0": lesser.format("3"), "GPL-2.0": "x\n#\n" + general.format("2") + "#\ny", "GPL-3.0": general.format("3"), "BSD-2-Clause": "Copyright (c) 2020, A\n\n" + L._BSD.format(""), "BSD-3-Clause": "Copyright (c) 2020, A\n\n" + L._BSD.format(L._NO_NAME),
        "MIT": "The MIT License\n\n" + L.FILES[3][1], "ISC": L.FILES[2][1], "Apache-2.0": "// Licensed under the Apache License, Version 2.0.\nint x;", "EPL-2.0": "/* SPDX-License-Identifier: EPL-2.0 */", None: "The license of the bar was revoked, and people redistribute wealth.",
    }
    files = [(k, f"own/{name}/x.c", t) for k, (name, t) in enumerate(texts.items())]
    long = words(rng, 1500, 300)
    bodies = [*texts.values(), None, "", "int x;", long, long + "\n\nReleased under the MIT License.", "license " * 700 + "MIT", "Released under the MIT License. " * 30, "Licensed under Apache-2.0.\n\nLicensed under Apache-2.0. Licensed under MIT.", "see LICENSE\r\n\r\nSPDX-License-Identifier: MPL-2.0\r\n"]
    folders = ["", "a", "a/b", "a/b/c", "a/b/c/d", "e", "e/f", "e//g", "a/bb"]
    for k in range(120):
        folder, name = folders[int(rng.integers(len(folders)))], ["LICENSE", "COPYING.txt", "x.c", "y.py", "license.md"][int(rng.integers(5))]
        files.append((100 + k, None if k % 29 == 0 else f"{folder}/{name}" if folder else name, bodies[int(rng.integers(len(bodies)))]))
    files += [files[20], files[20], (None, "a/b/z.c", "int x;")]
    df = spark.createDataFrame([files[k] for k in rng.permutation(len(files))], "doc_id long, path string, text string").repartition(4)
    got = [(r["doc_id"], r["path"], r["license"], r["score"], r["origin"], r["given_by"]) for r in L.scan_licenses(df).collect()]
    plain = lambda rows: sorted((str((*r[:3], r[4], r[5])), round(r[3] or 0, 7)) for r in rows)
    want = licences_by_hand(files)
    assert plain(got) == plain(want)
    assert [(r[2], r[4]) for r in want[: len(texts) - 1]] == [(name, "header") for name in list(texts)[:-1]] and want[len(texts) - 1][4] == "inherited"
    assert L.scan_licenses(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_bpe_of_any_tokenizer(spark, name):
    """Also of one whose cuts aren't safe: it lower-cases, composes and squeezes blanks."""
    import hashlib

    import public_tokenizers
    from tokenizers import Tokenizer

    from threadloom.llm import bpe

    rng = np.random.default_rng(24)
    texts = [words(rng, 400, 50), None, "", "  A  B \n\n c", "é" * 300 + " ü", "x" * 9000, words(rng, 400, 50) + "<|endoftext|>" + "q " * 500, "日本 語　a"]
    path = public_tokenizers.path(name)
    exact = Tokenizer.from_file(path)
    df = spark.createDataFrame([*enumerate(texts), (None, "no id"), (0, texts[0])], "doc_id long, text string").repartition(2)
    rows = bpe.encode(df, path).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        ids = exact.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["token_ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(exact.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode(df.limit(0), path).count() == 0


@pytest.mark.parametrize("block", [256, 7])
def test_ngram_links(spark, monkeypatch, block):
    import re

    from threadloom.llm import ngram_join

    monkeypatch.setattr(ngram_join, "LINK_BLOCK", block)
    monkeypatch.setattr(ngram_join, "SKIP", 64 if block == 256 else 2)
    rng = np.random.default_rng(25)
    texts = []
    for _ in range(12):
        base = words(rng, int(rng.integers(20, 90)), 900).split(" ")
        for _ in range(int(rng.integers(1, 9))):
            own = list(base)
            for _ in range(int(rng.integers(0, 3))):
                own[int(rng.integers(len(own)))] = f"new{rng.integers(99)}"
            texts.append(" ".join(own))
    chain = words(rng, 60, 900).split(" ")
    texts += [" ".join(chain[k : k + 40]) for k in range(0, 20, 2)] + [texts[0], texts[0].upper(), None, "", " ", "one two", "one two"]
    rows = [*enumerate(texts), (None, texts[0]), (3, texts[3])]

    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    sets = [shingles(t) for _, t in rows]
    link = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    want = sorted((str(i), 0 if i is None else sum(bool(link(sets[k], sets[j])) for j in range(len(rows)) if j != k and rows[j][0] is not None)) for k, (i, _) in enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((str(r["doc_id"]), r["n_links"]) for r in ngram_join.ngram_links(df).collect())
    assert got == want and max(n for _, n in want) > 3
