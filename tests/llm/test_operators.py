"""The corpus operators against brute force, on small tables with nulls, ties, empty and very long texts."""

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from threadloom.llm import bpe, embedding_dedup, fingerprints, licenses, mixing, ngram_join, quality, substring_dedup, toxicity, warc
from threadloom.llm.common import components

WORD = r"[^\x20\x09-\x0D]+"


def words(rng, n, size=400):
    return " ".join(f"w{rng.integers(size)}x" for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(5)
    base = [words(rng, int(rng.integers(1, 120)), 4000) for _ in range(60)]
    long = words(rng, 30_000, 9000)
    out = list(base)
    for b in base[:25]:  # near copies: one word changed, and exact ones
        w = b.split(" ")
        w[int(rng.integers(len(w)))] = "changed"
        out += [" ".join(w), b, b.upper()]
    passage = words(rng, 60, 4000)
    out += [f"{words(rng, 30, 4000)} {passage} {words(rng, 40, 4000)}" for _ in range(5)]
    out += [None, "", "  \n", "one", "one", "one two three four", "a" * 5000, "é" * 3000 + " ü", long, long + " tail", "short text", passage]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, ["en", None, "de"][i % 3], [f"src{i % 4}", None, "src0"][i % 3], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [(None, "no id here", "en", "src1", 10), rows[3]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def shingles(t, n=5):
    w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def closure(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1100)]
    want = closure({x for e in edges for x in e}, edges)
    from threadloom.llm import common

    for size in (common.EDGES_PER_TASK, 40):  # one forest; many, joined by stars
        old, common.EDGES_PER_TASK = common.EDGES_PER_TASK, size
        got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        common.EDGES_PER_TASK = old
        assert got == {k: v for k, v in want.items() if k != v}


def test_ngram_join(spark, docs, texts):
    sets = {i: shingles(t) for i, t in enumerate(texts)}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = closure(sets, links)
    rows = ngram_join.ngram_classes(docs).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["n_shingles"] == 1
        else:
            assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]]), r
    kept = [r["doc_id"] for r in ngram_join.drop_near_duplicates(docs).collect()]
    assert collections.Counter(kept) == collections.Counter([i for i in want if want[i] == i] + [None])  # one row, also of repeated ones


def test_ngram_join_groups_of_different_lists(spark):
    # Many sets share a passage: their lists hold several groups, so pairs of groups are verified.
    rng = np.random.default_rng(2)
    passage = words(rng, 40, 900)
    texts = [f"{passage} {words(rng, int(rng.integers(4, 14)), 50)}" for _ in range(80)]
    sets = dict(enumerate(map(shingles, texts)))
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = closure(sets, links)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (ngram_join.LIST_BLOCK, 5):  # whole lists, and pairs of blocks
        old, ngram_join.LIST_BLOCK = ngram_join.LIST_BLOCK, block
        try:
            assert {r["doc_id"]: r["component_id"] for r in ngram_join.ngram_classes(df).collect()} == want
        finally:
            ngram_join.LIST_BLOCK = old


def test_lists_are_streamed_over_batches():
    import pyarrow as pa

    rng = np.random.default_rng(8)
    rows = sorted({(int(x), int(y)) for x, y in rng.integers(0, 12, (60, 2))} | {(50, k) for k in range(40)})
    rows = [(x, y, (10 << 32) + 0, 0, None) for x, y in rows for _ in range(1 + y % 2)]
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("c", pa.int64()), ("doc", pa.int64()), ("par", pa.binary())])
    found = []
    for step in (1, 2, 3, 7, 1000):
        batches = [pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows[k : k + step], strict=True), schema, strict=True)], schema=schema) for k in range(0, len(rows), step)]
        out = [tuple(r.values())[:3] for b in ngram_join._stars(80)(iter(batches)) for r in b.to_pylist()]
        found.append((sorted(set(o for o in out if o[0] == 0)), sorted(o for o in out if o[0] == 2)))
    lists = collections.defaultdict(set)
    for x, y, *_ in rows:
        lists[x].add(y)
    assert all(f == found[0] for f in found)
    assert found[0][0] == sorted({(0, y, min(ys)) for ys in lists.values() for y in ys if y != min(ys)})
    assert found[0][1] == sorted((2, x, y) for x, ys in lists.items() for y in ys if len(ys) > 2)


def test_parities_never_drop_a_match():
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 3000))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > rng.random() * 0.25], rng.integers(0, 1 << 63, int(n * rng.random() * 0.2)).astype(np.uint64)]))
        if not len(b):
            continue
        common = len(np.intersect1d(a, b))
        match = 100 * common >= 80 * (len(a) + len(b) - common)
        pa, pb = (np.frombuffer(ngram_join.parity(x), np.uint64) for x in (a, b))
        assert not match or ngram_join.may_match(pa, [pb], len(a), np.array([len(b)]), 80)[0]


def vectors():
    rng = np.random.default_rng(4)
    base = rng.standard_normal((120, 16))
    rows = list(base)
    for k in range(30):
        rows += [base[k] * 2.5 + rng.standard_normal(16) * 0.2, base[k].copy()]
    centre = rng.standard_normal(16)
    rows += [centre + rng.standard_normal(16) * 0.05 for _ in range(150)]
    return [r.astype(float).tolist() for r in rows]


def test_embeddings(spark):
    good = vectors()
    rows = list(enumerate(good)) + [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [None] + [1.0] * 15), (1004, [float("nan")] + [1.0] * 15), (1005, [float("inf")] * 16), (1006, [1.0, 2.0]), (1007, [2.0, 4.0]), (None, good[0])]
    v = np.array(good)
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    hit = (u @ u.T) >= 0.95
    want = closure(range(len(v)), [(int(a), int(b)) for a, b in zip(*np.nonzero(hit), strict=True)])
    got = {r["vec_id"]: r for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect()}
    assert len(got) == len(rows)
    for i in range(len(v)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (int(hit[i].sum()) - 1, want[i], want[i] == i)
    for i in range(1000, 1006):
        assert (got[i]["n_links"], got[i]["component_id"]) == (0, i)
    assert (got[1006]["n_links"], got[1007]["component_id"]) == (1, 1006)
    assert got[None]["component_id"] is None and got[None]["n_links"] == 0
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_embedding_blocks(spark):
    good = vectors()
    old, embedding_dedup.BLOCK = embedding_dedup.BLOCK, 40
    try:
        rows = embedding_dedup.near_vectors(spark.createDataFrame(list(enumerate(good)), "vec_id long, embedding array<double>")).collect()
    finally:
        embedding_dedup.BLOCK = old
    u = np.array(good) / np.linalg.norm(good, axis=1, keepdims=True)
    links = ((u @ u.T) >= 0.95).sum(1) - 1
    assert {r["vec_id"]: r["n_links"] for r in rows} == dict(enumerate(links.tolist()))


def test_toxicity_learns_and_handles_edges(spark):
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 3 == 0
        w = words(rng, 40, 300).split(" ")
        if toxic:
            for _ in range(4):
                w[int(rng.integers(40))] = ["idiotic", "moronic", "vilest"][int(rng.integers(3))]
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(9000, None), (9001, ""), (9002, "x" * 50_000), (None, "moronic")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    lab = spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(df, lab).collect()}
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, y in held]) > 0.95
    assert got[9000] == got[9001] < 0.5
    none = toxicity.score_toxicity(df, lab.where("toxic = 0"))
    assert {r["score"] for r in none.collect()} == {0.0}
    assert toxicity.score_toxicity(df.limit(0), lab.limit(0)).count() == 0


def test_quality_rules(spark):
    rng = np.random.default_rng(7)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        t = words(rng, 30, 500)
        rows.append((i, t.upper().replace(" ", "!! ") if bad else t))
        labels.append((i, int(not bad)))
    rows += [(900, None), (901, ""), (902, "z" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit_quality(df, lab)
    assert 0 < len(model["rules"]) < 150
    got = {r["doc_id"]: r["_score"] for r in quality.score_quality(df, model).collect()}
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.3) == bool(y) for i, y in held]) > 0.97
    assert all(0 <= s <= 1 for s in got.values()) and got[900] == got[901]
    # The compiled column is the model: rules evaluated by hand give the same score.
    stats = {r["doc_id"]: [r[f"_{s}"] for s in quality.STATS] for r in quality.with_statistics(df).collect()}
    for i in list(got)[::37]:
        z = model["bias"] + sum(w for rule, w in model["rules"] if all((stats[i][f] > c) == bool(s) for f, s, c in rule))
        assert abs(got[i] - 1 / (1 + np.exp(-z))) < 1e-9
    assert {r["_score"] for r in quality.score_quality(df, quality.fit_quality(df, lab.limit(0))).collect()} == {0.5}


def chunks_by_hand(text, least, most, bits):
    """Cuts and digests of one text, byte by byte."""
    from threadloom.llm.common import BYTE_KEYS, WS

    b = text.encode()
    ends, last, h = [], 0, 0
    marks = []
    for i, x in enumerate(b):
        h = ((h << 1) + int(BYTE_KEYS[x] >> np.uint64(32))) & 0xFFFFFFFF
        if WS[x] and h >> (32 - bits) == 0:
            marks.append(i + 1)
    for c in [*[m for m in marks if m < len(b)], len(b)]:
        while c - last > most:
            cut = last + most
            while cut > last + 1 and b[cut] & 0xC0 == 0x80:
                cut -= 1
            ends.append(cut)
            last = cut
        if c < len(b) and c - last >= least:
            ends.append(c)
            last = c
    if len(b) > last:
        ends.append(len(b))
    return b, [(s, e) for s, e in zip([0, *ends], ends)]


def test_substring_dedup(spark, docs, texts):
    S = substring_dedup
    first, cut = {}, {}
    for i, t in enumerate(texts):
        b, spans = chunks_by_hand(t or "", S.LEAST, S.MOST, S.BITS)
        hit = []
        for s, e in spans:
            hit.append((b[s:e] in first))
            first.setdefault(b[s:e], (i, s))
        out, k = [], 0
        while k < len(hit):
            e = k
            while e < len(hit) and hit[e] == hit[k]:
                e += 1
            piece = b[spans[k][0] : spans[e - 1][1]]
            if not (hit[k] and len(piece.split()) >= S.MIN_WORDS):
                out.append(piece)
            k = e
        cut[i] = None if t is None else b"".join(out).decode()
    rows = S.remove_repeats(docs).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        assert r["text"] == ("no id here" if r["doc_id"] is None else cut[r["doc_id"]])
        if r["doc_id"] is not None and r["text"] is not None:
            assert r["_chars_removed"] == len(texts[r["doc_id"]]) - len(r["text"])
    # Passages that repeat are taken out of all but the first, however they are shifted.
    assert sum(r["_chars_removed"] > 0 for r in rows if r["doc_id"] in range(135, 140)) == 4
    assert S.remove_repeats(docs.limit(0)).count() == 0


def test_substring_blocks_agree(spark, docs):
    old, substring_dedup.BLOCK = substring_dedup.BLOCK, 7
    try:
        a = sorted((r["doc_id"] or -1, r["text"] or "") for r in substring_dedup.remove_repeats(docs).collect())
    finally:
        substring_dedup.BLOCK = old
    assert a == sorted((r["doc_id"] or -1, r["text"] or "") for r in substring_dedup.remove_repeats(docs).collect())


def test_fingerprints(spark, docs, texts):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    pieces = lambda p: re.sub("([s.,;:!?] )", "\\1\x01", p).split("\x01")
    below = lambda p: "".join(sha("l" + x) for x in pieces(p))
    root = lambda t: sha("r" + "".join(sha("s" + "".join(sha("p" + below(p)) for p in s.split("\n"))) for s in t.split("\n\n")))
    leaf = lambda t: {x for p in t.split("\n") for x in pieces(p)}
    like = lambda a, b: len(leaf(a) & leaf(b)) / len(leaf(a) | leaf(b))
    order = [(None, "no id here"), *enumerate(t or "" for t in texts)]
    want = {}
    for k, (i, t) in enumerate(order):
        n = order[(k + 1) % len(order)][1]
        e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        differ = [j for j, (x, y) in enumerate(itertools.zip_longest(*([p for s in v.split("\n\n") for p in s.split("\n")] for v in (t, e)))) if x != y and x is not None]
        want[i] = (len(t), sha(e), root(t), root(e), like(t, e), like(t, n), (differ or [None])[0] if t != e else None)
    rows = fingerprints.fingerprint_documents(docs).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        assert all(x == y or x is not None and y is not None and abs(x - y) < 1e-12 for x, y in zip(tuple(r)[1:], want[r["doc_id"]], strict=True)), r
    assert fingerprints.fingerprint_documents(docs.limit(0)).count() == 0
    alone = fingerprints.fingerprint_documents(docs.where("doc_id = 3").limit(1)).first()
    assert alone["near_next"] == 1.0
    from pyspark.sql import functions as F

    d = spark.createDataFrame([("a\nb\n\nc", "a\nx\n\nc")], "a string, b string").select(fingerprints.differing_paragraphs(*(fingerprints.paragraph_digests(fingerprints.leaf_tree(F.col(c))) for c in "ab")).alias("d")).first()
    assert d["d"] == [1]


def test_bpe(spark, docs, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = ["a<|endoftext|>b <|endoftext|>", "  lead\t\ttabs  \n\n x", "日本語 テキスト" * 900, "don't I'll we've 12345 !!!", "x" * 9000 + " y", "　wide spaces ", "é \U0001f600\U0001f468‍\U0001f469"]
    rows = list(enumerate([*texts, *odd]))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for knobs in ({}, {"least": 8, "most": 24, "bits": 1}):  # with forced cuts nearly everywhere: joins are repaired
        got = {r["doc_id"]: r for r in bpe.encode(df, **knobs).collect()}
        for i, x in rows:
            ids = t.encode(x or "", add_special_tokens=False).ids
            assert got[i]["token_ids"] == ids and got[i]["n_tokens"] == len(ids)
            assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert got[i]["decoded_sha256"] == hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode(df.limit(0)).count() == 0


def test_warc(spark, tmp_path):
    import base64

    pages = [(i, f"http://x/{i}", h) for i, h in enumerate(["<p>a</p>", "<p>a</p>", "", None, "<p>b</p>", "é" * 40_000, "<p>a</p>", "\r\n\r\n", "WARC/1.1\r\n\r\n"])] + [(100, None, "<p>b</p>"), (101, "http://x/\nb c", "z"), (None, "u", "<p>q</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    out = f"file://{tmp_path}/w"
    manifest = warc.write_archives(df, out, shard_bytes=20_000, roll_bytes=500).collect()
    assert len(manifest) > 2 and sum(m["records"] for m in manifest) == len(pages)
    import pathlib

    files = {p.name: p.read_bytes() for p in pathlib.Path(tmp_path, "w").iterdir() if p.name.endswith(".gz")}
    assert not [p for p in pathlib.Path(tmp_path, "w").iterdir() if p.name.endswith(".tmp")]
    assert {m["file"]: m["sha256"] for m in manifest} == {k: hashlib.sha256(v).hexdigest() for k, v in files.items()}
    warc.write_archives(df, out, shard_bytes=20_000, roll_bytes=500)
    assert {p.name: p.read_bytes() for p in pathlib.Path(tmp_path, "w").iterdir() if p.name.endswith(".gz")} == files
    rows = {r["page_id"]: r for r in warc.read_archives(spark, out).collect()}
    top = {}
    for i, _, h in pages:
        if i is not None:
            top[h or ""] = max(top.get(h or "", -1), i)
    for i, _, h in pages:
        payload = (h or "").encode()
        assert rows[i]["payload_bytes"] == len(payload)
        assert rows[i]["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first = i is None or top[h or ""] == i
        assert (rows[i]["record_type"], rows[i]["refers_to"]) == (("response", None) if first else ("revisit", top[h or ""]))
        if first:
            assert rows[i]["html"] == (h or "")
    empty = f"file://{tmp_path}/e"
    assert warc.write_archives(df.limit(0), empty).count() == 0 and warc.read_archives(spark, empty).count() == 0


def test_licenses(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.c", "int x;"), (3, "a/b/y.c", "// Licensed under the Apache License, Version 2.0.\ncode"), (4, "z.c", "nothing"),
        (5, "a/b/LICENSE", "This work is licensed under the GNU General Public License, version 3."), (6, "a/c/d/e.c", None), (7, None, "Released under the MIT License."), (8, None, ""), (9, "LICENSE", "see the licence of the shop"), (10, "a/b/x.c", "int x;"),
    ]
    got = {r["doc_id"]: r for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    assert {i: (r["license"], r["origin"], r["given_by"]) for i, r in got.items()} == {
        1: ("MIT", "header", None), 2: ("GPL-3.0", "inherited", "a/b/LICENSE"), 3: ("Apache-2.0", "header", None), 4: (None, "none", None), 5: ("GPL-3.0", "header", None),
        6: ("MIT", "inherited", "a/LICENSE"), 7: ("MIT", "header", None), 8: (None, "none", None), 9: (None, "none", None), 10: ("GPL-3.0", "inherited", "a/b/LICENSE")}
    # Cosines by hand.
    idf, unknown, model = licenses.template_model()
    for i, piece in ((3, "// Licensed under the Apache License, Version 2.0."), (5, rows[4][2])):
        tf = collections.Counter(licenses.terms(piece))
        w = {t: k * idf.get(t, unknown) for t, k in tf.items()}
        norm = sum(x * x for x in w.values()) ** 0.5
        assert got[i]["score"] == pytest.approx(max(sum(w.get(t, 0) * x for t, x in m.items()) / (norm * n) for _, m, n in model), abs=1e-8)


def test_mixing(spark, docs, texts):
    items = [(i, [f"src{i % 4}", None, "src0"][i % 3], len(re.findall(WORD, t or ""))) for i, t in enumerate(texts)]
    items += [(None, "src1", 3), items[3]]
    size = collections.Counter()
    for _, s, n in items:
        size[s] += n
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(size.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 3 * size[s]}
        if not full:
            target |= share
            break
        target |= {s: 3.0 * size[s] for s in full}
        left -= sum(3 * size[s] for s in full)
        open_ -= full
    from pyspark.sql import functions as F

    plan = mixing.plan_mix(docs.select("doc_id", "source", mixing.size_of(F.col("text")).alias("size"))).collect()
    taken, biggest = collections.Counter(), collections.Counter()
    for r in plan:
        s = None if r["_mix_key"] == "1" else r["_mix_key"][1:]
        assert r["target"] == pytest.approx(target[s]) and r["source_size"] == size[s] and 0 <= r["copies"] <= 3
        taken[s] += r["copies"] * r["size"] * r["n"]
        biggest[s] = max(biggest[s], r["size"] * r["n"])
    assert all(abs(taken[s] - target[s]) <= biggest[s] for s in order)
    mixed = mixing.mix_documents(docs).collect()
    again = mixing.mix_documents(docs.repartition(5)).collect()
    key = lambda rows: sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in rows)
    assert key(mixed) == key(again) and mixed[0].__fields__ == docs.columns
    assert len(mixed) == sum(r["copies"] * r["n"] for r in plan)
    assert mixing.mix_documents(docs.limit(0)).count() == 0


def test_inverse_demand(spark):
    from pyspark.sql import functions as F

    knots = [(0.0, 2.0), (0.3, 0.5), (1.0, 1.0)]
    grid = np.linspace(0, 1, 200_001)
    w = np.interp(grid, *zip(*knots, strict=True))
    area = np.concatenate([[0], np.cumsum((w[1:] + w[:-1]) / 2 * np.diff(grid))])
    shares = [0.0, 0.1, 0.35, 0.5, 0.77, 1.0]
    got = [r[0] for r in spark.createDataFrame([(s,) for s in shares], "s double").select(mixing.inverse_demand(knots, F.col("s"))).collect()]
    assert got == pytest.approx(np.interp(np.array(shares) * area[-1], area, grid).tolist(), abs=1e-4)
