"""Operator 12 against the library: every prefix of every text encoded anew."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from threadloom.llm import token_counts as tc

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def hard_texts():
    rng = random.Random(3)
    out = ["", " ", "  a ", "\n", "a▁b", "▁", "日本語テキスト", "\U0001f600é\x00a", "</s> <s>", "a" * 300, " " * 100, "ab" * 200, "-" * 77 + "=" * 50, "ﬁ①Å"]
    for letters, size in (("abcdehinorst  \n.-=éß日0123", 200), ("aeinst", 120), ("= -_*#", 120)):
        out += ["".join(rng.choice(letters) for _ in range(rng.randint(1, size))) for _ in range(150)]
    return out


def test_every_prefix(library):
    texts = hard_texts()
    counter = tc.PrefixCounter(open(MODEL, "rb").read())
    for text, counts in zip(texts, counter(texts), strict=True):
        assert counts.tolist() == [len(ids) for ids in library.encode([text[: k + 1] for k in range(len(text))])] if text else not len(counts)
        assert tc.unpack_counts(tc.pack_counts(counts)).tolist() == counts.tolist()


def test_small_tables_forget(library, monkeypatch):
    monkeypatch.setattr(tc, "KEPT", 5)
    monkeypatch.setattr(tc, "TOGETHER", 7)
    counter = tc.PrefixCounter(open(MODEL, "rb").read())
    counter.fit = tc.Pairs(counter._fit, 6)
    texts = hard_texts()
    for k in range(0, len(texts), 20):
        for text, counts in zip(texts[k : k + 20], counter(texts[k : k + 20]), strict=True):
            assert (int(counts[-1]) if text else 0) == len(library.encode(text))


def test_tables(spark, library):
    long = "lorem ipsum " * 30_000
    texts = [*hard_texts()[:40], None, None, long, "same", "same"]
    rows = [(None if i == 3 else i, t, i % 2) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `N_Tokens` int").repartition(5)
    out = tc.count_tokens(docs)
    assert out.columns == ["doc_id", "text", "n_tokens", "prefix_counts", "n_bytes"]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        assert got[i].n_tokens == len(library.encode(t or "")) and got[i].n_bytes == len((t or "").encode())
    budget = 7
    for r in tc.truncate(out, budget).collect():
        t = (r.text or "")[:5000]
        fits = [k for k in range(len(t) + 1) if len(library.encode(t[:k])) <= budget]
        assert r.n_kept == max(fits) and r.kept_text == t[: max(fits)]
    asked = tc.count_at(out.withColumn("at", out.doc_id % 9 - 1), "at").collect()
    assert all(r.tokens_at == (len(library.encode((r.text or "")[: max(r["at"], 0)])) if r["at"] is not None else 0) for r in asked)
    assert tc.count_tokens(docs.limit(0)).count() == 0


def test_query(spark, library):
    from conftest import SF

    got = tc.op12_token_counts(spark, SF).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert len(got) == len(texts)
    for r in got:
        n = len(library.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)
    assert np.any([r.over_limit for r in got])
