"""A corpus pipeline: each stage applies one operator to what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadloom.llm import bpe, mixing, ngram_join, quality, substring_dedup
from threadloom.llm.common import materialize, table


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose quality score is under 0.3."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.keep_quality(docs, model, 0.3)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates."""
    return ngram_join.drop_near_duplicates(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages out of the texts."""
    return substring_dedup.drop_passages(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents as often as their source's target asks for, in training order."""
    return mixing.mix_documents(docs)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded text."""
    return bpe.encode(docs).drop("text")


STAGES = [
    ("quality classifier", classify_quality),
    ("n-gram jaccard join", join_near_duplicates),
    ("substring dedup", remove_repeats),
    ("mixing sources", mix_sources),
    ("bpe encoding", encode_bpe),
]

#: The rule ensemble, content-defined chunks and BPE have no SQL form; tests hold each stage against a brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    out = STAGES[-1][1](spark, docs, sf_dir)
    return out.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256")
