"""Corpus pipeline: documents in, token ids out, one operator per stage.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet
and read again as the next stage's ``docs``.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import bpe, exact_dedup, mixing, simhash, toxicity
from tidewatch.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model rejects go (operator 10)."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised texts, one stays (operator 1)."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the smallest ``doc_id`` stays (operator 3)."""
    return simhash.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose sources, languages and topics follow their targets (operator 7)."""
    return mixing.sampled(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE ids of every document that is left (operator 9)."""
    return bpe.encode_decode(docs).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

#: SQL cannot express the classifier, the fingerprints' bit votes or the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
