"""The corpus pipeline: toxicity, quality, near copies, mixture, packing, each stage on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import mixing, packing, quality, queries, shingle_join, toxicity
from tidemart.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity lexicon, learned from the labelled ones among them, does not reject."""
    return toxicity.harmless(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network, learned from the labelled ones among them, does not reject."""
    return quality.worthy(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that with the least id."""
    return shingle_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the mixture takes them."""
    return mixing.mixed_rows(docs, weights=queries.WEIGHTS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens, which follow the mixture."""
    return packing.pack(docs, queries.byte_bpe(), in_order=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near_copies", drop_copies),
    ("mixture", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  #: scores are learned and packing is sequential, which SQL cannot express


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs if k == 0 else written(docs, name), sf_dir)
    return docs
