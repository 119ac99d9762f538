"""A training corpus from raw documents: language ID, near-dedup, pseudonyms, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import common, language_id, mixing, packing, pii, probminhash_dedup

MARGIN = 0.001  # texts whose two best languages come within a thousandth are rejected


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a clear language stay; texts that are null or have no letter, or are in between, go."""
    return language_id.accepted(docs, language_id.learn(docs), MARGIN)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return probminhash_dedup.one_of_each(docs)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms."""
    return pii.pseudonyms(docs, counts=False)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated towards the weights of their sources."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [("language ID", identify), ("near-dedup", deduplicate), ("pseudonyms", pseudonymise), ("mixing", mix), ("packing", pack)]
ORACLE_SQL = None  # compression, hashing and a tokenizer are beyond SQL; the tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
