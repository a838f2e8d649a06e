"""A training-data pipeline over the corpus operators: filter, deduplicate, decontaminate, mix and shard documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import decontaminate, minhash, mixing, quality, sharding
from gridloom.llm.common import cut, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of five words, similarity 0.8 or more."""
    return minhash.kept_documents(docs, k=5, threshold=0.8)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    return decontaminate.kept_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.draw(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document goes: doc_id, size, CRC, law, shard and slot."""
    return sharding.shard(docs, shards=8)


STAGES = [("quality", quality_filter), ("near_dedup", near_dedup), ("decontamination", decontaminated), ("mixing", mixed), ("sharding", sharded)]
#: Language models, near-duplicate components and bin packing are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
