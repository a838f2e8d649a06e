"""The registered queries of the corpus operators: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, forest, licenses, minhash, mixing, negatives, packing, quality, repair, secrets, sharding, substrings, templates
from .common import table


def op1_license_scan(spark: SparkSession, sf_dir: str, known: DataFrame | None = None) -> DataFrame:
    """``known`` may be a table of (digest, license) in place of the fixed one."""
    return licenses.report(licenses.scan(table(spark, sf_dir, "documents"), known))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.findings(docs, secrets.scan_new(docs)))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, threshold=0.85)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract(table(spark, sf_dir, "pages"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=8)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(mixing.mix(table(spark, sf_dir, "documents")))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """``tokenizer``: a tokenizer's file in place of the public one."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.digest(packing.pack(packing.pieces(table(spark, sf_dir, "documents"), tokenizer, with_ids=False)))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(negatives.relabelled(table(spark, sf_dir, "embeddings")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_license_scan, op2_secret_scan, op3_minhash_near_dedup, op4_decontamination, op5_html_extraction, op6_embedding_near_dedup, op7_sharding, op8_quality_classifier, op9_mixing, op10_substring_dedup, op11_packing, op12_hard_negatives, op13_conversation_repair)}
ORACLES: dict[str, str] = {"op1_license_scan": licenses.oracle(), "op12_hard_negatives": negatives.oracle(), "op13_conversation_repair": repair.oracle()}
