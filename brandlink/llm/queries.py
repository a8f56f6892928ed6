"""Registered queries of the training-data operators, ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (licenses, minhash, mixing, ngrams, overlap, phrases, pieces, quality, repair, suffixes, syncmers,
               toxicity, urls)
from .common import table


def op1_trie_score(spark: SparkSession, sf: str) -> DataFrame:
    return ngrams.score_documents(table(spark, sf, "documents"))


def op2_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.drop_repeats(table(spark, sf, "documents")).drop("kept")


def op4_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf, "documents")).drop("spans")


def op5_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents")).drop("source").withColumn(
        "target", F.round("target", 6))


def op6_closed_syncmers(spark: SparkSession, sf: str) -> DataFrame:
    return syncmers.fingerprint_documents(table(spark, sf, "documents"))


def op7_toxicity_chain(spark: SparkSession, sf: str) -> DataFrame:
    out = toxicity.judge_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return out.select("doc_id", "p_low_quality", "p_toxic", "is_toxic")


def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf, "pages")).drop("matched")


def op9_circulant_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf, "documents"))


def op10_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf, "documents"))


def op11_phrase_tiles(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.mine_phrases(table(spark, sf, "documents"))


def op12_structure_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repaired(table(spark, sf, "conversations"))


def op13_count_tree(spark: SparkSession, sf: str) -> DataFrame:
    return overlap.jaccard_groups(table(spark, sf, "documents"))


REGISTRY = {f.__name__: f for f in (
    op1_trie_score, op2_sentencepiece, op3_suffix_dedup, op4_license_scan, op5_source_mix, op6_closed_syncmers,
    op7_toxicity_chain, op8_url_filter,
    op9_circulant_minhash, op10_quality_rules,
    op11_phrase_tiles, op12_structure_repair, op13_count_tree)}
