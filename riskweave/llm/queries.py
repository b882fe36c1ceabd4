"""Registered queries of the corpus operators over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import (
    bestpos, bpe, langid, latent, licences, ordermin, permutation, phrases, resample, secrets, shards, treebpe, warc)
from riskweave.llm.tables import table


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file of the BPE queries; every worker must be able to read it there."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))
    whole = F.concat("header", F.lit(warc.END), "block")
    return records.withColumn("record_sha256", F.sha2(whole.cast("binary"), 256)).drop("header", "block")


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordermin.near_classes(table(spark, sf_dir, "documents")).drop("class_key", "text_md5")


def op3_entropy_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op4_licence_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.report(table(spark, sf_dir, "documents"))


def op5_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_batched_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), vocabulary())


def op7_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"))


def op8_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latent.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_md5")


def op9_importance_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents")).drop("distance")


def op11_segment_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treebpe.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))


def op12_best_position_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestpos.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_phrase_subtrees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_warc_derivatives, op2_order_minhash, op3_entropy_secrets, op4_licence_paragraphs, op5_permutation_index,
    op6_batched_bpe, op7_jump_shards, op8_latent_leaks, op9_importance_sample, op10_rank_order_language,
    op11_segment_tree_bpe, op12_best_position_search, op13_phrase_subtrees)}
ORACLES: dict[str, str] = {
    "op7_jump_shards": shards.assign_sql(), "op12_best_position_search": bestpos.rank_sql(),
    "op13_phrase_subtrees": phrases.collocations_sql()}
