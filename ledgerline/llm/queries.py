"""The subpackage's queries, one for each operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (ann, chat, decontaminate, embeddings, hard_negatives, importance, lang_id, line_dedup, packing, pii, simhash, suffix,
                            toxicity)
from ledgerline.llm.common import crc_mod


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = lang_id.identify(docs, lang_id.train(docs))
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "bits_per_byte")


def op2_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))
    held_out = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op6_suffix_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(_table(spark, sf_dir, "documents"))


def op7_chat_rendering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_control_conversation(_table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.format_conversations(rows))


def op8_bilstm_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(docs))


def op9_subspace_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))


def op11_bit_sliced_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op13_segment_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
    op1_ppm_language, op2_simhash_trie, op3_weak_toxicity, op4_spaced_seeds, op5_best_fit_packing, op6_suffix_grouping, op7_chat_rendering,
    op8_bilstm_pii, op9_subspace_join, op10_line_dedup, op11_bit_sliced_resampling, op12_inverted_multi_index, op13_segment_negatives, pipeline)}
