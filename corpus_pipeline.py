"""Corpus pipeline over ``documents``: language id, line dedup, SimHash near-dedup, decontamination, packing.

Each stage takes all that its predecessor kept, stored as Parquet in the shared
folder; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import decontaminate, lang_id, line_dedup, packing, simhash
from ledgerline.llm.common import staged


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter or in none of the learned languages (all, if ``docs`` names no language)."""
    return lang_id.keep_identified(docs, lang_id.train(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes lines that are similar to an earlier line; drops documents left without any."""
    return line_dedup.drop_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash group."""
    return simhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that overlap a benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences."""
    return packing.pack(docs)


STAGES = [("language id", language), ("line dedup", lines), ("near-duplicates", near_duplicates),
          ("decontamination", benchmark), ("packing", pack)]

#: Fingerprints, learned models and best-fit packing aren't SQL; the tests hold
#: each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
