"""A corpus from documents to shards, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixwright.llm import decontamination, mixing, quality, sharding, simhash
from mixwright.llm.common import land, read_table

SHARDS = 8


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier rejects."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops all documents of a near-duplicate group but the one with the smallest id."""
    return simhash.keep_first(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontamination.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix does."""
    return mixing.apply_mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents of the mix: doc_id, size, text_crc32, law, shard, slot."""
    return sharding.shard_documents(docs, leaves=SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot"
    )


STAGES = [
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", keep_one_of_each_group),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("mix_sources", mix_sources),
    ("sharding", shard),
]

# Learned scores and XXH64 fingerprints have no SQL form; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir))
    return docs
