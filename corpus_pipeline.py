"""From raw documents to shuffled training shards, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents that it keeps; the last one
adds the place of every document. Between stages the documents are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from legwork.llm import decontaminate, mixing, quality, sharding, simhash
from legwork.session import apply_defaults, cut_to_table

SHARDS = 40
SIMILARITY = 0.8


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the strict policy."""
    return quality.passing(docs, quality.STRICT)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, 0.8 alike or more."""
    return simhash.one_per_group(docs, width=5, similarity=SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with shard and slot."""
    return sharding.shard_rows(docs, SHARDS, seed=1)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("shards", shards),
]

#: The fingerprints (XXH64) and the shuffle are beyond SQL; tests hold the stages against
#: brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_defaults(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_to_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
