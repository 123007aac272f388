"""From raw documents to shards: quality, near-duplicates, benchmark passages, source weights, shards.

Each stage is ``function(spark, docs, sf_dir) -> DataFrame``. Its result is written
as Parquet to the shared folder and read again as the next one's ``docs``, so a lost
executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adlake.llm import decontaminate, mixing, quality, shards, simhash
from adlake.llm.common import prepared, table
from adlake.sources.writers import stage


def drop_bad_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counts or the perplexity band of their language reject go."""
    prepared(spark)
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    prepared(spark)
    return simhash.first_of_groups(docs)


def drop_benchmark_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated until each source has its share of words."""
    prepared(spark)
    return mixing.mixed(docs)


def deal_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ``shard`` and their ``slot`` in it, which replace columns of these names."""
    prepared(spark)
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    return shards.shard(docs, kept).select("row.*", "shard", "slot")


STAGES = [
    ("quality", drop_bad_quality),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark_texts),
    ("mix", mix_sources),
    ("shard", deal_into_shards),
]

# SimHash components, the perplexity model and the knapsack are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
