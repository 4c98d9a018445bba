"""Corpus pipeline: quality rules, near duplicates, benchmark passages, mixing, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Between
stages the rows are written as Parquet to the shared folder and read again. Stages are filters and rewrites on
whole tables; edge cases are those of the operators that they call.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from berthlake.llm import decontamination, jaccard_join, mixing, quality, sharding
from berthlake.llm.storage import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the quality model reject go."""
    return quality.kept_docs(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard_join.one_of_each_group(docs.select(COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that mostly consist of them go."""
    return decontamination.decontaminate(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, at most twice as often as the largest; no document is lost."""
    return mixing.mix(docs.select(COLUMNS)).select(COLUMNS)


def key_sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard and its slot in it."""
    return sharding.assign(docs.select(COLUMNS), shards=8)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("key_sharding", key_sharding),
]

# the quality model and the suffix automaton have no SQL form; tests compare the run with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
