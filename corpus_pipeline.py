"""From raw documents to training shards: each stage works on all that the one before kept.

``run`` applies the stages to ``documents``; every stage's result is written as Parquet to the shared
folder and read again as the next one's documents. All but the last return the columns of
``documents`` (with whatever further columns the table has); the last adds shard and slot.

Nulls, empty texts, repeated rows and empty tables are handled by the stages' operators as their
texts say. Two things hold for all: rows with a null text have no words, no near duplicates and no
leaks, and stay until the mix, which takes only documents that have words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimweft.llm.common import ship_package, stage_table, table
from claimweft.llm.importance import resample
from claimweft.llm.leaks import decontaminate
from claimweft.llm.mixing import apply_mix
from claimweft.llm.neardup import deduplicate
from claimweft.llm.sharding import histogram_sort


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling towards the labelled good documents; what isn't drawn goes."""
    ship_package(spark)
    kept = resample(docs, table(spark, sf_dir, "labels"))
    return kept.select(*[f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    ship_package(spark)
    return deduplicate(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, or a paraphrase of one, go."""
    ship_package(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the block mix to target weights takes their words."""
    ship_package(spark)
    return apply_mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Forty shards of nearly equal bytes, with shard and slot as further columns."""
    return histogram_sort(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("source_mix", source_mix),
    ("shards", shards),
]

#: The stages train models, sign sets and search a latent space: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
