"""A training corpus from raw documents: five stages, each written as Parquet and read again.

1. quality: documents that fail the base rules or lie outside the robust estimates of their
   language and source go.
2. near duplicates: one document of each group of near copies stays.
3. decontamination: documents that hold a benchmark item go.
4. mixing: words are taken source by source to the target weights; a row per document and pass.
5. sharding: a uniform shuffle into 40 shards of equal row counts.

Every stage takes null ids, texts, languages and sources, empty and very long texts, ties, repeated
rows, empty tables and further columns of any name; all but the last return the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, jaccard, mixing, quality, sharding
from tidemark.llm.common import staged

SHARDS = 40


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without the rows that fail the base rules or whose statistics lie outside their language's and
    source's estimate.  Null and blank texts have fewer than 50 words and go; repeated rows stay or go
    together."""
    return quality.reject(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies, that of the least doc_id (null last); rows without words
    stay; of rows that repeat id and text one stays."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without the rows that hold an item of the table benchmark within its edit bound; null texts stay."""
    return decontaminate.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each document and pass with the words that the mix takes; documents of which it takes none,
    those without words among them, have no row.  A null source is a source of its own."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with shard and slot; null ids and texts are values like others."""
    return sharding.shard(docs, SHARDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mixing", source_mixing),
    ("sharding", shards),
]

#: No stage's estimates, hashes or draws can be put in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
