"""A training corpus from raw documents, in five stages; each reads what the stage before it has written."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import language, minhash, mixing, sharding, tables, winnow


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null texts and texts without letters."""
    return language.known_language(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near copies, once."""
    return minhash.without_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which a twentieth or more lies in benchmark passages."""
    return winnow.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents so that sources reach their weights, in random order."""
    return mixing.mixed(docs).select(*docs.columns)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds slot and shard."""
    return sharding.placed(docs)


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("contamination", drop_contaminated),
    ("mixture", mix_sources),
    ("shards", assign_shards),
]

#: SQL cannot express the learned language filter: the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of a folder. Stages are written to the shared folder in between."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    run_id = uuid.uuid4().hex
    for name, stage in STAGES:
        path = f"{tables.folder(spark)}/corpus-{run_id}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
