"""The registered queries of this package: each operator over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import (
    language,
    lexical,
    minhash,
    mixing,
    pieces,
    prefix_free,
    quality,
    secrets,
    sharding,
    suffix_tree,
    toxicity,
    whitening,
    winnow,
)
from starmart.llm.sql import SQL  # noqa: F401  (registered with the queries)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir), labels(spark, sf_dir))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_copies(documents(spark, sf_dir))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.digest(suffix_tree.without_repeated_passages(documents(spark, sf_dir)))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.digest(winnow.contamination(documents(spark, sf_dir), benchmark(spark, sf_dir)))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placed(documents(spark, sf_dir)).select("doc_id", "source", "slot", "shard")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(documents(spark, sf_dir))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.secrets(documents(spark, sf_dir)))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_free.digest(prefix_free.without_repeated_bytes(documents(spark, sf_dir)))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rated(documents(spark, sf_dir), labels(spark, sf_dir))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(embeddings(spark, sf_dir))


def op12(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    model = pieces.read_model(path)
    return pieces.digest(pieces.decoded(pieces.encoded(documents(spark, sf_dir), model), model))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(documents(spark, sf_dir), benchmark(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1,
    "op2_minhash_near_dedup": op2,
    "op3_substring_dedup": op3,
    "op4_benchmark_decontamination": op4,
    "op5_sharding": op5,
    "op6_source_mixing": op6,
    "op7_language_id": op7,
    "op8_secret_scans": op8,
    "op9_suffix_array_dedup": op9,
    "op10_toxicity": op10,
    "op11_embedding_whitening": op11,
    "op12_sentencepiece": op12,
    "op13_lexical_search": op13,
}
