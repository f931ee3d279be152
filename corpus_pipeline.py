"""A corpus pipeline of five text operators, each stage working on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import mixing, order_minhash, quality_outliers, template_leaks, token_files
from skyledger.llm.common import settle
from skyledger.llm.queries import tokenizer_path
from skyledger.llm.shipping import ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counted rules and the outlier rule keep."""
    ship_package(spark)
    return quality_outliers.keep_documents(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the least id."""
    ship_package(spark)
    return order_minhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaked."""
    ship_package(spark)
    return template_leaks.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    ship_package(spark)
    return mixing.repeat_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of the mix, read back: doc_id, start, n_tokens, ids_crc32 of every repetition."""
    ship_package(spark)
    return token_files.round_trip(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality), ("dedup", dedup), ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens),
]

#: The quality estimates, the sketches and the tokenizer are not expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each result written as Parquet and read back for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = settle(docs, f"pipeline-{name}")
    return docs
