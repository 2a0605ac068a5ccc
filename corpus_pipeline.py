"""A corpus from documents to tokens: five stages, each written as Parquet and read again by the next.

All stages but the last return the columns of their input. Each holds its own rules for NULLs, empty texts and repeated rows;
see the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import decontaminate, minhash, mixing, quality, tokens
from ledgerlake.llm.shared import documents, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays."""
    return minhash.keep_leaders(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.take_mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids, read back from token files."""
    return tokens.encoded(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mix_sources),
    ("token-ID output", token_output),
]

#: Knapsack and tokenizer cannot be said in SQL; tests compare the whole run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
