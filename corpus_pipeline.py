"""Corpus preparation: five stages over ``documents``, each on all that the one before kept.

Every stage but the last returns the columns of ``documents``. A stage's
result is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablescout.llm import decontaminate, langid, linededup, packing, simhash
from tablescout.llm.common import discard, in_fold, small_arrow_batches, stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; rejected ones go, and with them null texts and texts without a letter."""
    small_arrow_batches(spark)
    return langid.keep_identified(docs, learn=~in_fold(F.col("doc_id"), 4, 2))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go, and documents that have none left; blank and null texts stay."""
    small_arrow_batches(spark)
    return linededup.remove_repeated_lines(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays; texts without words are one group."""
    small_arrow_batches(spark)
    return simhash.keep_one(docs, words=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go; texts without words hold none."""
    small_arrow_batches(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window_words=10)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their sequences and places; a null text is empty."""
    small_arrow_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Trained models, tokenizers and similarity components are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from ``documents`` to the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, stored(stage(spark, docs, sf_dir))
        if n:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
