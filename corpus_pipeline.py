"""A training corpus in five stages, each written and read again.

Good texts stay, then one of each group of near copies; passages that repeat
across documents are cut out, documents that leak the benchmark go, and what is
left is encoded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from formloom.llm import bpe, decontaminate, quality, repeats, simhash
from formloom.llm.common import read, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def without_repeated_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(docs)


def without_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(docs, bpe.default_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near_copies", one_of_near_copies),
    ("repeated_windows", without_repeated_windows),
    ("benchmark_leaks", without_benchmark_leaks),
    ("bpe", encoded),
]

#: Training, fingerprints and BPE are beyond SQL; the tests run a plain walk.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
