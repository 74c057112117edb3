"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decision_list, decontaminate, impact_search, merkle, phrases, prefix_counts, quality, repeats, simhash, tag_paths, token_files, warc
from .common import read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


@query
def op1_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.tokenise_to_files(read(spark, folder, "documents"), token_files.default_path())


@query
def op4_prefix_counts(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_counts.token_budget(read(spark, folder, "documents"), bpe.default_path(), limit=1024)


@query
def op9_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip_digests(read(spark, folder, "documents"), bpe.default_path())


@query
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"))


@query
def op7_repeated_windows(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.removal_digests(read(spark, folder, "documents"))


@query
def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


ORACLES["op8_decontaminate"] = decontaminate.ORACLE


@query
def op5_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return tag_paths.extract(read(spark, folder, "pages"))


@query
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_and_read(read(spark, folder, "pages"))


ORACLES["op10_warc"] = warc.ORACLE


@query
def op6_impact_search(spark: SparkSession, folder: str) -> DataFrame:
    return impact_search.top_k(read(spark, folder, "embeddings"), lambda vec_id: vec_id % 100 == 0)


ORACLES["op6_impact_search"] = impact_search.ORACLE


@query
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.documents_manifest(read(spark, folder, "documents"))


ORACLES["op11_merkle_manifest"] = merkle.ORACLE


@query
def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(read(spark, folder, "documents"))


ORACLES["op12_phrases"] = phrases.ORACLE


@query
def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return decision_list.quality_rules(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline  # at the repository's top; an installed package lacks it

    return corpus_pipeline.run(spark, folder)
