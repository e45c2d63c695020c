"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from turnstile.llm import (
    decontaminate,
    knn_quality,
    lexical_search,
    line_crf,
    minhash,
    packing,
    phrases,
    pseudo_likelihood,
    resampling,
    secret_scan,
    sharding,
    token_files,
    vector_search,
)
from turnstile.llm.common import read

Runner = Callable[[SparkSession, str], DataFrame]


def over_documents(operator: Callable[[DataFrame], DataFrame]) -> Runner:
    return lambda spark, sf_dir: operator(read(spark, sf_dir, "documents"))


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_passages(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.line_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_quality.quality_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.nearest_vectors(read(spark, sf_dir, "embeddings"))


def lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Runner]:
    return {
        "op1_histogram_shards": over_documents(sharding.shard_report),
        "op2_token_files": over_documents(token_files.token_report),
        "op3_knn_quality": quality,
        "op4_pseudo_likelihood": over_documents(pseudo_likelihood.score_documents),
        "op5_phrase_automata": over_documents(phrases.repeat_report),
        "op6_minhash_join": over_documents(minhash.near_duplicates),
        "op7_line_crf": lines,
        "op8_simhash_windows": passages,
        "op9_cost_packing": over_documents(packing.piece_report),
        "op10_secret_scan": over_documents(secret_scan.secret_report),
        "op11_columnar_search": neighbours,
        "op12_rmq_search": lexical,
        "op13_prefix_crc": importance,
    }
