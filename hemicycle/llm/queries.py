"""The ten operators' queries, each over the whole of its table, with production parameters.

None has SQL: tokenizers, sketches, suffix structures, factorisations and packing are beyond it. Tests
hold each against a brute-force version, an exact round trip or held-out labels.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hemicycle.llm.decontaminate import leaks
from hemicycle.llm.fingerprints import document_fingerprints
from hemicycle.llm.minhash import near_duplicates
from hemicycle.llm.packing import best_fit_packs
from hemicycle.llm.quality import quality_keeps
from hemicycle.llm.suffix_array import suffix_array_repeats
from hemicycle.llm.suffix_tree import suffix_tree_repeats
from hemicycle.llm.token_output import token_frames
from hemicycle.llm.tokens import token_counts
from hemicycle.llm.warc import page_captures


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_frames(table(spark, sf_dir, "documents"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array_repeats(table(spark, sf_dir, "documents"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_keeps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_captures(table(spark, sf_dir, "pages"))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packs(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree_repeats(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_output,
        op2_suffix_array_dedup,
        op3_document_fingerprints,
        op4_token_counts,
        op5_quality_classifier,
        op6_warc,
        op7_minhash_near_dedup,
        op8_benchmark_decontamination,
        op9_best_fit_packing,
        op10_substring_dedup,
    )
}
SQL: dict[str, str] = {}
