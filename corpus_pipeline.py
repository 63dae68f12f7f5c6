"""Training-corpus pipeline over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its output is written as Parquet in
the shared folder and reread as the next stage's input. The last stage returns packed sequences, the
others the columns of documents. No stage can be put in SQL; tests hold each against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hemicycle.llm.decontaminate import drop_leaks
from hemicycle.llm.minhash import drop_near_duplicates
from hemicycle.llm.packing import best_fit_packs
from hemicycle.llm.quality import keep_good
from hemicycle.llm.suffix_tree import remove_repeats
from hemicycle.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled neighbours vote good and not toxic."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each passage of 50 or more words that documents share, one copy stays."""
    return remove_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of permitted lengths, with the documents that each holds."""
    return best_fit_packs(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
