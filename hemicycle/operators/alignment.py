"""Topic alignment: each topic's share of the tag occurrences of an initiative in a knowledge base."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hemicycle.functions.numbers import r2


def without_singles(tags: DataFrame) -> DataFrame:
    """Drop topics that occur once only in an initiative and knowledge base."""
    total = F.sum("times").over(Window.partitionBy("id", "kb", "topic"))
    return tags.withColumn("total", total).filter("total <> 1").drop("total")


def topic_times(tags: DataFrame) -> DataFrame:
    """(id, kb, topic, times), a row a topic, without those that occur once only: what ``without_singles``
    leaves, summed. The sum tells singles by itself, without a window."""
    return tags.groupBy("id", "kb", "topic").agg(F.sum("times").alias("times")).filter("times <> 1")


def topic_alignment(tags: DataFrame) -> DataFrame:
    """(id, kb, topic, percentage)."""
    return shares(tags.groupBy("id", "kb", "topic").agg(F.sum("times").alias("times")))


def shares(times: DataFrame) -> DataFrame:
    """(id, kb, topic, percentage) of a row a topic."""
    share = F.try_divide(F.col("times") * 100, F.sum("times").over(Window.partitionBy("id", "kb")))
    return times.select("id", "kb", "topic", r2(share).alias("percentage"))


def ranked(alignment: DataFrame) -> DataFrame:
    """(id, kb, rank, topic, percentage): the order of ``nested``, without arrays; nulls are last."""
    by = Window.partitionBy("id", "kb").orderBy(F.desc_nulls_last("percentage"), F.asc_nulls_last("topic"))
    return alignment.select("id", "kb", F.row_number().over(by).alias("rank"), "topic", "percentage")


def nested(alignment: DataFrame) -> DataFrame:
    """(id, kb, topic_alignment): array of (topic, percentage), descending, ties by topic."""
    order = lambda a, b: F.when(a["percentage"] > b["percentage"], -1).when(a["percentage"] < b["percentage"], 1).when(a["topic"] < b["topic"], -1).when(a["topic"] > b["topic"], 1).otherwise(0)
    return alignment.groupBy("id", "kb").agg(F.array_sort(F.collect_list(F.struct("topic", "percentage")), order).alias("topic_alignment"))
