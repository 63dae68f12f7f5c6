"""Which references to fetch: gaps, open ones, and a tail up to the site's totals.

Gaps are found by generating each type's range and dropping what is stored (an anti join on type and
number), so that no window has to hold a whole type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.functions.text import is_final, reference

SAFETY_GAP = 3
BLOCK = 100_000  # numbers that one row is expanded to at most


def _range(frame: DataFrame, low, high) -> DataFrame:
    """The numbers of each code's range. Starts of blocks are expanded first and spread over the tasks, so that neither
    one row nor one task has to hold a whole type."""
    step = F.lit(BLOCK).cast("long")
    starts = frame.select("code", low.cast("long").alias("low"), high.cast("long").alias("high")).filter("low <= high").select("code", "high", F.explode(F.sequence("low", "high", step)).alias("at"))
    return starts.repartition("code", "at").select("code", F.explode(F.sequence(F.col("at"), F.least(F.col("at") + step - 1, F.col("high")))).alias("number"))


def _named(frame: DataFrame, reason: str) -> DataFrame:
    return frame.select("code", "number", reference(F.col("number"), F.col("code")).alias("reference"), F.lit(reason).alias("reason"))


def gaps(stored: DataFrame) -> DataFrame:
    """(code, number) missing between a type's first and last stored number."""
    bounds = stored.groupBy("code").agg(F.min("number").alias("a"), F.max("number").alias("b"))
    return _range(bounds, F.col("a"), F.col("b")).join(stored.select("code", "number"), ["code", "number"], "left_anti")


def plan_new(stored: DataFrame, totals: DataFrame, gap: int = SAFETY_GAP, single_type: bool = False) -> DataFrame:
    """(code, number, reference, reason): gaps, open references, and the tail. Stored: code, number, status;
    totals: code, total. The two variants differ in what the tail starts and ends with."""
    have = stored.groupBy("code").agg(F.count("*").alias("n"), F.min("number").alias("first"), F.max("number").alias("last"))
    state = totals.join(have, "code", "left").select("code", "total", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("last", F.lit(0)).alias("last"), "first")
    missing = gaps(stored)
    if single_type:
        counted = F.when(F.col("first").isNull(), 0).otherwise(F.col("last") - F.col("first") + 1)
        tail = _range(state.filter(F.col("total") != counted), F.col("last"), F.col("total") + gap - 1)
    else:
        new = F.col("total") - F.col("n")
        tail = _range(state.filter(new >= 0), F.col("last") + 1, F.col("last") + new + gap - 1)
    open_ = stored.filter(~is_final(F.col("status"))).select("code", "number")
    return _named(missing, "gap").unionByName(_named(open_, "open")).unionByName(_named(tail, "tail"))


def plan_all(totals: DataFrame, gap: int = SAFETY_GAP, single_type: bool = False) -> DataFrame:
    low, high = (0, F.col("total") + gap - 1) if single_type else (1, F.col("total") + gap)
    return _named(_range(totals, F.lit(low).cast("long"), high), "all")


def skip_group(planned: DataFrame, types: DataFrame, group: str) -> DataFrame:
    return planned.join(types.filter(F.col("type_group") == group).select("code"), "code", "left_anti")


def refresh(stored: DataFrame, remote: DataFrame) -> DataFrame:
    """Remote rows to process: all but those that are final and whose stored status is the same."""
    both = remote.join(stored.select("id", F.col("status").alias("saved")), "id", "left")
    return both.filter(~(is_final(F.col("status")) & F.col("status").eqNullSafe(F.col("saved")))).drop("saved")
