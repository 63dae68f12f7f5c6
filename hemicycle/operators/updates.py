"""Upserts, alerts, answers and vote selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hemicycle import dims
from hemicycle.functions.text import initiative_id, is_final


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """One row a key of ``new``, and the rows of ``old`` whose key it lacks. Of rows of one key the greatest, by
    the columns in their order, stays; a null key is a key like any other."""
    rest = [c for c in new.columns if c != key]
    one = new.groupBy(key).agg(F.max(F.struct(*rest)).alias("r")).select(key, "r.*") if rest else new.distinct()
    keys = one.select(F.col(key).alias("key_"))
    return old.join(keys, old[key].eqNullSafe(keys["key_"]), "left_anti").unionByName(one)


def latest(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row a key, the last by ``order``. One partial aggregation, no sort."""
    rest = [c for c in df.columns if c != key]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(key).agg(last.alias("r")).select(key, "r.*")


def untag_changed(nested: DataFrame, before: DataFrame, now: DataFrame) -> DataFrame:
    """Tagged rows (id, tagged), emptied where the content (id, content) changed, appeared or went."""
    both = before.select("id", F.col("content").alias("was")).join(now.select("id", "content"), "id", "full")
    changed = both.filter(~F.col("was").eqNullSafe(F.col("content"))).select("id").distinct().withColumn("changed_", F.lit(True))
    tagged = F.when(F.col("changed_"), F.slice("tagged", 1, 0)).otherwise(F.col("tagged"))
    return nested.join(changed, "id", "left").withColumn("tagged", tagged).drop("changed_")


def alert_for(initiatives: DataFrame, reference: str, reason: str) -> DataFrame:
    """(id, reason): an alert for the initiatives of one reference."""
    return initiatives.filter(F.col("reference") == reference).select("id", F.lit(reason).alias("reason"))


def alerts(before: DataFrame, now: DataFrame) -> DataFrame:
    """(id, reason) by transition: new rows, content published, processing finished. Both: id, status, has_content."""
    both = now.join(before.select("id", F.col("status").alias("was"), F.col("has_content").alias("had"), F.lit(True).alias("known")), "id", "left")
    known = F.coalesce("known", F.lit(False))
    reasons = F.array_compact(
        F.array(
            F.when(~known, dims.REASONS["new"]),
            F.when(known & ~F.col("had") & F.col("has_content"), dims.REASONS["published"]),
            F.when(known & ~is_final(F.col("was")) & is_final(F.col("status")), dims.REASONS["finished"]),
        )
    )
    return both.select("id", F.explode(reasons).alias("reason"))


def with_answers(questions: DataFrame) -> DataFrame:
    """Questions (id, reference, code, status, content, answer) and the answers split from them: an answer
    is an initiative of its own; without one an answered question goes back to being open."""
    wants = ~is_final(F.col("status")) | (F.col("status") == "Respondida")
    none = F.coalesce(F.col("answer"), F.lit("")) == ""
    asked = questions.select("id", "reference", "code", F.lit("Pregunta").alias("kind"), F.when(wants & none, dims.OPEN).otherwise(F.col("status")).alias("status"), "content")
    author = F.when(F.col("code") == "179", "RTVE").otherwise("Gobierno")
    answers = questions.filter(wants & ~none).select(F.concat(initiative_id(F.col("reference")), F.lit("-respuesta")).alias("id"), "reference", "code", F.concat(F.lit("Respuesta "), author).alias("kind"), "status", F.col("answer").alias("content"))
    return asked.unionByName(answers)


def selected_votes(blocks: DataFrame) -> DataFrame:
    """Vote blocks (id, pos, labelled, titled): labelled ones, and titled ones until a label was seen."""
    seen = F.max("labelled").over(Window.partitionBy("id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    return blocks.withColumn("seen", seen).filter(F.col("labelled") | (~F.col("seen") & F.col("titled"))).drop("seen")
