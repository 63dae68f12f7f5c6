"""Footprint: how much each deputy and group did on each topic.

Rules are data (see ``dims``): an initiative's weight is the sum of the rules that it meets. A deputy gets
the weight times the topic's alignment, shared among the deputies who sign; a group gets it whole. Deputies
with a score get contact bonuses; inactivity then takes a share off. Scores are put on 0..100 by minimum
and maximum over all entities of a kind, those without activity counting as 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hemicycle import dims
from hemicycle.functions.numbers import micros, of_micros, r2

EMAIL, SOCIAL = 40.0, 40.0


def valid(status):
    """A null status is valid."""
    return F.coalesce(~status.isin(*dims.EXCLUDED_STATUS), F.lit(True))


def weight(rules=None):
    """The sum of the rules that an initiative meets. The rules are few and become one expression of its row."""
    total = F.lit(0.0)
    for _, points, status, titles in dims.FOOTPRINT_RULES if rules is None else rules:
        meets = F.col("type").isin(*titles) & (valid(F.col("status")) if status is None else F.coalesce(F.col("status") == status, F.lit(False)))
        total = total + F.when(meets, points).otherwise(0.0)
    return total


def rule_counts(initiatives: DataFrame, authors: DataFrame, rules=None) -> DataFrame:
    """(rule, kind, name, initiatives, points): counts without topics, times the weight."""
    spark = initiatives.sparkSession
    by = F.broadcast(_rules(spark, rules))
    meets = F.when(F.col("needs").isNull(), valid(F.col("status"))).otherwise(F.coalesce(F.col("status") == F.col("needs"), F.lit(False)))
    hits = initiatives.select("id", "type", "status").join(by, "type").filter(meets).select("id", "rule", "weight")
    return hits.join(authors, "id").groupBy("rule", "kind", "name").agg(F.count("*").alias("initiatives"), F.sum("weight").alias("points"))


def _rules(spark, rules):
    return dims.footprint_rules(spark, rules)


def last_activity(initiatives: DataFrame, authors: DataFrame, topics: DataFrame | None = None) -> DataFrame:
    """Last date of a valid initiative by entity (and topic)."""
    alive = initiatives.filter(valid(F.col("status"))).select("id", "created").join(authors, "id")
    keys = ["kind", "name"]
    if topics is not None:
        alive, keys = alive.join(topics.select("id", "topic").distinct(), "id"), ["kind", "name", "topic"]
    return alive.groupBy(*keys).agg(F.max("created").alias("last"))


def penalty(last, as_of: str):
    """Shares by age: 360, 180 and 90 days; no date, no penalty."""
    at = lambda n: F.date_sub(F.lit(as_of).cast("date"), n).cast("timestamp_ntz")
    return F.when(last < at(360), 0.5).when(last < at(180), 0.25).when(last < at(90), 0.1).otherwise(0.0)


def contact_bonus(entities: DataFrame) -> DataFrame:
    bonus = F.when(F.col("kind") == "deputy", F.when(F.col("email"), EMAIL).otherwise(0.0) + F.when(F.col("social"), SOCIAL).otherwise(0.0)).otherwise(0.0)
    return entities.select("kind", "name", bonus.alias("bonus"))


def normalised(raw: DataFrame, keys: list[str]) -> DataFrame:
    by = Window.partitionBy(*keys)
    low, high = F.min("raw").over(by), F.max("raw").over(by)
    span = F.when(high == low, 1.0).otherwise(high - low)
    return raw.withColumn("score", r2((F.col("raw") - low) * 100 / span))


def _final(points: DataFrame, entities: DataFrame, topics: DataFrame | None, as_of: str) -> DataFrame:
    keys = ["kind", "name"] + (["topic"] if topics is not None else [])
    grid = contact_bonus(entities)
    if topics is not None:
        grid = grid.crossJoin(topics)
    p = F.coalesce(F.col("points").cast("double"), F.lit(0.0))
    raw = F.when(p > 0, r2((p + F.col("bonus")) * (1 - penalty(F.col("last"), as_of)))).otherwise(0.0)
    scored = grid.join(points, keys, "left").select(*keys, raw.alias("raw"))
    return normalised(scored, ["kind"] + (["topic"] if topics is not None else []))


def by_topic(initiatives: DataFrame, authors: DataFrame, alignment: DataFrame, entities: DataFrame, topics: DataFrame, as_of: str, rules=None) -> DataFrame:
    """(kind, name, topic, raw, score) for every entity and topic. Weighted initiatives and alignments meet on
    id, then authors; sums and last dates come from one aggregation."""
    cents = F.round(F.col("percentage") * 100).cast("long")
    shares = alignment.groupBy("id", "topic").agg((F.sum(cents) / 100).alias("pct"))
    signed = authors.withColumn("n", F.when(F.col("kind") == "deputy", F.count("*").over(Window.partitionBy("id", "kind"))).otherwise(1))
    alive = initiatives.filter(valid(F.col("status"))).select("id", "created", weight(rules).alias("weight"))
    facts = alive.join(shares, "id").join(signed, "id")
    value = micros(F.col("pct") / 100 / F.col("n") * F.col("weight"))
    points = facts.groupBy("kind", "name", "topic").agg(of_micros(F.sum(value)).alias("points"), F.max("created").alias("last"))
    return _final(points, entities, topics, as_of)


def overall(initiatives: DataFrame, authors: DataFrame, entities: DataFrame, as_of: str, rules=None) -> DataFrame:
    """(kind, name, raw, score) without topics: no sharing, no alignment."""
    alive = initiatives.filter(valid(F.col("status"))).select("id", "created", micros(weight(rules)).alias("value"))
    facts = alive.join(authors, "id")
    points = facts.groupBy("kind", "name").agg(of_micros(F.sum("value")).alias("points"), F.max("created").alias("last"))
    return _final(points, entities, None, as_of)


def topic_documents(scores: DataFrame) -> DataFrame:
    """(topic, kind, elements): the scores of a topic, descending, ties by name."""
    order = lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).when(a["name"] < b["name"], -1).when(a["name"] > b["name"], 1).otherwise(0)
    return scores.groupBy("topic", "kind").agg(F.array_sort(F.collect_list(F.struct("name", "score")), order).alias("elements"))


def entity_documents(scores: DataFrame, total: DataFrame) -> DataFrame:
    """(kind, name, score, topics): an entity's overall score and its topics."""
    topics = scores.groupBy("kind", "name").agg(F.sort_array(F.collect_list(F.struct("topic", "score"))).alias("topics"))
    return total.select("kind", "name", "score").join(topics, ["kind", "name"], "left")
