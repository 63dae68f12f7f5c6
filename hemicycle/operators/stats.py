"""Reports: counts by level, trends, grouped top-N and gap-filled weekly series.

All topics are counted in one pass, by grouping keys. Top-N goes through a ranking window, whose
group limit Spark pushes below the shuffle; ties are broken by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hemicycle import dims


def _once(tags: DataFrame, *keys: str) -> DataFrame:
    return tags.select("id", *keys).distinct()


def overall(initiatives: DataFrame, tags: DataFrame) -> DataFrame:
    """(kb, topic, initiatives): total (nulls), by knowledge base, and by topic."""
    topics = tags.groupBy("id", "kb").agg(F.collect_set("topic").alias("topics"))
    levels = F.explode(F.array_append("topics", F.lit(None).cast("string"))).alias("topic")
    counted = topics.select("kb", levels).groupBy("kb", "topic").agg(F.count("*").alias("initiatives"))
    none = F.lit(None).cast("string")
    return initiatives.agg(F.count("*").alias("initiatives")).select(none.alias("kb"), none.alias("topic"), "initiatives").unionByName(counted)


def subtopic_counts(tags: DataFrame) -> DataFrame:
    return _once(tags, "kb", "subtopic").groupBy("kb", "subtopic").agg(F.count("*").alias("initiatives"))


def last_days(initiatives: DataFrame, as_of: str, days: int = 15) -> DataFrame:
    """(type_group, current, previous, trend): windows (T-15d, T] and (T-30d, T-15d]."""
    top = F.lit(as_of).cast("timestamp_ntz")
    low, mid = (F.lit(as_of).cast("date") - F.expr(f"interval {n} days") for n in (2 * days, days))
    groups = {code: g for code, _, g, _ in dims.TYPES if g in (dims.LEGISLATIVE, dims.ORIENTATION, dims.OVERSIGHT)}
    spark = initiatives.sparkSession
    wanted = F.broadcast(spark.createDataFrame(sorted(groups.items()), "code string, type_group string"))
    recent = initiatives.filter((F.col("created") > low.cast("timestamp_ntz")) & (F.col("created") <= top)).join(wanted, "code")
    is_current = F.col("created") > mid.cast("timestamp_ntz")
    counted = recent.groupBy("type_group").agg(F.count_if(is_current).alias("current"), F.count_if(~is_current).alias("previous"))
    every = wanted.select("type_group").distinct().join(counted, "type_group", "left").na.fill(0)
    trend = F.when(F.col("current") > F.col("previous"), "up").when(F.col("current") < F.col("previous"), "down").otherwise("equal")
    return every.select("type_group", "current", "previous", trend.alias("trend"))


def top(df: DataFrame, keys: list[str], value: str, name: str, n: int) -> DataFrame:
    by = Window.partitionBy(*keys).orderBy(F.desc(value), F.asc(name))
    return df.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= n)


def by_key(tags: DataFrame, facts: DataFrame, key: str, name: str) -> DataFrame:
    """(kb, key, name, initiatives): how many tagged initiatives each name has."""
    return joined(_once(tags, "kb", key), facts, key, name)


def joined(once: DataFrame, facts: DataFrame, key: str, name: str) -> DataFrame:
    """``by_key`` of a row an initiative, knowledge base and key."""
    return once.select("id", "kb", key).join(facts.select("id", name), "id").groupBy("kb", key, name).agg(F.count("*").alias("initiatives"))


def deputies_by_topic(scores: DataFrame, n: int = 10) -> DataFrame:
    """Top deputies by the sum of their normalised footprints; homonyms merge."""
    summed = scores.filter("kind = 'deputy'").groupBy("topic", "name").agg(F.sum(F.col("score").cast("decimal(18,2)")).cast("double").alias("score"))
    return top(summed, ["topic"], "score", "name", n)


def iso_week(created: Column) -> Column:
    return F.format_string("%04d-%02d", F.extract(F.lit("YEAROFWEEK"), created), F.weekofyear(created))


def weekly(initiatives: DataFrame, start: str | None, end: str, keys: DataFrame | None = None, names: tuple[str, ...] = ()) -> DataFrame:
    """(names..., week, initiatives): observed weeks from ``start`` on, and each week that the calendar, in
    steps of seven days from ``start`` to ``end``, reaches. Without a start the first date is taken."""
    spark = initiatives.sparkSession
    rows = initiatives.select("id", "created")
    if start:
        rows = rows.filter(F.col("created") >= F.lit(start).cast("timestamp_ntz"))
        first = spark.range(1).select(F.lit(start).cast("date").alias("first"))
    else:
        first = rows.agg(F.min("created").cast("date").alias("first"))
    rows = rows.select("id", iso_week(F.col("created")).alias("week"))
    if keys is not None:
        rows = rows.join(keys, "id")
    seen = rows.groupBy(*names, "week").agg(F.count("*").alias("initiatives"))
    calendar = first.filter("first is not null").select(F.explode(F.sequence("first", F.greatest("first", F.lit(end).cast("date")), F.expr("interval 7 days"))).alias("d")).filter(F.col("d") <= F.lit(end).cast("date")).select(iso_week(F.col("d")).alias("week")).distinct()
    if names:
        calendar = seen.select(*names).distinct().crossJoin(calendar)
    filled = calendar.withColumn("initiatives", F.lit(0).cast("long")).unionByName(seen)
    return filled.groupBy(*names, "week").agg(F.sum("initiatives").alias("initiatives"))
