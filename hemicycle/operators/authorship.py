"""Who signed: resolving author items, signatures and places against small dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SHORT, _MORE, _SUFFIX = r" \((.+)\)", r" y [0-9]+ Diputados", " en el Congreso"


def resolve(items: DataFrame, deputies: DataFrame, groups: DataFrame) -> DataFrame:
    """(id, kind, name) of author items (id, item, linked): deputies, groups and others. Deputies: name,
    parliamentarygroup (short name); groups: name, shortname."""
    short = F.regexp_extract("item", _SHORT, 1)
    bare = F.regexp_replace("item", _SHORT, "")
    known = groups.select(F.col("shortname").alias("short"), F.col("name").alias("group_name"))
    rows = items.withColumn("short", short).join(known, "short", "left").withColumn("is_short", F.col("group_name").isNotNull())
    rows = rows.withColumn("name", F.when(F.col("is_short"), bare).otherwise(F.col("item")))
    people = deputies.groupBy("name").agg(F.min("parliamentarygroup").alias("own"))
    rows = rows.join(people, "name", "left").withColumn("is_deputy", F.col("own").isNotNull())
    rows = rows.join(known.withColumnsRenamed({"short": "own", "group_name": "own_name"}), "own", "left")
    more = F.col("item").rlike(_MORE)
    group = F.when(F.col("is_short") & F.col("is_deputy"), F.col("group_name")).when(~F.col("is_short") & ~more, F.when(F.col("is_deputy"), F.col("own_name")).otherwise(F.regexp_replace("item", _SUFFIX, "")))
    deputy = F.when(F.col("is_deputy") & (F.col("is_short") | ~more), F.col("name"))
    found = F.array(F.struct(F.lit("deputy").alias("kind"), F.when(F.col("linked"), deputy).alias("name")), F.struct(F.lit("group").alias("kind"), F.when(F.col("linked"), group).alias("name")), F.struct(F.lit("other").alias("kind"), F.when(~F.col("linked"), F.col("item")).alias("name")))
    return rows.select("id", F.inline(found)).filter("name is not null").distinct()


def composition(groups: DataFrame, deputies: DataFrame) -> DataFrame:
    """(group, party, members) of active deputies."""
    active = deputies.filter("active")
    return groups.select(F.col("name").alias("grp"), F.col("shortname").alias("parliamentarygroup")).join(active, "parliamentarygroup").groupBy("grp", "party").agg(F.count("*").alias("members"))


def place_from_history(history: Column, places: list[str] | Column) -> Column:
    """The first place, in the order of the dimension (a list, or an array column), that any history item contains."""
    known = places if isinstance(places, Column) else F.array(*map(F.lit, places))
    return F.get(F.filter(known, lambda p: F.exists(history, lambda h: h.contains(p))), 0)


def signed_by(lines: DataFrame, deputies: DataFrame) -> DataFrame:
    """(id, name): deputies whose name a signature line contains. Names are split into words to make
    candidates by an equi join on the first word; containment decides."""
    words = lines.select("id", "line", F.explode(F.array_distinct(F.split("line", "[^\\p{L}\\p{N}#]+"))).alias("word")).filter("word <> ''")
    named = deputies.select("name", "fullname", F.regexp_extract("fullname", "([\\p{L}\\p{N}#]+)", 1).alias("word"))
    return words.join(named, "word").filter(F.col("line").contains(F.col("fullname"))).select("id", "name").distinct()


def fuzzy(left: DataFrame, name: str, right: DataFrame, other: str, least: float = 0.0) -> DataFrame:
    """(name, match, similarity): the most similar of a small dimension by edit distance; ties by name."""
    distinct = left.select(name).distinct()
    longest = F.greatest(F.length(name), F.length(other), F.lit(1))
    score = F.round(1 - F.levenshtein(F.lower(name), F.lower(other)) / longest, 6)
    ranked = distinct.crossJoin(right.select(other).distinct()).withColumn("similarity", score)
    best = ranked.withColumn("rn", F.row_number().over(Window.partitionBy(name).orderBy(F.desc("similarity"), other)))
    return best.filter((F.col("rn") == 1) & (F.col("similarity") >= least)).drop("rn")
