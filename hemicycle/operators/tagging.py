"""Tagging by a regex dictionary, and rewriting what has been tagged.

The dictionary is small (a dimension) and becomes literal expressions: each pattern is compiled once, and
a text is scanned inside generated code, without Python and without a join. A combined alternation skips
texts that no pattern matches.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG_CHARS = 100_000
_TAG = "array<struct<topic:string,subtopic:string,tag:string,times:bigint>>"


class Entry(NamedTuple):
    kb: str
    topic: str
    subtopic: str
    tag: str
    regex: str


def count_tags(texts: Sequence[Column], dictionary: Sequence[Entry]) -> Column:
    """Array of (kb, topic, subtopic, tag, times) with the matches summed over the texts."""
    def times(e: Entry) -> Column:
        total = F.lit(0).cast("long")
        for t in texts:
            total = total + F.coalesce(F.regexp_count(t, F.lit(e.regex)).cast("long"), F.lit(0).cast("long"))
        return total

    rows = [F.struct(*(F.lit(getattr(e, n)).alias(n) for n in ("kb", "topic", "subtopic", "tag")), times(e).alias("times")) for e in dictionary]
    return F.filter(F.array(*rows), lambda r: r["times"] > 0)


def tag(docs: DataFrame, dictionary: Sequence[Entry], texts: Sequence[str] = ("title", "body")) -> DataFrame:
    """(id, kb, topic, subtopic, tag, times). Title and body tags merge by summing."""
    columns = [F.col(t) for t in texts]
    some = "|".join(f"(?:{e.regex})" for e in dictionary)
    hit = columns[0].rlike(some)
    for c in columns[1:]:
        hit = F.coalesce(hit, F.lit(False)) | F.coalesce(c.rlike(some), F.lit(False))
    return docs.filter(hit).select("id", F.inline(count_tags(columns, dictionary)))


def merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union on (id, kb, topic, subtopic, tag); times are summed."""
    keys = ["id", "kb", "topic", "subtopic", "tag"]
    return old.select(*keys, "times").unionByName(new.select(*keys, "times")).groupBy(*keys).agg(F.sum("times").alias("times"))


def nest(tags: DataFrame) -> DataFrame:
    """(id, tagged): one element a knowledge base, with its topics and tags, in order."""
    one = F.struct("topic", "subtopic", "tag", "times")
    by = tags.groupBy("id", "kb").agg(F.sort_array(F.collect_set("topic")).alias("topics"), F.sort_array(F.collect_list(one)).alias("tags"))
    return by.groupBy("id").agg(F.sort_array(F.collect_list(F.struct(F.col("kb").alias("knowledgebase"), "topics", "tags"))).alias("tagged"))


def flatten(nested: DataFrame) -> DataFrame:
    kb = nested.select("id", F.explode("tagged").alias("t"))
    return kb.select("id", F.col("t.knowledgebase").alias("kb"), F.inline("t.tags"))


def _rewrite(tagged: Column, change) -> Column:
    """Rewrite the tags of every knowledge base; topics follow from what is left."""
    def one(t: Column) -> Column:
        tags = change(t["tags"])
        return F.struct(t["knowledgebase"].alias("knowledgebase"), F.sort_array(F.array_distinct(F.transform(tags, lambda g: g["topic"]))).alias("topics"), tags.alias("tags"))

    return F.transform(tagged, one)


def rename(tagged: Column, topic: str, old: str, new: str) -> Column:
    def tag_(g: Column) -> Column:
        hit = (g["topic"] == topic) & (g["tag"] == old)
        return F.struct(g["topic"].alias("topic"), g["subtopic"].alias("subtopic"), F.when(hit, F.lit(new)).otherwise(g["tag"]).alias("tag"), g["times"].alias("times"))

    return _rewrite(tagged, lambda tags: F.transform(tags, tag_))


def untag_topic(tagged: Column, topic: str) -> Column:
    """A knowledge base stays even when nothing is left in it."""
    return _rewrite(tagged, lambda tags: F.filter(tags, lambda g: g["topic"] != topic))


def untag_tag(tagged: Column, topic: str, tag_: str) -> Column:
    return _rewrite(tagged, lambda tags: F.filter(tags, lambda g: ~((g["topic"] == topic) & (g["tag"] == tag_))))


def untag_kb(tagged: Column, kb: str) -> Column:
    return F.filter(tagged, lambda t: t["knowledgebase"] != kb)


def untag_reference(nested: DataFrame, ids: Sequence) -> DataFrame:
    return nested.withColumn("tagged", F.when(F.col("id").isin(*ids), F.slice("tagged", 1, 0)).otherwise(F.col("tagged")))


def has_topics(tagged: Column) -> Column:
    return F.exists(tagged, lambda t: F.coalesce(F.size(t["topics"]), F.lit(-1)) != 0)


def by_tag(tags: DataFrame, topic: str, name: str) -> DataFrame:
    """(id) of what holds a tag of a topic."""
    return tags.filter((F.col("topic") == topic) & (F.col("tag") == name)).select("id").distinct()


def merge_absent(old: DataFrame, new: DataFrame) -> DataFrame:
    """Tags of ``old``, and those of ``new`` whose name the same id lacks; of new ones of one name, the least row."""
    rest = [c for c in new.columns if c not in ("id", "tag")]
    one = new.groupBy("id", "tag").agg(F.min(F.struct(*rest)).alias("r")).select("id", "tag", "r.*")
    return old.unionByName(one.join(old.select("id", "tag"), ["id", "tag"], "left_anti"))


def untagged(docs: DataFrame, nested: DataFrame, long: bool, long_chars: int = LONG_CHARS, kb: str | None = None) -> DataFrame:
    """Short or long documents without tags (in a knowledge base, if one is given)."""
    size = F.length("title") + F.length("body")
    known = nested.filter(F.exists("tagged", lambda t: t["knowledgebase"] == kb) if kb else F.size("tagged") > 0)
    return docs.filter(size >= long_chars if long else size < long_chars).join(known.select("id"), "id", "left_anti")


def propagate(docs: DataFrame, tags: DataFrame, low: int, high: int, kbs: int = 2) -> DataFrame:
    """Tags of the first fully tagged document for all whose length lies strictly between the bounds."""
    alike = docs.filter((F.col("n_chars") > low) & (F.col("n_chars") < high)).select("id")
    full = tags.join(alike, "id").groupBy("id").agg(F.countDistinct("kb").alias("n")).filter(F.col("n") == kbs).agg(F.min("id").alias("template"))
    template = tags.join(F.broadcast(full), F.col("id") == F.col("template")).drop("id", "template")
    return alike.crossJoin(template)
