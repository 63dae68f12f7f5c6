"""Views that bind the domain to the star schema, one DataFrame a grain.

initiatives (id, code, type, status, created, place, reference), authors (id, kind, name), tags
(id, kb, topic, subtopic, times), entities (kind, name, email, social). Every view prunes to
the columns it needs; joins are left to the optimizer, which sees the tables' sizes. Views of the lines
are shuffled once, by id, into tasks of a bounded size; what groups, ranks or joins them by id needs no more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemicycle import dims

CODES = {"1-URGENT": "180", "2-HIGH": "161", "3-MEDIUM": "122", "4-NOT SPECIFIED": "172", "5-LOW": "184"}
STATUS = {"F": dims.APPROVED, "O": dims.OPEN, "P": "Retirada"}
BLANK_PLACE = "NATION_3"
KINDS = {"deputy": "s_name", "group": "r_name"}
#: Bytes of the lines' files a task after the shuffle by id.
TASK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_id(rows: DataFrame, sf_dir: str) -> DataFrame:
    """Shuffled by id. The number of tasks follows the size of the lines, so a task doesn't grow with them."""
    spark = rows.sparkSession
    size = int(table(spark, sf_dir, "lineitem")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return rows.repartition(max(spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES)), "id")


def _lookup(column: str, values: dict[str, str]):
    found = None
    for k, v in values.items():
        found = F.when(F.col(column) == k, v) if found is None else found.when(F.col(column) == k, v)
    return found


def initiatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = {code: title for code, title, _, _ in dims.TYPES}
    orders = table(spark, sf_dir, "orders")
    code = _lookup("o_orderpriority", CODES)
    return orders.select(
        F.col("o_orderkey").alias("id"),
        code.alias("code"),
        _lookup("o_orderpriority", {k: titles[c] for k, c in CODES.items()}).alias("type"),
        _lookup("o_orderstatus", STATUS).alias("status"),
        F.col("o_orderdate").alias("created"),
        F.concat(code, F.lit("/"), F.format_string("%06d", "o_orderkey")).alias("reference"),
        F.col("o_custkey"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, place); one place is stored empty."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    of = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    return orders.join(of, F.col("o_custkey") == F.col("c_custkey")).select("id", F.when(F.col("n_name") == BLANK_PLACE, "").otherwise(F.col("n_name")).alias("place"))


def _supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "s_name", "s_acctbal", "r_name")
    )


def authors(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    """(id, kind, name): deputies and groups (or one kind) that sign an initiative, once each. Both kinds come
    from one scan and one shuffle of the lines."""
    kinds = [kind] if kind else list(KINDS)
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), "l_suppkey")
    names = by_id(lines.join(_supplier(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey")).select("id", *(KINDS[k] for k in kinds)), sf_dir)
    if kind:
        return names.distinct().select("id", F.lit(kind).alias("kind"), F.col(KINDS[kind]).alias("name"))
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(KINDS[k]).alias("name")) for k in kinds))).alias("a")
    return names.select("id", each).select("id", "a.kind", "a.name").distinct()


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, name, email, social): presence of contacts, for deputies only."""
    people = _supplier(spark, sf_dir)
    deputies = people.groupBy(F.lit("deputy").alias("kind"), F.col("s_name").alias("name")).agg(F.max(F.col("s_acctbal") >= 3000).alias("email"), F.max(F.col("s_acctbal") >= 6000).alias("social"))
    groups = table(spark, sf_dir, "region").select(F.lit("group").alias("kind"), F.col("r_name").alias("name"), F.lit(False).alias("email"), F.lit(False).alias("social"))
    return deputies.unionByName(groups)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.regexp_extract("p_brand", "([0-9]+)$", 1).cast("int")
    return table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("kb"), number % 2).alias("kb"), F.col("p_brand").alias("topic"), F.col("p_type").alias("subtopic"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, kb, topic, subtopic, times), a row a line, before single occurrences are dropped. No query tells
    tags of a subtopic apart, so equal ones are left to the sums over topics."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), "l_partkey", F.col("l_quantity").cast("int").alias("times"))
    return by_id(lines.join(parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey")).select("id", "kb", "topic", "subtopic", "times"), sf_dir)
