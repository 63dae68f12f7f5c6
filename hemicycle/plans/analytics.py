"""Queries of the analytic core (stats, alignment, footprint), each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from hemicycle import dims
from hemicycle.operators import alignment as al
from hemicycle.operators import footprint as fp
from hemicycle.operators import stats
from hemicycle.plans import binding as b

AS_OF = "2001-07-15"
START, END = "1999-01-06", "2001-07-15"

_TITLES = {code: title for code, title, _, _ in dims.TYPES}


def _case(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def sql_r2(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(20,8)), 2) AS DOUBLE)"


_VALID = f"coalesce(status NOT IN {_in(dims.EXCLUDED_STATUS)}, true)"
VIEWS = f"""
initiatives AS (SELECT o_orderkey AS id, {_case("o_orderpriority", b.CODES)} AS code, {_case("o_orderpriority", {k: _TITLES[c] for k, c in b.CODES.items()})} AS type,
  {_case("o_orderstatus", b.STATUS)} AS status, o_orderdate AS created, o_custkey FROM orders),
places AS (SELECT i.id, CASE WHEN n_name = '{b.BLANK_PLACE}' THEN '' ELSE n_name END AS place FROM initiatives i JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
people AS (SELECT s_suppkey, s_name, s_acctbal, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
authors AS (SELECT DISTINCT l_orderkey AS id, 'deputy' AS kind, s_name AS name FROM lineitem JOIN people ON l_suppkey = s_suppkey
  UNION ALL SELECT DISTINCT l_orderkey, 'group', r_name FROM lineitem JOIN people ON l_suppkey = s_suppkey),
entities AS (SELECT 'deputy' AS kind, s_name AS name, bool_or(s_acctbal >= 3000) AS email, bool_or(s_acctbal >= 6000) AS social FROM people GROUP BY s_name
  UNION ALL SELECT 'group', r_name, false, false FROM region),
all_tags AS (SELECT l_orderkey AS id, 'kb' || (CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INT) % 2) AS kb, p_brand AS topic, p_type AS subtopic, p_name AS tag, CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS times
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4, 5),
tags AS (SELECT * FROM (SELECT *, sum(times) OVER (PARTITION BY id, kb, topic) AS total FROM all_tags) WHERE total <> 1),
alignment AS (SELECT id, kb, topic, {sql_r2("times * 100 / sum(times) OVER (PARTITION BY id, kb)")} AS percentage FROM (SELECT id, kb, topic, CAST(sum(times) AS DOUBLE) AS times FROM tags GROUP BY 1, 2, 3)),
rules(rule, weight, needs, type) AS (VALUES {", ".join(f"('{r}', {w}, {'NULL' if s is None else repr(s)}, '{t}')" for r, w, s, ts in dims.FOOTPRINT_RULES for t in ts)}),
hits AS (SELECT id, rule, weight FROM initiatives JOIN rules USING (type) WHERE CASE WHEN needs IS NULL THEN {_VALID} ELSE coalesce(status = needs, false) END),
alive AS (SELECT i.id, created, coalesce(weight, 0) AS weight FROM initiatives i LEFT JOIN (SELECT id, sum(weight) AS weight FROM hits GROUP BY id) USING (id) WHERE {_VALID}),
bonus AS (SELECT kind, name, CASE WHEN kind = 'deputy' THEN CASE WHEN email THEN {fp.EMAIL} ELSE 0 END + CASE WHEN social THEN {fp.SOCIAL} ELSE 0 END ELSE 0 END AS bonus FROM entities),
topics AS (SELECT DISTINCT p_brand AS topic FROM part)"""


def _penalty(last: str) -> str:
    at = lambda n: f"(DATE '{AS_OF}' - INTERVAL {n} DAY)"
    return f"CASE WHEN {last} < {at(360)} THEN 0.5 WHEN {last} < {at(180)} THEN 0.25 WHEN {last} < {at(90)} THEN 0.1 ELSE 0.0 END"


_TERM = "CAST(round(CAST({} AS DECIMAL(20,8)), 6) AS DECIMAL(18,6))"
_RAW = f"CASE WHEN coalesce(points, 0) > 0 THEN {sql_r2('(CAST(points AS DOUBLE) + bonus) * (1 - ' + _penalty('last') + ')')} ELSE 0.0 END"
_NORM = sql_r2("(raw - min(raw) OVER w) * 100 / CASE WHEN max(raw) OVER w = min(raw) OVER w THEN 1.0 ELSE max(raw) OVER w - min(raw) OVER w END")
SCORES = f"""{VIEWS},
shares AS (SELECT id, topic, sum(CAST(percentage AS DECIMAL(9,2))) AS pct FROM alignment GROUP BY 1, 2),
signed AS (SELECT *, CASE WHEN kind = 'deputy' THEN count(*) OVER (PARTITION BY id, kind) ELSE 1 END AS n FROM authors),
points AS (SELECT kind, name, topic, sum({_TERM.format("CAST(pct AS DOUBLE) / 100 / n * weight")}) AS points, max(created) AS last FROM alive JOIN shares USING (id) JOIN signed USING (id) GROUP BY 1, 2, 3),
raw AS (SELECT kind, name, topic, {_RAW} AS raw FROM bonus CROSS JOIN topics LEFT JOIN points USING (kind, name, topic)),
scores AS (SELECT kind, name, topic, raw, {_NORM} AS score FROM raw WINDOW w AS (PARTITION BY kind, topic))"""
GLOBAL = f"""{VIEWS},
points AS (SELECT kind, name, sum({_TERM.format("weight")}) AS points, max(created) AS last FROM alive JOIN authors USING (id) GROUP BY 1, 2),
raw AS (SELECT kind, name, {_RAW} AS raw FROM bonus LEFT JOIN points USING (kind, name)),
scores AS (SELECT kind, name, raw, {_NORM} AS score FROM raw WINDOW w AS (PARTITION BY kind))"""


def tags(spark, d):
    return al.without_singles(b.tags(spark, d))


def topics(spark, d):
    return al.topic_times(b.tags(spark, d))


def scores(spark, d, kind=None):
    every = b.table(spark, d, "part").select(F.col("p_brand").alias("topic")).distinct()
    return fp.by_topic(_initiatives(spark, d), b.authors(spark, d, kind), al.shares(topics(spark, d)), _entities(spark, d, kind), every, AS_OF)


def _initiatives(spark, d):
    return b.by_id(b.initiatives(spark, d), d)


def _entities(spark, d, kind):
    every = b.entities(spark, d)
    return every.filter(F.col("kind") == kind) if kind else every


def _people(kind: str, name: str):
    return lambda spark, d: b.authors(spark, d, kind).select("id", F.col("name").alias(name))


def _named_places(spark, d):
    return b.by_id(b.places(spark, d), d).filter("place is not null and place <> ''")


def _counted(key: str, facts, name: str, n: int | None):
    def run(spark, d):
        found = stats.joined(topics(spark, d), facts(spark, d), key, name) if key == "topic" else stats.by_key(tags(spark, d), facts(spark, d), key, name)
        return stats.top(found, ["kb", key], "initiatives", name, n) if n else found

    return run


def _counted_sql(key: str, source: str, name: str, n: int | None) -> str:
    counted = f"SELECT kb, {key}, {name}, count(*) AS initiatives FROM (SELECT DISTINCT id, kb, {key} FROM tags) JOIN ({source}) USING (id) GROUP BY 1, 2, 3"
    if not n:
        return f"WITH {VIEWS} {counted}"
    return f"WITH {VIEWS} SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kb, {key} ORDER BY initiatives DESC, {name}) AS rank FROM ({counted})) WHERE rank <= {n}"


_DEPUTIES = "SELECT id, name AS deputy FROM authors WHERE kind = 'deputy'"
_GROUPS = "SELECT id, name AS grp FROM authors WHERE kind = 'group'"
_PLACES = "SELECT id, place FROM places WHERE place <> ''"
_WEEK = "strftime({}, '%G-%V')"


def _weeks_sql(keys: str) -> str:
    k = f"{keys}, " if keys else ""
    source = "initiatives" + (f" JOIN (SELECT DISTINCT id, {keys} FROM tags) USING (id)" if keys else "")
    calendar = f"SELECT DISTINCT {_WEEK.format('d')} AS week FROM (SELECT unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 7 DAY)) AS d)"
    grid = f"SELECT {k}week, 0 AS n FROM (SELECT DISTINCT {keys} FROM seen) CROSS JOIN ({calendar})" if keys else f"SELECT week, 0 AS n FROM ({calendar})"
    return f"""WITH {VIEWS}, seen AS (SELECT {k}{_WEEK.format('created')} AS week, count(*) AS n FROM {source} WHERE created >= DATE '{START}' GROUP BY ALL)
SELECT {k}week, CAST(sum(n) AS BIGINT) AS initiatives FROM (SELECT * FROM seen UNION ALL {grid}) GROUP BY ALL"""


def _lastdays_sql() -> str:
    groups = ", ".join(f"('{c}', '{g}')" for c, _, g, _ in dims.TYPES if g in (dims.LEGISLATIVE, dims.ORIENTATION, dims.OVERSIGHT))
    at = lambda n: f"(DATE '{AS_OF}' - INTERVAL {n} DAY)"
    return f"""WITH {VIEWS}, g(code, type_group) AS (VALUES {groups}),
counted AS (SELECT type_group, count(id) FILTER (created > {at(15)}) AS current, count(id) FILTER (created <= {at(15)}) AS previous
  FROM g LEFT JOIN (SELECT * FROM initiatives WHERE created > {at(30)} AND created <= DATE '{AS_OF}') USING (code) GROUP BY 1)
SELECT *, CASE WHEN current > previous THEN 'up' WHEN current < previous THEN 'down' ELSE 'equal' END AS trend FROM counted"""


def _penalties(spark, d):
    last = fp.last_activity(_initiatives(spark, d), b.authors(spark, d), topics(spark, d))
    return last.select("kind", "name", "topic", "last", fp.penalty(F.col("last"), AS_OF).alias("penalty"))


def _rules(spark, d):
    return fp.rule_counts(_initiatives(spark, d), b.authors(spark, d))


def _global(spark, d, kind=None):
    return fp.overall(_initiatives(spark, d), b.authors(spark, d, kind), _entities(spark, d, kind), AS_OF)


def _documents(spark, d):
    total, each = _global(spark, d), scores(spark, d)
    nested = fp.entity_documents(each, total)
    return nested.select("kind", "name", F.col("score").alias("total"), F.explode("topics").alias("t")).select("kind", "name", "total", "t.topic", "t.score")


def _of_kind(source, kind):
    return lambda spark, d: source(spark, d, kind).drop("kind")


QUERIES = {
    "stats_overall_levels": lambda s, d: stats.overall(b.initiatives(s, d), topics(s, d)),
    "stats_subtopic_counts": lambda s, d: stats.subtopic_counts(tags(s, d)),
    "stats_lastdays_trend": lambda s, d: stats.last_days(b.initiatives(s, d), AS_OF),
    "stats_deputies_by_topic_top10": lambda s, d: stats.deputies_by_topic(scores(s, d, "deputy")),
    "stats_groups_by_topic": _counted("topic", _people("group", "grp"), "grp", None),
    "stats_places_by_topic_top5": _counted("topic", _named_places, "place", 5),
    "stats_deputies_by_subtopic_top10": _counted("subtopic", _people("deputy", "deputy"), "deputy", 10),
    "stats_groups_by_subtopic": _counted("subtopic", _people("group", "grp"), "grp", None),
    "stats_places_by_subtopic_top5": _counted("subtopic", _named_places, "place", 5),
    "stats_by_week_gapfilled": lambda s, d: stats.weekly(b.initiatives(s, d), START, END),
    "stats_topics_by_week": lambda s, d: stats.weekly(_initiatives(s, d), START, END, topics(s, d).select("id", "kb", "topic"), ("kb", "topic")),
    "topic_alignment": lambda s, d: al.shares(topics(s, d)),
    "topic_alignment_ranked": lambda s, d: al.ranked(al.shares(topics(s, d))),
    "footprint_rule_counts_global": _rules,
    "footprint_topic_deputy": _of_kind(scores, "deputy"),
    "footprint_topic_group": _of_kind(scores, "group"),
    "footprint_global_deputy": _of_kind(_global, "deputy"),
    "footprint_global_group": _of_kind(_global, "group"),
    "footprint_penalty": _penalties,
    "footprint_contact_bonus": lambda s, d: fp.contact_bonus(b.entities(s, d)),
    "footprint_entity_documents": _documents,
}
SQL = {
    "stats_overall_levels": f"""WITH {VIEWS} SELECT NULL AS kb, NULL AS topic, count(*) AS initiatives FROM initiatives
UNION ALL SELECT kb, NULL, count(DISTINCT id) FROM tags GROUP BY kb UNION ALL SELECT kb, topic, count(DISTINCT id) FROM tags GROUP BY kb, topic""",
    "stats_subtopic_counts": f"WITH {VIEWS} SELECT kb, subtopic, count(DISTINCT id) AS initiatives FROM tags GROUP BY 1, 2",
    "stats_lastdays_trend": _lastdays_sql(),
    "stats_deputies_by_topic_top10": f"""WITH {SCORES} SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC, name) AS rank FROM
(SELECT topic, name, CAST(sum(CAST(score AS DECIMAL(18,2))) AS DOUBLE) AS score FROM scores WHERE kind = 'deputy' GROUP BY 1, 2)) WHERE rank <= 10""",
    "stats_groups_by_topic": _counted_sql("topic", _GROUPS, "grp", None),
    "stats_places_by_topic_top5": _counted_sql("topic", _PLACES, "place", 5),
    "stats_deputies_by_subtopic_top10": _counted_sql("subtopic", _DEPUTIES, "deputy", 10),
    "stats_groups_by_subtopic": _counted_sql("subtopic", _GROUPS, "grp", None),
    "stats_places_by_subtopic_top5": _counted_sql("subtopic", _PLACES, "place", 5),
    "stats_by_week_gapfilled": _weeks_sql(""),
    "stats_topics_by_week": _weeks_sql("kb, topic"),
    "topic_alignment": f"WITH {VIEWS} SELECT * FROM alignment",
    "topic_alignment_ranked": f"WITH {VIEWS} SELECT id, kb, CAST(row_number() OVER (PARTITION BY id, kb ORDER BY percentage DESC, topic) AS INT) AS rank, topic, percentage FROM alignment",
    "footprint_rule_counts_global": f"WITH {VIEWS} SELECT rule, kind, name, count(*) AS initiatives, CAST(sum(weight) AS DOUBLE) AS points FROM hits JOIN authors USING (id) GROUP BY 1, 2, 3",
    "footprint_topic_deputy": f"WITH {SCORES} SELECT name, topic, raw, score FROM scores WHERE kind = 'deputy'",
    "footprint_topic_group": f"WITH {SCORES} SELECT name, topic, raw, score FROM scores WHERE kind = 'group'",
    "footprint_global_deputy": f"WITH {GLOBAL} SELECT name, raw, score FROM scores WHERE kind = 'deputy'",
    "footprint_global_group": f"WITH {GLOBAL} SELECT name, raw, score FROM scores WHERE kind = 'group'",
    "footprint_penalty": f"""WITH {VIEWS}, last AS (SELECT kind, name, topic, max(created) AS last FROM alive JOIN authors USING (id) JOIN (SELECT DISTINCT id, topic FROM tags) USING (id) GROUP BY 1, 2, 3)
SELECT kind, name, topic, last, CAST({_penalty("last")} AS DOUBLE) AS penalty FROM last""",
    "footprint_contact_bonus": f"WITH {VIEWS} SELECT kind, name, CAST(bonus AS DOUBLE) AS bonus FROM bonus",
    "footprint_entity_documents": f"""WITH {SCORES}, gpoints AS (SELECT kind, name, sum({_TERM.format("weight")}) AS points, max(created) AS last FROM alive JOIN authors USING (id) GROUP BY 1, 2),
graw AS (SELECT kind, name, {_RAW} AS raw FROM bonus LEFT JOIN gpoints USING (kind, name)),
gscores AS (SELECT kind, name, {_NORM} AS total FROM graw WINDOW w AS (PARTITION BY kind)) SELECT kind, name, total, topic, score FROM gscores JOIN scores USING (kind, name)""",
}
