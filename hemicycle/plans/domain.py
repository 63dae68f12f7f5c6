"""Queries of tagging, planning, authorship, text and updates, each with its SQL where it has one."""

from __future__ import annotations

from pyspark.sql import functions as F

from hemicycle import dims
from hemicycle.functions import text as tx
from hemicycle.operators import authorship as au
from hemicycle.operators import planning as pl
from hemicycle.operators import tagging as tg
from hemicycle.operators import updates as up
from hemicycle.operators.alignment import without_singles
from hemicycle.plans import analytics as an
from hemicycle.plans import binding as b

DICTIONARY = [
    tg.Entry("kb1", "english", "function", "thing", "thing"),
    tg.Entry("kb1", "english", "function", "thatin", "thatin"),
    tg.Entry("kb1", "english", "ending", "ation", "ation"),
    tg.Entry("kb1", "german", "negation", "nicht", "[Nn]icht"),
    tg.Entry("kb1", "german", "ending", "heit", "(heit|keit)en"),
    tg.Entry("kb2", "romance", "adverb", "mente", "mente"),
    tg.Entry("kb2", "romance", "plural", "eaux", "eaux"),
    tg.Entry("kb2", "romance", "pronoun", "elle", "elle"),
    tg.Entry("kb2", "licence", "permission", "licensed", "[Ll]icensed"),
    tg.Entry("kb2", "insult", "mild", "clown", "clown"),
    tg.Entry("kb2", "insult", "strong", "idiot", "idiot"),
    tg.Entry("kb2", "noise", "marks", "percent", "%%%"),
]
LOW, HIGH = 1000, 1100
LATER = "1999-12-31"


def docs(spark, d):
    """(id, title, body, n_chars): first line and the rest."""
    title = F.substring_index("text", "\n", 1)
    return b.table(spark, d, "documents").select(F.col("doc_id").alias("id"), title.alias("title"), F.substr(F.col("text"), F.length(title) + 2).alias("body"), "n_chars")


def tags(spark, d, dictionary=DICTIONARY):
    return without_singles(tg.tag(docs(spark, d), dictionary))


def _rows(dictionary) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in e) + ")" for e in dictionary)


DOCS = "docs AS (SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, substr(text, length(split_part(text, chr(10), 1)) + 2) AS body, n_chars FROM documents)"


def _tags_cte(dictionary=DICTIONARY, name="tags", singles=False) -> str:
    times = "len(regexp_extract_all(title, regex)) + len(regexp_extract_all(body, regex))"
    keep = "" if singles else " WHERE total <> 1"
    return f"""{name}_all AS (SELECT id, kb, topic, subtopic, tag, CAST({times} AS BIGINT) AS times FROM docs CROSS JOIN (VALUES {_rows(dictionary)}) AS v(kb, topic, subtopic, tag, regex) WHERE {times} > 0),
{name} AS (SELECT id, kb, topic, subtopic, tag, times FROM (SELECT *, sum(times) OVER (PARTITION BY id, kb, topic) AS total FROM {name}_all){keep})"""


TAGS = f"WITH {DOCS}, {_tags_cte()}"
_ALL = "id, kb, topic, subtopic, tag, times"
_MODIFIED = [DICTIONARY[9]._replace(regex="clowns?|fool")]


def _nested(change):
    return lambda s, d: tg.flatten(tg.nest(tags(s, d)).select("id", change(F.col("tagged")).alias("tagged")))


def _retag(s, d):
    left = tg.flatten(tg.nest(tags(s, d)).select("id", tg.untag_tag(F.col("tagged"), "insult", "clown").alias("tagged")))
    return without_singles(tg.merge(left, tg.tag(docs(s, d), _MODIFIED)))


def _amendments(s, d):
    """Justification (title) and proposed change (body) are tagged apart, singles stay."""
    both = [tg.tag(docs(s, d), DICTIONARY, (c,)).withColumn("part", F.lit(p)) for c, p in (("title", "justification"), ("body", "propossed_change"))]
    return both[0].unionByName(both[1])


def references(spark, d):
    """(code, number, status) of all orders: five types, numbers from 1."""
    codes = F.array(*map(F.lit, ["121", "122", "161", "180", "184"]))
    return b.initiatives(spark, d).select(F.get(codes, (F.col("id") % 5).cast("int")).alias("code"), (F.floor(F.col("id") / 5) + 1).alias("number"), "status", "id")


def stored(spark, d):
    have = b.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id")).distinct()
    return references(spark, d).join(have, "id", "left_semi").select("code", "number", "status")


def totals(spark, d):
    return references(spark, d).groupBy("code").agg(F.count("*").alias("total"))


_PAD = "CASE WHEN number < 1000000 THEN lpad(CAST(number AS VARCHAR), 6, '0') ELSE CAST(number AS VARCHAR) END"
REFS = f"""{an.VIEWS}, refs AS (SELECT ['121', '122', '161', '180', '184'][id % 5 + 1] AS code, id // 5 + 1 AS number, status, id FROM initiatives),
stored AS (SELECT code, number, status FROM refs WHERE id IN (SELECT l_orderkey FROM lineitem)), totals AS (SELECT code, count(*) AS total FROM refs GROUP BY 1),
bounds AS (SELECT code, min(number) AS a, max(number) AS z, count(*) AS n FROM stored GROUP BY 1),
gaps AS (SELECT code, number FROM (SELECT code, unnest(range(a, z + 1)) AS number FROM bounds) ANTI JOIN stored USING (code, number)),
opened AS (SELECT code, number FROM stored WHERE status = '{dims.OPEN}')"""


def _plan_sql(tail: str) -> str:
    return f"""WITH {REFS}, tail AS ({tail}) SELECT code, number, code || '/' || {_PAD} AS reference, reason FROM
(SELECT code, number, 'gap' AS reason FROM gaps UNION ALL SELECT code, number, 'open' FROM opened UNION ALL SELECT code, number, 'tail' FROM tail)"""


_TAIL_ALL = "SELECT code, unnest(range(z + 1, z + (total - n) + 3)) AS number FROM totals JOIN bounds USING (code) WHERE total >= n"
_TAIL_ONE = "SELECT code, unnest(range(z, total + 3)) AS number FROM totals JOIN bounds USING (code) WHERE total <> z - a + 1"

_ITEMS = ["Pleno desde 01/02/2020", "convalidado", "Comisión de Justicia desde 3/4/2021", "Decaído", "Tramitado por completo sin req.", "Concluido - (x)", "aprobado CON modificaciones", "Inadmitido a trámite", "nada", "Caducado", "Retirado", "Gobierno Contestación", "Rechazado Convertido"]
_CODES = ["070", "080", "121", "180", "212", "162", "184"]


def _statuses(s, d):
    items, codes = F.array(*map(F.lit, _ITEMS)), F.array(*map(F.lit, _CODES))
    at = lambda a, n: F.get(a, (F.col("o_orderkey") % n).cast("int"))
    rows = b.table(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 17 != 0, at(items, len(_ITEMS))).alias("item"), at(codes, len(_CODES)).alias("code"))
    status = tx.status(F.col("item"), F.col("code"))
    return rows.select("id", "code", status.alias("status"), tx.is_final(status).alias("final"))


def _status_sql() -> str:
    case = f"CASE WHEN code = '070' THEN '{dims.APPROVED}' WHEN item IS NULL THEN '{dims.UNKNOWN}'"
    for name, pattern, only, without in dims.STATUS_RULES:
        case += f" WHEN regexp_matches(item, '(?i){pattern}')" + (f" AND code IN {an._in(only)}" if only else "") + (f" AND code NOT IN {an._in(without)}" if without else "") + f" THEN '{name}'"
    case += f" ELSE '{dims.UNKNOWN}' END"
    lst = lambda v: "[" + ", ".join(f"'{x}'" for x in v) + "]"
    return f"""WITH rows AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 17 <> 0 THEN {lst(_ITEMS)}[o_orderkey % {len(_ITEMS)} + 1] END AS item, {lst(_CODES)}[o_orderkey % {len(_CODES)} + 1] AS code FROM orders),
named AS (SELECT id, code, {case} AS status FROM rows) SELECT id, code, status, status NOT IN ('{dims.OPEN}', '{dims.UNKNOWN}') AS final FROM named"""


def _author_items(s, d):
    """Author items of each initiative: names with and without the group's short name, groups, others."""
    lines = b.table(s, d, "lineitem").select(F.col("l_orderkey").alias("id"), "l_suppkey").distinct()
    rows = lines.join(b._supplier(s, d), F.col("l_suppkey") == F.col("s_suppkey"))
    k = F.col("l_suppkey") % 5
    item = F.when(k == 0, F.concat("s_name", F.lit(" ("), F.upper(F.substring("r_name", 1, 2)), F.substring("r_name", -1, 1), F.lit(")"))).when(k == 1, F.col("s_name")).when(k == 2, F.concat("r_name", F.lit(" en el Congreso"))).when(k == 3, F.concat("s_name", F.lit(" y 3 Diputados"))).otherwise(F.lit("Gobierno"))
    return rows.select("id", item.alias("item"), (k != 4).alias("linked"))


def _short(c):
    return F.concat(F.upper(F.substring(c, 1, 2)), F.substring(c, -1, 1))


def _resolve(s, d):
    people = b._supplier(s, d)
    deputies = people.select(F.col("s_name").alias("name"), _short("r_name").alias("parliamentarygroup"))
    groups = b.table(s, d, "region").select(F.col("r_name").alias("name"), _short("r_name").alias("shortname"))
    return au.resolve(_author_items(s, d), deputies, groups)


_SHORT_SQL = "upper(substr(r_name, 1, 2)) || right(r_name, 1)"
_RESOLVE_SQL = f"""WITH {an.VIEWS}, lines AS (SELECT DISTINCT l_orderkey AS id, l_suppkey % 5 AS k, s_name, r_name FROM lineitem JOIN people ON l_suppkey = s_suppkey)
SELECT DISTINCT id, kind, name FROM (SELECT id, 'deputy' AS kind, s_name AS name FROM lines WHERE k IN (0, 1) UNION ALL SELECT id, 'group', r_name FROM lines WHERE k IN (0, 1, 2)
UNION ALL SELECT id, 'other', 'Gobierno' FROM lines WHERE k = 4)"""


def _composition(s, d):
    people = b.table(s, d, "supplier").join(b.table(s, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(b.table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    deputies = people.select(F.col("s_name").alias("name"), _short("r_name").alias("parliamentarygroup"), F.col("n_name").alias("party"), (F.col("s_acctbal") > 0).alias("active"))
    groups = b.table(s, d, "region").select(F.col("r_name").alias("name"), _short("r_name").alias("shortname"))
    return au.composition(groups, deputies)


def _place_history(s, d):
    ordered = F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name")))
    places = b.table(s, d, "nation").agg(F.transform(ordered, lambda n: n["n_name"]).alias("places")).scalar()
    rows = b.table(s, d, "customer").join(b.table(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    history = F.array(F.lit("Mesa del Congreso"), F.concat(F.lit("Comisión de "), F.when(F.col("c_custkey") % 7 != 0, F.col("n_name")), F.lit(" desde 1/1/2020")), F.concat(F.lit("Pleno NATION_"), (F.col("c_custkey") % 30).cast("string")))
    return rows.select("c_custkey", F.array_compact(history).alias("history"), places.alias("places")).select("c_custkey", au.place_from_history(F.col("history"), F.col("places")).alias("place"))


_PLACE_SQL = """WITH h AS (SELECT c_custkey, list_filter(['Mesa del Congreso', 'Comisión de ' || CASE WHEN c_custkey % 7 <> 0 THEN n_name END || ' desde 1/1/2020', 'Pleno NATION_' || (c_custkey % 30)], lambda x: x IS NOT NULL) AS history
FROM customer JOIN nation ON c_nationkey = n_nationkey), p AS (SELECT n_nationkey, n_name FROM nation),
hits AS (SELECT c_custkey, min_by(n_name, n_nationkey) AS place FROM h, p WHERE len(list_filter(history, lambda x: contains(x, n_name))) > 0 GROUP BY 1) SELECT c_custkey, place FROM h LEFT JOIN hits USING (c_custkey)"""


def _signatures(s, d):
    lines = b.table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("Palacio del Congreso, "), F.format_string("Supplier#%09d", F.col("c_custkey") % 150), F.lit(" y "), F.format_string("Supplier#%09d", (F.col("c_custkey") * 7) % 150), F.lit(", Diputados")).alias("line"))
    deputies = b.table(s, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_name").alias("fullname"))
    return au.signed_by(lines, deputies)


_HTML = "trim(regexp_replace(html, '<[^>]+>', '', 'g'))"


def _plain_sql():
    x = "regexp_replace(html, '(<br>){3,4}', chr(10), 'g')"
    for old in ("<br>", "    ", "   ", "  "):
        x = f"replace({x}, '{old}', ' ')"
    x = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    for name, char in dims.ENTITIES.items():
        x = f"replace({x}, '&{name};', '{char.replace(chr(39), chr(39) * 2)}')"
    return f"SELECT page_id, {x} AS text FROM pages"


def _merged(s, d):
    have = tags(s, d)
    return tg.merge_absent(have.filter("kb = 'kb1'"), have.filter("kb <> 'kb1'"))


def _strings(s, d):
    full = F.concat(F.lit("Título de "), "p_name", F.lit(" (121/000"), F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0"), F.lit(")"))
    ref = F.concat(F.lit("121/000"), F.lpad((F.col("p_partkey") % 1000).cast("string"), 3, "0"))
    name = F.concat(F.initcap("p_name"), F.lit(", "), F.initcap(F.lower("p_type")))
    return b.table(s, d, "part").select(
        "p_partkey",
        tx.title_of(full, ref).alias("title"),
        tx.initiative_id(ref).alias("initiative_id"),
        tx.first_last(name).alias("fullname"),
        tx.slug(name).alias("slug"),
        F.sha1(F.concat("p_name", "p_brand")).alias("sha"),
        F.concat(ref, F.lit("/"), F.md5("p_brand"), F.lit("/1")).alias("amendment_id"),
        tx.without_dot(F.concat("p_type", F.when(F.col("p_size") % 2 == 0, ".").otherwise(""))).alias("type_name"),
        tx.after(F.col("p_name"), "ring").alias("after_needle"),
        tx.reference(F.col("p_partkey"), F.lit("181")).alias("reference"),
    )


_STRINGS_SQL = """WITH p AS (SELECT *, '121/000' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') AS ref, upper(substr(p_name, 1, 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' || upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) AS cap, upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) AS typ FROM part)
SELECT p_partkey, 'Título de ' || p_name AS title, replace(ref, '/', '-') AS initiative_id, typ || ' ' || cap AS fullname, replace(lower(cap), ' ', '-') || '-' || lower(typ) AS slug, sha1(p_name || p_brand) AS sha, ref || '/' || md5(p_brand) || '/1' AS amendment_id, p_type AS type_name,
CASE WHEN contains(p_name, 'ring') THEN substr(p_name, strpos(p_name, 'ring') + 4) ELSE substr(p_name, 4) END AS after_needle,
'181/' || CASE WHEN p_partkey < 1000000 THEN lpad(CAST(p_partkey AS VARCHAR), 6, '0') ELSE CAST(p_partkey AS VARCHAR) END AS reference FROM p"""


def _dates(s, d):
    fmt = lambda c: F.date_format(c, "dd/MM/yyyy")
    created = F.col("o_orderdate")
    text = F.concat(F.lit("Presentado el "), fmt(created), F.lit(", calificado el "), fmt(created + F.expr("interval 40 days")), F.lit(" y 31/02/2000; plazo "), fmt(created + F.expr("interval 900 days")))
    return b.table(s, d, "orders").select("o_orderkey", tx.latest_date(text, LATER).alias("updated"))


_DATES_SQL = f"SELECT o_orderkey, (SELECT max(x) FROM (SELECT unnest([o_orderdate, o_orderdate + INTERVAL 40 DAY, o_orderdate + INTERVAL 900 DAY]) AS x) WHERE x < TIMESTAMP '{LATER}') AS updated FROM orders"


def _json(s, d):
    k = F.from_json("props", "k int").getField("k")
    return b.table(s, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(k.isNotNull()).alias("with_k"), F.sum(k.cast("long")).alias("sum_k"))


def _emails(s, d):
    k = F.col("c_custkey") % 6
    raw = F.when(k == 0, F.concat(F.lit("Ana."), F.col("c_custkey").cast("string"), F.lit("@congreso.es"))).when(k == 1, F.lit("sin arroba")).when(k == 2, F.concat(F.lit("x@-mal-."), F.col("c_custkey").cast("string"))).when(k == 3, F.concat(F.lit("JUAN@SENADO"), F.col("c_custkey").cast("string"), F.lit(".GOV.PY"))).when(k == 4, F.lit("a@b@congreso.es"))
    return b.table(s, d, "customer").select("c_custkey", tx.email(raw).alias("email"))


_EMAILS_SQL = "SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'Ana.' || c_custkey || '@congreso.es' WHEN 3 THEN 'JUAN@SENADO' || c_custkey || '.GOV.PY' END AS email FROM customer"


def _alerts(s, d):
    lines = b.table(s, d, "lineitem").select(F.col("l_orderkey").alias("id")).distinct().withColumn("has", F.lit(True))
    now = b.initiatives(s, d).select("id", "status").join(lines, "id", "left").select("id", "status", F.coalesce("has", F.lit(False)).alias("has_content"))
    before = now.filter("id % 10 <> 0").select("id", F.when(F.col("id") % 3 == 0, dims.OPEN).otherwise(F.col("status")).alias("status"), (F.col("has_content") & (F.col("id") % 4 != 0)).alias("has_content"))
    return up.alerts(before, now)


_ALERTS_SQL = f"""WITH {an.VIEWS}, now AS (SELECT id, status, id IN (SELECT l_orderkey FROM lineitem) AS has FROM initiatives),
b AS (SELECT *, CASE WHEN id % 3 = 0 THEN '{dims.OPEN}' ELSE status END AS was, has AND id % 4 <> 0 AS had FROM now)
SELECT id, '{dims.REASONS["new"]}' AS reason FROM now WHERE id % 10 = 0 UNION ALL SELECT id, '{dims.REASONS["published"]}' FROM b WHERE id % 10 <> 0 AND has AND NOT had
UNION ALL SELECT id, '{dims.REASONS["finished"]}' FROM b WHERE id % 10 <> 0 AND was = '{dims.OPEN}' AND status <> '{dims.OPEN}'"""


def _upsert(s, d):
    events = b.table(s, d, "events").select("user_id", "event_id", "ts", "event_type")
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    old, new = (up.latest(events.filter(p), "user_id", "ts", "event_id") for p in (F.col("ts") < cut, F.col("ts") >= cut))
    return up.upsert(old, new, "user_id")


def _votes(s, d):
    """A line number can come twice in an order; its flags join."""
    lines = b.table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("pos"))
    return up.selected_votes(lines.agg(F.max(F.col("l_returnflag") == "R").alias("labelled"), F.max(F.col("l_linestatus") == "F").alias("titled")))


def _answers(s, d):
    rows = b.initiatives(s, d).select(F.col("id").cast("string").alias("id"), "reference", "code", F.when(F.col("status") == dims.APPROVED, "Respondida").otherwise(F.col("status")).alias("status"), F.concat(F.lit("P"), F.col("id").cast("string")).alias("content"), F.when(F.col("id") % 3 != 0, F.concat(F.lit("R"), F.col("id").cast("string"))).alias("answer")).filter("code = '184'")
    return up.with_answers(rows)


_ANSWERS_SQL = f"""WITH {an.VIEWS}, q AS (SELECT id, code || '/' || CASE WHEN id < 1000000 THEN lpad(CAST(id AS VARCHAR), 6, '0') ELSE CAST(id AS VARCHAR) END AS reference, code, CASE WHEN status = '{dims.APPROVED}' THEN 'Respondida' ELSE status END AS status, 'P' || id AS content, CASE WHEN id % 3 <> 0 THEN 'R' || id END AS answer FROM initiatives WHERE code = '184'),
w AS (SELECT *, status IN ('{dims.OPEN}', 'Respondida') AS wants FROM q)
SELECT CAST(id AS VARCHAR) AS id, reference, code, 'Pregunta' AS kind, CASE WHEN wants AND answer IS NULL THEN '{dims.OPEN}' ELSE status END AS status, content FROM w
UNION ALL SELECT replace(reference, '/', '-') || '-respuesta', reference, code, 'Respuesta Gobierno', status, answer FROM w WHERE wants AND answer IS NOT NULL"""


def _links(s, d):
    hrefs = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    return b.table(s, d, "pages").select("page_id", F.posexplode(hrefs).alias("pos", "href"))


def _sentences(s, d):
    return b.table(s, d, "documents").select("doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("pos", "sentence"))


def _roman(s, d):
    return b.table(s, d, "part").select("p_partkey", tx.roman((F.col("p_partkey") % 4000).cast("long")).alias("roman"))


_ROMAN_SQL = "SELECT p_partkey, " + " || ".join(
    f"[{', '.join(repr(x) for x in values)}][(p_partkey % 4000) // {10**k} % 10 + 1]" for k, values in reversed(list(enumerate(tx._ROMAN)))
) + " AS roman FROM part"


def _fuzzy(s, d):
    return au.fuzzy(b.table(s, d, "customer"), "c_mktsegment", b.table(s, d, "region"), "r_name")


_FUZZY_SQL = """SELECT c_mktsegment, r_name, similarity FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY similarity DESC, r_name) AS rn FROM
(SELECT c_mktsegment, r_name, round(1 - levenshtein(lower(c_mktsegment), lower(r_name)) / greatest(length(c_mktsegment), length(r_name), 1), 6) AS similarity FROM (SELECT DISTINCT c_mktsegment FROM customer), region)) WHERE rn = 1"""


QUERIES = {
    "initiatives_with_topics": lambda s, d: tg.nest(tags(s, d)).filter(tg.has_topics(F.col("tagged"))).select("id"),
    "tag_documents": tags,
    "tag_single_kb": lambda s, d: tags(s, d, [e for e in DICTIONARY if e.kb == "kb1"]),
    "tag_new_topic": lambda s, d: without_singles(tg.merge(tags(s, d, [e for e in DICTIONARY if e.topic != "insult"]), tg.tag(docs(s, d), [e for e in DICTIONARY if e.topic == "insult"]))),
    "tag_new_tag": lambda s, d: tags(s, d, [DICTIONARY[5]]),
    "tag_amendments": _amendments,
    "tag_untagged_short": lambda s, d: tg.untagged(docs(s, d), tg.nest(tags(s, d)), False, 2000).select("id"),
    "tag_untagged_long_kb": lambda s, d: tg.untagged(docs(s, d), tg.nest(tags(s, d)), True, 2000, "kb1").select("id"),
    "tag_rename": _nested(lambda t: tg.rename(t, "english", "thing", "entity")),
    "untag_topic": _nested(lambda t: tg.untag_topic(t, "english")),
    "untag_tag": _nested(lambda t: tg.untag_tag(t, "english", "thing")),
    "untag_kb": _nested(lambda t: tg.untag_kb(t, "kb1")),
    "untag_reference": lambda s, d: tg.flatten(tg.untag_reference(tg.nest(tags(s, d)), [7, 8, 9])),
    "untag_all": lambda s, d: tg.nest(tags(s, d)).select("id", F.size(F.slice("tagged", 1, 0)).cast("long").alias("n_tagged")),
    "retag_modify_regex": _retag,
    "tag_propagate_near_duplicates": lambda s, d: tg.propagate(docs(s, d), tags(s, d), LOW, HIGH),
    "reference_gaps": lambda s, d: pl.gaps(stored(s, d)),
    "reference_plan_new": lambda s, d: pl.plan_new(stored(s, d), totals(s, d)),
    "reference_plan_new_single_type": lambda s, d: pl.plan_new(stored(s, d), totals(s, d), single_type=True),
    "reference_plan_all": lambda s, d: pl.plan_all(totals(s, d)),
    "reference_plan_all_single_type": lambda s, d: pl.plan_all(totals(s, d), single_type=True),
    "skip_oversight_refs": lambda s, d: pl.skip_group(pl.plan_all(totals(s, d)), dims.initiative_types(s), dims.OVERSIGHT),
    "status_classify": _statuses,
    "authors_resolve": _resolve,
    "group_composition": _composition,
    "place_from_history": _place_history,
    "authors_from_signature": _signatures,
    "fuzzy_group_match": _fuzzy,
    "html_strip_text": lambda s, d: b.table(s, d, "pages").select("page_id", tx.strip_tags(F.col("html")).alias("text")),
    "content_plain_text": lambda s, d: b.table(s, d, "pages").select("page_id", tx.plain_text(F.col("html")).alias("text")),
    "age_from_date": lambda s, d: b.table(s, d, "orders").select("o_orderkey", tx.age(F.col("o_orderdate"), F.lit("2024-02-29").cast("date")).alias("age")),
    "initiatives_by_tag": lambda s, d: tg.by_tag(tags(s, d), "english", "thing"),
    "tag_merge_absent": _merged,
    "html_title": lambda s, d: b.table(s, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title")),
    "html_links": _links,
    "sentence_split": _sentences,
    "string_normalise": _strings,
    "dates_parse_latest": _dates,
    "json_payload": _json,
    "roman_numerals": _roman,
    "email_validate": _emails,
    "alerts_new_published_finished": _alerts,
    "upsert_latest": _upsert,
    "votes_sticky_selection": _votes,
    "question_answer_split": _answers,
}
SQL = {
    "initiatives_with_topics": f"{TAGS} SELECT DISTINCT id FROM tags",
    "tag_documents": f"{TAGS} SELECT * FROM tags",
    "tag_single_kb": f"{TAGS} SELECT * FROM tags WHERE kb = 'kb1'",
    "tag_new_topic": f"{TAGS} SELECT * FROM tags",
    "tag_new_tag": f"WITH {DOCS}, {_tags_cte([DICTIONARY[5]])} SELECT * FROM tags",
    "tag_amendments": f"WITH {DOCS} SELECT id, kb, topic, subtopic, tag, CAST(times AS BIGINT) AS times, part FROM (SELECT id, kb, topic, subtopic, tag, part, len(regexp_extract_all(txt, regex)) AS times FROM (SELECT id, 'justification' AS part, title AS txt FROM docs UNION ALL SELECT id, 'propossed_change', body FROM docs) CROSS JOIN (VALUES {_rows(DICTIONARY)}) AS v(kb, topic, subtopic, tag, regex)) WHERE times > 0",
    "tag_untagged_short": f"{TAGS} SELECT id FROM docs WHERE length(title) + length(body) < 2000 AND id NOT IN (SELECT id FROM tags)",
    "tag_untagged_long_kb": f"{TAGS} SELECT id FROM docs WHERE length(title) + length(body) >= 2000 AND id NOT IN (SELECT id FROM tags WHERE kb = 'kb1')",
    "tag_rename": f"{TAGS} SELECT id, kb, topic, subtopic, CASE WHEN topic = 'english' AND tag = 'thing' THEN 'entity' ELSE tag END AS tag, times FROM tags",
    "untag_topic": f"{TAGS} SELECT * FROM tags WHERE topic <> 'english'",
    "untag_tag": f"{TAGS} SELECT * FROM tags WHERE NOT (topic = 'english' AND tag = 'thing')",
    "untag_kb": f"{TAGS} SELECT * FROM tags WHERE kb <> 'kb1'",
    "untag_reference": f"{TAGS} SELECT * FROM tags WHERE id NOT IN (7, 8, 9)",
    "untag_all": f"{TAGS} SELECT DISTINCT id, CAST(0 AS BIGINT) AS n_tagged FROM tags",
    "retag_modify_regex": f"WITH {DOCS}, {_tags_cte()}, {_tags_cte(_MODIFIED, 'fresh', True)}, both_ AS (SELECT * FROM tags WHERE NOT (topic = 'insult' AND tag = 'clown') UNION ALL SELECT * FROM fresh), m AS (SELECT id, kb, topic, subtopic, tag, CAST(sum(times) AS BIGINT) AS times FROM both_ GROUP BY ALL) SELECT {_ALL} FROM (SELECT *, sum(times) OVER (PARTITION BY id, kb, topic) AS total FROM m) WHERE total <> 1",
    "tag_propagate_near_duplicates": f"{TAGS}, alike AS (SELECT id FROM docs WHERE n_chars > {LOW} AND n_chars < {HIGH}), t AS (SELECT min(id) AS id FROM (SELECT id FROM tags SEMI JOIN alike USING (id) GROUP BY id HAVING count(DISTINCT kb) = 2)) SELECT a.id, g.kb, g.topic, g.subtopic, g.tag, g.times FROM alike a, tags g WHERE g.id = (SELECT id FROM t)",
    "reference_gaps": f"WITH {REFS} SELECT * FROM gaps",
    "reference_plan_new": _plan_sql(_TAIL_ALL),
    "reference_plan_new_single_type": _plan_sql(_TAIL_ONE),
    "reference_plan_all": f"WITH {REFS}, t AS (SELECT code, unnest(range(1, total + 4)) AS number FROM totals) SELECT code, number, code || '/' || {_PAD} AS reference, 'all' AS reason FROM t",
    "reference_plan_all_single_type": f"WITH {REFS}, t AS (SELECT code, unnest(range(0, total + 3)) AS number FROM totals) SELECT code, number, code || '/' || {_PAD} AS reference, 'all' AS reason FROM t",
    "skip_oversight_refs": f"WITH {REFS}, t AS (SELECT code, unnest(range(1, total + 4)) AS number FROM totals) SELECT code, number, code || '/' || {_PAD} AS reference, 'all' AS reason FROM t WHERE code NOT IN ('180', '184')",
    "status_classify": _status_sql(),
    "authors_resolve": _RESOLVE_SQL,
    "group_composition": f"SELECT r_name AS grp, n_name AS party, count(*) AS members FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_acctbal > 0 GROUP BY 1, 2",
    "place_from_history": _PLACE_SQL,
    "authors_from_signature": "SELECT DISTINCT c_custkey AS id, s_name AS name FROM customer, supplier WHERE s_suppkey IN (c_custkey % 150, (c_custkey * 7) % 150)",
    "fuzzy_group_match": _FUZZY_SQL,
    "html_strip_text": f"SELECT page_id, {_HTML} AS text FROM pages",
    "content_plain_text": _plain_sql(),
    "age_from_date": "SELECT o_orderkey, CAST(date_sub('year', CAST(o_orderdate AS DATE), DATE '2024-02-29') AS INT) AS age FROM orders",
    "initiatives_by_tag": f"{TAGS} SELECT DISTINCT id FROM tags WHERE topic = 'english' AND tag = 'thing'",
    "tag_merge_absent": f"{TAGS}, o AS (SELECT * FROM tags WHERE kb = 'kb1'), n AS (SELECT *, row_number() OVER (PARTITION BY id, tag ORDER BY kb, topic, subtopic, times) AS rn FROM tags WHERE kb <> 'kb1') SELECT {_ALL} FROM o UNION ALL SELECT {_ALL} FROM n WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM o WHERE o.id = n.id AND o.tag = n.tag)",
    "html_title": "SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages",
    "html_links": "SELECT page_id, CAST(unnest(range(len(h))) AS INT) AS pos, unnest(h) AS href FROM (SELECT page_id, regexp_extract_all(html, 'href=\"([^\"]*)\"', 1) AS h FROM pages)",
    "sentence_split": "SELECT doc_id, CAST(unnest(range(len(p))) AS INT) AS pos, replace(unnest(p), chr(1), '.') AS sentence FROM (SELECT doc_id, list_filter(string_split(regexp_replace(text, '\\.([0-9])', chr(1) || '\\1', 'g'), '.'), lambda x: x <> '') AS p FROM documents)",
    "string_normalise": _STRINGS_SQL,
    "dates_parse_latest": _DATES_SQL,
    "json_payload": "SELECT event_type, count(*) AS n, count(k) AS with_k, CAST(sum(k) AS BIGINT) AS sum_k FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) GROUP BY 1",
    "roman_numerals": _ROMAN_SQL,
    "email_validate": _EMAILS_SQL,
    "alerts_new_published_finished": _ALERTS_SQL,
    "upsert_latest": "SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
    "votes_sticky_selection": "SELECT id, pos, labelled, titled FROM (SELECT *, bool_or(labelled) OVER (PARTITION BY id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS seen FROM (SELECT l_orderkey AS id, l_linenumber AS pos, bool_or(l_returnflag = 'R') AS labelled, bool_or(l_linestatus = 'F') AS titled FROM lineitem GROUP BY 1, 2)) WHERE labelled OR (NOT seen AND titled)",
    "question_answer_split": _ANSWERS_SQL,
}
