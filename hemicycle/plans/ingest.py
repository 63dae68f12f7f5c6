"""Queries of extraction: pages, bulletins, votes and speeches. Page readers have no SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from hemicycle.operators import extraction as ex
from hemicycle.plans import binding as b


def _bulletins(s, d):
    """Each document becomes a bulletin of amendments, its lines the proposed change."""
    head = F.concat(F.lit("ENMIENDA NÚM. 1\nGrupo Parlamentario "), F.col("source"), F.lit("\nAl artículo 1\nDe modificación.\n"))
    content = F.concat(head, F.col("text"), F.lit("\nJUSTIFICACIÓN\nMejora técnica.\nENMIENDA NÚM. 2\nGrupo Mixto\nDe supresión.\nJUSTIFICACIÓN\n"), F.col("lang"))
    return b.table(s, d, "documents").select(F.concat(F.lit("121/"), F.format_string("%06d", "doc_id")).alias("reference"), F.lit("Enmiendas e índice de enmiendas al articulado").alias("name"), content.alias("content"))


def _amendments(s, d):
    rows = ex.amendment_rows(_bulletins(s, d), [])
    return rows.select("id", "reference", "chamber", "type", "applies_to", F.array_join("groups", ",").alias("groups"), F.array_join("justification", "|").alias("justification"))


_AMENDMENTS_SQL = """WITH d AS (SELECT '121/' || CASE WHEN doc_id < 1000000 THEN lpad(CAST(doc_id AS VARCHAR), 6, '0') ELSE CAST(doc_id AS VARCHAR) END AS reference, source, lang, md5('Enmiendas e índice de enmiendas al articulado') AS h FROM documents)
SELECT reference || '/' || h || '/1' AS id, reference, 'congress' AS chamber, 'De modificación' AS type, 'Al artículo 1' AS applies_to, 'Grupo Parlamentario ' || source AS groups, 'Mejora técnica.' AS justification FROM d
UNION ALL SELECT reference || '/' || h || '/2', reference, 'congress', 'De supresión', NULL, 'Grupo Mixto', lang FROM d"""


def _parsed_pages(s, d):
    """Title and links of each page, by the document tree."""
    def read(html, url):
        root = ex.parse(html)
        return {"url": url, "title": root.first("title").text(), "links": [a.attrs.get("href") for a in root.select("nav a")]}

    rows = ex.pages_to_rows(b.table(s, d, "pages"), read, "url string, title string, links array<string>, error string")
    return rows.select("url", "title", F.size("links").alias("n_links"), "error")


def _speeches(s, d):
    events = b.table(s, d, "events")
    json = F.concat(F.lit('{"a": {"video_intervencion": {"enlace_descarga02": "http://v/'), F.col("event_id"), F.lit('"}, "fecha": '), F.col("user_id"), F.lit(', "sesion": {"nombre_sesion": "Pleno"}, "tipo_intervencion": "x"'), F.when(F.col("event_id") % 2 == 0, ', "orador": "Ana"').otherwise(""), F.lit("}}"))
    return ex.speeches(events.select(F.col("event_id").cast("string").alias("reference"), json.alias("json")))


_SPEECHES_SQL = """WITH e AS (SELECT *, CAST(event_id AS VARCHAR) AS reference, 'http://v/' || event_id AS link, CASE WHEN event_id % 2 = 0 THEN 'Ana' END AS speaker FROM events)
SELECT sha1(reference || link || coalesce(speaker, '')) AS id, link, reference, 'Pleno' AS session_name, 'x' AS type, speaker, user_id AS date FROM e"""

QUERIES = {"amendment_parse": _amendments, "html_tree_pages": _parsed_pages, "speeches_from_json": _speeches}
SQL = {"amendment_parse": _AMENDMENTS_SQL, "speeches_from_json": _SPEECHES_SQL}
