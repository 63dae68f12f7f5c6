"""From raw pages and documents to rows. A row that can't be read carries its error and nulls."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple
from urllib.parse import parse_qs, urlparse

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hemicycle import dims
from hemicycle.functions import text as tx
from hemicycle.functions.html import Node, parse

INITIATIVE = "id string, reference string, code string, title string, type string, place string, created string, history array<string>, authors array<struct<item:string,linked:boolean>>, dates array<string>, url string, error string"
DEPUTY = "name string, grp string, constituency string, gender string, email string, twitter string, facebook string, web string, start_date string, end_date string, birthdate string, positions array<string>, legislatures array<string>, bio array<string>, declarations map<string,string>, error string"
AMENDMENT = "id string, reference string, bulletin_name string, chamber string, type string, applies_to string, groups array<string>, authors array<string>, justification array<string>, propossed_change array<string>"
_DATE = re.compile(r"[0-9]{2}/[0-9]{2}/[0-9]{4}")


def _squeeze(s: str) -> str:
    return re.sub(r"\s+", " ", s).strip()


def _text(root: Node, path: str) -> str | None:
    node = root.first(path)
    return None if node is None else _squeeze(node.text())


def initiative_page(html: str, url: str) -> dict:
    root = parse(html)
    ref = parse_qs(urlparse(url).query).get("_iniciativas_id", [""])[0]
    full = root.first(".entradilla-iniciativa")
    if full is None:
        raise ValueError("no header")
    sections = [_squeeze(n.text()) for n in root.select(".titular-seccion")]
    history = []
    if (steps := root.first(".iniciativaTramitacion")) is not None:
        history = [p.strip() for p in steps.parts("br")]
    if (result := root.first(".resultadoTramitacion")) is not None:
        history.append(result.text())
    authors = []
    for head in root.select("h3"):
        if "Autor" in head.text() and head.parent is not None:
            after = head.parent.children[head.parent.children.index(head) + 1 :]
            lists = [n for n in after if isinstance(n, Node) and n.tag == "ul"]
            authors = [{"item": _squeeze(li.text()), "linked": bool(li.select("a"))} for li in (lists[0].select("li") if lists else [])]
            break
    shown = root.first(".f-present")
    created = _DATE.search(shown.text().split(",")[0]) if shown is not None else None
    whole = root.first("#portlet_iniciativas")
    title = _squeeze(full.text())
    return {
        "id": ref.replace("/", "-"), "reference": ref, "code": ref.split("/")[0], "title": title.removesuffix(f" ({ref})"),
        "type": sections[1].removesuffix(".") if len(sections) > 1 else None, "place": _text(root, ".comisionesCompetentes"),
        "created": created.group() if created else None, "history": history, "authors": authors,
        "dates": _DATE.findall(whole.text().replace(full.text(), "")) if whole is not None else [], "url": url,
    }


def deputy_page(html: str, url: str) -> dict:
    root = parse(html)
    name = _text(root, ".nombre-dip")
    if not name:
        raise ValueError("no name")
    header = (_text(root, ".cargo-dip") or "").split()
    dates = [_DATE.search(n.text()) for n in root.select(".f-alta")]
    dates = [d.group() if d else None for d in dates]
    social = {}
    for a in root.select(".rrss-dip a"):
        image = next((c.attrs.get("src", "") for c in a.walk()), "")
        for kind in ("twitter", "facebook", "web"):
            if kind in image:
                href = a.attrs.get("href", "")
                social[kind] = href if href.startswith("http") else "http://" + href
    paragraphs, bio = [], ""
    for h in root.select("h3"):
        if _squeeze(h.text()) == "Ficha personal" and h.parent is not None:
            paragraphs = [_squeeze(p.text()) for p in h.parent.select("p")]
            bio = _squeeze(h.parent.text()).replace("Ficha personal", "")
    born = _DATE.search(paragraphs[0]) if paragraphs else None
    terms = re.sub(r"Diputad[ao]| de la | Legislaturas|y ", "", paragraphs[1]).split(", ") if len(paragraphs) > 1 else []
    for p in paragraphs[:2]:
        bio = bio.replace(p, "")
    group = re.search(r"\(([^)]+)", _text(root, ".grupo-dip a") or "")
    return {
        "name": name, "grp": group.group(1).strip() if group else "", "constituency": " ".join(header[2:]) or None,
        "gender": ("Mujer" if header[0] == "Diputada" else "Hombre") if header else None, "email": _text(root, ".email-dip a"),
        "twitter": social.get("twitter"), "facebook": social.get("facebook"), "web": social.get("web"),
        "start_date": dates[0] if dates else None, "end_date": dates[1] if len(dates) > 1 else None, "birthdate": born.group() if born else None,
        "positions": [_squeeze(n.text()) for n in root.select(".cargos li")], "legislatures": terms,
        "bio": [s for s in _squeeze(bio.split(" Condición plena")[0]).split(". ") if s],
        "declarations": {_squeeze(a.text()): a.attrs.get("href", "") for a in root.select(".declaraciones-dip a")},
    }


def pages_to_rows(pages: DataFrame, read: Callable[[str, str], dict], schema: str) -> DataFrame:
    """One row a page (url, html) by a page reader."""
    names = [c.strip().split(" ")[0] for c in re.split(r", (?=\w+ )", schema)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url, html in zip(batch["url"], batch["html"], strict=True):
                try:
                    rows.append({**dict.fromkeys(names), **read(html, url)})
                except Exception as e:
                    rows.append({**dict.fromkeys(names), "error": f"{type(e).__name__}: {e}"})
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return pages.select("url", "html").mapInPandas(run, schema)


def initiatives(pages: DataFrame, as_of: str) -> DataFrame:
    """Initiatives with dates and status resolved by expressions."""
    rows = pages_to_rows(pages, initiative_page, INITIATIVE)
    seen = F.transform("dates", lambda d: tx.parse_date(d))
    updated = F.array_max(F.filter(seen, lambda d: d < F.lit(as_of).cast("timestamp_ntz")))
    last = F.try_element_at("history", F.lit(-1))
    return rows.withColumns({"created": tx.parse_date(F.col("created")), "updated": updated, "status": tx.status(last, F.col("code"))}).drop("dates")


class Deputy(NamedTuple):
    name: str
    fullname: str


def _signs(item: str, groups: list, authors: list, deputies: list[Deputy]) -> bool:
    """Authorship of a congress amendment: true when the line ends the authors."""
    if item.startswith("A la Mesa de la Comisión de Presupuestos"):
        return True
    if item[0] == "(" or item.startswith("Grupo"):
        groups.append(item.replace("(", "").replace(")", ""))
        return True
    authors += [d.name for d in deputies if d.fullname in item]
    if item[-1] == ")" and (inner := re.search(r".*\((.*)\)", item)):
        groups.append(inner.group(1))
        return True
    return False


def _senate_signs(item: str, groups: list) -> bool:
    if item == "ENMIENDA":
        return True
    found = re.search(r"\(([a-zA-Z]*)\)", item)
    if found:
        groups.append(found.group(1))
    return bool(found)


_SKIPPED = {"", "Común", "FIRMANTE:", "[...]'", "[**********página con cuadro**********]", "Podemos-En Comú Podem-Galicia en Común"}


def amendments(reference: str, name: str, content: str, deputies: list[Deputy]) -> list[dict]:
    """Amendments of one bulletin; its name tells the kind: totality, senate, or partial."""
    kind = "senate" if "(Senado)" in name else "totality" if "a la totalidad" in name else "partial"
    begin = content.find("ENMIENDA NÚM")
    out = []
    for text in [p for p in content[begin:].split("ENMIENDA NÚM.") if p] if begin >= 0 else []:
        lines = text.split("\n")
        row: dict = {"id": f"{reference}/{hashlib.md5(name.encode()).hexdigest()}/{lines[0].strip()}", "reference": reference, "bulletin_name": name, "chamber": "senate" if kind == "senate" else "congress"}
        row |= {"type": "Enmienda a la totalidad de devolución" if kind == "totality" else None, "applies_to": None, "groups": [], "authors": [], "justification": [], "propossed_change": []}
        state, pending = "authors", ""
        for item in lines[1:]:
            if item in _SKIPPED or item.startswith("Página") or item.isnumeric():
                continue
            if state == "authors":
                done = _senate_signs(item, row["groups"]) if kind == "senate" else _signs(item, row["groups"], row["authors"], deputies)
                if done:
                    state = {"senate": "intro", "totality": "change", "partial": "type"}[kind]
                continue
            if kind == "senate" and item.startswith("RETIRADA"):
                row["type"] = "RETIRADA"
                break
            if state == "intro":
                state = "type" if item.startswith("ENMIENDA") else state
            elif state == "type" and kind == "senate":
                pending += " " + item
                if len(item) > 4:
                    row["type"], state = pending.replace(".", ""), "change"
            elif state == "type":
                if item.startswith("Enmienda a la totalidad"):
                    row["type"], state = item, "change"
                elif item.startswith(("Al título", "Se propone suprimir")):
                    row |= {"type": "De modificación", "applies_to": item}
                    state = "change"
                elif item.startswith("Se añade un nuevo"):
                    row["type"], state = "De adición", "change"
                elif item.startswith("De "):
                    row |= {"type": item.replace(".", ""), "applies_to": pending.strip() or None}
                    state = "change"
                else:
                    pending += " " + item
            elif state == "change":
                if item.startswith("JUSTIFICACIÓN") or (kind != "totality" and item.startswith("MOTIVACIÓN")):
                    state = "why"
                elif kind != "totality":
                    row["propossed_change"].append(item)
            else:
                row["justification"].append(item)
        out.append(row)
    return out


def amendment_rows(bulletins: DataFrame, deputies: list[Deputy]) -> DataFrame:
    """Bulletins (reference, name, content) to amendments; the deputies are a small dimension."""
    columns = [c.split(" ")[0] for c in AMENDMENT.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [a for r in batch.itertuples() for a in amendments(r.reference, r.name, r.content or "", deputies)]
            yield pd.DataFrame(rows, columns=columns, dtype=object)

    return bulletins.select("reference", "name", "content").mapInPandas(run, AMENDMENT)


def unread_bulletins(bulletins: DataFrame, known: DataFrame) -> DataFrame:
    return bulletins.join(known.select("reference", F.col("bulletin_name").alias("name")).distinct(), ["reference", "name"], "left_anti")


def can_have_amendments(code):
    return code.isin(*dims.AMENDABLE)


def vote_blocks(pages: DataFrame, titles: DataFrame) -> DataFrame:
    """(id, pos, block, link, labelled, titled) from pages (id, html) and titles (id, title)."""
    pieces = F.split("html", "JSON</a>")
    rows = pages.select("id", F.posexplode(F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))).alias("pos", "piece")).join(titles, "id", "left")
    block = F.concat("piece", F.lit("JSON</a>"))
    labels = ("Toma en consideración", "Debate de totalidad", "Votación de conjunto")
    labelled = F.lit(False)
    for label in labels:
        labelled = labelled | F.col("piece").contains(label)
    tag = F.regexp_extract(block, r'(<a[\sa-zA-Z".=0-9_/:]+>JSON</a>)', 1)
    link = F.nullif(F.regexp_extract(tag, 'href="([^"]*)"', 1), F.lit(""))
    return rows.select("id", "pos", block.alias("block"), link.alias("link"), labelled.alias("labelled"), F.coalesce(F.col("piece").contains(F.col("title")), F.lit(False)).alias("titled"))


_SPEECH = "map<string,struct<video_intervencion:struct<enlace_descarga02:string>,fecha:bigint,sesion:struct<nombre_sesion:string>,tipo_intervencion:string,orador:string>>"


def speeches(raw: DataFrame) -> DataFrame:
    """Videos from JSON (reference, json): a map of interventions; every page is read, the last one too."""
    one = raw.select("reference", F.explode(F.from_json("json", _SPEECH)).alias("key", "v"))
    link = F.col("v.video_intervencion.enlace_descarga02")
    return one.select(F.sha1(F.concat_ws("", "reference", link, F.col("v.orador"))).alias("id"), link.alias("link"), "reference", F.col("v.sesion.nombre_sesion").alias("session_name"), F.col("v.tipo_intervencion").alias("type"), F.col("v.orador").alias("speaker"), F.col("v.fecha").alias("date"))


_PROJECT = "idProyecto bigint, expedienteCamara string, acapite string, tipoProyecto string, descripcionEtapa string, descripcionSubEtapa string, estadoProyecto string, origenProyecto string, appURL string, fechaIngresoExpediente string, iniciativa string"


def projects(raw: DataFrame, stored: DataFrame | None = None, limit: str = "2000-01-01") -> DataFrame:
    """Project payloads (json) of the second source to initiatives. Those whose stored row (id, updated) was updated
    before ``limit`` are left out; new ones, and stored ones without a date, are not."""
    p = raw.select(F.from_json("json", _PROJECT).alias("p")).select("p.*")
    entered = tx.parse_date(F.col("fechaIngresoExpediente"))
    rows = p.select(
        F.col("idProyecto").cast("string").alias("id"), F.col("expedienteCamara").alias("reference"), F.col("acapite").alias("title"), F.col("tipoProyecto").alias("type"), F.col("origenProyecto").alias("place"),
        F.array(F.concat(F.coalesce("descripcionEtapa", F.lit("")), F.lit(" ("), F.coalesce("descripcionSubEtapa", F.lit("")), F.lit(")"))).alias("history"),
        F.col("estadoProyecto").alias("status"), F.col("appURL").alias("url"), entered.alias("created"), entered.alias("updated"), F.col("iniciativa").alias("proponente"),
    )
    rows = rows.filter("id is not null")
    if stored is None:
        return rows
    old = stored.filter(F.col("updated") < F.lit(limit).cast("timestamp_ntz")).select("id")
    return rows.join(old, "id", "left_anti")


def content_due(content, stored_bulletins=None, bulletins=None):
    """Whether content is to be read: there is none, or the number of bulletins changed, where a strategy counts them."""
    empty = F.coalesce(F.size(content), F.lit(0)) <= 0
    return empty if bulletins is None else empty | ~stored_bulletins.eqNullSafe(bulletins)


def authors_in_content(title):
    """Types whose authors are named in the content."""
    return F.coalesce(title.isin(*dims.AUTHORS_IN_CONTENT), F.lit(False))


def attachments_due(attachments: DataFrame, state: DataFrame) -> DataFrame:
    """Attachments (id, phase, file) of the phases still to be read: those after the saved phase, and the
    saved one again when it has more files than were read. State: id, phase, counter."""
    position = F.coalesce(F.array_position(F.array(*map(F.lit, dims.PHASES)), F.col("phase")), F.lit(0)).cast("int")
    placed = attachments.withColumn("position", position).filter("position > 0")
    placed = placed.withColumn("n", F.count("*").over(Window.partitionBy("id", "phase")))
    saved = state.select("id", position.alias("done"), "counter")
    due = placed.join(saved, "id", "left").withColumns({"done": F.coalesce("done", F.lit(0)), "counter": F.coalesce("counter", F.lit(0))})
    return due.filter((F.col("position") > F.col("done")) | ((F.col("position") == F.col("done")) & (F.col("counter") < F.col("n")))).select("id", "phase", "file")


def members(raw: DataFrame, active_ids: DataFrame) -> DataFrame:
    """Members of the second source: (id, name, parliamentarygroup, email, active)."""
    name = tx.squeeze(F.concat_ws(" ", tx.title_case(F.trim("nombres")), tx.title_case(F.trim("apellidos"))))
    rows = raw.select(F.col("idParlamentario").cast("string").alias("id"), name.alias("name"), F.col("partidoPolitico").alias("parliamentarygroup"), tx.email(F.trim("emailParlamentario")).alias("email"))
    on = active_ids.select(F.col("id").cast("string").alias("id")).distinct().withColumn("on", F.lit(True))
    return rows.join(on, "id", "left").withColumn("active", F.coalesce("on", F.lit(False))).drop("on")
