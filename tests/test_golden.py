"""Small fixtures with values known by hand."""

import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from hemicycle import dims
from hemicycle.functions import text as tx
from hemicycle.functions.html import parse
from hemicycle.operators import alignment as al
from hemicycle.operators import authorship as au
from hemicycle.operators import extraction as ex
from hemicycle.operators import footprint as fp
from hemicycle.operators import planning as pl
from hemicycle.operators import stats, tagging, updates
from hemicycle.sources import files, sinks
from hemicycle.streaming import weekly

TAGS = "id string, kb string, topic string, subtopic string, tag string, times long"
day = datetime.datetime.fromisoformat


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_merge(spark):
    title = spark.createDataFrame([("1", "k", "A", "s", "t", 2), ("2", "k", "A", "s1", "t1", 1), ("3", "k", "A", "s", "t1", 1)], TAGS)
    body = spark.createDataFrame([("1", "k", "A", "s", "t", 3), ("2", "k", "B", "s2", "t2", 4), ("3", "k", "A", "s", "t2", 1)], TAGS)
    assert rows(tagging.merge(title, body), "id", "tag", "times") == [("1", "t", 5), ("2", "t1", 1), ("2", "t2", 4), ("3", "t1", 1), ("3", "t2", 1)]


def test_alignment_and_singles(spark):
    df = spark.createDataFrame([("1", "k", "A", "s", "t", 2), ("1", "k", "A", "s", "u", 1), ("1", "k", "B", "s", "v", 1), ("2", "k1", "A", "s", "t", 5), ("2", "k2", "B", "s", "t", 3), ("2", "k2", "C", "s", "t", 1)], TAGS)
    assert rows(al.topic_alignment(df), "id", "kb", "topic", "percentage") == [("1", "k", "A", 75.0), ("1", "k", "B", 25.0), ("2", "k1", "A", 100.0), ("2", "k2", "B", 75.0), ("2", "k2", "C", 25.0)]
    nested = al.nested(al.topic_alignment(df)).filter("id = '1'").first().topic_alignment
    assert [(t.topic, t.percentage) for t in nested] == [("A", 75.0), ("B", 25.0)]
    kept = spark.createDataFrame([("1", "kb1", "A", "s1", "t1", 3), ("1", "kb1", "A", "s2", "t2", 2), ("1", "kb1", "B", "s3", "t3", 1)], TAGS)
    assert rows(al.without_singles(kept), "tag") == [("t1",), ("t2",)]


def test_rename_and_untag(spark):
    df = tagging.nest(spark.createDataFrame([("1", "kb1", "A", "s", "t1", 2), ("1", "kb1", "A", "s", "t2", 1), ("1", "kb2", "B", "s", "t3", 3)], TAGS))
    def apply(change):
        return tagging.flatten(df.select("id", change(F.col("tagged")).alias("tagged")))
    assert rows(apply(lambda t: tagging.rename(t, "A", "t1", "new")), "tag") == [("new",), ("t2",), ("t3",)]
    assert rows(apply(lambda t: tagging.untag_topic(t, "A")), "tag") == [("t3",)]
    assert rows(apply(lambda t: tagging.untag_tag(t, "A", "t1")), "tag") == [("t2",), ("t3",)]
    assert rows(apply(lambda t: tagging.untag_kb(t, "kb1")), "tag") == [("t3",)]
    left = df.select(tagging.untag_topic(F.col("tagged"), "A").alias("t")).first().t
    assert [(k.knowledgebase, k.topics) for k in left] == [("kb1", []), ("kb2", ["B"])]
    assert tagging.untag_reference(df, ["1"]).first().tagged == []


@pytest.mark.parametrize(("code", "item", "want"), [("070", None, "Aprobada"), ("001", None, "Desconocida"), ("001", "Convalidado", "Convalidada"), ("001", "zzz", "Desconocida"), ("080", "Tramitado por completo sin req", "Rechazada"), ("184", "Concluido", "Respondida"), ("212", "Tramitado por completo sin", "Celebrada"), ("121", "Concluido", "Aprobada"), ("121", "INADMITIDO A TRÁMITE", "No admitida a trámite")])
def test_status(spark, code, item, want):
    df = spark.createDataFrame([(code, item)], "code string, item string")
    assert df.select(tx.status(F.col("item"), F.col("code")).alias("s")).first().s == want


def test_scalars(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("x")).first().x
    assert [get(tx.roman(F.lit(n))) for n in (0, 4, 9, 14, 40, 1990, 2024)] == ["", "IV", "IX", "XIV", "XL", "MCMXC", "MMXXIV"]
    assert get(tx.sentences(F.lit("a.b.3.4"))) == ["a", "b.3.4"]
    assert get(tx.reference(F.lit(12), F.lit("181"))) == "181/000012" and get(tx.reference(F.lit(1234567), F.lit("181"))) == "181/1234567"
    assert get(tx.title_case(F.lit("josé pérez-LÓPEZ"))) == "José Pérez-López"
    assert get(tx.email(F.lit("ana@congreso.es"))) == "ana@congreso.es" and get(tx.email(F.lit("a@b"))) is None
    assert get(tx.after(F.lit("abcdef"), "cd")) == "ef" and get(tx.after(F.lit("abcdef"), "zzz")) == "cdef"
    assert [tuple(get(tx.next_phase(F.lit(p)))) for p in ("", "INICIATIVA", "SANCIÓN COMPLETA", "LEY")] == [(0, "INICIATIVA"), (1, "SANCIÓN COMPLETA"), (2, "LEY"), (-1, "")]
    assert [get(tx.is_final_word(F.lit(s))) for s in ("archivado", "Publicado en Gaceta", "RETIRADO", "En estudio")] == [True, True, True, False]
    assert get(stats.iso_week(F.lit("2021-01-03").cast("date"))) == "2020-53"
    content = "x Página 3 y 121/000004 uno\ndos 121/000009 otro"
    assert get(tx.bulletin_slice(F.lit(content), F.lit("3"), F.lit("121/000004"))) == [" uno", "dos "]
    assert get(tx.constituency(F.lit("Diputada por Santa Cruz"))) == "Santa Cruz" and get(tx.gender(F.lit("Diputada por X"))) == "Mujer"
    assert files.clean_lines("  Titulo\fSegunda\tpagina\nTercera  ") == ["Titulo Segundapagina", "Tercera"]


def test_planning(spark):
    stored = lambda *n: spark.createDataFrame([("121", i, "Aprobada") for i in n], "code string, number long, status string")
    site = spark.createDataFrame([("121", 5)], "code string, total long")
    numbers = lambda df: [r[0] for r in rows(df, "number")]
    assert numbers(pl.plan_new(stored(1, 2, 3, 4, 5), site)) == [6, 7]
    assert numbers(pl.plan_new(stored(1, 2, 4), site)) == [3, 5, 6, 7, 8]
    assert numbers(pl.plan_new(stored(1, 2, 4), site, single_type=True)) == [3, 4, 5, 6, 7]
    assert numbers(pl.plan_all(site)) == list(range(1, 9)) and numbers(pl.plan_all(site, single_type=True)) == list(range(0, 8))
    open_ = spark.createDataFrame([("121", 1, dims.OPEN)], "code string, number long, status string")
    assert ("open", 1) in rows(pl.plan_new(open_, site), "reason", "number")


def test_footprint(spark):
    rules = [("ten", 10.0, None, ("T",)), ("fourty", 40.0, None, ("F",)), ("twenty", 20.0, "Aprobada", ("F",)), ("four", 1.0, None, ("V",))]
    initiatives = spark.createDataFrame([("I1", "T", "En tramitación", day("2024-12-01")), ("I2", "F", "Aprobada", day("2024-08-01")), ("I3", "V", None, day("2023-06-01")), ("I4", "T", "Retirada", day("2024-12-15"))], "id string, type string, status string, created timestamp_ntz")
    authors = spark.createDataFrame([("I1", "deputy", "D1"), ("I1", "deputy", "D2"), ("I2", "deputy", "D1"), ("I3", "deputy", "D2"), ("I4", "deputy", "D2")], "id string, kind string, name string")
    shares = spark.createDataFrame([("I1", "k", "A", 100.0), ("I2", "k", "A", 75.0), ("I2", "k", "B", 25.0), ("I3", "k", "A", 50.0), ("I3", "k", "B", 50.0), ("I4", "k", "A", 100.0)], "id string, kb string, topic string, percentage double")
    people = spark.createDataFrame([("deputy", "D1", True, False), ("deputy", "D2", False, False), ("deputy", "D3", True, True)], "kind string, name string, email boolean, social boolean")
    topics = spark.createDataFrame([("A",), ("B",)], "topic string")
    got = fp.by_topic(initiatives, authors, shares, people, topics, "2024-12-31", rules)
    assert rows(got, "topic", "name", "raw", "score") == [("A", "D1", 90.0, 100.0), ("A", "D2", 5.5, 6.11), ("A", "D3", 0.0, 0.0), ("B", "D1", 49.5, 100.0), ("B", "D2", 0.25, 0.51), ("B", "D3", 0.0, 0.0)]
    assert rows(fp.overall(initiatives, authors, people, "2024-12-31", rules), "name", "raw", "score") == [("D1", 110.0, 100.0), ("D2", 11.0, 10.0), ("D3", 0.0, 0.0)]


def test_penalty_bounds(spark):
    base = datetime.date(2024, 12, 31)
    dates = [(n, datetime.datetime.combine(base - datetime.timedelta(days=n), datetime.time())) for n in (90, 91, 180, 181, 360, 361)]
    df = spark.createDataFrame(dates, "n int, last timestamp_ntz").select("n", fp.penalty(F.col("last"), "2024-12-31").alias("p"))
    assert dict(rows(df, "n", "p")) == {90: 0.0, 91: 0.1, 180: 0.1, 181: 0.25, 360: 0.25, 361: 0.5}


def test_weeks_and_trend(spark):
    df = spark.createDataFrame([(1, day("2024-01-05")), (2, day("2024-01-23"))], "id int, created timestamp_ntz")
    assert rows(stats.weekly(df, "2024-01-03", "2024-01-22"), "week", "initiatives") == [("2024-01", 1), ("2024-02", 0), ("2024-03", 0), ("2024-04", 1)]
    assert rows(stats.weekly(df.filter("id = 1"), "2024-01-03", "2024-01-22"), "week") == [("2024-01",), ("2024-02",), ("2024-03",)]
    dates = ["2024-03-31", "2024-03-20", "2024-03-16", "2024-03-02", "2024-03-01"]
    recent = spark.createDataFrame([(i, "121", day(x)) for i, x in enumerate(dates)], "id int, code string, created timestamp_ntz")
    assert ("Función legislativa", 2, 2, "equal") in rows(stats.last_days(recent, "2024-03-31"), "type_group", "current", "previous", "trend")


def test_extraction(spark):
    html = """<div id="portlet_iniciativas"><div class="entradilla-iniciativa">Ley de prueba (121/000001)</div><p class="titular-seccion">a</p><p class="titular-seccion">Proyecto de ley.</p>
    <p class="f-present">Presentado el 01/02/2024, calificado</p><h3>Autor:</h3><ul><li><a href="#">García, Ana (GS)</a></li><li>Gobierno</li></ul>
    <div class="iniciativaTramitacion">Mesa <b>uno</b><br/>Pleno desde 03/02/2024</div><div class="resultadoTramitacion">Concluido</div></div>"""
    pages = spark.createDataFrame([("http://x?_iniciativas_id=121%2F000001", html), ("http://y", "<p>nothing")], "url string, html string")
    good, bad = ex.initiatives(pages, "2024-06-01").orderBy(F.col("error").isNotNull()).collect()
    assert (good.id, good.reference, good.title, good.type, good.status) == ("121-000001", "121/000001", "Ley de prueba", "Proyecto de ley", "Aprobada")
    assert good.created == day("2024-02-01") and good.updated == day("2024-02-03") and good.history == ["Mesa uno", "Pleno desde 03/02/2024", "Concluido"]
    assert [(a.item, a.linked) for a in good.authors] == [("García, Ana (GS)", True), ("Gobierno", False)] and "no header" in bad.error
    page = """<div class="nombre-dip">García, Ana</div><div class="cargo-dip">Diputada por Santa Cruz</div><div class="grupo-dip"><a>G. Socialista (GS)</a></div><div class="f-alta">Condición plena: 01/01/2020</div><div class="f-alta">Causó baja el 02/02/2022</div>
    <div class="rrss-dip"><a href="t.co/x"><img src="twitter.png"></a></div><div><h3>Ficha personal</h3><p>Nacida el 03/03/1980</p><p>Diputada de la X, XI Legislaturas</p>Abogada. Docente. Condición plena</div>"""
    who = ex.pages_to_rows(spark.createDataFrame([("u", page)], "url string, html string"), ex.deputy_page, ex.DEPUTY).first()
    assert (who.name, who.grp, who.constituency, who.gender, who.twitter, who.start_date, who.end_date, who.birthdate) == ("García, Ana", "GS", "Santa Cruz", "Mujer", "http://t.co/x", "01/01/2020", "02/02/2022", "03/03/1980")
    assert who.legislatures == ["X", "XI"] and who.bio == ["Abogada", "Docente."] or who.bio == ["Abogada", "Docente"]


def test_amendments(spark):
    name = "Enmiendas a la totalidad"
    text = "intro\nENMIENDA NÚM. 1\nGrupo Parlamentario Mixto\nA la totalidad\nJUSTIFICACIÓN\nPor todo.\nENMIENDA NÚM. 2\nAna García (GS)\nJUSTIFICACIÓN\nNo."
    a, b = ex.amendments("122/000001", name, text, [ex.Deputy("García, Ana", "Ana García")])
    assert a["id"] == f"122/000001/{hashlib.md5(name.encode()).hexdigest()}/1" and a["groups"] == ["Grupo Parlamentario Mixto"] and a["justification"] == ["Por todo."]
    assert b["groups"] == ["GS"] and b["authors"] == ["García, Ana"]
    (c,) = ex.amendments("r", "Enmiendas (Senado)", "ENMIENDA NÚM. 3\nFirma (GPP)\nENMIENDA\nDe adición.\nTexto\nMOTIVACIÓN\nMejora", [])
    assert (c["chamber"], c["groups"], c["type"], c["propossed_change"], c["justification"]) == ("senate", ["GPP"], " De adición", ["Texto"], ["Mejora"])
    assert ex.amendments("r", name, "nothing", []) == []
    known = ex.amendment_rows(spark.createDataFrame([("122/000001", name, text)], "reference string, name string, content string"), [])
    left = ex.unread_bulletins(spark.createDataFrame([("122/000001", name, ""), ("9", name, "")], "reference string, name string, content string"), known)
    assert rows(left, "reference") == [("9",)]


def test_votes_speeches_projects(spark):
    html = '<div>Toma en consideración <a href="http://a.b/c.json">JSON</a> Mi ley <a href="http://a.b/d.json?x">JSON</a> tail</div>'
    blocks = ex.vote_blocks(spark.createDataFrame([("1", html)], "id string, html string"), spark.createDataFrame([("1", "Mi ley")], "id string, title string"))
    assert rows(blocks, "pos", "link", "labelled", "titled") == [(0, "http://a.b/c.json", True, False), (1, None, False, True)]
    assert rows(updates.selected_votes(blocks), "pos") == [(0,)]
    raw = spark.createDataFrame([('{"idProyecto": 7, "acapite": "t", "estadoProyecto": "x", "fechaIngresoExpediente": "05/06/2020"}',), ("bad",)], "json string")
    assert rows(ex.projects(raw), "id", "title", "created") == [("7", "t", day("2020-06-05"))]
    saved = spark.createDataFrame([("7", day("1999-12-31")), ("8", None)], "id string, updated timestamp_ntz")
    other = spark.createDataFrame([('{"idProyecto": 8, "descripcionEtapa": "a", "descripcionSubEtapa": "b", "origenProyecto": "o"}',), ('{"idProyecto": 9, "fechaIngresoExpediente": "01/01/1990"}',)], "json string")
    assert rows(ex.projects(raw.unionByName(other), saved), "id", "place", "history") == [("8", "o", ["a (b)"]), ("9", None, [" ()"])]
    files_ = spark.createDataFrame([("7", "INICIATIVA", "a"), ("7", "INICIATIVA", "b"), ("7", "LEY", "c"), ("8", "INICIATIVA", "d")], "id string, phase string, file string")
    state = spark.createDataFrame([("7", "INICIATIVA", 2), ("8", "INICIATIVA", 0)], "id string, phase string, counter int")
    assert rows(ex.attachments_due(files_, state), "file") == [("c",), ("d",)]
    people = spark.createDataFrame([(1, "ana ", " pérez-lópez", "P", "ANA@x.py"), (2, "b", "c", "P", "no")], "idParlamentario int, nombres string, apellidos string, partidoPolitico string, emailParlamentario string")
    assert rows(ex.members(people, spark.createDataFrame([(1,)], "id int")), "name", "email", "active") == [("Ana Pérez-López", "ANA@x.py", True), ("B C", None, False)]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "groups.json").write_text('[{"_id": "1", "name": "Mixto", "shortname": "GMx", "color": "#000", "parties": ["A"]}]')
    assert rows(files.groups(spark, str(tmp_path / "groups.json")), "id", "parties") == [("1", ["A"])]
    assert files.api_pages(spark, 45).count() == 3
    got = files.attachments(spark.createDataFrame([("a", "text/plain", bytearray(b"x\ty\nz")), ("b", "application/vnd.ms-excel", bytearray(b"q"))], "path string, mime string, content binary"))
    assert rows(got, "path", "lines", "ignored") == [("a", ["xy", "z"], False), ("b", [""], True)]
    path = str(tmp_path / "table")
    for batch in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")]):
        sinks.save(spark.createDataFrame(batch, "k int, v string"), path, "k")
    assert rows(spark.read.parquet(path), "k", "v") == [(1, "a"), (2, "c"), (3, "d")]


def test_upsert_has_one_row_a_key(spark):
    old, new = (spark.createDataFrame(r, "k int, v string") for r in ([(1, "a"), (2, "b"), (None, "n")], [(2, "c"), (2, "d"), (None, "x"), (None, "y")]))
    assert rows(updates.upsert(old, new, "k"), "k", "v") == [(1, "a"), (2, "d"), (None, "y")]
    assert rows(updates.upsert(old, new.limit(0), "k"), "k", "v") == rows(old, "k", "v")


def test_content_changes(spark):
    tagged = spark.createDataFrame([(i, ["t"]) for i in (1, 2, 3, 4)], "id int, tagged array<string>")
    was, now = (spark.createDataFrame(r, "id int, content array<string>") for r in ([(1, ["a"]), (2, ["a"]), (3, None)], [(1, ["a"]), (2, ["b"]), (3, ["c"]), (4, ["d"])]))
    assert rows(updates.untag_changed(tagged, was, now), "id", "tagged") == [(1, ["t"]), (2, []), (3, []), (4, [])]
    due = spark.createDataFrame([(1, None, 1, 1), (2, ["x"], 1, 1), (3, ["x"], 1, 2), (4, [], 1, 1)], "id int, content array<string>, was int, now int")
    assert rows(due.select("id", ex.content_due(F.col("content")).alias("a"), ex.content_due(F.col("content"), F.col("was"), F.col("now")).alias("b")), "id", "a", "b") == [(1, True, True), (2, False, False), (3, False, True), (4, True, True)]
    kinds = spark.createDataFrame([("Proposición de ley de Diputados",), ("Proyecto de ley",), (None,)], "t string").select(ex.authors_in_content(F.col("t")).alias("a"))
    assert rows(kinds, "a") == [(False,), (False,), (True,)]
    refs = spark.createDataFrame([(1, "121/000001"), (2, "121/000002")], "id int, reference string")
    assert rows(updates.alert_for(refs, "121/000002", "new"), "id", "reason") == [(2, "new")]


def test_plain_text_ages_and_merging(spark):
    get = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert get(tx.plain_text(F.lit("<p>a<br><br><br>b<br>c    d &aacute;&amp;lt;</p>"))) == "a\nb c d á&lt;"
    assert get(tx.plain_text(F.lit("a<br><br><br><br>b<br><br>c"))) == "a\nb c"
    assert [get(tx.age(F.lit(x).cast("date"), F.lit("2024-05-10").cast("date"))) for x in ("2000-05-10", "2000-05-11", "1980-01-01")] == [24, 23, 44]
    old, new = (spark.createDataFrame(r, TAGS) for r in ([("1", "k", "A", "s", "t", 1)], [("1", "k", "B", "s", "t", 5), ("1", "k", "B", "s", "u", 2), ("1", "k", "A", "s", "u", 3), ("2", "k", "A", "s", "t", 4)]))
    merged = tagging.merge_absent(old, new)
    assert rows(merged, "id", "topic", "tag", "times") == [("1", "A", "t", 1), ("1", "A", "u", 3), ("2", "A", "t", 4)]
    assert rows(tagging.by_tag(merged, "A", "t"), "id") == [("1",), ("2",)]


def test_ranges_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(pl, "BLOCK", 3)
    stored = spark.createDataFrame([("121", i, "Aprobada") for i in (1, 2, 11)], "code string, number long, status string")
    assert sorted(r[0] for r in rows(pl.gaps(stored), "number")) == list(range(3, 11))


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("ts", "event_type")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    weekly.upsert_stream(weekly.weekly_counts(stream, "60 days"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    want = weekly.weekly_counts(events)
    assert rows(spark.read.parquet(str(tmp_path / "out")), "week_start", "event_type", "events") == rows(want, "week_start", "event_type", "events")


def test_places_signatures_fuzzy(spark):
    df = spark.createDataFrame([(["Pleno", "Comisión de Justicia desde"],), (["x"],)], "h array<string>")
    assert sorted(df.select(au.place_from_history(F.col("h"), ["Comisión de Justicia", "Pleno"]).alias("p")).toPandas().p, key=str) == ["Comisión de Justicia", None]
    lines = spark.createDataFrame([(1, "Palacio, 1 de mayo. Ana García Pérez, Diputada")], "id int, line string")
    people = spark.createDataFrame([("García, Ana", "Ana García"), ("Ruiz, Eva", "Eva Ruiz")], "name string, fullname string")
    assert rows(au.signed_by(lines, people), "name") == [("García, Ana",)]


def test_document_tree():
    root = parse('<ul class="a b"><li>x<br>y<li>z</ul><p id="q">&eacute;</p>')
    assert [n.text() for n in root.select("ul.a li")][-1] == "z" and root.first("#q").text() == "é" and root.first("li").parts("br")[0] == "x"


def test_micros_round_like_decimals(spark):
    from decimal import Decimal

    from hemicycle.functions.numbers import micros, of_micros, term

    values = [0.0, 1 / 3, 33.33 / 100 / 3 * 10, 0.0000005, 0.00000049999999, 0.000000495, 0.000000494999999, 1.0000015, 2.675, -1.0000005, -0.00000149, -0.000000005, 1e9 + 0.123456789, -2e10, 0.1234565, 12.345678499999, None]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    got = df.select(micros(F.col("x")).alias("m"), (term(F.col("x")) * 1_000_000).cast("long").alias("t")).collect()
    assert [r.m for r in got] == [r.t for r in got]
    same = spark.range(20000).select((F.rand(1) * 100 / 100 / (F.col("id") % 7 + 1) * 40).alias("x")).filter(micros(F.col("x")) != (term(F.col("x")) * 1_000_000).cast("long"))
    assert same.count() == 0
    assert df.select(of_micros(F.sum(micros(F.col("x")))).alias("s")).first().s == df.select(F.sum(term(F.col("x"))).alias("s")).first().s
    assert spark.range(1).select(of_micros(F.lit(9007199254740993)).alias("s")).first().s == Decimal("9007199254.740993")


def _nodes(df):
    """Operators of the plan before adaptive changes, from the top."""
    return [x.strip(" +-:*") for x in df._jdf.queryExecution().executedPlan().toString().splitlines()]


def test_topics_take_one_shuffle_and_no_wide_sums(spark):
    from hemicycle.plans import analytics

    small = "/root/testdata/sf0.001"
    for name in ("topic_alignment", "topic_alignment_ranked"):
        nodes = _nodes(analytics.QUERIES[name](spark, small))
        shuffles = [n for n in nodes if n.startswith("Exchange")]
        assert len([n for n in shuffles if "hashpartitioning(id#" in n]) == len(shuffles) == 1
        below = nodes[nodes.index(shuffles[0]) :]
        assert not [n for n in below if "Aggregate" in n or n.startswith("Sort")]  # a map task holds no groups
        assert not [n for n in nodes if "p_name" in n or "ObjectHash" in n]


@pytest.mark.parametrize("name", ["footprint_topic_deputy", "footprint_topic_group", "stats_deputies_by_topic_top10", "footprint_entity_documents", "stats_groups_by_topic", "stats_places_by_topic_top5", "stats_topics_by_week", "stats_deputies_by_subtopic_top10"])
def test_lines_are_shuffled_by_id_before_they_are_grouped(spark, name):
    from hemicycle.plans import analytics

    nodes = _nodes(analytics.QUERIES[name](spark, "/root/testdata/sf0.001"))
    by_id = [n for n in nodes if n.startswith("Exchange") and "(id#" in n]
    assert by_id and all("hashpartitioning(id#" in n and n.count("#") <= 3 and "REPARTITION_BY_NUM" in n for n in by_id)


def test_tasks_follow_the_size_of_the_lines(spark, monkeypatch):
    from hemicycle.plans import binding

    rows = spark.range(10)
    assert binding.by_id(rows, "/root/testdata/sf0.001").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(binding, "TASK_BYTES", 10_000)
    few = binding.by_id(rows, "/root/testdata/sf0.001").rdd.getNumPartitions()
    assert 8 * few < binding.by_id(rows, "/root/testdata/sf0.01").rdd.getNumPartitions() < 12 * few


def test_topic_times_and_ranks(spark):
    df = spark.createDataFrame([("1", "k", "A", "s", "t", 1), ("1", "k", "B", "s", "t", 1), ("1", "k", "B", "s", "t", 1), ("1", "k", "C", "s", "u", 2), ("1", "k", None, "s", "u", 2), ("2", "k", "A", "s", "t", None)], TAGS)
    times = al.topic_times(df)
    assert rows(times, "id", "topic", "times") == rows(al.without_singles(df).groupBy("id", "topic").agg(F.sum("times").alias("times")), "id", "topic", "times") == [("1", "B", 2), ("1", "C", 2), ("1", None, 2)]
    assert [tuple(r) for r in al.ranked(al.shares(times)).orderBy("rank").select("rank", "topic", "percentage").collect()] == [(1, "B", 33.33), (2, "C", 33.33), (3, None, 33.33)]
