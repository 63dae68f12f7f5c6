"""Dimensions kept as data: initiative types, status rules, footprint rules, alert reasons, phases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GROUPS = [
    "Actos en relación con las Comunidades Autónomas",
    "Actos en relación con los estados de alarma, excepción y sitio",
    "Comisiones, subcomisiones y ponencias",
    "Competencias en relación con la Corona",
    "Confianza parlamentaria",
    "Convenios Internacionales",
    "Declaración Institucional",
    "Declaración de actividades",
    "Declaración de bienes y rentas",
    "Declaración de intereses económicos",
    "Función de control",
    "Función de orientación política",
    "Función legislativa",
    "Reforma constitucional",
    "Reglamento del Congreso",
    "Relaciones con órganos e instituciones públicas",
    "Secretaría general",
]

# code, group (position in GROUPS), content strategy, title
_TYPES = """
004	7	non_exclusive	Declaración de actividades
005	8	non_exclusive	Declaración de bienes y rentas
007	9	non_exclusive	Declaración de intereses económicos
023	14	base	Funciones de la Mesa de la Cámara
042	2	non_exclusive	Funciones de las Comisiones
043	10	base	Documentación remitida a Comisiones para su conocimiento
044	10	base	Documentación remitida a Comisiones para su eventual tramitación
062	10	non_exclusive	Funciones de la Diputación Permanente
070	3	base	Competencias en relación con la Corona
080	4	first_d	Propuesta de candidato a la Presidencia del Gobierno
082	4	non_exclusive	Moción de censura
084	4	base	Moción de reprobación a miembros del Gobierno
091	1	non_exclusive	Actos en relación con los estados de alarma, excepción y sitio
093	0	non_exclusive	Convenios entre Comunidades Autónomas
094	0	base	Otros actos en relación con las Comunidades Autónomas
095	10	non_exclusive	Operaciones de las Fuerzas Armadas en el exterior
100	13	first_b	Proposición de reforma Constitucional de Grupos Parlamentarios
101	13	first_b	Proposición de reforma constitucional de Comunidades Autónomas
102	13	first_a	Proyecto de reforma Constitucional
110	5	first_a	Autorización de Convenios Internacionales
111	5	first_boe	Información sobre Convenios Internacionales (art. 94.2 Const.)
112	5	base	Otros asuntos relativos a Convenios Internacionales
120	12	all_b	Iniciativa legislativa popular
121	12	first_a	Proyecto de ley
122	12	first_b	Proposición de ley de Grupos Parlamentarios del Congreso
123	12	first_b	Proposición de ley de Diputados
124	12	first_b	Proposición de ley del Senado
125	12	first_b	Proposición de ley de Comunidades y Ciudades Autónomas
127	12	first_b	Propuesta de reforma de Estatuto de Autonomía
130	12	first_boe	Real Decreto-Ley
131	12	first_e	Real Decreto legislativo en desarrollo de Ley de Bases
132	12	first_boe	Real Decreto legislativo que aprueba texto refundido
140	6	non_exclusive	Declaración Institucional
151	2	non_exclusive	Comisión permanente (art. 50)
152	2	non_exclusive	Comisión de Investigación (art. 52)
153	2	non_exclusive	Otras Comisiones no permanentes (art. 53)
154	2	non_exclusive	Subcomisiones y Ponencias
155	2	base	Solicitud de creación de Comisión permanente (art. 50)
156	2	non_exclusive	Solicitud de creación de Comisión de Investigación (art. 52)
157	2	non_exclusive	Solicitud de creación de otras Comisiones no permanentes (art. 53)
158	2	non_exclusive	Solicitud de creación de Subcomisiones y Ponencias
159	2	non_exclusive	Grupo de trabajo
161	11	non_exclusive	Proposición no de Ley en Comisión
162	11	non_exclusive	Proposición no de Ley ante el Pleno
170	10	non_exclusive	Interpelación ordinaria
171	11	base	Moción consecuencia de interpelación ordinaria
172	10	non_exclusive	Interpelación urgente
173	11	non_exclusive	Moción consecuencia de interpelación urgente
178	10	base	Pregunta oral a la Corporación RTVE
179	10	question	Pregunta a la Corporación RTVE con respuesta escrita
180	10	base	Pregunta oral en Pleno
181	10	non_exclusive	Pregunta oral al Gobierno en Comisión
184	10	question	Pregunta al Gobierno con respuesta escrita
186	10	base	Solicitud de informe a la Administración del Estado (art. 7)
187	10	base	Solicitud de informe a Comunidad Autónoma (art. 7)
188	10	base	Solicitud de informe a Entidad Local (art. 7)
189	10	base	Solicitud de informe a otra Entidad Pública (art. 7)
193	10	base	Solicitud de informe a la Administración del Estado (art. 44)
194	10	base	Solicitud de informe a Comunidad Autónoma (art. 44)
195	10	base	Solicitud de informe a Entidad Local (art. 44)
196	10	base	Solicitud de informe a otra Entidad Pública (art. 44)
197	10	base	Otras solicitudes de informe (art. 44)
200	11	non_exclusive	Comunicación del Gobierno
201	11	non_exclusive	Planes y programas
210	10	base	Comparecencia del Gobierno ante el Pleno
212	10	base	Comparecencia de autoridades y funcionarios en Comisión
213	10	base	Comparecencia del Gobierno en Comisión (art. 44)
214	10	base	Comparecencia del Gobierno en Comisión (arts. 202 y 203)
219	10	base	Otras comparecencias en Comisión
221	10	base	Comparecencia del Gobierno en Comisión Mixta solicitada en el Senado
222	10	base	Comparec. autoridades y funcionarios en Com. Mx. solicitada en Senado
223	10	base	Otras comparecencias en Comisión Mixta solicitadas en el Senado
224	10	base	Información sobre secretos oficiales
225	11	base	Propuesta de resolución relativa al art 11 de la Ley Orgánica 6/2002 de Partidos Políticos
230	15	non_exclusive	Conflicto de competencia ante el Tribunal Constitucional
231	15	base	Recurso previo contra Convenios Internacionales
232	15	non_exclusive	Recurso de inconstitucionalidad
233	15	non_exclusive	Cuestión de inconstitucionalidad
234	15	non_exclusive	Recurso de amparo
235	15	non_exclusive	Nombramientos para el Tribunal Constitucional
240	15	non_exclusive	Suplicatorio
244	15	non_exclusive	Nombramientos de miembros del Consejo General del Poder Judicial
245	15	non_exclusive	Memoria del Consejo General del Poder Judicial
250	15	all_a	Cuenta General del Estado
251	15	non_exclusive	Informe del Tribunal de Cuentas
253	15	base	Solicitud de fiscalización del Tribunal de Cuentas
259	15	base	Otros asuntos relativos al Tribunal de Cuentas
260	15	base	Informe anual del Defensor del Pueblo
261	15	non_exclusive	Otros informes del Defensor del Pueblo
262	15	boe	Nombramientos del Defensor del Pueblo y Adjuntos
276	15	base	Elección de miembros de otros órganos
282	15	base	Control de la aplicación del principio de subsidiariedad
285	15	non_exclusive	Memoria de la Fiscalía General del Estado
291	16	non_exclusive	Normas relativas a la org. y func. de la Secretaría General
294	16	bulletin_and_senate	Normas sobre personal y org. administrativa de las Cortes Generales
295	16	bulletin_and_senate	Actos sobre personal y org. administrativa de las Cortes Generales
299	16	non_exclusive	Personal eventual del Congreso de los Diputados
401	15	non_exclusive	Informe anual del Consejo de Seguridad Nuclear
410	14	first_b	Proposición de reforma del Reglamento del Congreso
411	14	non_exclusive	Resolución de la Presidencia del Congreso
412	14	non_exclusive	Otros asuntos relativos al Reglamento del Congreso
413	14	first_a	Resoluciones normativas de las Cortes Generales
414	14	first_a	Resoluciones normativas del Congreso
430	11	non_exclusive	Objetivo de estabilidad presupuestaria
440	15	bulletin_and_senate	Memoria anual de la Corporación RTVE
442	15	non_exclusive	Informe anual de la Corporación RTVE
"""

TYPES = [(code, title, GROUPS[int(group)], strategy) for code, group, strategy, title in (line.split("\t") for line in _TYPES.strip().splitlines())]
OVERSIGHT, LEGISLATIVE, ORIENTATION = "Función de control", "Función legislativa", "Función de orientación política"

OPEN, UNKNOWN, APPROVED = "En tramitación", "Desconocida", "Aprobada"
_QUESTIONS, _HEARINGS = ("170", "172", "178", "179", "180", "181", "184"), ("210", "212", "213", "214", "219")
_DONE = "Tramitado por completo sin"
_STAGES = (
    "Boletín Oficial de las Cortes Generales Publicación desde|Comisión.*desde|Senado desde|Pleno desde|Pleno Aprobación desde|Junta Electoral Central desde",
    "|Solicitud de amparo|Respuesta.*Gobierno|Junta de Portavoces|Pleno Toma en consideración",
    "".join(f"|{who} Contestación" for who in ("Gobierno", "Pleno", "Entidad Pública", "Corporación RTVE", "Administración del Estado")),
    "".join(f"|Mesa del Congreso {what}" for what in ("Reclamación", "Requerimiento", "Calificación", "Acuerdo")),
    "|Gobierno Reclamación",
)
# In order; the first rule that matches the last history item wins: status, pattern, only types, not types.
STATUS_RULES: list[tuple[str, str, tuple[str, ...], tuple[str, ...]]] = [
    (OPEN, "".join(_STAGES), (), ()),
    *((status, word, (), ()) for status, word in (("Convalidada", "Convalidado"), ("Convertida en otra", "Convertido"), ("Acumulada en otra", "Subsumido en otra iniciativa"), ("No admitida a trámite", "Inadmitido a trámite"), ("No debatida", "Decaído"), ("Rechazada", "Rechazado"))),
    ("Rechazada", _DONE, ("080",), ()),
    *((status, word, (), ()) for status, word in (("Retirada", "Retirado"), ("No celebrada", "No celebración"), ("Derogada", "Derogado"), ("Extinguida", "Extinguido"), ("Caducada", "Caducado"))),
    (APPROVED, "Aprobado sin modificaciones", ("080",), ()),
    (APPROVED, f"Aprobado (con|sin) modificaciones|Tramitado con propuesta de resolución|Concluido|{_DONE}", (), ("080", *_QUESTIONS, *_HEARINGS)),
    ("Respondida", f"Concluido|{_DONE}", _QUESTIONS, ()),
    ("Celebrada", _DONE, _HEARINGS, ()),
]
FINAL_WORDS = ("archivado", "publicado", "retirado", "contestado", "suspendido")
PHASES = ("INICIATIVA", "SANCIÓN COMPLETA", "LEY")
REASONS = {"new": "Nueva iniciativa", "published": "Texto publicado", "finished": "Tramitación finalizada"}
AMENDABLE = ("120", "121", "122", "123", "124", "125", "127", "171", "173")
EXCLUDED_STATUS = ("No admitida a trámite", "Retirada")

_BILLS, _MOTIONS = ("122", "123"), ("161", "162")
# rule, weight, needed status (None: any but the excluded ones), type codes. "four" weighs 1, by parity with the published
# scores; pass other rows to change it.
_FOOTPRINT: list[tuple[str, float, str | None, tuple[str, ...]]] = [
    ("four", 1.0, None, ("170", "172", "186", "189", "193", "196", "197", "212", "213", "214", "219", "222")),
    ("ten", 10.0, None, ("082", "178", "181", "180")),
    ("fourty", 40.0, None, (*_MOTIONS, "171", "173")),
    ("eighty", 80.0, None, (*_BILLS, "100", "101", "102")),
    ("additional_twenty", 20.0, APPROVED, _MOTIONS),
    ("additional_sixty", 60.0, APPROVED, _BILLS),
]
_TITLE = {code: title for code, title, _, _ in TYPES}
FOOTPRINT_RULES = [(rule, weight, status, tuple(_TITLE[c] for c in codes)) for rule, weight, status, codes in _FOOTPRINT]


def initiative_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TYPES, "code string, title string, type_group string, strategy string")


def footprint_rules(spark: SparkSession, rules=None) -> DataFrame:
    rows = [(rule, weight, status, title) for rule, weight, status, titles in (FOOTPRINT_RULES if rules is None else rules) for title in titles]
    return spark.createDataFrame(rows, "rule string, weight double, needs string, type string")

#: Entities that pages of the sources hold; the ampersand comes last, so that nothing is replaced twice.
ENTITIES = {
    "nbsp": "\xa0", "lt": "<", "gt": ">", "quot": '"', "#39": "'", "apos": "'", "middot": "·", "copy": "©", "laquo": "«", "raquo": "»", "ordm": "º", "ordf": "ª", "euro": "€", "hellip": "…", "ndash": "–", "mdash": "—",
    "iexcl": "¡", "iquest": "¿", "aacute": "á", "eacute": "é", "iacute": "í", "oacute": "ó", "uacute": "ú", "uuml": "ü", "ntilde": "ñ", "ccedil": "ç", "Aacute": "Á", "Eacute": "É", "Iacute": "Í", "Oacute": "Ó", "Uacute": "Ú", "Ntilde": "Ñ", "amp": "&",
}

#: Types whose authors are named in their content.
AUTHORS_IN_CONTENT = ["Proposición no de Ley ante el Pleno", "Proposición no de Ley en Comisión", "Proposición de ley de Grupos Parlamentarios del Congreso", "Proposición de ley de Diputados"]
