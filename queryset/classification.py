"""Classification, merge and export queries."""

from pyspark.sql import functions as F

from cotejo.operators import classify as C
from cotejo.operators import export as E
from cotejo.operators import merge as M
from queryset.catalog import ascii_sql, fold_sql, query, strip_sql
from queryset.views import spark_view, with_views

RUN_YEAR = 2026

_RECORD = (
    "EXPEDIENTE", "NOMBRE", "PROYECTO", "ESTADO", "CLASE", "SUBCLASE", "MATERIALES", "REGIMEN_JURIDICO", "FINALIDAD",
    "PROVINCIA", "CANTON", "DISTRITO", "UNIDAD",
)


def _sheet(spark, sf_dir):
    return spark_view(spark, sf_dir, "stage_reg")


# By age

_UPPERED = {c: f"upper({strip_sql(c)})" for c in ("ESTADO", "CLASE", "MATERIALES", "EXPEDIENTE")}
_AGED = (
    "aged",
    "SELECT *, CASE WHEN regexp_full_match(left(EXPEDIENTE, 4), '[0-9]{4}') THEN CAST(left(EXPEDIENTE, 4) AS INT) END AS ANIO_EXP, "
    f"{RUN_YEAR} - CASE WHEN regexp_full_match(left(EXPEDIENTE, 4), '[0-9]{{4}}') THEN CAST(left(EXPEDIENTE, 4) AS INT) END AS ANTIGUEDAD "
    f"FROM (SELECT * REPLACE ({', '.join(f'{sql} AS {c}' for c, sql in _UPPERED.items())}) FROM stage_reg)",
)
_BY_AGE = (
    "by_age",
    """SELECT *, CASE WHEN ESTADO = 'ARCHIVADO' THEN 'ARCHIVADOS'
  WHEN EXPEDIENTE LIKE '%EXP%' OR EXPEDIENTE LIKE '%SUB%' OR CLASE IN ('EXPLORACIÓN', 'SUBTERRÁNEO')
    OR MATERIALES LIKE '%ORO%' OR MATERIALES LIKE '%PLATA%' THEN 'METALICOS'
  WHEN EXPEDIENTE LIKE '%CNE%' OR EXPEDIENTE LIKE '%CAN-MUN%' OR (EXPEDIENTE LIKE '%MUN%' AND ANTIGUEDAD > 4)
    THEN 'PERMISOS_ESPECIALES' ELSE 'NO_METALICOS' END AS GRUPO_CATASTRO FROM aged""",
)


def _counts(table):
    return f"SELECT GRUPO_CATASTRO, count(*) AS CANTIDAD FROM {table} GROUP BY 1"


@query(with_views("SELECT * FROM by_age", "stage_reg", extra=(_AGED, _BY_AGE)))
def classified_by_age(spark, sf_dir):
    return C.by_age(_sheet(spark, sf_dir), RUN_YEAR)


@query(with_views(_counts("by_age"), "stage_reg", extra=(_AGED, _BY_AGE)))
def group_counts_by_age(spark, sf_dir):
    return C.group_counts(C.by_age(_sheet(spark, sf_dir), RUN_YEAR))


@query(with_views("SELECT count(*) FILTER (GRUPO_CATASTRO = '') AS SIN_GRUPO FROM by_age", "stage_reg", extra=(_AGED, _BY_AGE)))
def ungrouped_rows(spark, sf_dir):
    return C.ungrouped_count(C.by_age(_sheet(spark, sf_dir), RUN_YEAR))


# By clean text

_CLEAN = (
    "clean",
    f"SELECT row_seq AS ROW_SEQ, {', '.join(f'{ascii_sql(c)} AS {c}' for c in _RECORD)}, AREA, FECHA_INGRESO FROM stage_reg",
)
_BY_TEXT = (
    "by_text",
    """SELECT *, CASE WHEN ESTADO = 'ARCHIVADO' THEN 'ARCHIVADOS'
  WHEN regexp_matches(MATERIALES, 'ORO|PLATA|COBRE|HIERRO') THEN 'METALICOS'
  WHEN REGIMEN_JURIDICO = 'PERMISO_ESPECIAL' OR (SUBCLASE <> 'PRIVADO' AND SUBCLASE <> '') OR FINALIDAD = 'EMERGENCIA'
    OR regexp_matches(EXPEDIENTE, 'MUN|CNE') THEN 'PERMISO_ESPECIAL' ELSE 'NO_METALICOS' END AS GRUPO_CATASTRO FROM clean""",
)


@query(with_views("SELECT * FROM by_text", "stage_reg", extra=(_CLEAN, _BY_TEXT)))
def classified_by_clean_text(spark, sf_dir):
    return C.by_clean_text(_sheet(spark, sf_dir))


@query(with_views(_counts("by_text"), "stage_reg", extra=(_CLEAN, _BY_TEXT)))
def group_counts_by_clean_text(spark, sf_dir):
    return C.group_counts(C.by_clean_text(_sheet(spark, sf_dir)))


# By word stems

_BY_STEMS = (
    "by_stems",
    f"""SELECT *, CASE WHEN regexp_matches({fold_sql('ESTADO')}, 'ARCHIV|CANCEL|DENEG|CADUC|RENUNC|DESIST') THEN 'ARCHIVADO'
  WHEN {fold_sql('EXPEDIENTE')} LIKE '%CDP%' OR regexp_matches({fold_sql('NOMBRE')}, 'MUNICIPALIDAD|CONCEJO|ICE|CNE') THEN 'PERMISO_ESPECIAL'
  WHEN regexp_matches({fold_sql('EXPEDIENTE')}, 'EXP|SUB') AND (regexp_matches({fold_sql('CLASE')}, 'EXPLOR|EXPLOT|SUB')
    OR regexp_matches({fold_sql('SUBCLASE')}, 'EXPLOR|EXPLOT|SUB')) THEN 'METALICO' ELSE 'NO_METALICO' END AS GRUPO_CATASTRO,
  CASE upper(trim(UNIDAD)) WHEN 'KM2' THEN AREA WHEN 'HA' THEN AREA / 100 WHEN 'M2' THEN AREA / 1000000 END AS AREA_KM2
FROM stage_reg""",
)


@query(with_views("SELECT * FROM by_stems", "stage_reg", extra=(_BY_STEMS,)))
def classified_by_word_stems(spark, sf_dir):
    return C.by_word_stems(_sheet(spark, sf_dir))


@query(with_views(_counts("by_stems"), "stage_reg", extra=(_BY_STEMS,)))
def group_counts_by_word_stems(spark, sf_dir):
    return C.group_counts(C.by_word_stems(_sheet(spark, sf_dir)))


# Merge of two sheets

_A = ("a", f"SELECT {strip_sql('expediente')} AS EXPEDIENTE, Nombre AS NOMBRE, segmento AS SEGMENTO, region AS REGION, true AS hit FROM merge_a")
_B = ("b", f"SELECT * REPLACE ({strip_sql('EXPEDIENTE')} AS EXPEDIENTE) FROM merge_b")
_SHARED = ("NOMBRE", "SEGMENTO", "REGION")


def _norm(x):
    return f"upper({strip_sql(f'coalesce({x}, chr(32))')})"


_CHANGED = {c: f"(a.hit AND {_norm('a.' + c)} <> {_norm('b.' + c)})" for c in _SHARED}
_COMPARED = (
    "compared",
    "SELECT b.EXPEDIENTE, "
    + ", ".join(f"CASE WHEN {t} THEN a.{c} ELSE b.{c} END AS {c}" for c, t in _CHANGED.items())
    + ", b.EXTRA_B, CASE WHEN a.hit IS NULL THEN 'NO_EN_ORIGEN' WHEN "
    + " OR ".join(_CHANGED.values())
    + " THEN 'ACTUALIZADO' ELSE 'SIN_CAMBIO' END AS VALIDACION_CAMBIO FROM b LEFT JOIN a ON a.EXPEDIENTE = b.EXPEDIENTE",
)
_CELLS = " UNION ALL ".join(
    f"SELECT b.EXPEDIENTE, '{c}' AS CAMPO, b.{c} AS VALOR_ANTERIOR, a.{c} AS VALOR_NUEVO "
    f"FROM b JOIN a ON a.EXPEDIENTE = b.EXPEDIENTE WHERE {t}"
    for c, t in _CHANGED.items()
)


def _compared(spark, sf_dir):
    return M.compare(*[spark_view(spark, sf_dir, v) for v in ("merge_a", "merge_b")])


@query(with_views("SELECT * FROM compared", "merge_a", "merge_b", extra=(_A, _B, _COMPARED)))
def merged_sheet(spark, sf_dir):
    return M.merged(_compared(spark, sf_dir))


@query(with_views(_CELLS, "merge_a", "merge_b", extra=(_A, _B)))
def cell_changes(spark, sf_dir):
    return M.cell_changes(_compared(spark, sf_dir))


@query(
    with_views(
        "SELECT count(*) FILTER (VALIDACION_CAMBIO = 'ACTUALIZADO') AS ACTUALIZADOS, "
        "count(*) FILTER (VALIDACION_CAMBIO = 'SIN_CAMBIO') AS SIN_CAMBIO, "
        "count(*) FILTER (VALIDACION_CAMBIO = 'NO_EN_ORIGEN') AS NO_EN_ORIGEN FROM compared",
        "merge_a", "merge_b", extra=(_A, _B, _COMPARED),
    )
)
def merge_outcome(spark, sf_dir):
    return M.outcome_counts(_compared(spark, sf_dir))


# Exports

_STRICT = "ESTADO NOT IN ('NO_UBICADO', 'ARCHIVADO')"
_GROUPS = "(VALUES ('METALICOS'), ('NO_METALICOS'), ('PERMISO_ESPECIAL')) g(GRUPO_CATASTRO)"


def _manifest(table):
    return (
        f"SELECT g.GRUPO_CATASTRO, count(t.row_seq) AS REGISTROS, "
        "CASE WHEN count(t.row_seq) > 0 THEN 'EXPORTADO' ELSE 'SIN_REGISTROS' END AS RESULTADO "
        f"FROM {_GROUPS} LEFT JOIN (SELECT * FROM {table} WHERE {_STRICT}) t ON t.GRUPO_CATASTRO = g.GRUPO_CATASTRO GROUP BY 1"
    )


@query(
    with_views(
        f"SELECT * FROM by_text WHERE {_STRICT} AND GRUPO_CATASTRO IN ('METALICOS', 'NO_METALICOS', 'PERMISO_ESPECIAL')",
        "stage_reg", extra=(_CLEAN, _BY_TEXT),
    )
)
def segmented_export_rows(spark, sf_dir):
    return E.exportable_groups(C.by_clean_text(_sheet(spark, sf_dir)))


@query(with_views(_manifest("by_text"), "stage_reg", extra=(_CLEAN, _BY_TEXT)))
def segmented_export_manifest(spark, sf_dir):
    return E.group_manifest(E.exportable_groups(C.by_clean_text(_sheet(spark, sf_dir))))


@query(with_views(_manifest("by_age"), "stage_reg", extra=(_AGED, _BY_AGE)))
def segmented_manifest_other_labels(spark, sf_dir):
    """The age rules name the special group differently, so the export finds no row for it."""
    return E.group_manifest(E.exportable_groups(C.by_age(_sheet(spark, sf_dir), RUN_YEAR)))


_SHORT = {
    "EXPEDIENTE": "expediente", "NOMBRE": "nombre", "ESTADO": "estado", "FECHA_INGRESO": "fecha_ingr",
    "PROYECTO": "proyecto", "CLASE": "clase", "SUBCLASE": "subclase", "MATERIALES": "materiales",
    "PROVINCIA": "provincia", "CANTON": "canton", "DISTRITO": "distrito", "AREA": "area", "UNIDAD": "unidad",
    "REGIMEN_JURIDICO": "regimen_ju", "FINALIDAD": "finalidad",
}
_LENIENT = "ESTADO IS NULL OR upper(ESTADO) NOT IN ('ARCHIVADO', 'NO_UBICADO')"


@query(
    with_views(
        f"SELECT {', '.join(f'{c} AS {s}' for c, s in _SHORT.items())} FROM stage_reg WHERE {_LENIENT}", "stage_reg"
    )
)
def single_export_rows(spark, sf_dir):
    return E.single_export(_sheet(spark, sf_dir))[0]


@query(
    with_views(
        f"SELECT count(*) FILTER ({_STRICT}) AS SIN_NULOS, count(*) FILTER ({_LENIENT}) AS CON_NULOS FROM stage_reg",
        "stage_reg",
    )
)
def exportable_counts(spark, sf_dir):
    """The two export policies differ on null and on case."""
    from cotejo.functions import predicates as P

    return _sheet(spark, sf_dir).agg(
        F.count_if(P.status_exportable_strict("ESTADO")).alias("SIN_NULOS"),
        F.count_if(P.status_exportable_lenient("ESTADO")).alias("CON_NULOS"),
    )
