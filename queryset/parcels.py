"""Overlap queries: every parcel of the table against every other."""

from pyspark.sql import functions as F

from cotejo.functions import geometry as G
from cotejo.functions.predicates import new_id_problem
from cotejo.operators import overlap as O
from queryset.catalog import query, strip_sql
from queryset.views import spark_view, with_views

CELL = 8.0  # about the extent of a small parcel in the given tables

_AREA = "(xmax - xmin) * (ymax - ymin)"
_W = "greatest(least(s.xmax, p.xmax) - greatest(s.xmin, p.xmin), 0)"
_H = "greatest(least(s.ymax, p.ymax) - greatest(s.ymin, p.ymin), 0)"
_MEET = "s.xmin <= p.xmax AND s.xmax >= p.xmin AND s.ymin <= p.ymax AND s.ymax >= p.ymin"
_MEASURES = (
    f"CASE WHEN {_W} * {_H} > 0 THEN 'TRASLAPA' ELSE 'TOCA' END AS TIPO, round({_W} * {_H}, 2) AS AREA_TRASLAPE, "
    f"round({_W} * {_H} / s.area * 100, 2) AS PORCENTAJE_TRASLAPE, p.oid AS oid"
)


def _first(table, key="id"):
    return (
        f"SELECT * FROM (SELECT * FROM {table} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY oid) = 1) WHERE area > 0"
    )


# Trimmed ids and statuses, status of the polygon table.
_TRIMMED = (
    "rows_t",
    f"SELECT oid, {strip_sql('coalesce(EXPEDIENTE, chr(32))')} AS id, {strip_sql('ESTADO')} AS st, {_AREA} AS area, "
    "xmin, ymin, xmax, ymax FROM target_base WHERE xmin IS NOT NULL",
)
_TRIMMED_SUBJECTS = ("subj", _first("(SELECT * FROM rows_t WHERE id <> '')"))
_TRIMMED_FOUND = (
    "found",
    f"SELECT s.id AS EXPEDIENTE_BASE, p.id AS EXPEDIENTE, CASE WHEN coalesce(p.st, '') = '' THEN 'SIN_ESTADO' ELSE p.st END AS ESTADO, "
    f"{_MEASURES} FROM subj s JOIN rows_t p ON {_MEET} WHERE p.id <> s.id "
    "AND upper(coalesce(p.st, '')) NOT IN ('ARCHIVADO', 'EXTINTO', 'NO_UBICADO')",
)
_TRIMMED_STEPS = (_TRIMMED, _TRIMMED_SUBJECTS, _TRIMMED_FOUND)


def _parcels(spark, sf_dir):
    return spark_view(spark, sf_dir, "target_base")


def _found(spark, sf_dir):
    parcels = _parcels(spark, sf_dir)
    return O.overlaps(parcels, parcels, cell=CELL)


@query(with_views("SELECT * FROM found", "target_base", extra=_TRIMMED_STEPS))
def parcel_overlaps(spark, sf_dir):
    return O.ranked(_found(spark, sf_dir))


# Exact ids, status of the attribute table (the last row of an id decides).
_STATES = (
    "states",
    "SELECT EXPEDIENTE AS id, ESTADO AS st FROM target_attr WHERE EXPEDIENTE IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY EXPEDIENTE ORDER BY oid DESC) = 1",
)
_EXACT = (
    "rows_x",
    f"SELECT oid, EXPEDIENTE AS id, {_AREA} AS area, xmin, ymin, xmax, ymax FROM target_base WHERE xmin IS NOT NULL",
)
_EXACT_SUBJECTS = ("subj", _first("(SELECT * FROM rows_x WHERE id IS NOT NULL)"))


@query(
    with_views(
        f"SELECT s.id AS EXPEDIENTE_BASE, p.id AS EXPEDIENTE, CASE WHEN coalesce({strip_sql('t.st')}, '') = '' THEN 'SIN_ESTADO' ELSE t.st END AS ESTADO, "
        f"{_MEASURES} FROM subj s JOIN rows_x p ON {_MEET} LEFT JOIN states t ON t.id = p.id "
        f"WHERE p.id IS DISTINCT FROM s.id AND (coalesce({strip_sql('t.st')}, '') = '' OR upper(t.st) NOT IN ('ARCHIVADO', 'EXTINTO'))",
        "target_base", "target_attr", extra=(_STATES, _EXACT, _EXACT_SUBJECTS),
    )
)
def overlaps_with_joined_status(spark, sf_dir):
    parcels, attributes = _parcels(spark, sf_dir), spark_view(spark, sf_dir, "target_attr")
    return O.overlaps_joined_status(parcels, attributes, parcels, cell=CELL)


# New parcels: one per part, beside the existing ones.

_NEW = (
    "news",
    "SELECT oid, 'NUEVO-' || CAST(oid AS STRING) AS id, xmin + 1 AS xmin, ymin + 1 AS ymin, xmax + 2 AS xmax, ymax + 1 AS ymax, "
    "(xmax - xmin + 1) * (ymax - ymin) AS area FROM target_base WHERE xmin IS NOT NULL",
)


def _new_parcels(spark, sf_dir):
    return _parcels(spark, sf_dir).select(
        "oid", F.concat(F.lit("NUEVO-"), F.col("oid").cast("string")).alias("EXPEDIENTE"),
        (F.col("xmin") + 1).alias("xmin"), (F.col("ymin") + 1).alias("ymin"),
        (F.col("xmax") + 2).alias("xmax"), (F.col("ymax") + 1).alias("ymax"),
    )


@query(
    with_views(
        "SELECT s.id AS EXPEDIENTE_NUEVO, p.id AS EXPEDIENTE, CASE WHEN t.id IS NULL THEN 'NO_DEFINIDO' ELSE t.st END AS ESTADO, "
        f"round({_W} * {_H}, 2) AS AREA_TRASLAPE, round({_W} * {_H} / s.area * 100, 2) AS PORCENTAJE_TRASLAPE, p.oid AS oid "
        "FROM news s JOIN (SELECT oid, id, xmin, ymin, xmax, ymax, false AS added FROM rows_x "
        f"UNION ALL SELECT oid, id, xmin, ymin, xmax, ymax, true FROM news) p ON {_MEET} LEFT JOIN states t ON t.id = p.id "
        f"WHERE (NOT p.added OR p.oid < s.oid) AND {_W} * {_H} > 0 AND s.area > 0 AND NOT (t.id IS NOT NULL AND coalesce(t.st, '') IN ('ARCHIVADO', 'EXTINTO'))",
        "target_base", "target_attr", extra=(_STATES, _EXACT, _NEW),
    )
)
def overlaps_of_new_parcels(spark, sf_dir):
    return O.overlaps_of_new(
        _new_parcels(spark, sf_dir), _parcels(spark, sf_dir), spark_view(spark, sf_dir, "target_attr"), cell=CELL
    )


def _plain_sql(x):
    return f"CAST({x} AS VARCHAR)"


@query(
    with_views(
        f"SELECT 'Expediente base: ' || id || ' | Área base: ' || {_plain_sql('round(area, 2)')} || ' m²' AS line FROM subj "
        "UNION ALL SELECT 'Expediente: ' || EXPEDIENTE || ' | Estado: ' || ESTADO || ' | Tipo: ' || TIPO || ' | Área traslapada: ' || "
        f"{_plain_sql('AREA_TRASLAPE')} || ' m² | % respecto al base: ' || CASE WHEN TIPO = 'TOCA' THEN '0' ELSE {_plain_sql('PORCENTAJE_TRASLAPE')} END || ' %' FROM found "
        "UNION ALL SELECT 'No se detectaron traslapes válidos.' FROM subj WHERE id NOT IN (SELECT EXPEDIENTE_BASE FROM found)",
        "target_base", extra=_TRIMMED_STEPS,
    )
)
def overlap_report_lines(spark, sf_dir):
    parcels = _parcels(spark, sf_dir)
    return O.report_lines(O.overlaps(parcels, parcels, cell=CELL), O.analysed_subjects(parcels, parcels))


@query(
    with_views(
        "SELECT coalesce(EXPEDIENTE, '') AS EXPEDIENTE, CASE WHEN coalesce(EXPEDIENTE, '') = '' THEN 'EXPEDIENTE_VACIO' WHEN n = 0 THEN 'EXPEDIENTE_NO_ENCONTRADO' ELSE 'AREA_CERO' END AS PROBLEMA FROM ("
        f"SELECT w.EXPEDIENTE, count(p.oid) AS n, coalesce(arg_min({_AREA}, p.oid) FILTER (p.xmin IS NOT NULL), 0) AS a "
        f"FROM (SELECT {strip_sql('EXPEDIENTE')} AS EXPEDIENTE FROM target_attr UNION SELECT {strip_sql('EXPEDIENTE')} FROM target_base) w "
        f"LEFT JOIN (SELECT * REPLACE ({strip_sql('EXPEDIENTE')} AS EXPEDIENTE) FROM target_base) p ON p.EXPEDIENTE = w.EXPEDIENTE GROUP BY 1) WHERE n = 0 OR a = 0",
        "target_attr", "target_base",
    )
)
def parcels_not_analysable(spark, sf_dir):
    parcels = _parcels(spark, sf_dir)
    wanted = spark_view(spark, sf_dir, "target_attr").select("EXPEDIENTE").union(parcels.select("EXPEDIENTE"))
    return O.subject_problems(parcels, wanted)


_PROBLEM = (
    "CASE WHEN coalesce(EXPEDIENTE, '') = '' THEN 'OBLIGATORIO' WHEN contains(EXPEDIENTE, ' ') THEN 'CONTIENE_ESPACIOS' "
    "WHEN EXPEDIENTE <> upper(EXPEDIENTE) THEN 'NO_MAYUSCULAS' END"
)


@query(with_views(f"SELECT oid, EXPEDIENTE, {_PROBLEM} AS PROBLEMA FROM target_base", "target_base"))
def new_id_checks(spark, sf_dir):
    return _parcels(spark, sf_dir).select("oid", "EXPEDIENTE", new_id_problem("EXPEDIENTE").alias("PROBLEMA"))


@query(
    with_views(
        "SELECT oid, EXPEDIENTE, ESTADO, xmin, ymin, xmax, ymax FROM target_base UNION ALL "
        f"(SELECT row_seq + 1000000000000, EXPEDIENTE, NULL, 0, 0, 1, 1 FROM stage_reg WHERE {_PROBLEM} IS NULL "
        "QUALIFY row_number() OVER (PARTITION BY EXPEDIENTE ORDER BY row_seq) = 1)",
        "target_base", "stage_reg",
    )
)
def parcels_after_adding(spark, sf_dir):
    base = _parcels(spark, sf_dir).select("oid", "EXPEDIENTE", "ESTADO", *O.BOX)
    box = {c: F.lit(0.0 if c.endswith("min") else 1.0) for c in O.BOX}
    new = spark_view(spark, sf_dir, "stage_reg").select((F.col("row_seq") + 1000000000000).alias("oid"), "EXPEDIENTE")
    return O.add_parcels(base, new.withColumns(box))


# L-shaped parcels: the general polygon path, checked against sums over their two rectangles.

_L_PARTS = (
    "parts",
    "SELECT oid, EXPEDIENTE AS id, ESTADO AS st, x0 AS xmin, y0 AS ymin, x0 + w AS xmax, y0 + h / 2 AS ymax, w * h * 0.75 AS area FROM parcels_l "
    "UNION ALL SELECT oid, EXPEDIENTE, ESTADO, x0, y0 + h / 2, x0 + w / 2, y0 + h, w * h * 0.75 FROM parcels_l",
)


def _l_parcels(spark, sf_dir):
    x, y, w, h = (F.col(c) for c in ("x0", "y0", "w", "h"))
    rings = spark_view(spark, sf_dir, "parcels_l").select(
        "oid", "EXPEDIENTE", "ESTADO",
        F.array(x, x + w, x + w, x + w / 2, x + w / 2, x).alias("xs"),
        F.array(y, y, y + h / 2, y + h / 2, y + h, y + h).alias("ys"),
        F.array(F.lit(6)).alias("ring_sizes"),
    )
    return G.with_box(rings).withColumn("area", G.polygon_area("xs", "ys", "ring_sizes"))


@query(with_views("SELECT oid, w * h * 0.75 AS area, x0 AS xmin, y0 AS ymin, x0 + w AS xmax, y0 + h AS ymax FROM parcels_l", "parcels_l"))
def polygon_areas(spark, sf_dir):
    return _l_parcels(spark, sf_dir).select("oid", "area", *O.BOX)


@query(
    with_views(
        "SELECT id_s AS EXPEDIENTE_BASE, id_p AS EXPEDIENTE, coalesce(st, 'SIN_ESTADO') AS ESTADO, "
        "CASE WHEN shared > 0 THEN 'TRASLAPA' ELSE 'TOCA' END AS TIPO, round(shared, 2) AS AREA_TRASLAPE, "
        "round(shared / area * 100, 2) AS PORCENTAJE_TRASLAPE, oid FROM ("
        f"SELECT s.id AS id_s, p.id AS id_p, p.oid, p.st, s.area, sum({_W} * {_H}) AS shared "
        f"FROM parts s JOIN parts p ON {_MEET} WHERE s.id <> p.id AND coalesce(p.st, '') <> 'ARCHIVADO' GROUP BY ALL)",
        "parcels_l", extra=(_L_PARTS,),
    )
)
def polygon_overlaps(spark, sf_dir):
    parcels = _l_parcels(spark, sf_dir)
    return O.overlaps(parcels, parcels, shape="ring", cell=CELL)
