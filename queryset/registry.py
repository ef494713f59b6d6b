"""Registry reconciliation queries."""

from pyspark.sql import functions as F

from cotejo.operators import quality as Q
from cotejo.operators import reconcile as R
from cotejo.operators import schema as S
from cotejo.functions.text import fold_key
from cotejo.plans.registry_etl import RegistryRun, RunInfo, gate_summary
from cotejo.plans.sheet_audit import audit_summary, prepare_sheet
from cotejo.sources.durable import stored
from queryset.catalog import RUN_TEXT, RUN_TS, blank_sql, fold_sql, query, strip_sql
from queryset.views import spark_view, with_views

INFO = RunInfo(RUN_TS, labels={"HOJA_USADA": "Hoja1"})

# SQL of the shared steps.
_KEYED = ("st", f"SELECT *, {fold_sql('EXPEDIENTE')} AS EXPEDIENTE_KEY FROM stage_reg")
_WINNERS = (
    "win",
    "SELECT * FROM st WHERE EXPEDIENTE_KEY <> '' "
    "QUALIFY row_number() OVER (PARTITION BY EXPEDIENTE_KEY ORDER BY row_seq DESC) = 1",
)
_ATTR_RANKED = (
    "att_all",
    "SELECT *, CASE WHEN EXPEDIENTE_KEY = '' THEN 1 ELSE row_number() OVER "
    "(PARTITION BY EXPEDIENTE_KEY ORDER BY FECHA_INGRESO DESC NULLS LAST, oid) END AS rn FROM target_attr",
)
_ATTR = ("att", "SELECT * EXCLUDE (rn), CAST(NULL AS VARCHAR) AS SUBCLASE FROM att_all WHERE rn = 1")
_BASE_KEYED = ("base_keyed", f"SELECT *, {fold_sql('EXPEDIENTE')} AS EXPEDIENTE_KEY FROM target_base")
# The polygon table has no filled date column yet, so the lowest oid of a key stays.
_BASE_RANKED = (
    "base_all",
    "SELECT *, CASE WHEN EXPEDIENTE_KEY = '' THEN 1 ELSE row_number() OVER "
    "(PARTITION BY EXPEDIENTE_KEY ORDER BY oid) END AS rn FROM base_keyed",
)
_BASE = ("base", "SELECT * EXCLUDE (rn) FROM base_all WHERE rn = 1")

_STAGED_COLUMNS = (
    "EXPEDIENTE", "NOMBRE", "PROYECTO", "ESTADO", "CLASE", "SUBCLASE", "MATERIALES", "REGIMEN_JURIDICO", "FINALIDAD",
    "PROVINCIA", "CANTON", "DISTRITO", "AREA", "UNIDAD", "FECHA_INGRESO",
)
_NOW = f"TIMESTAMP '{RUN_TS}'"
_DIFFERS = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in _STAGED_COLUMNS)
_LAPSES = f"(t.ESTADO IS NULL OR {strip_sql('t.ESTADO')} <> 'SIN_DATOS')"


def _snapshot_sql(action, staged, oid, old_columns, old_date, geometry=""):
    """New snapshot of the joined rows ``t`` (old) and ``s`` (staged), by the action taken."""
    columns = []
    for c in _STAGED_COLUMNS:
        old = f"t.{c}" if c in old_columns else "NULL"
        if c == "ESTADO":
            old = f"CASE WHEN {action} = 'SET_SIN_DATOS' THEN 'SIN_DATOS' ELSE t.ESTADO END"
        columns.append(f"CASE WHEN {staged} THEN s.{c} ELSE {old} END AS {c}")
    return (
        f"SELECT {oid} AS oid, coalesce(s.EXPEDIENTE_KEY, t.EXPEDIENTE_KEY) AS EXPEDIENTE_KEY, {', '.join(columns)}, "
        f"CASE WHEN {action} IN ('INSERT', 'UPDATE') THEN {_NOW} ELSE {old_date} END AS Fecha_Actualizacion, "
        f"CAST(CASE WHEN {staged} THEN 1 ELSE 0 END AS SMALLINT) AS EN_REPORTE, "
        f"CASE WHEN {staged} THEN {_NOW} END AS FECHA_REPORTE{geometry}, {action} AS ACCION "
    )


_ATTR_ACTION = (
    "CASE WHEN s.EXPEDIENTE_KEY IS NOT NULL AND t.oid IS NULL THEN 'INSERT' "
    f"WHEN s.EXPEDIENTE_KEY IS NOT NULL AND ({_DIFFERS}) THEN 'UPDATE' "
    "WHEN s.EXPEDIENTE_KEY IS NOT NULL THEN 'NOCHANGE' "
    f"WHEN {_LAPSES} THEN 'SET_SIN_DATOS' END"
)
_ATTR_ROWS = (
    "attr_rows",
    _snapshot_sql(
        _ATTR_ACTION, "s.EXPEDIENTE_KEY IS NOT NULL",
        "coalesce(t.oid, (SELECT max(oid) FROM target_attr) + 1 + s.row_seq)", _STAGED_COLUMNS, "t.Fecha_Actualizacion",
    )
    + "FROM att t FULL OUTER JOIN win s ON t.EXPEDIENTE_KEY = s.EXPEDIENTE_KEY",
)
_BASE_DIFFERS = " OR ".join(
    f"s.{c} IS DISTINCT FROM t.{c}" if c in ("EXPEDIENTE", "ESTADO", "AREA") else f"s.{c} IS NOT NULL"
    for c in _STAGED_COLUMNS
)
_BASE_ACTION = (
    f"CASE WHEN s.EXPEDIENTE_KEY IS NOT NULL AND ({_BASE_DIFFERS}) THEN 'UPDATE' "
    "WHEN s.EXPEDIENTE_KEY IS NOT NULL THEN 'NOCHANGE' WHEN t.EXPEDIENTE_KEY <> '' THEN 'SET_SIN_DATOS' END"
)
_BASE_ROWS = (
    "base_rows",
    _snapshot_sql(
        _BASE_ACTION, "s.EXPEDIENTE_KEY IS NOT NULL", "t.oid", ("EXPEDIENTE", "ESTADO", "AREA"), "NULL",
        ", t.xmin, t.ymin, t.xmax, t.ymax",
    )
    + "FROM base t LEFT JOIN win s ON t.EXPEDIENTE_KEY = s.EXPEDIENTE_KEY",
)
_ARCHIVED = (
    "archived",
    f"SELECT s.EXPEDIENTE, s.EXPEDIENTE_KEY, {fold_sql('t.ESTADO')} AS ESTADO_GIS_ACTUAL, "
    f"{fold_sql('s.ESTADO')} AS ESTADO_EXCEL_NUEVO FROM win s JOIN base t USING (EXPEDIENTE_KEY) "
    f"WHERE {fold_sql('s.ESTADO')} = 'ARCHIVADO' AND {fold_sql('t.ESTADO')} <> 'ARCHIVADO'",
)
_NO_POLYGON = (
    "no_polygon",
    "SELECT EXPEDIENTE AS EXPEDIENTE_EXCEL, EXPEDIENTE_KEY, ESTADO AS ESTADO_EXCEL FROM win "
    "WHERE EXPEDIENTE_KEY NOT IN (SELECT EXPEDIENTE_KEY FROM base_keyed)",
)
_NOT_STAGED = (
    "not_staged",
    "SELECT EXPEDIENTE AS EXPEDIENTE_CM_BASE, EXPEDIENTE_KEY FROM base WHERE EXPEDIENTE_KEY <> '' "
    "AND EXPEDIENTE_KEY NOT IN (SELECT EXPEDIENTE_KEY FROM win)",
)
_DUPLICATES = (
    "dups",
    "SELECT EXPEDIENTE_KEY, count(*) AS CANTIDAD FROM st WHERE EXPEDIENTE_KEY <> '' GROUP BY 1 HAVING count(*) > 1",
)
_BLANKS = ("blanks", f"SELECT EXPEDIENTE, EXPEDIENTE_KEY, ESTADO FROM st WHERE {blank_sql('ESTADO')}")


def _log_sql(action, table, key, detail, source):
    return (
        f"SELECT '{RUN_TEXT}' AS TIMESTAMP, {action} AS ACCION, '{table}' AS TABLA, {key} AS EXPEDIENTE_KEY, "
        f"{detail} AS DETALLE FROM {source}"
    )


_LOG_ATTR = (
    "log_attr",
    _log_sql("'DELETE_DUP'", "CM_ATRIBUTOS", "EXPEDIENTE_KEY", "'OID=' || oid || ' duplicado eliminado'", "att_all WHERE rn > 1")
    + " UNION ALL "
    + _log_sql(
        "ACCION", "CM_ATRIBUTOS", "EXPEDIENTE_KEY",
        "CASE ACCION WHEN 'UPDATE' THEN 'Registro actualizado' WHEN 'NOCHANGE' THEN 'Sin cambios de atributos' "
        "WHEN 'INSERT' THEN 'Registro insertado' ELSE 'No vino en Excel' END",
        "attr_rows WHERE ACCION IS NOT NULL",
    ),
)
_LOG_BASE = (
    "log_base",
    " UNION ALL ".join(
        [
            _log_sql("'DELETE_DUP'", "CM_BASE", "EXPEDIENTE_KEY", "'OID=' || oid || ' duplicado eliminado'", "base_all WHERE rn > 1"),
            _log_sql(
                "ACCION", "CM_BASE", "EXPEDIENTE_KEY",
                "CASE ACCION WHEN 'UPDATE' THEN 'Registro espacial actualizado' ELSE 'Sin cambios de atributos' END",
                "base_rows WHERE ACCION IN ('UPDATE', 'NOCHANGE')",
            ),
            _log_sql(
                "'SKIP_NO_GEOMETRY'", "CM_BASE", "EXPEDIENTE_KEY",
                "'No existe registro espacial en CM_BASE. Estado Excel=''' || coalesce(ESTADO_EXCEL, 'None') || ''''",
                "no_polygon",
            ),
            _log_sql(
                "'SET_SIN_DATOS'", "CM_BASE", "EXPEDIENTE_KEY", "'Existe en CM_BASE pero no vino en Excel'", "not_staged"
            ),
        ]
    ),
)
_PROBLEMS = (
    "problems",
    """SELECT '' AS EXPEDIENTE, EXPEDIENTE_KEY, 'DUPLICADO_ORIGEN' AS TIPO_PROBLEMA, 'Cantidad=' || CANTIDAD AS DETALLE FROM dups
UNION ALL SELECT EXPEDIENTE, EXPEDIENTE_KEY, 'ESTADO_VACIO', 'Estado nulo o vacío en Excel' FROM blanks
UNION ALL SELECT EXPEDIENTE, '', 'LLAVE_VACIA', 'No se pudo construir EXPEDIENTE_KEY en staging' FROM st WHERE EXPEDIENTE_KEY = ''
UNION ALL SELECT EXPEDIENTE, EXPEDIENTE_KEY, 'NUEVO_ARCHIVADO', 'Antes=''' || ESTADO_GIS_ACTUAL || ''' Ahora=''' || ESTADO_EXCEL_NUEVO || '''' FROM archived
UNION ALL SELECT EXPEDIENTE_EXCEL, EXPEDIENTE_KEY, 'EXCEL_SIN_CM_BASE', 'Existe en Excel pero no en CM_BASE. Estado Excel=''' || coalesce(ESTADO_EXCEL, 'None') || '''' FROM no_polygon
UNION ALL SELECT '', EXPEDIENTE_KEY, 'ATRIBUTO_SIN_DATOS', 'No vino en Excel actual' FROM attr_rows WHERE ACCION = 'SET_SIN_DATOS'
UNION ALL SELECT EXPEDIENTE_CM_BASE, EXPEDIENTE_KEY, 'CM_BASE_SIN_EXCEL', 'Existe en CM_BASE pero no vino en Excel actual' FROM not_staged""",
)

# Winners of the sheet with typed areas that neither table's AREA can hold; the polygon table gets those with a polygon.
_UNFIT = (
    "unfit",
    "SELECT EXPEDIENTE, EXPEDIENTE_KEY, 'VALOR_NO_VALIDO' AS TIPO_PROBLEMA, 'Tabla=' || t || ' Campo=AREA Valor=' || chr(39) || AREA || chr(39) AS DETALLE "
    "FROM win, (SELECT unnest(['CM_ATRIBUTOS', 'CM_BASE']) AS t) WHERE AREA IS NOT NULL AND TRY_CAST(AREA AS DOUBLE) IS NULL "
    "AND (t = 'CM_ATRIBUTOS' OR EXPEDIENTE_KEY IN (SELECT EXPEDIENTE_KEY FROM base_keyed))",
)

_ATTR_STEPS = (_KEYED, _WINNERS, _ATTR_RANKED, _ATTR, _ATTR_ROWS)
_BASE_STEPS = (_KEYED, _WINNERS, _BASE_KEYED, _BASE_RANKED, _BASE, _BASE_ROWS)
_ALL_STEPS = (
    _KEYED, _WINNERS, _ATTR_RANKED, _ATTR, _ATTR_ROWS, _BASE_KEYED, _BASE_RANKED, _BASE, _BASE_ROWS, _ARCHIVED,
    _NO_POLYGON, _NOT_STAGED, _DUPLICATES, _BLANKS,
)


def _attr_sql(body, *more):
    return with_views(body, "stage_reg", "target_attr", extra=(*_ATTR_STEPS, *more))


def _base_sql(body, *more):
    return with_views(body, "stage_reg", "target_base", extra=(*_BASE_STEPS, *more))


def _all_sql(body, *more):
    return with_views(body, "stage_reg", "target_attr", "target_base", extra=(*_ALL_STEPS, *more))


def _text_sql(body, *more):
    """The whole run over the sheet with typed areas: a value that does not fit leaves the stored one."""
    sql = with_views(body, "stage_text", "target_attr", "target_base", extra=(*_ALL_STEPS, _UNFIT, *more)).replace("FROM stage_reg", "FROM stage_text")
    return sql.replace("s.AREA IS DISTINCT FROM", "coalesce(TRY_CAST(s.AREA AS DOUBLE), t.AREA) IS DISTINCT FROM").replace(
        "THEN s.AREA ELSE", "THEN coalesce(TRY_CAST(s.AREA AS DOUBLE), t.AREA) ELSE"
    )


def _stage(spark, sf_dir):
    return R.with_key(spark_view(spark, sf_dir, "stage_reg"))


def _run(spark, sf_dir, sheet="stage_reg", **options):
    return RegistryRun(*[spark_view(spark, sf_dir, v) for v in (sheet, "target_attr", "target_base")], INFO, **options)


def _stored_run(spark, sf_dir, sheet="stage_reg"):
    """For reports that read the staged rows and both snapshots several times: each is computed once and stored."""
    return _run(spark, sf_dir, sheet, materialize=lambda name, df: stored(df))


def _counted_run(spark, sf_dir, sheet="stage_reg"):
    """For the counts alone: they read winners and snapshots once, so only the staged rows are stored, with their keys."""
    return _run(spark, sf_dir, sheet, materialize=lambda name, df: stored(df) if name == "stage" else df)


@query(_attr_sql("SELECT coalesce(ACCION, 'SIN_ACCION') AS ACCION, count(*) AS CANTIDAD FROM attr_rows GROUP BY 1"))
def reconcile_actions(spark, sf_dir):
    rows = _run(spark, sf_dir).attr_rows
    return rows.groupBy(F.coalesce("ACCION", F.lit("SIN_ACCION")).alias("ACCION")).agg(F.count("*").alias("CANTIDAD"))


@query(with_views("SELECT row_seq, EXPEDIENTE, EXPEDIENTE_KEY FROM st", "stage_reg", extra=(_KEYED,)))
def staged_keys(spark, sf_dir):
    return _stage(spark, sf_dir).select("row_seq", "EXPEDIENTE", "EXPEDIENTE_KEY")


@query(with_views("SELECT * FROM win", "stage_reg", extra=(_KEYED, _WINNERS)))
def staged_winners(spark, sf_dir):
    return R.stage_winners(_stage(spark, sf_dir))


@query(with_views("SELECT * FROM dups", "stage_reg", extra=(_KEYED, _DUPLICATES)))
def duplicate_keys(spark, sf_dir):
    return Q.duplicate_keys(_stage(spark, sf_dir))


@query(with_views("SELECT * FROM blanks", "stage_reg", extra=(_KEYED, _BLANKS)))
def blank_status_rows(spark, sf_dir):
    stage = _stage(spark, sf_dir)
    return Q.blank_status(stage, S.find_status(stage))


@query(with_views("SELECT row_seq, EXPEDIENTE, ESTADO FROM st WHERE EXPEDIENTE_KEY = ''", "stage_reg", extra=(_KEYED,)))
def blank_key_rows(spark, sf_dir):
    return Q.blank_keys(_stage(spark, sf_dir)).select("row_seq", "EXPEDIENTE", "ESTADO")


@query(with_views("SELECT oid, EXPEDIENTE_KEY, ESTADO FROM target_attr", "target_attr"))
def attribute_scan(spark, sf_dir):
    return spark_view(spark, sf_dir, "target_attr").select("oid", "EXPEDIENTE_KEY", "ESTADO")


@query(with_views("SELECT * EXCLUDE (rn) FROM att_all WHERE rn = 1", "target_attr", extra=(_ATTR_RANKED,)))
def deduplicated_attributes(spark, sf_dir):
    return R.drop_duplicates(spark_view(spark, sf_dir, "target_attr"))


@query(with_views("SELECT oid, EXPEDIENTE_KEY FROM att_all WHERE rn > 1", "target_attr", extra=(_ATTR_RANKED,)))
def deleted_duplicates(spark, sf_dir):
    return R.duplicate_losers(spark_view(spark, sf_dir, "target_attr"))


@query(_attr_sql("SELECT * FROM attr_rows"))
def upserted_attributes(spark, sf_dir):
    return _run(spark, sf_dir).attr_rows


@query(
    with_views(
        f"SELECT row_seq + 1 AS oid, EXPEDIENTE_KEY, {', '.join(_STAGED_COLUMNS)}, {_NOW} AS Fecha_Actualizacion, "
        f"CAST(1 AS SMALLINT) AS EN_REPORTE, {_NOW} AS FECHA_REPORTE, 'INSERT' AS ACCION FROM win",
        "stage_reg", extra=(_KEYED, _WINNERS),
    )
)
def first_run_attributes(spark, sf_dir):
    """The attribute table does not exist yet: it is created from the staged schema."""
    stage, base = (spark_view(spark, sf_dir, v) for v in ("stage_reg", "target_base"))
    return RegistryRun(stage, None, base, INFO).attr_rows


@query(_attr_sql("SELECT 'NOCHANGE' AS ACCION, count(*) AS CANTIDAD FROM win"))
def second_run_actions(spark, sf_dir):
    """The result of a run, run again with the same sheet: every staged key is unchanged, nothing else happens."""
    run = _stored_run(spark, sf_dir)
    again = R.upsert(run.attr_rows.drop("ACCION"), run.winners, RUN_TS)
    return again.where(F.col("ACCION").isNotNull()).groupBy("ACCION").agg(F.count("*").alias("CANTIDAD"))


@query(_base_sql("SELECT * FROM base_rows"))
def synced_polygons(spark, sf_dir):
    return _run(spark, sf_dir).base_rows


@query(_base_sql("SELECT CASE ACCION WHEN 'UPDATE' THEN 'NOCHANGE' ELSE ACCION END AS ACCION, count(*) AS CANTIDAD FROM base_rows WHERE ACCION IS NOT NULL GROUP BY 1"))
def second_sync_actions(spark, sf_dir):
    run = _stored_run(spark, sf_dir)
    again = R.sync(run.base_rows.drop("ACCION"), run.winners, RUN_TS)
    return again.where(F.col("ACCION").isNotNull()).groupBy("ACCION").agg(F.count("*").alias("CANTIDAD"))


@query(_all_sql("SELECT * FROM no_polygon"))
def staged_without_polygon(spark, sf_dir):
    return _run(spark, sf_dir).without_polygon()


@query(_base_sql("SELECT row_seq, EXPEDIENTE_KEY FROM win WHERE EXPEDIENTE_KEY IN (SELECT EXPEDIENTE_KEY FROM base_keyed)"))
def staged_with_polygon(spark, sf_dir):
    run = _run(spark, sf_dir)
    return R.staged_with_polygon(run.winners, run.base_before).select("row_seq", "EXPEDIENTE_KEY")


@query(_base_sql("SELECT oid, EXPEDIENTE_KEY FROM base_keyed WHERE EXPEDIENTE_KEY <> '' AND EXPEDIENTE_KEY NOT IN (SELECT EXPEDIENTE_KEY FROM win)"))
def polygon_rows_not_staged(spark, sf_dir):
    """Every row of a missing key, duplicates included."""
    run = _run(spark, sf_dir)
    return R.polygons_not_staged(run.base_before, run.stage).select("oid", "EXPEDIENTE_KEY")


@query(_all_sql("SELECT * FROM not_staged"))
def polygons_without_staged_row(spark, sf_dir):
    return _run(spark, sf_dir).not_staged()


@query(_all_sql("SELECT * FROM archived"))
def newly_archived(spark, sf_dir):
    return _run(spark, sf_dir).archived()


@query(_attr_sql("SELECT * FROM log_attr", _LOG_ATTR))
def attribute_log(spark, sf_dir):
    return _run(spark, sf_dir).log_attributes()


@query(_all_sql("SELECT * FROM log_base", _LOG_BASE))
def polygon_log(spark, sf_dir):
    return _stored_run(spark, sf_dir).log_polygons()


@query(_all_sql("SELECT * FROM problems", _PROBLEMS))
def problem_list(spark, sf_dir):
    return _stored_run(spark, sf_dir).problems()


@query(_text_sql("SELECT * FROM problems UNION ALL SELECT * FROM unfit", _PROBLEMS))
def problem_list_of_typed_areas(spark, sf_dir):
    """Staged areas that the number columns of both tables cannot hold are problems, not silence."""
    return _stored_run(spark, sf_dir, "stage_text").problems()


@query(_text_sql("SELECT * FROM attr_rows"))
def upserted_typed_areas(spark, sf_dir):
    return _run(spark, sf_dir, "stage_text").attr_rows


def _metric(name, count):
    return f"SELECT '{name}' AS METRICA, CAST(({count}) AS VARCHAR) AS VALOR"


def _n(table, condition):
    return f"SELECT count(*) FROM {table} WHERE {condition}"


def _metrics(unfit):
    return " UNION ALL ".join([*_METRICS, _metric("VALORES_NO_VALIDOS", unfit)])


_METRICS = [
    *["SELECT 'HOJA_USADA' AS METRICA, 'Hoja1' AS VALOR", "SELECT 'CM_ATRIBUTOS', 'CM_ATRIBUTOS'", "SELECT 'CM_BASE', 'CM_BASE'"],
    *[
        _metric("DUPLICADOS_ORIGEN", _n("dups", "true")),
        _metric("ESTADOS_VACIOS", _n("blanks", "true")),
        _metric("NUEVOS_ARCHIVADO", _n("archived", "true")),
        _metric("CM_BASE_SIN_EXCEL", _n("not_staged", "true")),
        _metric("EXCEL_SIN_CM_BASE", _n("no_polygon", "true")),
        _metric("SKIPS_STAGING_SIN_LLAVE", _n("st", "EXPEDIENTE_KEY = ''")),
        _metric("CM_ATRIBUTOS_DUPLICADOS_ELIMINADOS", _n("att_all", "rn > 1")),
        _metric("CM_BASE_DUPLICADOS_ELIMINADOS", _n("base_all", "rn > 1")),
        _metric("CM_ATRIBUTOS_UPDATES", _n("attr_rows", "ACCION = 'UPDATE'")),
        _metric("CM_ATRIBUTOS_INSERTS", _n("attr_rows", "ACCION = 'INSERT'")),
        _metric("CM_ATRIBUTOS_NOCHANGE", _n("attr_rows", "ACCION = 'NOCHANGE'")),
        _metric("CM_ATRIBUTOS_SET_SIN_DATOS", _n("attr_rows", "ACCION = 'SET_SIN_DATOS'")),
        _metric("CM_BASE_UPDATES", _n("base_rows", "ACCION = 'UPDATE'")),
        _metric("CM_BASE_INSERTS", "SELECT 0"),
        _metric("CM_BASE_NOCHANGE", _n("base_rows", "ACCION = 'NOCHANGE'")),
        _metric("CM_BASE_SET_SIN_DATOS", _n("base_rows", "ACCION = 'SET_SIN_DATOS'")),
    ],
]


@query(_all_sql(_metrics("SELECT 0")))
def run_metrics(spark, sf_dir):
    return _counted_run(spark, sf_dir).summary()


@query(_text_sql(_metrics(_n("unfit", "true"))))
def run_metrics_of_typed_areas(spark, sf_dir):
    return _counted_run(spark, sf_dir, "stage_text").summary()


@query(
    with_views(
        f"SELECT '{RUN_TEXT}' AS FECHA_EJECUCION, "
        "CASE WHEN (SELECT count(*) FROM dups) > 0 THEN 'DETENIDO_POR_DUPLICADOS' ELSE 'OK' END AS ESTADO_ETL, "
        "(SELECT count(*) FROM st) AS TOTAL_ORIGEN, (SELECT count(*) FROM target_attr) AS TOTAL_PREVIO, "
        "(SELECT count(*) FROM dups) AS DUPLICADOS, (SELECT count(*) FROM st WHERE EXPEDIENTE_KEY = '') AS SKIPS",
        "stage_reg", "target_attr", extra=(_KEYED, _DUPLICATES),
    )
)
def duplicate_gate_summary(spark, sf_dir):
    return gate_summary(spark_view(spark, sf_dir, "stage_reg"), spark_view(spark, sf_dir, "target_attr"), INFO)


# Sheet preparation and audit

_NAMED = ("PROYECTO", "PROVINCIA", "CANTON", "DISTRITO")
_PREPARED = (
    "prepared",
    "SELECT row_seq, EXPEDIENTE, ESTADO, NOMBRE, "
    + ", ".join(f"{fold_sql(c)} AS {c}" for c in _NAMED)
    + ", CLASE, SUBCLASE, MATERIALES, REGIMEN_JURIDICO, FINALIDAD, AREA, UNIDAD, FECHA_INGRESO FROM stage_reg",
)
_FILLED = " + ".join(
    f"CASE WHEN {c} IS NOT NULL AND {strip_sql(f'CAST({c} AS VARCHAR)')} <> '' THEN 1 ELSE 0 END" for c in _STAGED_COLUMNS
)
_COMPLETE = (
    "complete",
    f"SELECT * FROM prepared WHERE {blank_sql('EXPEDIENTE')} UNION ALL "
    f"(SELECT * FROM prepared WHERE NOT {blank_sql('EXPEDIENTE')} "
    f"QUALIFY row_number() OVER (PARTITION BY EXPEDIENTE ORDER BY {_FILLED} DESC, row_seq) = 1)",
)


@query(with_views("SELECT * FROM prepared", "stage_reg", extra=(_PREPARED,)))
def normalised_text_columns(spark, sf_dir):
    return prepare_sheet(spark_view(spark, sf_dir, "stage_reg"))


@query(with_views("SELECT * FROM complete", "stage_reg", extra=(_PREPARED, _COMPLETE)))
def most_complete_rows(spark, sf_dir):
    return R.keep_most_complete(prepare_sheet(spark_view(spark, sf_dir, "stage_reg")))


@query(
    with_views(
        f"SELECT row_seq, EXPEDIENTE, CASE WHEN {blank_sql('ESTADO')} THEN 'PENDIENTE' ELSE ESTADO END AS ESTADO FROM stage_reg",
        "stage_reg",
    )
)
def blank_status_pending(spark, sf_dir):
    return R.fill_blank_status(spark_view(spark, sf_dir, "stage_reg").select("row_seq", "EXPEDIENTE", "ESTADO"))


@query(
    with_views(
        "SELECT (SELECT count(*) FROM prepared) AS FILAS_ORIGEN, (SELECT count(*) FROM complete) AS FILAS_FINALES, "
        "(SELECT count(*) FROM prepared) - (SELECT count(*) FROM complete) AS DUPLICADOS_ELIMINADOS, "
        f"(SELECT count(*) FROM complete WHERE {blank_sql('ESTADO')}) AS ESTADOS_CORREGIDOS",
        "stage_reg", extra=(_PREPARED, _COMPLETE),
    )
)
def sheet_audit_summary(spark, sf_dir):
    return audit_summary(spark_view(spark, sf_dir, "stage_reg"))


@query(
    with_views(
        f"SELECT {fold_sql('ESTADO')} AS ESTADO_CLAVE, count(*) AS CANTIDAD FROM stage_reg GROUP BY 1", "stage_reg"
    )
)
def staged_status_counts(spark, sf_dir):
    stage = spark_view(spark, sf_dir, "stage_reg")
    return stage.groupBy(fold_key("ESTADO").alias("ESTADO_CLAVE")).agg(F.count("*").alias("CANTIDAD"))


@query(
    "SELECT CAST(o_orderkey AS VARCHAR) AS EXPEDIENTE_KEY, 'AREA' AS CAMPO, 'ca. ' || CAST(o_orderkey AS VARCHAR) || ' ha' AS VALOR "
    "FROM orders WHERE o_orderkey % 7 = 0"
)
def values_not_valid(spark, sf_dir):
    """Staged texts that do not fit a number column of the target."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    key, number = F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("double")
    text = F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("ca. "), key, F.lit(" ha"))).otherwise(number.cast("string"))
    winners = orders.select(key.alias("EXPEDIENTE_KEY"), F.col("o_orderkey").alias("row_seq"), text.alias("AREA"))
    target = orders.select(F.col("o_orderkey").alias("oid"), key.alias("EXPEDIENTE_KEY"), number.alias("AREA"))
    return R.values_not_valid(target, winners)
