"""Input views over the given tables, written once in SQL that both Spark and DuckDB read.

Each view derives one input schema (staged sheet, attribute table, parcels, tasks, mail, meetings, files) from a
whole table, row by row, by formula. Key spaces, coordinates and dates grow with the table, so the density of
duplicates, matches and overlaps stays the same at any scale.
"""

import re

_ID = """
  CAST(2000 + {b} % 27 AS STRING) || '-' ||
  CASE {b} % 7 WHEN 0 THEN 'CAN' WHEN 1 THEN 'EXP' WHEN 2 THEN 'SUB' WHEN 3 THEN 'MUN' WHEN 4 THEN 'CNE'
               WHEN 5 THEN 'CAN-MUN' ELSE 'CDP' END || '-PRI-' || CAST({b} AS STRING)"""

# Columns of a registry record, from its number k and an order's status, value and date.
_RECORD = """
  CASE k % 5 WHEN 0 THEN 'Municipalidad de San José' WHEN 1 THEN 'Concejo ' || CAST(k % 50 AS STRING)
             WHEN 2 THEN 'ICE' WHEN 3 THEN 'Titular Ñandú ' || CAST(o_custkey AS STRING)
             ELSE 'Áridos del Sur' END AS NOMBRE,
  CASE WHEN k % 8 = 0 THEN NULL ELSE 'Proyecto ' || CAST(k % 100 AS STRING) END AS PROYECTO,
  CASE WHEN o_orderstatus = 'F' THEN (CASE k % 4 WHEN 0 THEN 'ARCHIVADO' WHEN 1 THEN 'Archivado'
                                                 WHEN 2 THEN ' archivado ' ELSE 'Extinto' END)
       WHEN o_orderstatus = 'O' THEN (CASE k % 6 WHEN 0 THEN 'Denegado' WHEN 1 THEN 'NO_UBICADO'
                                                 ELSE 'Vigente' END)
       WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN '' ELSE '  ' END AS ESTADO,
  CASE k % 6 WHEN 0 THEN 'EXPLORACIÓN' WHEN 1 THEN 'subterráneo' WHEN 2 THEN 'Explotación'
             WHEN 3 THEN 'EXPLORACION' WHEN 4 THEN 'Tajo' ELSE NULL END AS CLASE,
  CASE k % 4 WHEN 0 THEN 'PRIVADO' WHEN 1 THEN '' WHEN 2 THEN 'Público' ELSE NULL END AS SUBCLASE,
  CASE k % 9 WHEN 0 THEN 'Oro y plata' WHEN 1 THEN 'Cobre' WHEN 2 THEN NULL WHEN 3 THEN 'arena, hierro'
             ELSE 'Arena' END AS MATERIALES,
  CASE k % 10 WHEN 3 THEN 'PERMISO_ESPECIAL' WHEN 4 THEN NULL ELSE 'CONCESIÓN' END AS REGIMEN_JURIDICO,
  CASE k % 12 WHEN 5 THEN 'Emergencia' ELSE 'Comercial' END AS FINALIDAD,
  CASE k % 3 WHEN 0 THEN 'San José' WHEN 1 THEN 'Limón' ELSE 'Guanacaste' END AS PROVINCIA,
  'Cantón ' || CAST(k % 80 AS STRING) AS CANTON,
  'Distrito  ' || CAST(k % 400 AS STRING) AS DISTRITO,
  o_totalprice AS AREA,
  CASE k % 4 WHEN 0 THEN 'KM2' WHEN 1 THEN 'ha ' WHEN 2 THEN 'm2' ELSE 'acre' END AS UNIDAD,
  o_orderdate AS FECHA_INGRESO"""

# Several sheet rows share an id: two neighbours in every 13, and one id takes a 29th of all rows.
_BASE = """CASE WHEN o_orderkey % 29 = 8 THEN 8 WHEN o_orderkey % 13 IN (5, 6) THEN o_orderkey - o_orderkey % 13 + 4
                ELSE o_orderkey END"""

_RECTANGLE = """
  CAST((k * 37) % 200 + 200 * floor(k / 1000) AS DOUBLE) AS x0,
  CAST((k * 91) % 1000 AS DOUBLE) AS y0,
  CAST(CASE WHEN k % 67 = 0 THEN 0 ELSE 5 + p_size % 20 END AS DOUBLE) AS w,
  CAST(5 + k % 13 AS DOUBLE) AS h"""

VIEWS = {
    # The staged sheet.
    "stage_reg": f"""
SELECT k AS row_seq,
  CASE WHEN k % 97 = 0 THEN (CASE k % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE '   ' END)
       WHEN k % 17 = 2 THEN lower(id) WHEN k % 17 = 5 THEN '  ' || id || ' '
       WHEN k % 17 = 7 THEN chr(160) || id || chr(9) WHEN k % 17 = 11 THEN replace(id, 'E', 'É')
       ELSE id END AS EXPEDIENTE,
  {_RECORD}
FROM (SELECT o_orderkey AS k, {_ID.format(b="b")} AS id, o_custkey, o_orderstatus, o_totalprice, o_orderdate
      FROM (SELECT *, {_BASE} AS b FROM {{orders}}) t) u""",
    # The attribute table: most staged ids, some rows changed, some duplicated, some no longer staged, one staged
    # column not known yet.
    "target_attr": f"""
SELECT k AS oid,
  CASE WHEN k % 41 = 0 THEN '' WHEN k % 5 = 0 THEN '1991-OLD-PRI-' || CAST(k AS STRING)
       WHEN k % 11 = 1 THEN '1990-OLD-PRI-' || CAST(k AS STRING) ELSE id END AS EXPEDIENTE_KEY,
  CASE WHEN k % 5 = 0 THEN '1991-OLD-PRI-' || CAST(k AS STRING)
       WHEN k % 11 = 1 THEN '1990-OLD-PRI-' || CAST(k AS STRING)
       WHEN k % 17 = 2 THEN lower(id) WHEN k % 17 = 5 THEN '  ' || id || ' '
       WHEN k % 17 = 7 THEN chr(160) || id || chr(9) WHEN k % 17 = 11 THEN replace(id, 'E', 'É')
       ELSE id END AS EXPEDIENTE,
  NOMBRE, CASE WHEN k % 3 = 0 THEN 'Otro' ELSE PROYECTO END AS PROYECTO,
  CASE WHEN k % 22 = 1 THEN 'SIN_DATOS' WHEN k % 6 = 1 THEN NULL ELSE ESTADO END AS ESTADO,
  CLASE, MATERIALES, REGIMEN_JURIDICO, FINALIDAD, PROVINCIA, CANTON, DISTRITO, AREA, UNIDAD,
  CASE WHEN k % 13 = 6 THEN NULL WHEN k % 13 = 5 THEN CAST('1999-01-01 00:00:00' AS TIMESTAMP) ELSE FECHA_INGRESO END
    AS FECHA_INGRESO,
  CASE WHEN k % 2 = 0 THEN NULL ELSE o_orderdate END AS Fecha_Actualizacion
FROM (SELECT k, id, o_orderdate, {_RECORD}
      FROM (SELECT o_orderkey AS k, {_ID.format(b="b")} AS id, o_custkey, o_orderstatus, o_totalprice, o_orderdate
            FROM (SELECT *, {_BASE} AS b FROM {{orders}}) t) u) v""",
    # The polygon table: upright rectangles over part of the id space, some ids twice, some not staged.
    "target_base": f"""
SELECT k AS oid,
  CASE WHEN k % 43 = 0 THEN NULL WHEN k % 19 = 3 THEN '1980-SIN-PRI-' || CAST(k - k % 2 AS STRING)
       WHEN k % 23 = 4 THEN '  ' || lower(id) ELSE id END AS EXPEDIENTE,
  CASE k % 14 WHEN 0 THEN 'ARCHIVADO' WHEN 1 THEN 'EXTINTO' WHEN 2 THEN 'NO_UBICADO' WHEN 3 THEN NULL
              WHEN 4 THEN ' archivado ' WHEN 5 THEN '' WHEN 6 THEN 'SIN_DATOS' WHEN 7 THEN 'Extinto'
              ELSE 'Vigente' END AS ESTADO,
  CASE WHEN k % 7 = 0 THEN NULL ELSE p_retailprice END AS AREA,
  CASE WHEN k % 53 = 0 THEN NULL ELSE x0 END AS xmin,
  CASE WHEN k % 53 = 0 THEN NULL ELSE y0 END AS ymin,
  CASE WHEN k % 53 = 0 THEN NULL ELSE x0 + w END AS xmax,
  CASE WHEN k % 53 = 0 THEN NULL ELSE y0 + h END AS ymax
FROM (SELECT k, p_retailprice, {_RECTANGLE}, {_ID.format(b="b")} AS id
      FROM (SELECT p_partkey AS k, CASE WHEN p_partkey % 17 = 9 THEN p_partkey - 1 ELSE p_partkey END AS b,
                   p_size, p_retailprice FROM {{part}}) t) u""",
    # L-shaped parcels: a rectangle w x h without its upper right quarter.
    "parcels_l": f"""
SELECT k AS oid, {_ID.format(b="k")} AS EXPEDIENTE,
  CASE k % 5 WHEN 0 THEN 'ARCHIVADO' WHEN 1 THEN NULL ELSE 'Vigente' END AS ESTADO,
  x0, y0, 2 * (3 + w % 10) AS w, 2 * (2 + h % 8) AS h
FROM (SELECT p_partkey AS k, {_RECTANGLE.replace("k *", "p_partkey *").replace("k /", "p_partkey /").replace("k %", "p_partkey %")} FROM {{part}}) t""",
    # Two versions of one sheet.
    "merge_a": """
SELECT CASE WHEN k % 31 = 0 THEN NULL WHEN k % 10 = 1 OR k % 9 = 2 THEN 'A-' || CAST(k AS STRING) ELSE ' C-' || CAST(k AS STRING) END
    AS expediente,
  CASE k % 7 WHEN 0 THEN upper(c_name) WHEN 1 THEN ' ' || c_name || ' ' WHEN 2 THEN 'Nuevo ' || CAST(k AS STRING)
             WHEN 3 THEN NULL ELSE c_name END AS Nombre,
  CASE WHEN k % 4 = 0 THEN lower(c_mktsegment) WHEN k % 4 = 1 THEN 'OTRO' ELSE c_mktsegment END AS segmento,
  CASE WHEN k % 6 = 0 THEN CAST(c_nationkey + 1 AS STRING) ELSE CAST(c_nationkey AS STRING) END AS region,
  'solo A' AS EXTRA_A
FROM (SELECT c_custkey AS k, * FROM {customer}) t""",
    "merge_b": """
SELECT CASE WHEN k % 37 = 0 THEN NULL ELSE 'C-' || CAST(k AS STRING) || ' ' END AS EXPEDIENTE,
  CASE WHEN k % 5 = 0 THEN NULL ELSE c_name END AS NOMBRE, c_mktsegment AS SEGMENTO,
  CAST(c_nationkey AS STRING) AS REGION, 'solo B' AS EXTRA_B
FROM (SELECT c_custkey AS k, * FROM {customer}) t""",
    # Task and mail sheets with text dates in two notations and some junk.
    "tasks": """
SELECT k AS row_seq,
  CASE WHEN k % 50 = 0 THEN 'sin fecha' WHEN k % 2 = 0 THEN strftime_dmy ELSE strftime_iso END AS "Fecha de inicio",
  CASE WHEN user_id % 7 = 0 THEN ' Ana Rojas' WHEN user_id % 7 < 4 THEN 'ana rojas' ELSE 'LUIS VEGA' END AS Usuario,
  CASE WHEN k % 20 = 3 THEN NULL
       WHEN k % 4 = 0 THEN 'Revisión 2024-can-pri-' || CAST(user_id AS STRING) || ' tema ' || CAST(user_id AS STRING)
       ELSE 'Tema ' || CAST(user_id AS STRING) END AS Asunto,
  CAST(event_id AS STRING) AS Consectivo
FROM (SELECT event_id AS k, * , {dmy} AS strftime_dmy, {iso} AS strftime_iso FROM {events}) t
WHERE event_type IN ('view', 'click')""",
    "mail": """
SELECT k AS row_seq,
  CASE WHEN k % 60 = 0 THEN '' WHEN k % 3 = 0 THEN strftime_dmy ELSE strftime_iso END AS "Fecha de envío",
  CASE WHEN k % 20 = 3 THEN NULL ELSE 'Tema ' || CAST(user_id AS STRING) END AS Asunto,
  'p' || CAST(user_id % 9 AS STRING) || '@example.org' AS Destinatarios,
  CASE WHEN user_id % 5 < 2 THEN 'Ana Rojas ' ELSE 'Luis Vega' END AS Remitente
FROM (SELECT event_id AS k, * , {dmy} AS strftime_dmy, {iso} AS strftime_iso FROM {events}) t
WHERE event_type IN ('click', 'purchase')""",
    # Calendar items.
    "meetings": """
SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'Calendario 0' ELSE 'Calendario ' || CAST(user_id % 10 AS STRING) END AS calendar,
  CASE WHEN event_id % 8 = 0 THEN 43 ELSE 26 END AS class,
  CASE WHEN event_id % 5 = 0 THEN 0 ELSE 1 END AS meeting_status,
  CASE WHEN event_id % 100 = 1 THEN CAST('2024-02-01 00:00:00' AS TIMESTAMP)
       WHEN event_id % 100 = 2 THEN CAST('2024-01-01 00:00:00' AS TIMESTAMP) ELSE ts END AS start,
  CAST(floor(value) AS INT) % 240 + 15 AS duration_min,
  CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN 'CANCELLED: comité' WHEN 2 THEN 'cancelled' ELSE 'Comité ' || event_type END
    AS subject,
  'Organiza ' || CAST(user_id % 5 AS STRING) AS organizer,
  user_id % 4 AS invited
FROM {events}""",
    # A file listing from page addresses.
    "files": """
SELECT page_id, {host} AS folder,
  CASE page_id % 6 WHEN 0 THEN 'DGT-O-' || CAST(page_id AS STRING) || '-2024_Reserva  de área_2024-CAN-PRI-' || CAST(page_id AS STRING)
    WHEN 1 THEN 'Nota-' || CAST(page_id AS STRING) || '_Visita' WHEN 2 THEN 'Plano-' || CAST(page_id AS STRING)
    WHEN 3 THEN 'A_ _B__' || CAST(page_id AS STRING) || '_C- _2024-EXP-PRI-9' WHEN 4 THEN '_-_'
    ELSE 'v1.2_final_' || CAST(page_id AS STRING) END ||
  CASE page_id % 8 WHEN 0 THEN '.PDF' WHEN 1 THEN '.docx' WHEN 2 THEN '.xlsx' WHEN 3 THEN '.exe' WHEN 4 THEN '.Msg'
    WHEN 5 THEN '' WHEN 6 THEN '.csv' ELSE '.tmp' END AS name,
  CAST('2024-01-01 08:00:00' AS TIMESTAMP) + (page_id % 75) * INTERVAL '1' DAY AS mtime
FROM {pages}""",
    "docs_text": "SELECT doc_id, text FROM {documents}",
}

# The staged sheet with its areas as typed text: some do not fit the targets' number columns.
VIEWS["stage_text"] = VIEWS["stage_reg"].replace(
    "  o_totalprice AS AREA", "  CASE WHEN k % 7 = 3 THEN 'ca. ' || CAST(k AS STRING) || ' ha' ELSE CAST(o_totalprice AS STRING) END AS AREA"
)

# The few spots where the two dialects have no common spelling.
_SPARK = {
    "dmy": "date_format(ts, 'd/M/yyyy')", "iso": "date_format(ts, 'yyyy-MM-dd')",
    "host": "regexp_extract(url, '^https?://([^/]+)', 1)",
}
_DUCKDB = {
    "dmy": "strftime(ts, '%-d/%-m/%Y')", "iso": "strftime(ts, '%Y-%m-%d')",
    "host": "regexp_extract(url, '^https?://([^/]+)', 1)",
}


def _tables(sql):
    return sorted(set(re.findall(r"\{(\w+)\}", sql)) - set(_SPARK))


def spark_view(spark, sf_dir, name):
    sql = VIEWS[name].replace('"', "`").replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")
    for mark, text in _SPARK.items():
        sql = sql.replace("{" + mark + "}", text)
    return spark.sql(sql, **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _tables(sql)})


def duckdb_view(name):
    sql = VIEWS[name]
    for mark, text in _DUCKDB.items():
        sql = sql.replace("{" + mark + "}", text)
    for t in _tables(sql):
        sql = sql.replace("{" + t + "}", t)
    return sql


def with_views(body, *names, extra=()):
    """``body`` behind the views it reads; ``extra`` are further (name, SQL) pairs."""
    parts = [f"{n} AS ({duckdb_view(n)})" for n in names] + [f"{n} AS ({sql})" for n, sql in extra]
    return f"WITH {', '.join(parts)} {body}"
