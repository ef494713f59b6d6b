"""Monthly activity, meeting, document and text queries."""

from pyspark.sql import functions as F

from cotejo.functions import dates as D
from cotejo.functions import text as X
from cotejo.operators import activity as A
from cotejo.operators import meetings as M
from queryset.catalog import ascii_sql, blank_sql, fold_sql, query, squeeze_sql, strip_sql, text_sql
from queryset.views import spark_view, with_views

YEAR, MONTH, USER = 2024, 1, "Ana Rojas"


def _view(name):
    return lambda spark, sf_dir: spark_view(spark, sf_dir, name)


_tasks, _mail, _meetings, _docs = (_view(v) for v in ("tasks", "mail", "meetings", "docs_text"))


def _date_sql(x):
    return f"coalesce(try_strptime({x}, '%d/%m/%Y'), try_strptime({x}, '%Y-%m-%d'))"


def _in_month(x, year=YEAR, month=MONTH):
    return f"{x} >= TIMESTAMP '{year}-{month:02d}-01' AND {x} < TIMESTAMP '{year}-{month + 1:02d}-01'"


# Tasks and mail

_DATED_TASKS = ("dated", f'SELECT *, {_date_sql(chr(34) + "Fecha de inicio" + chr(34))} AS FECHA FROM tasks')
_MONTH_TASKS = (
    "month_tasks",
    f"SELECT * FROM dated WHERE {_in_month('FECHA')} AND upper(Usuario) = 'ANA ROJAS'",
)
_TASK_TABLE = ("t", "SELECT FECHA, Asunto AS ASUNTO, '' AS EXPEDIENTE, '' AS CONSECUTIVO FROM month_tasks")
_MONTH_MAIL = (
    "m",
    f'SELECT FECHA, Asunto AS ASUNTO, Destinatarios AS DESTINATARIOS FROM (SELECT *, {_date_sql(chr(34) + "Fecha de envío" + chr(34))} AS FECHA FROM mail) '
    f"WHERE {_in_month('FECHA')}",
)
_SAME = "m.FECHA = t.FECHA AND m.ASUNTO = t.ASUNTO"
_ALONE = f"SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM t WHERE {_SAME})"
_TASK_STEPS = (_DATED_TASKS, _MONTH_TASKS, _TASK_TABLE)


def _task_table(spark, sf_dir):
    return A.task_table([A.month_tasks(_tasks(spark, sf_dir), YEAR, MONTH, USER)], spark)


def _month_mail(spark, sf_dir):
    return A.month_mail(_mail(spark, sf_dir), YEAR, MONTH)


@query(
    with_views(
        "SELECT row_seq AS ROW_SEQ, FECHA, Usuario AS USUARIO, Asunto AS ASUNTO, Consectivo AS CONSECTIVO FROM month_tasks",
        "tasks", extra=(_DATED_TASKS, _MONTH_TASKS),
    )
)
def month_tasks(spark, sf_dir):
    return A.month_tasks(_tasks(spark, sf_dir), YEAR, MONTH, USER)


@query(
    with_views(
        "SELECT FECHA, Asunto AS ASUNTO, coalesce(regexp_extract(upper(Asunto), '[0-9]{4}-[A-Z]+-[A-Z]+-[0-9]+'), '') AS EXPEDIENTE, "
        "Consectivo AS CONSECUTIVO FROM month_tasks",
        "tasks", extra=(_DATED_TASKS, _MONTH_TASKS),
    )
)
def simple_task_report(spark, sf_dir):
    return A.by_date(A.task_table([A.tasks_with_case_ids(_tasks(spark, sf_dir), YEAR, MONTH, USER)], spark))


@query(
    with_views(
        f"SELECT t.*, m.DESTINATARIOS FROM t LEFT JOIN m ON {_SAME} "
        f"UNION ALL SELECT FECHA, ASUNTO, '', '', DESTINATARIOS FROM ({_ALONE})",
        "tasks", "mail", extra=(*_TASK_STEPS, _MONTH_MAIL),
    )
)
def task_mail_report(spark, sf_dir):
    return A.task_report(_task_table(spark, sf_dir), _month_mail(spark, sf_dir))


@query(with_views(_ALONE, "tasks", "mail", extra=(*_TASK_STEPS, _MONTH_MAIL)))
def mail_without_task(spark, sf_dir):
    return A.mail_without_task(_task_table(spark, sf_dir), _month_mail(spark, sf_dir))


@query(with_views("SELECT *, '' AS DESTINATARIOS FROM t", "tasks", extra=_TASK_STEPS))
def task_report_without_mail(spark, sf_dir):
    return A.tasks_without_mail_sheet(_task_table(spark, sf_dir))


@query(with_views("SELECT row_seq, FECHA FROM dated", "tasks", extra=(_DATED_TASKS,)))
def parsed_dates(spark, sf_dir):
    return _tasks(spark, sf_dir).select("row_seq", D.parse_lenient("Fecha de inicio").alias("FECHA"))


# Consolidated sheets

_CONSOLIDATED = (
    "cons",
    f"SELECT row_seq AS ROW_SEQ, {_date_sql('d')} AS FECHA, u AS USUARIO, ASUNTO, DESTINATARIOS FROM ("
    'SELECT row_seq, "Fecha de inicio" AS d, Usuario AS u, Asunto AS ASUNTO, NULL AS DESTINATARIOS FROM tasks '
    'UNION ALL SELECT row_seq, "Fecha de envío", Remitente, Asunto, Destinatarios FROM mail) '
    f"WHERE upper({strip_sql('u')}) = 'ANA ROJAS'",
)


def _consolidated(spark, sf_dir):
    tasks = _tasks(spark, sf_dir).withColumnsRenamed({"Fecha de inicio": "Fecha", "Consectivo": "Consecutivo"})
    mail = _mail(spark, sf_dir).withColumnsRenamed({"Fecha de envío": "Fecha", "Remitente": "Usuario"})
    return A.consolidate([tasks, mail], USER)


@query(with_views("SELECT * FROM cons", "tasks", "mail", extra=(_CONSOLIDATED,)))
def consolidated_sheets(spark, sf_dir):
    return A.by_date(_consolidated(spark, sf_dir))


@query(
    with_views(
        "SELECT month(FECHA_INGRESO) AS MES FROM stage_reg GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1", "stage_reg"
    )
)
def most_frequent_month(spark, sf_dir):
    return A.most_frequent_month(spark_view(spark, sf_dir, "stage_reg"), "FECHA_INGRESO")


@query(with_views("SELECT arg_min(month(FECHA), row_seq) FILTER (FECHA IS NOT NULL) AS MES FROM dated", "tasks", extra=(_DATED_TASKS,)))
def first_valid_month(spark, sf_dir):
    tasks = _tasks(spark, sf_dir).select("row_seq", D.parse_lenient("Fecha de inicio").alias("FECHA"))
    return A.first_month(tasks)


@query(
    with_views(
        "SELECT 'Informe del mes ' || strftime(make_date(1900, CAST(MES AS INT), 1), '%B') || ' 2024' AS TITULO FROM "
        "(SELECT month(FECHA_INGRESO) AS MES FROM stage_reg GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)",
        "stage_reg",
    )
)
def consolidated_title(spark, sf_dir):
    month = A.most_frequent_month(spark_view(spark, sf_dir, "stage_reg"), "FECHA_INGRESO")
    return A.title_from_month(month, "Informe del mes", YEAR)


_MONTHS = "['ENERO','FEBRERO','MARZO','ABRIL','MAYO','JUNIO','JULIO','AGOSTO','SETIEMBRE','OCTUBRE','NOVIEMBRE','DICIEMBRE']"


@query(
    f"SELECT 'Informe de ' || {_MONTHS}[month(o_orderdate)] || ' ' || year(o_orderdate) AS TITULO, "
    "upper(strftime(o_orderdate, '%B')) AS MES_INGLES, count(*) AS CANTIDAD FROM orders GROUP BY 1, 2"
)
def rows_per_month_title(spark, sf_dir):
    d = F.col("o_orderdate")
    title = X.report_title("Informe de", X.month_label(F.month(d)), F.year(d))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.groupBy(title.alias("TITULO"), D.english_month(d).alias("MES_INGLES")).agg(F.count("*").alias("CANTIDAD"))


# Documents

BASE = "/datos"


def _tidy_sql(x):
    return f"trim(regexp_replace({squeeze_sql(strip_sql(x))}, '_+', '_', 'g'), ' _-')"


_FILE_ROWS = (
    "file_rows",
    f"""SELECT mtime AS FECHA_MODIFICACION, folder AS CARPETA, name AS ARCHIVO, lower(regexp_extract(name, '^.+(\\.[^.]+)$', 1)) AS EXTENSION,
  list_filter(list_transform(string_split(regexp_replace(name, '^(.+)\\.[^.]+$', '\\1'), '_'), lambda x: {_tidy_sql('x')}), lambda x: x <> '') AS parts,
  '{BASE}/' || folder || '/' || name AS RUTA_COMPLETA FROM files""",
)
_DOCUMENTS = (
    "docs",
    f"""SELECT FECHA_MODIFICACION, CARPETA, ARCHIVO, CASE WHEN len(parts) >= 1 THEN parts[1] ELSE '' END AS CONSECUTIVO,
  CASE WHEN len(parts) >= 3 THEN array_to_string(parts[2:len(parts) - 1], ' - ') WHEN len(parts) = 2 THEN parts[2] ELSE '' END AS ASUNTO,
  CASE WHEN len(parts) >= 3 THEN parts[len(parts)] ELSE '' END AS EXPEDIENTE, EXTENSION,
  year(FECHA_MODIFICACION) AS ANIO, month(FECHA_MODIFICACION) AS MES, RUTA_COMPLETA
FROM file_rows WHERE {_in_month('FECHA_MODIFICACION', 2024, 2)}
  AND EXTENSION IN ('.pdf', '.doc', '.docx', '.xls', '.xlsx', '.ppt', '.pptx', '.txt', '.csv', '.msg')""",
)
_DOC_STEPS = (_FILE_ROWS, _DOCUMENTS)


def _documents(spark, sf_dir):
    listing = spark_view(spark, sf_dir, "files").select(
        F.concat(F.lit(BASE + "/"), "folder", F.lit("/"), "name").alias("path"), F.col("mtime").alias("modificationTime")
    )
    return A.month_documents(listing, BASE, 2024, 2)


@query(with_views("SELECT * FROM docs", "files", extra=_DOC_STEPS))
def month_documents(spark, sf_dir):
    return A.documents_in_order(_documents(spark, sf_dir))


@query(with_views("SELECT CARPETA, count(*) AS CANTIDAD_DOCUMENTOS FROM docs GROUP BY 1", "files", extra=_DOC_STEPS))
def document_folder_counts(spark, sf_dir):
    return A.folder_counts(_documents(spark, sf_dir))


@query(
    with_views(
        f"SELECT * FROM docs WHERE {blank_sql('CONSECUTIVO')} OR {blank_sql('ASUNTO')} OR {blank_sql('EXPEDIENTE')}",
        "files", extra=_DOC_STEPS,
    )
)
def document_names_to_review(spark, sf_dir):
    return A.names_to_review(_documents(spark, sf_dir))


# Meetings

_HELD = (
    "held",
    "SELECT CAST(start AS DATE) AS FECHA, strftime(start, '%H:%M:%S') AS HORA_INICIO, "
    "strftime(start + to_minutes(duration_min), '%H:%M:%S') AS HORA_FIN, round(duration_min / 60, 2) AS DURACION_HORAS, "
    "subject AS ASUNTO, organizer AS ORGANIZADOR, "
    "array_to_string(list_transform(range(1, invited + 1), lambda i: 'Persona ' || i), ', ') AS PARTICIPANTES FROM meetings "
    f"WHERE {_in_month('start')} AND class = 26 AND meeting_status <> 0 AND invited > 0 "
    "AND subject IS NOT NULL AND NOT starts_with(lower(subject), 'cancelled')",
)
_RANGE = "class = 26 AND start >= TIMESTAMP '2024-01-10' AND start < TIMESTAMP '2024-01-20'"
_FIRST, _UNTIL = "2024-01-10", "2024-01-20"


def _calendar_items(spark, sf_dir):
    people = F.when(F.col("invited") > 0, F.transform(F.sequence(F.lit(1), F.col("invited").cast("int")), lambda i: F.concat(F.lit("Persona "), i.cast("string"))))
    return _meetings(spark, sf_dir).select(
        "*", F.expr("start + make_dt_interval(0, 0, duration_min)").alias("end"),
        F.coalesce(people, F.array().cast("array<string>")).alias("recipients"),
    )


@query(with_views("SELECT * FROM held", "meetings", extra=(_HELD,)))
def held_meetings(spark, sf_dir):
    return M.held_meetings(_calendar_items(spark, sf_dir), YEAR, MONTH)


@query(
    with_views(
        "SELECT count(*) AS TOTAL_REUNIONES, CAST(sum(CAST(DURACION_HORAS AS DECIMAL(18,2))) AS DOUBLE) AS TOTAL_HORAS FROM held",
        "meetings", extra=(_HELD,),
    )
)
def meeting_totals(spark, sf_dir):
    return M.meeting_totals(M.held_meetings(_calendar_items(spark, sf_dir), YEAR, MONTH))


@query(
    with_views(
        f"SELECT calendar, n, event_id, start, subject, organizer FROM (SELECT *, row_number() OVER (PARTITION BY calendar ORDER BY start, event_id) AS n "
        f"FROM meetings WHERE {_RANGE}) WHERE n <= 20",
        "meetings",
    )
)
def first_events_per_calendar(spark, sf_dir):
    events = M.first_events(_meetings(spark, sf_dir), _FIRST, _UNTIL)
    return events.select("calendar", "n", "event_id", "start", "subject", "organizer")


@query(
    with_views(
        "SELECT c.calendar, count(m.event_id) AS TOTAL_ELEMENTOS, "
        f"count(*) FILTER ({_RANGE}) AS EN_RANGO, count(*) FILTER ({_RANGE}) = 0 AS SIN_EVENTOS "
        "FROM (SELECT DISTINCT 'Calendario ' || CAST(user_id % 12 AS STRING) AS calendar FROM events) c "
        "LEFT JOIN meetings m ON m.calendar = c.calendar GROUP BY 1",
        "meetings",
    )
)
def calendar_inventory(spark, sf_dir):
    number = (F.col("user_id") % 12).cast("string")
    calendars = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.concat(F.lit("Calendario "), number).alias("calendar")
    ).distinct()
    return M.calendar_inventory(calendars, _meetings(spark, sf_dir), _FIRST, _UNTIL)


# Whole texts


def _digest(c):
    return F.md5(c.cast("binary"))


def _text_query(rule, sql):
    return f"SELECT doc_id, md5({sql}) AS huella, length({sql}) AS largo FROM documents", lambda spark, sf_dir: _docs(spark, sf_dir).withColumn(
        "_t", rule("text")
    ).select("doc_id", _digest(F.col("_t")).alias("huella"), F.length("_t").alias("largo"))


def _register_text(name, rule, sql):
    oracle, fn = _text_query(rule, sql)
    fn.__name__ = name
    query(oracle)(fn)


_register_text("documents_as_keys", X.fold_key, fold_sql("text"))
_register_text("documents_as_ascii", X.fold_ascii, ascii_sql("text"))
_register_text("documents_without_accents", X.drop_accents, "strip_accents(text)")
_register_text("documents_trimmed_upper", X.trim_upper, f"upper(replace({strip_sql(text_sql('text'))}, 'ß', 'SS'))")
_register_text("documents_tidied", X.tidy, _tidy_sql(text_sql("text")))


@query(
    "SELECT doc_id, coalesce(regexp_extract(upper(text), '[0-9]{4}-[A-Z]+-[A-Z]+-[0-9]+'), '') AS EXPEDIENTE FROM documents"
)
def case_ids_in_documents(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", X.extract_case_id("text").alias("EXPEDIENTE"))


@query(with_views("SELECT oid, CASE WHEN " + blank_sql("ESTADO") + " THEN 'SIN_ESTADO' ELSE ESTADO END AS ESTADO FROM target_base", "target_base"))
def status_labels(spark, sf_dir):
    return spark_view(spark, sf_dir, "target_base").select("oid", X.status_label("ESTADO").alias("ESTADO"))
