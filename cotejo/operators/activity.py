"""Monthly activity: tasks and mail, documents, consolidated sheets."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.errors import RegistryError, require_columns
from cotejo.functions import text as X
from cotejo.functions.dates import as_timestamp, english_month, in_month
from cotejo.functions.predicates import is_document, lacks_name_part, same_user
from cotejo.operators import schema as S
from cotejo.sources.durable import stored

TASK_COLUMNS = ("FECHA", "ASUNTO", "EXPEDIENTE", "CONSECUTIVO")
DOCUMENT_COLUMNS = (
    "FECHA_MODIFICACION", "CARPETA", "ARCHIVO", "CONSECUTIVO", "ASUNTO", "EXPEDIENTE", "EXTENSION", "ANIO", "MES",
    "RUTA_COMPLETA",
)
UNKNOWN_MONTH = "Sin datos"
PIECE = 1_000  # rows of either side of a busy (time, subject) pair that one task takes at a time


# Tasks and mail


def month_tasks(sheet: DataFrame, year: int, month: int, user=None):
    """One task sheet's rows of the month and user, with a FECHA column; None if the sheet has no date."""
    df = S.standard_date(S.clean_headers(sheet))
    if df is None:
        return None
    df = df.withColumn("FECHA", as_timestamp(df, "FECHA")).where(in_month("FECHA", year, month))
    if user is not None and "USUARIO" in df.columns:
        df = df.where(same_user("USUARIO", user, trim=False))
    return df


def task_table(sheets, spark) -> DataFrame:
    """Union of sheets with the four task columns; typed and empty if there are none."""
    seed = spark.createDataFrame([], "FECHA timestamp_ntz, ASUNTO string, EXPEDIENTE string, CONSECUTIVO string")
    for df in sheets:
        if df is not None:
            full = S.with_defaults(df, TASK_COLUMNS).select(*TASK_COLUMNS)
            seed = seed.unionByName(full.withColumns({c: F.col(c).cast("string") for c in TASK_COLUMNS[1:]}))
    return seed


def tasks_with_case_ids(sheet: DataFrame, year: int, month: int, user=None):
    """The simple report's rows: the case id is read from the subject, a misspelt number column is repaired."""
    df = month_tasks(sheet, year, month, user)
    if df is None:
        return None
    df = S.with_defaults(S.repair_aliases(df), ["ASUNTO", "CONSECUTIVO"])
    return df.withColumn("EXPEDIENTE", X.extract_case_id("ASUNTO")).select(*TASK_COLUMNS)


def month_mail(sheet: DataFrame, year: int, month: int) -> DataFrame:
    df = S.clean_headers(sheet)
    require_columns(df.columns, ["FECHA_DE_ENVIO"], "mail sheet")
    df = df.withColumn("FECHA", as_timestamp(df, "FECHA_DE_ENVIO")).where(in_month("FECHA", year, month))
    return S.with_defaults(df, ["ASUNTO", "DESTINATARIOS"]).select("FECHA", "ASUNTO", "DESTINATARIOS")


def _same_pair(null_subjects_match):
    subject = F.col("ASUNTO").eqNullSafe(F.col("_a")) if null_subjects_match else F.col("ASUNTO") == F.col("_a")
    return (F.col("FECHA") == F.col("_f")) & subject


def _heavy_pairs(tasks, mail, null_subjects_match, piece) -> DataFrame:
    """_hf, _ha (time, subject), _parts_t, _parts_m of the pairs that would give more than ``piece`` squared rows."""
    def counted(df, n):
        known = F.col("FECHA").isNotNull() if null_subjects_match else F.col("FECHA").isNotNull() & F.col("ASUNTO").isNotNull()
        return df.where(known).groupBy(F.col("FECHA").alias(f"_f{n}"), F.col("ASUNTO").alias(f"_a{n}")).agg(F.count("*").alias(f"_n{n}"))

    both = counted(tasks, 1).join(counted(mail, 2), (F.col("_f1") == F.col("_f2")) & F.col("_a1").eqNullSafe(F.col("_a2")))
    parts = [F.ceil(F.col(n) / piece).cast("int").alias(p) for n, p in (("_n1", "_parts_t"), ("_n2", "_parts_m"))]
    return both.where(F.col("_n1") * F.col("_n2") > piece * piece).select(F.col("_f1").alias("_hf"), F.col("_a1").alias("_ha"), *parts)


def _is_heavy():
    """The hash keeps a busy pair splittable in joins to the heavy ones."""
    same = (F.col("FECHA") == F.col("_hf")) & F.col("ASUNTO").eqNullSafe(F.col("_ha"))
    return same & (F.xxhash64("FECHA", "ASUNTO") == F.xxhash64("_hf", "_ha"))


def _heavy_matches(tasks, mail, heavy):
    """Every task of a heavy pair with every mail of it, dealt to a grid: parts of the tasks by parts of the mails."""
    def part(df, columns, own, other):
        rows = df.join(heavy, _is_heavy()).select(*columns, "_hf", "_ha", "_parts_t", "_parts_m", F.monotonically_increasing_id().alias("_n"))
        rows = stored(rows)  # a row keeps its number, and so its part, whatever is computed again
        across = F.explode(F.sequence(F.lit(0), F.col(other[0]) - 1))
        return rows.select(*columns, "_hf", "_ha", (F.col("_n") % F.col(own[0])).cast("int").alias(own[1]), across.alias(other[1]))

    t, m = ("_parts_t", "_i"), ("_parts_m", "_j")
    left = part(tasks, TASK_COLUMNS, t, m)
    right = part(mail, ("DESTINATARIOS",), m, t).withColumnsRenamed({c: f"{c}2" for c in ("_hf", "_ha", "_i", "_j")})
    same = F.col("_ha").eqNullSafe(F.col("_ha2"))
    for c in ("_hf", "_i", "_j"):
        same = same & (F.col(c) == F.col(f"{c}2"))
    return left.join(right, same).select(*TASK_COLUMNS, "DESTINATARIOS")


def tasks_with_mail(tasks: DataFrame, mail: DataFrame, null_subjects_match=False, piece=PIECE) -> DataFrame:
    """Tasks next to the mail of the same time and subject, then the mail that belongs to no task.

    A task with several mails appears once per mail. Null subjects are no match, as they would pair every task of a
    time with every mail of it; ``null_subjects_match`` asks for just that. Null times never match. Pairs are counted first;
    one that gives more than ``piece`` squared rows is dealt to many tasks.
    """
    tasks = tasks.select(*TASK_COLUMNS)
    heavy = stored(_heavy_pairs(tasks, mail, null_subjects_match, piece))
    few_tasks, few_mail, matches = tasks, mail, []
    if not heavy.isEmpty():
        few_tasks, few_mail = (df.join(heavy, _is_heavy(), "left_anti") for df in (tasks, mail))
        matches = [_heavy_matches(tasks, mail, heavy)]
    m = few_mail.select(F.col("FECHA").alias("_f"), F.col("ASUNTO").alias("_a"), "DESTINATARIOS")
    related = few_tasks.join(m, _same_pair(null_subjects_match), "left").drop("_f", "_a")
    alone = mail_without_task(tasks, mail, null_subjects_match).select(
        "FECHA", "ASUNTO", F.lit("").alias("EXPEDIENTE"), F.lit("").alias("CONSECUTIVO"), "DESTINATARIOS"
    )
    return reduce(DataFrame.unionByName, [related, *matches, alone])


def mail_without_task(tasks: DataFrame, mail: DataFrame, null_subjects_match=False) -> DataFrame:
    """The distinct pairs are combined per task before they travel; their hash keeps a busy pair splittable."""
    pair = F.xxhash64("FECHA", "ASUNTO")
    known = tasks.select("FECHA", "ASUNTO").distinct().select(
        F.col("FECHA").alias("_f"), F.col("ASUNTO").alias("_a"), pair.alias("_h")
    )
    same = _same_pair(null_subjects_match) & (F.col("_mh") == F.col("_h"))
    return mail.withColumn("_mh", pair).join(known, same, "left_anti").drop("_mh")


def tasks_without_mail_sheet(tasks: DataFrame) -> DataFrame:
    """Without a mail sheet the recipients are blank text, not null."""
    return tasks.select(*TASK_COLUMNS, F.lit("").alias("DESTINATARIOS"))


def task_report(tasks: DataFrame, mail: DataFrame, null_subjects_match=False) -> DataFrame:
    """Tasks and mail by date; whether the mail sheet is empty is found out inside the plan.

    Both are read several times, for the counts of busy pairs and for the joins, and are stored first.
    """
    tasks, mail = stored(tasks.select(*TASK_COLUMNS)), stored(mail.select("FECHA", "ASUNTO", "DESTINATARIOS"))
    empty = mail.limit(1).agg(F.count("*") == 0).scalar()
    joined = tasks_with_mail(tasks, mail, null_subjects_match)
    return by_date(joined.withColumn("DESTINATARIOS", F.when(empty, F.lit("")).otherwise(F.col("DESTINATARIOS"))))


def by_date(df: DataFrame, date="FECHA") -> DataFrame:
    """By date, rows without one last. The other columns break ties, so that a busy day is split between tasks."""
    return df.orderBy(F.col(date).asc_nulls_last(), *[c for c in df.columns if c != date])


def report_name(user: str, year: int, month: int) -> str:
    """Base name of a task report."""
    from datetime import date

    return f"Reporte Teletrabajo_{date(year, month, 1).strftime('%B').upper()}-{year}_{user}"


# Documents


def month_documents(files: DataFrame, base: str, year: int, month: int) -> DataFrame:
    """Documents changed in the month, from a listing with ``path`` and ``modificationTime``."""
    changed = F.col("modificationTime").cast("timestamp_ntz")
    name = F.regexp_extract("path", r"(?s)([^/]*)$", 1)
    df = files.withColumn("FECHA_MODIFICACION", changed).where(in_month("FECHA_MODIFICACION", year, month))
    df = df.withColumn("ARCHIVO", name).withColumn("EXTENSION", X.file_suffix("ARCHIVO"))
    number, subject, case_id = X.split_file_name("ARCHIVO")
    return df.where(is_document("EXTENSION")).select(
        "FECHA_MODIFICACION", X.relative_folder("path", base).alias("CARPETA"), "ARCHIVO",
        number.alias("CONSECUTIVO"), subject.alias("ASUNTO"), case_id.alias("EXPEDIENTE"), "EXTENSION",
        F.year("FECHA_MODIFICACION").alias("ANIO"), F.month("FECHA_MODIFICACION").alias("MES"),
        F.col("path").alias("RUTA_COMPLETA"),
    )


def documents_in_order(docs: DataFrame) -> DataFrame:
    return docs.orderBy("FECHA_MODIFICACION", "CARPETA", "ARCHIVO")


def folder_counts(docs: DataFrame) -> DataFrame:
    """Documents per folder, null folder included, largest first."""
    counts = docs.groupBy("CARPETA").agg(F.count("*").alias("CANTIDAD_DOCUMENTOS"))
    return counts.orderBy(F.desc("CANTIDAD_DOCUMENTOS"), F.asc("CARPETA"))


def names_to_review(docs: DataFrame) -> DataFrame:
    return docs.where(lacks_name_part())


# Consolidated sheets


def consolidate(sheets, user: str, drop=("CONSECUTIVO",), trim_user=True) -> DataFrame:
    """Union by column name, empty rows out, one user's rows, unwanted columns dropped, dates parsed."""
    if not sheets:
        raise RegistryError("no sheets to consolidate")
    df = sheets[0]
    for other in sheets[1:]:
        df = df.unionByName(other, allowMissingColumns=True)
    data = [c for c in df.columns if not c.startswith("_") and c.lower() != "row_seq"]  # not what the reader adds
    df = S.upper_headers(df.dropna("all", subset=data) if data else df)
    require_columns(df.columns, ["USUARIO"], "consolidated sheet")
    df = df.where(same_user("USUARIO", user, trim=trim_user)).drop(*drop)
    if "FECHA" in df.columns:
        df = df.withColumn("FECHA", as_timestamp(df, "FECHA"))
    return df


def most_frequent_month(df: DataFrame, date="FECHA") -> DataFrame:
    """The month with most rows, the earliest on a tie; no rows without a valid date."""
    counts = df.where(F.col(date).isNotNull()).groupBy(F.month(date).alias("MES")).agg(F.count("*").alias("CANTIDAD"))
    return counts.orderBy(F.desc("CANTIDAD"), F.asc("MES")).limit(1).select("MES")


def first_month(df: DataFrame, date="FECHA", order="row_seq") -> DataFrame:
    """The month of the first row, in input order, that has a valid date."""
    return df.agg(F.min_by(F.month(date), F.when(F.col(date).isNotNull(), F.col(order))).alias("MES"))


def title_from_month(month: DataFrame, subject: str, year: int, missing=UNKNOWN_MONTH) -> DataFrame:
    """One-row title from a one-row MES frame; ``missing`` names a month that could not be found."""
    named = F.coalesce(
        english_month(F.make_date(F.lit(1900), F.max("MES"), F.lit(1)), style="title"), F.lit(missing)
    )
    return month.agg(X.report_title(subject, named, F.lit(year)).alias("TITULO"))
