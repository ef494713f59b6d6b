"""Monthly activity reports: from reading the sources to the written sheets."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotejo.errors import RegistryError
from cotejo.functions.dates import month_bounds
from cotejo.functions.text import month_label, report_title
from cotejo.operators import activity as A
from cotejo.operators import meetings as M
from cotejo.sources.durable import stored
from cotejo.sources.files import list_files
from cotejo.sources.publish import Publication
from cotejo.sources.reports import write_report, write_table
from cotejo.sources.sheets import read_folder, read_sheet

# Names that mark a report's own outputs, left out when a folder is read (fixed values).
OWN_TASK_REPORT = "reporte teletrabajo"
OWN_CONSOLIDATION = "informe_teletrabajo"


def task_report(spark: SparkSession, folder, year, month, user, out_dir, mail_path=None, fmt="csv", overwrite=True):
    """Tasks of a folder next to the mail sheet. Without one, case ids are read from the subjects.

    Returns (report, rejected files).
    """
    sheets, rejects = read_folder(spark, folder, fmt, skip_containing=[OWN_TASK_REPORT])
    if mail_path is None:
        report = A.by_date(A.task_table([A.tasks_with_case_ids(s, year, month, user) for s in sheets], spark))
    else:
        tasks = A.task_table([A.month_tasks(s, year, month, user) for s in sheets], spark)
        report = A.task_report(tasks, A.month_mail(read_sheet(spark, mail_path, fmt), year, month))
    write_table(report, f"{out_dir.rstrip('/')}/{A.report_name(user, year, month)}", fmt, overwrite)
    return report, rejects


def document_report(spark: SparkSession, base, year, month, out_dir, subject="Informe de Teletrabajo", fmt="parquet", files=None):
    """Documents changed in the month: REPORTE, RESUMEN_CARPETA, REVISAR_NOMBRES and their title."""
    month_bounds(year, month)
    listing = list_files(spark, base) if files is None else files
    docs = stored(A.month_documents(listing, base, year, month))
    if docs.isEmpty():
        raise RegistryError(f"no documents for {year}-{month:02d}")
    label = month_label(F.lit(month))
    sheets = {
        "TITULO": spark.range(1).select(report_title(subject, F.concat(F.lit("- "), label), F.lit(year)).alias("TITULO")),
        "REPORTE": A.documents_in_order(docs),
        "RESUMEN_CARPETA": A.folder_counts(docs),
        "REVISAR_NOMBRES": A.names_to_review(docs),
    }
    return write_report(sheets, f"{out_dir.rstrip('/')}/Informe_Documentos_{year}_{month:02d}", fmt, overwrite=True)


def consolidation_report(spark, folder, user, year, out_dir, subject, first_month=True, drop=("CONSECUTIVO",), fmt="csv"):
    """One user's rows of every sheet in a folder by date, under a title with the month they belong to."""
    sheets, rejects = read_folder(spark, folder, fmt, skip_prefix=[OWN_CONSOLIDATION])
    if not sheets:
        raise RegistryError(f"no sheets in {folder}")

    def order(sheet):
        """Input order is file order, then the position in the file."""
        place = F.col("_source_row") if "_source_row" in sheet.columns else F.monotonically_increasing_id()
        return F.struct(F.col("_source_file"), place.alias("n"))

    rows = stored(A.consolidate([s.withColumn("_order", order(s)) for s in sheets], user, drop))
    data = rows.drop("_ORDER", "_SOURCE_FILE", "_SOURCE_ROW")
    out = {"DATOS": A.by_date(data) if "FECHA" in rows.columns else data}
    if "FECHA" in rows.columns:
        month = A.first_month(rows, order="_ORDER") if first_month else A.most_frequent_month(rows)
        out["TITULO"] = A.title_from_month(month, subject, year, A.UNKNOWN_MONTH if first_month else "")
    return write_report(out, f"{out_dir.rstrip('/')}/Consolidado_{year}", fmt, overwrite=True), rejects


def meeting_report(meetings: DataFrame, year, month, out_dir, fmt="parquet"):
    """Detalle and Resumen of the month's meetings."""
    report = Publication(meetings.sparkSession, f"{out_dir.rstrip('/')}/Reporte_Reuniones_{year}_{month:02d}", replace=True)
    detail = report.write("Detalle", M.held_meetings(meetings, year, month), fmt)
    if not report.rows("Detalle"):
        raise RegistryError(f"no meetings in {year}-{month:02d}")
    summary = report.write("Resumen", M.meeting_totals(detail), fmt)
    report.commit()
    return {"Detalle": detail, "Resumen": summary}
