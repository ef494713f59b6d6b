"""Row tests. The status policies differ on purpose (null dropped, kept or relabelled): do not merge them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from cotejo.functions.text import _col, is_blank, strip, trim_upper

# Statuses left out of exports and overlap checks (fixed values).
EXPORT_EXCLUDED = ("NO_UBICADO", "ARCHIVADO")
OVERLAP_EXCLUDED = ("ARCHIVADO", "EXTINTO")
OVERLAP_EXCLUDED_LOCATED = ("ARCHIVADO", "EXTINTO", "NO_UBICADO")

# File types that count as office documents (fixed values).
DOCUMENT_SUFFIXES = (".pdf", ".doc", ".docx", ".xls", ".xlsx", ".ppt", ".pptx", ".txt", ".csv", ".msg")


def status_exportable_strict(c) -> Column:
    """SQL NOT IN: exact case, null is dropped."""
    return ~_col(c).isin(*EXPORT_EXCLUDED)


def status_exportable_lenient(c) -> Column:
    """Any case; null is kept."""
    c = _col(c)
    return c.isNull() | ~F.upper(c).isin(*EXPORT_EXCLUDED)


def status_overlap_untrimmed(c) -> Column:
    """Upper case but not trimmed; null and blank are kept."""
    return is_blank(c) | ~F.upper(_col(c)).isin(*OVERLAP_EXCLUDED)


def status_overlap_trimmed(c) -> Column:
    """Trimmed upper case, parcels that were never located are skipped too."""
    return ~trim_upper(c).isin(*OVERLAP_EXCLUDED_LOCATED)


def status_overlap_exact(c) -> Column:
    """Exact values; null is kept."""
    c = _col(c)
    return c.isNull() | ~c.isin(*OVERLAP_EXCLUDED)


def same_user(c, user: str, trim=True) -> Column:
    c = _col(c).cast("string")
    return F.upper(strip(c) if trim else c) == F.upper(F.lit(user))


def is_document(suffix) -> Column:
    return F.lower(_col(suffix)).isin(*DOCUMENT_SUFFIXES)


def lacks_name_part(number="CONSECUTIVO", subject="ASUNTO", case_id="EXPEDIENTE") -> Column:
    return is_blank(number) | is_blank(subject) | is_blank(case_id)


def is_held_meeting() -> Column:
    """An appointment that is a meeting, has someone invited and is not called off; no subject, no meeting."""
    return (
        (F.col("class") == 26)
        & (F.col("meeting_status") != 0)
        & (F.size("recipients") > 0)
        & F.coalesce(~F.startswith(F.lower("subject"), F.lit("cancelled")), F.lit(False))
    )


def new_id_problem(c) -> Column:
    """Why a candidate id is not acceptable; null if it is."""
    c = _col(c)
    return (
        F.when(c.isNull() | (c == ""), "OBLIGATORIO")
        .when(F.contains(c, F.lit(" ")), "CONTIENE_ESPACIOS")
        .when(c != F.upper(c), "NO_MAYUSCULAS")
    )
