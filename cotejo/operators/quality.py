"""Checks of the staged rows and the shape of log and problem tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.functions.text import is_blank
from cotejo.operators.schema import CASE, KEY, case_column

PROBLEM_COLUMNS = ("EXPEDIENTE", "EXPEDIENTE_KEY", "TIPO_PROBLEMA", "DETALLE")
LOG_COLUMNS = ("TIMESTAMP", "ACCION", "TABLA", "EXPEDIENTE_KEY", "DETALLE")


def repeated_keys(stage: DataFrame) -> DataFrame:
    """Keys staged more than once with their count, in no order; blank keys do not count."""
    return stage.where(F.col(KEY) != "").groupBy(KEY).agg(F.count("*").alias("CANTIDAD")).where("CANTIDAD > 1")


def duplicate_keys(stage: DataFrame) -> DataFrame:
    """The repeated keys, most frequent first."""
    return repeated_keys(stage).orderBy(F.desc("CANTIDAD"), F.asc(KEY))


def blank_status(stage: DataFrame, status) -> DataFrame:
    """Staged rows whose status is null or blank; no rows if there is no status column."""
    case = case_column(stage, "stage")
    found = F.lit(False) if status is None else is_blank(status)
    shown = F.lit(None).cast("string") if status is None else F.col(status)
    return stage.where(found).select(F.col(case).alias(CASE), F.col(KEY), shown.alias("ESTADO"))


def blank_keys(stage: DataFrame) -> DataFrame:
    """Staged rows without a usable key."""
    return stage.where(F.col(KEY) == "")


def union_all(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _problem_cells(case, key, kind, detail):
    values = (case.cast("string"), key.cast("string"), F.lit(kind), detail)
    return [v.alias(n) for v, n in zip(values, PROBLEM_COLUMNS)]


def problem(case, key, kind: str, detail):
    """One problem row as a struct, for lists that are ``inline``d."""
    return F.struct(*_problem_cells(case, key, kind, detail))


def problems(df: DataFrame, case, key, kind: str, detail) -> DataFrame:
    """Rows of ``df`` as problem rows."""
    return df.select(*_problem_cells(case, key, kind, detail))


def log_rows(df: DataFrame, run_text: str, action, table: str, key, detail) -> DataFrame:
    """Rows of ``df`` as action log rows; one run time for the whole run."""
    values = (F.lit(run_text), action, F.lit(table), F.coalesce(key.cast("string"), F.lit("")), detail)
    return df.select(*[v.alias(n) for v, n in zip(values, LOG_COLUMNS)])
