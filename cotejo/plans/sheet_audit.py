"""Preparing a sheet by hand rules: normalise, keep the fullest row per id, fill blank statuses, report."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.functions.text import fold_key, is_blank
from cotejo.operators import reconcile as R
from cotejo.operators import schema as S
from cotejo.sources.reports import run_folder, write_report

# Text columns brought to upper case without accents (fixed values).
NORMALISED = ("CONCESIONA", "PROYECTO", "PROVINCIA", "CANTON", "DISTRITO")


def prepare_sheet(sheet: DataFrame, columns=NORMALISED, keys=("EXPEDIENTE", "ESTADO")) -> DataFrame:
    """Named text columns folded, key columns as text, the status next to the id."""
    df = S.clean_text_columns(sheet, fold_key, columns)
    return S.place_after(S.keys_as_text(df, keys), "ESTADO", "EXPEDIENTE")


def audit_summary(sheet: DataFrame) -> DataFrame:
    """Rows before and after, duplicates removed and statuses filled, in one row."""
    kept = R.keep_most_complete(prepare_sheet(sheet))
    after = kept.agg(F.count("*").alias("FILAS_FINALES"), F.count_if(is_blank("ESTADO")).alias("ESTADOS_CORREGIDOS"))
    return after.withColumn("FILAS_ORIGEN", sheet.agg(F.count("*")).scalar()).select(
        "FILAS_ORIGEN", "FILAS_FINALES", (F.col("FILAS_ORIGEN") - F.col("FILAS_FINALES")).alias("DUPLICADOS_ELIMINADOS"),
        "ESTADOS_CORREGIDOS",
    )


def audit_sheet(sheet: DataFrame, out_dir: str, run_ts, sheet_name="AUDITORIA") -> dict:
    """Write the cleaned sheet and its audit sheet below a folder for the run."""
    cleaned = R.fill_blank_status(R.keep_most_complete(prepare_sheet(sheet)))
    return write_report({"DATOS": cleaned, sheet_name: audit_summary(sheet)}, run_folder(out_dir, run_ts))
