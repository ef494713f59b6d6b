"""Classify a sheet and write it with its group counts."""

from pyspark.sql import DataFrame

from cotejo.errors import RegistryError
from cotejo.operators import classify as C
from cotejo.sources.reports import run_stamp, write_detail_and_summary, write_report

RULES = {"age": C.by_age, "clean_text": C.by_clean_text, "word_stems": C.by_word_stems}


def classify_sheet(sheet: DataFrame, rules: str, out_dir: str, run_ts, run_year=None, fmt="parquet"):
    """Write DATOS and RESUMEN twice: under the run's time, and in place over the last result.

    The sheet is classified once; everything else is read from the stamped copy. Returns the counts and the one-row
    control figure of rows without a group.
    """
    if rules not in RULES:
        raise RegistryError(f"rules must be one of {', '.join(RULES)}, got {rules}")
    args = {"run_year": run_year or run_ts.year} if rules == "age" else {}
    detail = RULES[rules](sheet, **args)
    base = out_dir.rstrip("/")
    stamped = f"{base}/AGRUPADO_{run_stamp(run_ts)}"
    rows = write_report({"DATOS": detail}, stamped, fmt)["DATOS"]
    counts = write_report({"RESUMEN": C.group_counts(rows)}, stamped, fmt)["RESUMEN"]
    write_detail_and_summary(rows, counts, f"{base}/CLASIFICADO", fmt=fmt, overwrite=True)
    return counts, C.ungrouped_count(rows)
