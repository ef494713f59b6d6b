"""Merge two sheets and write the result with its change report."""

from pyspark.sql import DataFrame

from cotejo.operators import merge as M
from cotejo.sources.durable import stored
from cotejo.sources.reports import run_stamp, write_report


def merge_sheets(source: DataFrame, target: DataFrame, out_dir: str, names, run_ts, key="EXPEDIENTE", fmt="parquet", **options):
    """Write DATOS_ACTUALIZADOS and, if any cell changed, REPORTE_CAMBIOS; returns the outcome counts.

    ``names`` are the base names of the two inputs. The comparison feeds all three outputs and is stored once.
    """
    compared = stored(M.compare(source, target, key, **options))
    folder = f"{out_dir.rstrip('/')}/MERGE_{names[0]}_CON_{names[1]}_{run_stamp(run_ts)}"
    sheets = {"DATOS_ACTUALIZADOS": M.merged(compared), "REPORTE_CAMBIOS": M.cell_changes(compared, key)}
    write_report(sheets, folder, fmt, skip_empty=("REPORTE_CAMBIOS",))
    return M.outcome_counts(compared)
