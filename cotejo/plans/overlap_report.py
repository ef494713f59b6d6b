"""Overlap reports of existing and of new parcels."""

from pyspark.sql import DataFrame

from cotejo.errors import RegistryError, require_columns
from cotejo.operators import overlap as O
from cotejo.operators.schema import find_qualified
from cotejo.sources.durable import stored
from cotejo.sources.reports import run_stamp, write_lines, write_report

# The names the id column may have, best first.
ID_NAMES = ("EXPEDIENTE", "EXPEDIEN_1", "ID")
# Fixed value: the name of the status column.
STATUS_NAMES = ("ESTADO",)
# Fixed value: the report's title.
TITLE = "REPORTE DE TRASLAPES - CM_BASE"


def _named(parcels, given, names, what):
    """(parcels, column); a qualified name loses its dots, which Spark would read as steps into a struct."""
    column = given or find_qualified(parcels, names)
    if column is None or column not in parcels.columns:
        raise RegistryError(f"parcels: missing {what} column {given or ' or '.join(names)}; found {', '.join(parcels.columns)}")
    plain = column.split(".")[-1]
    if plain == column:
        return parcels, column
    if plain in parcels.columns:
        parcels = parcels.drop(plain)
    return parcels.withColumnRenamed(column, plain), plain


def report_overlaps(parcels: DataFrame, ids: DataFrame, out_dir: str, run_ts, **options) -> DataFrame:
    """Write the text report of the wanted ids and the ids that could not be analysed; returns the overlaps.

    Id and status column are found by plain or qualified name (``CM_BASE.ESTADO``) unless they are given; it is an error if
    the table lacks one. ENCABEZADO names the columns used and the run time, LINEAS holds the report's lines.
    """
    shape = options.get("shape", "box")
    parcels, id_col = _named(parcels, options.get("id_col"), ID_NAMES, "id")
    parcels, status = _named(parcels, options.get("status"), STATUS_NAMES, "status")
    if id_col not in ids.columns:
        own = find_qualified(ids, (id_col, *ID_NAMES))
        require_columns(ids.columns, [id_col] if own is None else [own], "wanted ids")
        ids = ids.withColumnRenamed(own, id_col)
    options |= {"id_col": id_col, "status": status}
    found = stored(O.overlaps(parcels, ids, **options))
    folder = f"{out_dir.rstrip('/')}/Reporte_Traslapes_{run_stamp(run_ts)}"
    head = (
        TITLE, f"Campo expediente usado: {id_col}", f"Campo estado usado: {status}",
        f"Fecha: {run_ts:%Y-%m-%d %H:%M:%S}",
    )
    lines = parcels.sparkSession.createDataFrame([(line,) for line in head], "line string").coalesce(1)
    write_lines(lines, f"{folder}/ENCABEZADO")
    write_lines(O.report_lines(found, O.analysed_subjects(parcels, ids, shape, id_col)), f"{folder}/LINEAS")
    write_report({"PROBLEMAS": O.subject_problems(parcels, ids, shape, id_col)}, folder)
    return O.ranked(found)


def add_and_report(base: DataFrame, candidates: DataFrame, attributes: DataFrame, out_dir: str, run_ts, **options):
    """Append the valid new parcels; write TRASLAPES if they overlap any. Returns the new parcel table."""
    id_col = options.get("id_col", "EXPEDIENTE")
    accepted = stored(O.acceptable(candidates, id_col))
    if accepted.isEmpty():
        raise RegistryError("no candidate parcel has an acceptable id")
    found = O.overlaps_of_new(accepted, base, attributes, **options).drop("oid")
    write_report({"TRASLAPES": found}, f"{out_dir.rstrip('/')}/TRASLAPES_{run_stamp(run_ts)}", skip_empty=("TRASLAPES",))
    return base.unionByName(accepted, allowMissingColumns=True)
