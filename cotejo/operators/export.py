"""Exports: one output per group, or one filtered output with renamed columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.errors import RegistryError, require_columns
from cotejo.functions.predicates import status_exportable_lenient, status_exportable_strict
from cotejo.operators.classify import GROUP
from cotejo.operators.schema import find_ignoring_case, pick_wanted, short_names
from cotejo.sources.durable import stored
from cotejo.sources.reports import run_stamp, write_table

# Groups exported one by one (fixed values).
EXPORT_GROUPS = ("METALICOS", "NO_METALICOS", "PERMISO_ESPECIAL")


def exportable_groups(df: DataFrame, groups=EXPORT_GROUPS, group=GROUP) -> DataFrame:
    """Rows of the wanted groups whose status allows export (null statuses are left out)."""
    require_columns([c.upper() for c in df.columns], [group.upper(), "ESTADO"], "segmented export")
    return df.where(F.col(group).isin(*groups) & status_exportable_strict("ESTADO"))


def group_manifest(selected: DataFrame, groups=EXPORT_GROUPS, group=GROUP) -> DataFrame:
    """Every wanted group with its row count, and whether an output is made or skipped for lack of rows."""
    counts = selected.groupBy(group).agg(F.count("*").alias("_n"))
    wanted = selected.sparkSession.range(1).select(F.explode(F.array(*[F.lit(g) for g in groups])).alias(group))
    n = F.coalesce("_n", F.lit(0))
    return wanted.join(counts, group, "left").select(
        group, n.alias("REGISTROS"), F.when(n > 0, "EXPORTADO").otherwise("SIN_REGISTROS").alias("RESULTADO")
    )


def export_groups(df: DataFrame, out_dir: str, groups=EXPORT_GROUPS, group=GROUP, fmt="parquet") -> DataFrame:
    """Write one directory per group with rows; returns the manifest. The write needs no shuffle."""
    selected = exportable_groups(df, groups, group)
    write_table(selected, out_dir, fmt, partition_by=[group])
    return group_manifest(selected, groups, group)


def single_export(df: DataFrame):
    """(filtered rows in the export's column order with short names, name plan, wanted columns not found)."""
    status = find_ignoring_case(df, "ESTADO")
    if status is None:
        raise RegistryError("single export: missing required column ESTADO")
    present, missing = pick_wanted(df)
    plan = short_names(present)
    rows = df.where(status_exportable_lenient(status))
    return rows.select(*[F.col(name).alias(short) for name, short in plan]), plan, missing


def name_map(df: DataFrame, plan, missing) -> DataFrame:
    """CAMPO, NOMBRE_CORTO, TIPO of the exported columns, and the wanted ones not found (without a short name)."""
    kinds = {c.name.upper(): c.dataType.simpleString() for c in df.schema.fields}
    lines = [(name, short, kinds.get(name.upper())) for name, short in plan] + [(name, None, None) for name in missing]
    return df.sparkSession.createDataFrame(lines, "CAMPO string, NOMBRE_CORTO string, TIPO string")


def write_single_export(df: DataFrame, path: str, fmt="parquet", run_ts=None):
    """Write the filtered export; an error if the filter leaves no row. With ``run_ts`` its name map is written beside it."""
    rows, plan, missing = single_export(df)
    rows = stored(rows)  # evaluated once, whether there is a row and for the output
    if rows.isEmpty():
        raise RegistryError("no rows to export after leaving out archived and unlocated ones")
    write_table(rows, path, fmt)
    if run_ts is not None:
        write_table(name_map(df, plan, missing).coalesce(1), f"{path.rstrip('/')}_CAMPOS_{run_stamp(run_ts)}", "csv")
    return plan, missing
