"""Sinks: report sheets as one folder per sheet, run-stamped or published over the last version."""

from pyspark.sql import DataFrame, SparkSession

from cotejo.errors import RegistryError
from cotejo.sources.durable import stored
from cotejo.sources.publish import Publication, locate


def run_stamp(run_ts) -> str:
    return run_ts.strftime("%Y%m%d_%H%M%S")


def run_folder(out_dir: str, run_ts) -> str:
    """Every run writes below its own folder of the shared storage."""
    return f"{out_dir.rstrip('/')}/run_ts={run_stamp(run_ts)}"


def write_table(df: DataFrame, path: str, fmt="parquet", overwrite=False, partition_by=()):
    """A new folder; with ``overwrite`` a published version that replaces the last one, which stays if the write fails."""
    if overwrite:
        new = Publication(df.sparkSession, path, replace=True)
        new.write("", df, fmt, partition_by)
        new.commit()
        return
    writer = df.write.format(fmt).mode("errorifexists")
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_table(spark: SparkSession, path: str, fmt="parquet") -> DataFrame:
    """A table by the name it was written under, published or plain."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.load(locate(spark, path))


def write_report(sheets: dict, folder: str, fmt="parquet", overwrite=False, skip_empty=()) -> dict:
    """Write every sheet below ``folder``; returns them read back. ``skip_empty`` names optional sheets.

    With ``overwrite`` all sheets are published together in place of the last ones. Every frame is evaluated once.
    """
    written = {}
    if overwrite:
        new = Publication(next(iter(sheets.values())).sparkSession, folder, replace=True)
        for name, df in sheets.items():
            written[name] = new.write(name, df, fmt)
        return {name: written[name] for name in new.commit(leave_out_empty=skip_empty)}
    for name, df in sheets.items():
        if name in skip_empty:
            df = stored(df)
            if df.isEmpty():
                continue
        path = f"{folder}/{name}"
        write_table(df, path, fmt)
        written[name] = read_table(df.sparkSession, path, fmt)
    return written


def write_detail_and_summary(detail, summary, folder, names=("DATOS", "RESUMEN"), **options) -> dict:
    return write_report(dict(zip(names, (detail, summary))), folder, **options)


def write_lines(df: DataFrame, path: str, overwrite=False):
    """One text line per row of a single string column, in the frame's order."""
    if len(df.columns) != 1:
        raise RegistryError(f"write_lines needs one column, got {', '.join(df.columns)}")
    df.write.mode("overwrite" if overwrite else "errorifexists").text(path)
