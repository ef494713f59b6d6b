"""Inventory of a database and a work folder."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotejo.sources.files import notebooks, run_logs
from cotejo.sources.reports import write_report

_TABLE_ROW = "NOMBRE string, TIPO string, GEOMETRIA string, RUTA string"


def tables(spark: SparkSession, database="default") -> DataFrame:
    """Tables and views of a database; a table with a box or ring columns is a polygon layer."""
    rows = []
    for t in spark.catalog.listTables(database):
        name = t.name if t.isTemporary else f"{database}.{t.name}"
        columns = {c.lower() for c in spark.table(name).columns}
        is_layer = {"xmin", "ymin", "xmax", "ymax"} <= columns or {"xs", "ys"} <= columns
        rows.append((t.name, "FeatureClass" if is_layer else "Table", "Polygon" if is_layer else None, name))
    return spark.createDataFrame(rows, _TABLE_ROW)


def inventory(spark: SparkSession, database="default", project_dir=None, log_dir=None) -> dict:
    """Category name -> rows."""
    found = tables(spark, database)
    layers = found.where("TIPO = 'FeatureClass'")
    out = {"FEATURE_CLASSES": layers, "TABLAS": found.where("TIPO = 'Table'").drop("GEOMETRIA")}
    if project_dir:
        out["NOTEBOOKS"] = notebooks(spark, project_dir)
    if log_dir:
        out["LOGS_AUTOMATICOS"] = run_logs(spark, log_dir)
    return out


def category_counts(categories: dict) -> DataFrame:
    """Number of rows of every category, empty ones included."""
    frames = [df.agg(F.lit(name).alias("CATEGORIA"), F.count("*").alias("CANTIDAD")) for name, df in categories.items()]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def write_inventory(categories: dict, folder: str, fmt="csv") -> dict:
    """One sheet per category that has rows."""
    return write_report(categories, folder, fmt, skip_empty=tuple(categories))
