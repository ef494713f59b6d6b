"""Reading tabular sheets (CSV or Parquet), one or many."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotejo.errors import RegistryError
from cotejo.sources import quoted_csv
from cotejo.sources.durable import stored
from cotejo.sources.files import list_files


def read_sheet(spark: SparkSession, path, fmt="csv", schema=None, line_breaks=True, order=None) -> DataFrame:
    """One sheet, the header row as column names. CSV columns are text unless a schema is given.

    Quoted cells may hold line breaks, and large files are still read by many tasks (``quoted_csv``); rows come in no
    order then, and ``order`` names a column to add that rises along the file. Rows that cannot be read whole are left
    out: ``read_sheet_with_rejects`` lists them. A ``schema`` or ``line_breaks=False`` leaves the reading to Spark's reader.
    """
    if fmt == "csv" and line_breaks and schema is None:
        return read_sheet_with_rejects(spark, path, order)[0]
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(header=True, multiLine=line_breaks, **quoted_csv.CSV_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return with_row_seq(df).withColumnRenamed("row_seq", order) if order else df


def read_sheet_with_rejects(spark: SparkSession, path, order=None, sep=","):
    """(sheet, rejects) of one CSV: rejects (path, reason) are rows with more cells than columns and unclosed quotes."""
    # Spark's own reader looks at the first row only, so the driver learns the names without reading the file.
    columns = tuple(spark.read.options(header=True, multiLine=True, sep=sep, **quoted_csv.CSV_OPTIONS).csv(path).columns)
    columns = tuple(c.strip("\ufeff\r") for c in columns)
    rows, n = quoted_csv.records(spark, path), F.lit(len(columns))
    sheet = quoted_csv.parsed(quoted_csv.intact(rows, n, sep), columns, sep, ["seq"] if order else [])
    return (sheet.withColumnRenamed("seq", order) if order else sheet), quoted_csv.damaged(rows, n, sep)


def read_first_available(spark: SparkSession, candidates, fmt="csv"):
    """(sheet, path used) for the first candidate that can be read; an error naming all if none can."""
    reasons = []
    for path in candidates:
        try:
            df = read_sheet(spark, path, fmt)
            if df.columns:
                return df, path
            reasons.append(f"{path}: no header")
        except AnalysisException as e:
            reasons.append(f"{path}: {str(e).splitlines()[0]}")
    raise RegistryError("no readable sheet among: " + "; ".join(reasons))


def _own_output(path, skip_containing, skip_prefix):
    name = F.lower(F.regexp_extract(path, r"(?s)([^/]*)$", 1))
    tests = [F.contains(name, F.lit(x.lower())) for x in skip_containing] + [F.startswith(name, F.lit(x.lower())) for x in skip_prefix]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def read_folder(spark: SparkSession, folder: str, fmt="csv", skip_containing=(), skip_prefix=()):
    """(sheets, rejects): all sheets of a folder except own outputs, one frame per distinct header.

    Every row carries ``_source_file`` and, of a CSV, ``_source_row`` (rises along the file). ``rejects`` is a frame (path, reason):
    files without a readable header, and damaged rows. The files of a folder of CSVs are read once, all together, and
    stored as rows of text; only the distinct headers reach the driver.
    """
    listing = list_files(spark, folder, f"*.{fmt}", recursive=False)
    wanted = listing.where(~_own_output("path", skip_containing, skip_prefix))
    return _csv_folder(spark, folder, wanted) if fmt == "csv" else _other_folder(spark, wanted, fmt)


def _csv_folder(spark, folder, wanted):
    if wanted.isEmpty():
        return [], spark.createDataFrame([], "path string, reason string")
    found = quoted_csv.records(spark, f"{folder.rstrip('/')}/*.csv")
    rows = stored(found.join(wanted.select("path"), "path", "left_semi"))
    heads = rows.where("header").select("path", F.col("record").alias("head"))
    rejects = [wanted.join(heads, "path", "left_anti").select("path", F.lit("no header").alias("reason"))]
    layouts = {}
    for r in heads.select("head").distinct().toLocalIterator():
        layouts.setdefault(quoted_csv.column_names(r["head"]), []).append(r["head"])
    sheets = []
    for columns, texts in sorted(layouts.items()):
        own = rows.join(heads.where(F.col("head").isin(texts)).select("path"), "path")
        named = own.withColumns({"_source_file": F.regexp_extract("path", r"(?s)([^/]*)$", 1), "_source_row": F.col("seq")})
        n = F.lit(len(columns))
        sheets.append(quoted_csv.parsed(quoted_csv.intact(named, n), columns, keep=("_source_file", "_source_row")))
        rejects.append(quoted_csv.damaged(own, n))
    return sheets, reduce(DataFrame.unionByName, rejects)


def _other_folder(spark, wanted, fmt):
    """Formats that hold their own schema: one look at each file's schema, then one scan per layout."""
    layouts, rejects = {}, []
    for path in [r.path for r in wanted.select("path").orderBy("path").toLocalIterator()]:
        try:
            columns = tuple(read_sheet(spark, path, fmt).columns)
            if not columns:
                raise RegistryError("no header")
            layouts.setdefault(columns, []).append(path)
        except (AnalysisException, RegistryError) as e:
            rejects.append((path, str(e).splitlines()[0]))
        except Exception as e:  # damaged file: the reader's own error
            rejects.append((path, type(e).__name__))
    sheets = [
        read_sheet(spark, files, fmt).withColumn("_source_file", F.col("_metadata.file_name"))
        for _, files in sorted(layouts.items())
    ]
    return sheets, spark.createDataFrame(rejects, "path string, reason string")


def with_row_seq(df: DataFrame, order=()) -> DataFrame:
    """Give a freshly read sheet its stored row order; write the result before use.

    With ``order`` columns the number is taken from their global sort. Without, it follows the reader's order
    (file part and position in it), which is the sheet's order for one Parquet file; CSV sheets get theirs from
    ``read_sheet(order=...)``.
    """
    if order:
        df = df.orderBy(*order)
    return df.withColumn("row_seq", F.monotonically_increasing_id())


def read_meetings(spark: SparkSession, path, fmt="parquet") -> DataFrame:
    """Calendar items as a table, with times free of a time zone and recipients as a list."""
    df = spark.read.format(fmt).load(path)
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")}
    return df.withColumns(times)
