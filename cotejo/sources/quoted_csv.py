"""Quoted CSV read by many tasks, however large a file is and whatever its cells hold.

Spark's text reader cuts files at any line; a line break inside a quoted cell is told from the end of a row by the quotes
before it. Every line with an odd number of quotes opens or closes such a cell (a doubled quote counts twice), so with the
number of those lines before it, a line knows whether it begins inside a cell, and of which. That number is a
running sum in the line's own split plus the sums of the file's earlier splits: a frame of one row per split.
Lines outside cells are rows as they are; the lines of a cell that spans several are put together, cell by cell.

Cells are quoted as spreadsheets do it: ``"`` around the cell and doubled inside. A quote that is never closed would
make one row of all that follows; such lines are damaged rows instead. Blank lines are no rows.
"""

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE = '"'
CSV_OPTIONS = {"quote": QUOTE, "escape": QUOTE}


def _decoded(c) -> Column:
    """A path of ``_metadata`` as listings give it: percent signs resolved, plus signs left alone, no scheme on local paths."""
    return F.regexp_replace(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), "^file:/+", "/")


def _lines(spark: SparkSession, paths) -> DataFrame:
    """path, start (of the split), at (rises within a split), value, odd (1: the line opens or closes a cell)."""
    raw = spark.read.option("lineSep", "\n").text(paths)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    return raw.select(
        _decoded(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), "value", (quotes % 2).cast("long").alias("odd"),
    )


def _splits(lines: DataFrame) -> DataFrame:
    """Per split: switches before it and in the whole file, and where the file's first row is."""
    blank = F.trim(F.regexp_replace("value", "[﻿\r\t]", "")) == ""
    found = lines.groupBy("path", "start").agg(F.sum("odd").alias("own"), F.min(F.when(~blank, F.col("at"))).alias("first_at"))
    file, earlier = Window.partitionBy("path"), Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    head = F.min(F.when(F.col("first_at").isNotNull(), F.struct("start", "first_at"))).over(file)
    return found.select(
        "path", "start", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("before"), F.sum("own").over(file).alias("all_odd"), head.alias("head"),
    )


def records(spark: SparkSession, paths) -> DataFrame:
    """path, seq, record, header, closed: the rows of the files as text.

    ``seq`` rises along a file; ``header`` marks a file's first row; ``closed`` is false for a line after a quote that
    is never closed.
    """
    lines = _lines(spark, paths)
    split = Window.partitionBy("path", "start").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        lines.withColumns({"n": F.row_number().over(Window.partitionBy("path", "start").orderBy("at")), "so_far": F.sum("odd").over(split)})
        .join(_splits(lines), ["path", "start"])
        .withColumn("switches", F.col("before") + F.col("so_far") - F.col("odd"))
    )
    text = F.when((F.col("start") == 0) & (F.col("n") == 1), F.regexp_replace("value", "^﻿", "")).otherwise(F.col("value"))
    cell = F.floor(F.col("switches") / 2)
    inside = (F.col("switches") % 2 == 1) | (F.col("odd") == 1)
    unclosed = inside & (F.col("all_odd") % 2 == 1) & (cell == F.floor(F.col("all_odd") / 2))
    placed = placed.select(
        # A line takes a byte at least, so no line of a later split can have a smaller number.
        "path", (F.col("start") + F.col("n") - 1).alias("seq"), text.alias("record"), F.when(inside, cell).alias("cell"),
        F.coalesce((F.col("head.start") == F.col("start")) & (F.col("head.first_at") == F.col("at")), F.lit(False)).alias("header"),
        (~unclosed).alias("closed"),
    )
    whole = placed.where("cell IS NULL OR NOT closed").drop("cell")
    parts = F.sort_array(F.collect_list(F.struct("seq", "record")))
    spanning = placed.where("cell IS NOT NULL AND closed").groupBy("path", "cell").agg(
        F.min("seq").alias("seq"), F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"), F.max("header").alias("header"), F.lit(True).alias("closed"),
    )
    out = whole.unionByName(spanning.drop("cell")).withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return out.where(F.trim(F.regexp_replace("record", "\t", "")) != "")


def column_names(header: str, sep=",") -> tuple:
    """The names in a header row: blank ones by position, repeated ones with their position added."""
    names = next(csv.reader([header], delimiter=sep), [])
    seen = [n.lower() for n in names]
    return tuple(f"_c{i}" if not n else f"{n}{i}" if seen.count(n.lower()) > 1 else n for i, n in enumerate(names))


def cell_count(record, sep=",") -> Column:
    """Cells of a row: separators outside quotes, and one."""
    bare = F.regexp_replace(record, f"{QUOTE}[^{QUOTE}]*{QUOTE}", "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit(""))) + 1


def parsed(rows: DataFrame, columns, sep=",", keep=()) -> DataFrame:
    """The cells of ``record`` as text columns; missing ones at the end are null. ``keep`` names columns of ``rows``."""
    schema = ", ".join(f"c{i} STRING" for i in range(len(columns)))
    # A row is one text here: a separator that no text holds keeps line breaks in cells as they are.
    cells = F.from_csv("record", schema, {"sep": sep, "mode": "PERMISSIVE", **CSV_OPTIONS})
    made = rows.select(*keep, cells.alias("cells_"))
    return made.select(*[F.col("cells_")[f"c{i}"].alias(c) for i, c in enumerate(columns)], *keep)


def damaged(rows: DataFrame, columns: Column, sep=",") -> DataFrame:
    """path, reason of the rows that cannot be read whole; ``columns`` is the number of names in their header."""
    count = cell_count("record", sep)
    reason = F.when(~F.col("closed"), F.format_string("row at %d: a quote is not closed", "seq")).when(
        count > columns, F.format_string("row at %d: %d cells, %d columns", "seq", count, columns)
    )
    return rows.where(~F.col("header")).select("path", reason.alias("reason")).where("reason IS NOT NULL")


def intact(rows: DataFrame, columns: Column, sep=",") -> DataFrame:
    return rows.where(~F.col("header") & F.col("closed") & (cell_count("record", sep) <= columns))
