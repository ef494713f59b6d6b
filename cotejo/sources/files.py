"""File listings: names, times and sizes only, never the content."""

import fnmatch
import os
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotejo.errors import RegistryError
from cotejo.functions.text import file_suffix
from cotejo.session import ship_package
from cotejo.sources.durable import stored

PAGE = 10_000  # rows of a listing that a task holds at a time
_ENTRY = pa.schema([("path", pa.string()), ("modificationTime", pa.timestamp("us", "UTC")), ("length", pa.int64()), ("folder", pa.bool_())])


def _located(folder):
    """(file system, path in it, what precedes that path)."""
    if "://" not in folder:
        return fs.LocalFileSystem(), os.path.abspath(folder.removeprefix("file:")), ""
    system, path = fs.FileSystem.from_uri(folder)
    path = path.rstrip("/")
    local = isinstance(system, fs.LocalFileSystem)
    return system, path, "" if local else folder.rstrip("/").removesuffix(path)


def _local_entries(path):
    """(path, time, size, is a folder) of what a local folder holds, one by one; links to folders are not followed."""
    with os.scandir(path) as found:
        for entry in found:
            try:
                stat = entry.stat()
            except FileNotFoundError:  # gone meanwhile, or a link that leads nowhere
                yield entry.path, None, None, False
                continue
            is_folder = entry.is_dir()
            if not (is_folder and entry.is_symlink()):
                yield entry.path, stat.st_mtime_ns // 1000, None if is_folder else stat.st_size, is_folder


def _store_entries(system, path, before):
    """The same for any other store, whose interface gives a folder's listing as one list."""
    for i in system.get_file_info(fs.FileSelector(path)):
        yield before + i.path, i.mtime_ns and i.mtime_ns // 1000, i.size, i.type == fs.FileType.Directory


def _children(batches):
    """Direct children of each folder, ``PAGE`` rows at a time."""
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            system, path, before = _located(folder)
            entries = _local_entries(path) if isinstance(system, fs.LocalFileSystem) else _store_entries(system, path, before)
            while rows := list(islice(entries, PAGE)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ENTRY.types)], schema=_ENTRY)


def list_files(spark: SparkSession, folder: str, pattern=None, recursive=True) -> DataFrame:
    """path, modificationTime, length of every file, hidden and empty ones too; local paths carry no scheme.

    One round per level of folders, whose folders are listed side by side; a local folder of any size is listed in
    pages. ``pattern`` is a glob on the name.
    """
    system, path, _ = _located(folder)
    if system.get_file_info(path).type != fs.FileType.Directory:
        raise RegistryError(f"no such folder: {folder}")
    ship_package(spark)
    level, files = spark.createDataFrame([(folder,)], "path string"), []
    while True:
        found = stored(level.repartition(spark.sparkContext.defaultParallelism).mapInArrow(
            _children, "path string, modificationTime timestamp, length long, folder boolean"))
        files.append(found.where(~F.col("folder")).drop("folder"))
        level = found.where("folder").select("path")
        if not recursive or level.isEmpty():
            break
    out = files[0]
    for more in files[1:]:
        out = out.unionByName(more)
    if pattern:
        out = out.where(F.regexp_extract("path", r"(?s)([^/]*)$", 1).rlike(fnmatch.translate(pattern).replace(r"\Z", r"\z")))
    return out


def _named(files, name_rule):
    name = F.regexp_extract("path", r"(?s)([^/]*)$", 1)
    return files.withColumn("_name", name).where(F.col("_name").rlike(name_rule))


def notebooks(spark: SparkSession, folder: str) -> DataFrame:
    """Notebooks anywhere below a folder."""
    found = _named(list_files(spark, folder), r"(?i)\.ipynb$")
    return found.select(F.col("_name").alias("NOTEBOOK"), F.col("path").alias("RUTA"))


def run_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Log files directly in a folder with their time as text."""
    found = _named(list_files(spark, folder, recursive=False), r"(?is)^log_.*\.csv$")
    return found.select(
        F.col("_name").alias("ARCHIVO_LOG"), F.col("path").alias("RUTA"),
        F.date_format("modificationTime", "yyyy-MM-dd HH:mm:ss").alias("FECHA_MODIFICACION"),
    )


def files_by_suffix(files: DataFrame) -> DataFrame:
    """Number of files and bytes per suffix."""
    name = F.regexp_extract("path", r"(?s)([^/]*)$", 1)
    return files.groupBy(file_suffix(name).alias("EXTENSION")).agg(
        F.count("*").alias("ARCHIVOS"), F.sum("length").alias("BYTES")
    )
