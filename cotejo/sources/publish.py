"""Reports that become visible all at once, and stay as they were when a run fails.

A run writes its sheets below a folder of its own attempt. One small file then names them: the commit. Readers follow the
last commit, so they see all sheets of a run or those of the run before. A run that dies before its commit leaves
nothing that readers look at, and may be run again under the same name. Nothing is renamed or deleted, which suits
object stores; attempts without a commit may be removed at any time.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cotejo.errors import RegistryError

_COMMIT = "seq long, attempt string, sheet string, path string, rows long"


def _commits(spark: SparkSession, folder: str):
    try:
        return spark.read.schema(_COMMIT).parquet(f"{folder}/commits/*")
    except AnalysisException:  # none yet
        return None


def published(spark: SparkSession, folder: str):
    """{sheet: path} of the last commit, None if there is none. Of commits made at the same time the larger name counts."""
    commits = _commits(spark, folder.rstrip("/"))
    if commits is None:
        return None
    last = commits.agg(F.max(F.struct("seq", "attempt")).alias("last")).first()["last"]
    if last is None:
        return None
    return {r["sheet"]: r["path"] for r in commits.where((F.col("seq") == last["seq"]) & (F.col("attempt") == last["attempt"])).collect()}


def locate(spark: SparkSession, path: str) -> str:
    """Where the table named ``path`` lies: as its report's last commit says, or else right there."""
    root, sheet = path.rstrip("/"), ""
    while root.count("/") > 1:
        found = published(spark, root)
        if found and sheet in found:
            return found[sheet]
        root, _, name = root.rpartition("/")
        sheet = f"{name}/{sheet}" if sheet else name
        if sheet.count("/") > 1:
            break
    return path


class Publication:
    """One run's sheets: ``write`` each, then ``commit``. Without ``replace`` a report that is there is an error."""

    def __init__(self, spark: SparkSession, folder: str, replace=False):
        self.spark, self.folder, self.attempt = spark, folder.rstrip("/"), uuid.uuid4().hex
        if not replace and published(spark, self.folder) is not None:
            raise RegistryError(f"report {self.folder} already exists")
        self._written = {}

    def write(self, name: str, df: DataFrame, fmt="parquet", partition_by=()) -> DataFrame:
        """Write a sheet (``name`` may hold one slash, or be empty for a lone table); rows are counted as they are written."""
        path = f"{self.folder}/attempts/{self.attempt}/{name or 'data'}"
        counted = Observation()
        writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
        self._written[name] = (path, counted.get["rows"])
        reader = self.spark.read.format(fmt)
        return (reader.option("header", True) if fmt == "csv" else reader).load(path)

    def rows(self, name: str) -> int:
        return self._written[name][1]

    def commit(self, leave_out_empty=()) -> list:
        """Make the sheets visible, but for those of ``leave_out_empty`` that have no rows; returns the visible names."""
        shown = {n: w for n, w in self._written.items() if w[1] or n not in leave_out_empty}
        commits = _commits(self.spark, self.folder)
        seq = 1 + ((commits.agg(F.max("seq")).first()[0] or 0) if commits is not None else 0)
        lines = [(seq, self.attempt, n, path, rows) for n, (path, rows) in shown.items()]
        self.spark.createDataFrame(lines, _COMMIT).coalesce(1).write.parquet(f"{self.folder}/commits/{seq:08d}-{self.attempt}")
        return list(shown)
