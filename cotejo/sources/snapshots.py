"""Snapshots that the next run reads without moving them: tables bucketed and sorted by the key rows are joined on.

A registry table is large and a staged sheet is small. Joined by key, both would be shuffled in every run; a snapshot
that lies in buckets of that key is read bucket by bucket, and only the staged rows travel to it.
"""

from pyspark.sql import DataFrame, SparkSession

from cotejo.operators.reconcile import ROW_KEY, with_row_key


def keep_snapshot(rows: DataFrame, table: str, buckets: int, row_id="oid") -> DataFrame:
    """Save ``rows`` as a catalog table of ``buckets`` buckets, one file each; returns it as read.

    Choose as many buckets as ``spark.sql.shuffle.partitions``: with fewer Spark may prefer its own partitioning, with more the staged
    rows are moved once more. A table that is there is an error: a run must not overwrite what it reads.
    """
    kept = with_row_key(rows.drop("ACCION"), row_id).repartition(buckets, ROW_KEY)
    kept.write.bucketBy(buckets, ROW_KEY).sortBy(ROW_KEY).format("parquet").mode("errorifexists").saveAsTable(table)
    return read_snapshot(rows.sparkSession, table)


def read_snapshot(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
