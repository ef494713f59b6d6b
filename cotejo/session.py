"""Session settings the operators are written for."""

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# AQE does the run-time sizing: it coalesces small shuffle partitions, splits skewed ones and turns a
# shuffled join into a broadcast join only after it has measured the side (autoBroadcastJoinThreshold).
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name="cotejo", master=None, shuffle_partitions=None, extra=None):
    """A session with the settings above; size ``shuffle_partitions`` to 2-3 per core on a cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped = set()


def ship_package(spark):
    """Give this package to the Python workers, once per application: they may start in any folder of any machine."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="cotejo-ship-")
    archive = shutil.make_archive(os.path.join(folder, "cotejo"), "zip", os.path.dirname(root), os.path.basename(root))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
