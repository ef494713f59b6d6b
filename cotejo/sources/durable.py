"""Frames that several outputs read, written once to the shared folder the cluster names."""

import tempfile
import uuid

from pyspark.sql import DataFrame

from cotejo.errors import RegistryError


def shared_folder(spark) -> str:
    """``spark.checkpoint.dir``, or the context's checkpoint folder; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RegistryError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="cotejo-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table of its own: computed once, safe from lost executors, read by column."""
    path = f"{shared_folder(df.sparkSession)}/cotejo-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
