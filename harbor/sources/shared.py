"""Where jobs keep intermediate tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share.

    Where it is unset, a temporary one on a local master; on a cluster that
    would be each machine's own, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder is None:
        folder = context.getCheckpointDir()
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="harbor-")
    return folder.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job made for itself, wherever it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
