"""Tables kept between the steps of a job, in storage that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from harbor.sources.shared import shared_folder


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder, also set as that of checkpoints where none is set."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again.

    Cuts the lineage: what comes after a lost executor starts from the table.
    The table stays until whoever owns the folder clears it.
    """
    path = f"{shared_folder(frame.sparkSession)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
