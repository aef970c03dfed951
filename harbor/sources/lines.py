"""Raw receiver lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines of a file, folder or glob as the column ``value``."""
    return spark.read.text(path)
