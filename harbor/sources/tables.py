"""Parquet tables: messages partitioned by type, decoded tables plain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_messages(
    messages: DataFrame, path: str, mode: str = "errorifexists", compact: bool = True
) -> None:
    """Write a message table, one folder per message type.

    ``compact`` first rebalances the rows by type, letting Spark split the large
    types and join the small ones into well-sized files, at the price of one
    shuffle.  Without it every task writes a file per type it holds, which at
    scale makes millions of them.
    """
    if compact:
        messages = messages.hint("rebalance", "id")
    messages.write.mode(mode).partitionBy("id").parquet(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Read a message table; ``id`` comes from the folders."""
    return spark.read.parquet(path)


def write_table(table: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a decoded table."""
    table.write.mode(mode).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a decoded table."""
    return spark.read.parquet(path)
