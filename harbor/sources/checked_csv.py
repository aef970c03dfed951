"""CSV tables of an independent decoder, one family per folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_checked(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    """Read CSV with a header line and doubled quotes.

    Give a schema for large tables; without one Spark reads the data twice to
    infer it.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def family(message_id: Column, part_number: Column) -> Column:
    """Family name: types 1 to 3 together, type 24 by part, others by number."""
    return (
        F.when(message_id <= 3, "123")
        .when(message_id == 24, F.concat_ws("_", F.lit("24"), part_number.cast("string")))
        .otherwise(message_id.cast("string"))
    )


def write_by_family(
    rows: DataFrame,
    path: str,
    id_column: str = "id",
    part_column: str = "part_num",
    mode: str = "errorifexists",
) -> None:
    """Write rows as CSV with a header, one folder per family."""
    (
        rows.withColumn("family", family(F.col(id_column), F.col(part_column)))
        .write.mode(mode)
        .partitionBy("family")
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )
