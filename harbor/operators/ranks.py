"""Row numbers within groups of any size.

The rows are cut into ranges of the whole order, which Spark makes about equal
whatever the groups are.  A row's number is its place within its range plus what
the group has in earlier ranges, so no task meets more of a group than a range.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from harbor.sources.shared import shared_folder


def with_rank(rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Append ``name``, the row's number from 1 among those of its ``keys``, by ``order``.

    Nulls are a group, and a value, like any other and come first.  Rows alike
    in keys and order get their numbers in any way.  The ranges are kept in the
    shared folder, where they stay the same whoever reads them.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/ranges-{uuid.uuid4().hex}"
    # Drawn anew for every row, so that rows alike can be in several ranges.
    drawn = rows.withColumn("__tie", F.rand(17))
    cut = drawn.repartitionByRange(*keys, *order, "__tie").select(
        *rows.columns, F.spark_partition_id().alias("__range")
    )
    cut.write.parquet(path)
    ranges = spark.read.schema(cut.schema).parquet(path)
    here = [*keys, "__range"]
    placed = ranges.withColumn("__place", F.row_number().over(W.partitionBy(*here).orderBy(*order)))
    totals = ranges.groupBy(*here).agg(F.count(F.lit(1)).alias("__n"))
    earlier = W.partitionBy(*keys).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select(
        *[F.col(c).alias(f"__of_{c}") for c in here],
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in here]
    return placed.join(before, same).select(
        *rows.columns, (F.col("__before") + F.col("__place")).alias(name)
    )
