"""Connected components of a graph that no task or driver holds.

Each round first turns every node's neighbours larger than it towards the
smallest node of its neighbourhood, then every node's smaller neighbours
towards the smallest of them.  Edges only ever move towards smaller nodes of
the same component, until every component is a star around its smallest node;
the rounds needed grow with the logarithm of the size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harbor.llm.storage import checkpoint_folder

#: Far above the logarithm of any number of nodes.
MAX_ROUNDS = 60


def _turned(edges: DataFrame) -> DataFrame:
    """Every edge ``u, v`` moved to the smallest of ``u`` and its listed neighbours.

    The minimum is a grouping and a join: a node with many edges is combined
    before the exchange, and its side of the join can be split.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("__least"))
    return edges.join(
        least.select(F.col("u"), F.least("u", "__least").alias("m")), "u"
    )


def _round(edges: DataFrame) -> DataFrame:
    """``edges`` as ``v, m`` with ``v > m``; the same after a round."""
    both = edges.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        edges.select(F.col("m").alias("u"), F.col("v"))
    )
    large = _turned(both).where(F.col("v") > F.col("u")).select("v", "m").distinct()
    down = large.select(F.col("v").alias("u"), F.col("m").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    small = moved.select(F.col("v"), F.col("m")).union(
        least.select(F.col("u").alias("v"), F.col("m"))
    )
    return small.where(F.col("v") != F.col("m")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node that has an edge and is not a root itself.

    ``root`` is the smallest node of the component.  Loops and repeated edges
    do not matter; the ends must not be null.  Each round ends in a checkpoint
    in shared storage.
    """
    checkpoint_folder(edges.sparkSession)
    current = (
        edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("m"))
        .where(F.col("v") != F.col("m"))
        .distinct()
        .checkpoint()
    )
    state = None
    for _ in range(MAX_ROUNDS):
        mark = current.agg(
            F.count(F.lit(1)), F.expr("sum(cast(xxhash64(v, m) as decimal(38, 0)))")
        ).first()
        if mark == state:
            return current.select(F.col("v").alias("node"), F.col("m").alias("root"))
        state = mark
        current = _round(current).checkpoint()
    raise RuntimeError("components did not settle")
