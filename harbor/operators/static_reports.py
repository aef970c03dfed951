"""Class B static reports (type 24): two parts, joined on ship and second."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harbor.functions.payload import sextet
from harbor.operators.decode import of_lengths, of_types, with_fields
from harbor.plans import layouts as L


def _part_number() -> Column:
    # Bits 38 and 39 are the middle pair of the seventh character, so routing
    # by part needs one character and no unpacking.
    return F.shiftright(sextet(F.col("data"), 6), 2).bitwiseAND(F.lit(3))


def _family(messages: DataFrame) -> DataFrame:
    return of_lengths(of_types(messages, L.STATIC_B.types), L.STATIC_B.lengths)


def _is_name_part() -> Column:
    return _part_number() == 0


def _is_detail_part(by_number_only: bool) -> Column:
    numbered = _part_number() == 1
    if by_number_only:
        return numbered
    # Some devices number a detail part 0; its length gives it away.
    return numbered | ((_part_number() == 0) & (F.length("data") == L.SHORT_SLOT))


def with_part_number(messages: DataFrame) -> DataFrame:
    """Type 24 rows with repeat indicator, MMSI and part number."""
    return with_fields(_family(messages), L.STATIC_B.fields, L.SHORT_SLOT)


def name_parts(messages: DataFrame, trim_text: bool = False) -> DataFrame:
    """Part A: the distinct ``(ship_name, mmsi, timestamp)``."""
    rows = _family(messages).where(_is_name_part()).select("data", "timestamp")
    named = with_fields(rows, (*L.STATIC_B_NAME, L.MMSI), L.SHORT_SLOT, trim_text)
    return named.select("ship_name", "mmsi", "timestamp").distinct()


def detail_parts(
    messages: DataFrame, by_number_only: bool = False, trim_text: bool = False
) -> DataFrame:
    """Part B: the common columns and eight fields of the detail part."""
    rows = _family(messages).where(_is_detail_part(by_number_only))
    fields = L.STATIC_B.fields + L.STATIC_B_DETAIL
    return with_fields(rows, fields, L.SHORT_SLOT, trim_text)


def decode_static_reports(
    messages: DataFrame, by_number_only: bool = False, trim_text: bool = False
) -> DataFrame:
    """Part B with the ship name of Part A where one was heard in that second.

    A left join on ``(mmsi, timestamp)``, which lead the output.  The names'
    size is not known beforehand, so the strategy is left to Spark.  Reports
    without a time match nothing and stay out of the join, where they would
    all meet in the task of the null key; on a stored table the filter for
    them is answered by the Parquet statistics.
    """
    names = name_parts(messages.where(F.col("timestamp").isNotNull()), trim_text)
    details = detail_parts(messages, by_number_only, trim_text)
    order = [
        "mmsi",
        "timestamp",
        *[c for c in details.columns if c not in ("mmsi", "timestamp")],
        "ship_name",
    ]
    timed = details.where(F.col("timestamp").isNotNull())
    untimed = details.where(F.col("timestamp").isNull())
    return (
        timed.join(names, ["mmsi", "timestamp"], "left")
        .select(*order)
        .unionByName(
            untimed.withColumn("ship_name", F.lit(None).cast("string")).select(*order)
        )
    )
