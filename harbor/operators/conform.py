"""Checks of a decoded table against an independent one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harbor.operators.ranks import with_rank

# What an independent decoder leaves in place of "not available".
_ABSENT_EQUAL = {
    "true_heading": 511,
    "x": 181.0,
    "y": 91.0,
    "cog": 260,
    "eta_month": 0,
    "eta_day": 0,
    "eta_hour": 24,
    "eta_minute": 60,
}
_ABSENT_ABOVE = {"timestamp": 59, "sog": 102.3}
_ABSENT_BEYOND = {"rot": 720.1}  # either sign


def rename_select(table: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The columns that have a new name, renamed, in the table's own order."""
    return table.select(*[F.col(c).alias(names[c]) for c in table.columns if c in names])


def dashes(text: Column) -> Column:
    """Underscores to dashes, as the independent decoder writes them."""
    return F.translate(text, "_", "-")


def corrected(table: DataFrame) -> DataFrame:
    """Booleans to 0 and 1, backticks in text to apostrophes."""
    columns = []
    for name, dtype in table.dtypes:
        column = F.col(name)
        if dtype == "boolean":
            column = column.cast("int").alias(name)
        elif dtype == "string":
            column = F.translate(column, "`", "'").alias(name)
        columns.append(column)
    return table.select(*columns)


def with_absent_as_null(table: DataFrame) -> DataFrame:
    """Null in place of the values that stand for "not available"."""
    columns = []
    for name in table.columns:
        column = F.col(name)
        if name in _ABSENT_EQUAL:
            column = F.when(column != _ABSENT_EQUAL[name], column)
        elif name in _ABSENT_ABOVE:
            column = F.when(~(column > _ABSENT_ABOVE[name]), column)
        elif name in _ABSENT_BEYOND:
            column = F.when(~(F.abs(column) > _ABSENT_BEYOND[name]), column)
        columns.append(column.alias(name))
    return table.select(*columns)


def different_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows found on one side only, with ``side``.

    One grouping of both tables finds both differences; nulls compare equal.
    Empty when the tables hold the same distinct rows.
    """
    columns = left.columns
    both = left.select(*columns, F.lit(True).alias("__left")).unionByName(
        right.select(*columns, F.lit(False).alias("__left"))
    )
    return (
        both.groupBy(*columns)
        .agg(F.max("__left").alias("__in_left"), F.min("__left").alias("__all_left"))
        .where(F.col("__in_left") == F.col("__all_left"))
        .select(*columns, F.when(F.col("__in_left"), "left").otherwise("right").alias("side"))
    )


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """True when both tables hold the same distinct rows."""
    return different_rows(left, right).isEmpty()


def compare_by_key(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    tolerances: Mapping[str, float] | None = None,
    tolerance: float = 0.0,
    by_rank: bool = False,
) -> DataFrame:
    """Compare two tables row by row, rows paired by ``keys``.

    One row per compared column: rows paired, rows that differ by more than the
    column's tolerance, and the largest difference of a numeric column.  Three
    more rows count the rows whose key is on one side only
    (``(left only)``, ``(right only)``) and those whose key is not unique on a
    side (``(ambiguous)``); the latter are not paired, unless both sides hold
    the same rows under that key, in which case they are equal.

    With ``by_rank`` the rows of a repeated key are paired as well: both sides
    are put in order, by the values that must be equal and then by those with a
    tolerance, and the first meets the first.  Rows that one side has more of
    are counted as that side's only, and none is ambiguous.

    Both tables go through one grouping with state of fixed size per key, so a
    key shared by a large share of the rows costs no more than any other.
    """
    tolerances = dict(tolerances or {})
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    dtypes = dict(left.dtypes)
    values = [c for c in left.columns if c not in keys]
    if by_rank:
        loose = [c for c in values if dtypes[c] in numeric and tolerances.get(c, tolerance) > 0]
        order = [c for c in values if c not in loose] + loose
        left = with_rank(left, keys, order, "__rank")
        right = with_rank(right.select(*left.columns[:-1]), keys, order, "__rank")
        keys = [*keys, "__rank"]

    def tagged(table: DataFrame, is_left: bool) -> DataFrame:
        return table.select(*keys, *values, F.lit(is_left).alias("__left"))

    def digest(seed: int) -> Column:
        # A null leaves a hash unchanged, so every value comes with a flag.
        told = [part for c in values for part in (F.col(c).isNull(), F.col(c))]
        return F.xxhash64(F.lit(seed), *told).cast("decimal(38,0)")

    on_left = F.col("__left")
    grouped = (
        # United first, so that both sides are hashed in the same types.
        tagged(left, True)
        .unionByName(tagged(right, False))
        .select(
            *keys,
            "__left",
            F.struct(*values).alias("__row"),
            digest(1).alias("__digest"),
            digest(2).alias("__other"),
        )
        .groupBy(*keys)
        .agg(
            F.count_if(on_left).alias("__n_left"),
            F.count_if(~on_left).alias("__n_right"),
            F.min(F.when(on_left, F.col("__row"))).alias("__l"),
            F.min(F.when(~on_left, F.col("__row"))).alias("__r"),
            F.sum(F.when(on_left, F.col("__digest"))).alias("__sum_l"),
            F.sum(F.when(~on_left, F.col("__digest"))).alias("__sum_r"),
            F.sum(F.when(on_left, F.col("__other"))).alias("__other_l"),
            F.sum(F.when(~on_left, F.col("__other"))).alias("__other_r"),
        )
    )
    n_left, n_right = F.col("__n_left"), F.col("__n_right")
    alike = (
        (n_left == n_right)
        & (F.col("__sum_l") == F.col("__sum_r"))
        & (F.col("__other_l") == F.col("__other_r"))
    )
    status = (
        F.when(n_right == 0, "left only")
        .when(n_left == 0, "right only")
        .when((n_left == 1) & (n_right == 1), "paired")
        .when(alike, "alike")
        .otherwise("ambiguous")
    )
    judged = grouped.withColumn("__status", status)
    paired = F.col("__status") == "paired"
    matched = paired | (F.col("__status") == "alike")

    def total(rows: Column, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, rows)), F.lit(0).cast("long"))

    def line(name: str, n_rows: Column, n_different: Column, largest: Column) -> Column:
        return F.struct(
            F.lit(name).alias("column"),
            n_rows.alias("n_rows"),
            n_different.alias("n_different"),
            largest.cast("double").alias("max_difference"),
        )

    lines = []
    n_matched = total(n_left, matched)
    for name in values:
        l, r = F.col(f"__l.{name}"), F.col(f"__r.{name}")
        gap = F.lit(None)
        differs = ~l.eqNullSafe(r)
        if dtypes[name] in numeric:
            gap = F.abs(l.cast("double") - r.cast("double"))
            limit = tolerances.get(name, tolerance)
            differs = F.when(l.isNull() | r.isNull(), differs).otherwise(gap > limit)
        lines.append(
            line(
                name,
                n_matched,
                total(F.lit(1), paired & differs),
                F.max(F.when(paired, gap)),
            )
        )
    for label, rows in (
        ("left only", n_left),
        ("right only", n_right),
        ("ambiguous", n_left + n_right),
    ):
        n = total(rows, F.col("__status") == label)
        lines.append(line(f"({label})", n, n, F.lit(None)))
    return judged.agg(F.array(*lines).alias("__lines")).select(F.inline("__lines"))
