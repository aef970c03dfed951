"""Filter interaction audit: what each filter removes, alone and among others.

The filters of a corpus form a game: a coalition of them is worth the documents
that at least one of its members removes.  The potential of Hart and Mas-Colell
is defined by removing one filter at a time,

    P(T) * |T| = worth(T) + sum of P(T without i) over i in T,

and a filter's Shapley value is P(all) - P(all without it).  With every potential
times ``n!`` all of it stays in whole numbers, and the value is the sum of what
the filter removes over all orders.  What one step of one order removes is the
difference between two coalitions' worths.

Documents are met once, to be counted by part and set of failed filters; all
that follows works on ``2 ** n`` counts per part.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harbor.llm.storage import stored

_SEPARATORS = r"[\x20\x09-\x0D]+"

# The bounds of the text filters.
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
SYMBOLS = r"[#$%&*|]"


def text_failures(text: Column) -> dict[str, Column]:
    """The filters A to D: few words, repeated words, capitals, symbols.

    ``text`` must not be null; an empty one has no words and fails A only.
    """
    words = F.filter(F.split(text, _SEPARATORS), lambda w: w != "")
    n_words = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": n_words < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * n_words,
        "C": 100 * capitals.cast("long") > MAX_CAPITALS_PERCENT * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def document_failures(docs: DataFrame, part: str = "source") -> DataFrame:
    """``doc_id, part, A, B, C, D, E`` of every row; E is a text that a smaller id has.

    Null texts and parts read as empty.  A row without an id has no smaller one
    and is none; repeated rows do not fail E for each other.  Texts are compared
    by their SHA-256.  The digests are kept in the shared folder, and a text's
    smallest id is joined to its own row alone, so a text that very many rows
    share makes no large group.
    """
    text = F.coalesce("text", F.lit(""))
    facts = stored(
        docs.select(
            "doc_id",
            F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
            text.alias("__text"),
        ).select(
            "doc_id",
            "part",
            F.unhex(F.sha2("__text", 256)).alias("__digest"),
            *[failed.alias(name) for name, failed in text_failures(F.col("__text")).items()],
        ),
        "audit",
    )
    first = (
        facts.where(F.col("doc_id").isNotNull())
        .groupBy("__digest")
        .agg(F.min("doc_id").alias("doc_id"))
        .withColumn("__first", F.lit(True))
    )
    copy = F.col("__first").isNull() & F.col("doc_id").isNotNull()
    return facts.join(first, ["__digest", "doc_id"], "left").select(
        "doc_id", "part", "A", "B", "C", "D", copy.alias("E")
    )


def _potential(worth: Column, n: int) -> Column:
    """Potentials of all coalitions, by mask, times ``n!``; ``worth`` likewise by mask."""

    def of_one(found: Column, coalition: Column) -> Column:
        total = F.lit(factorial(n)) * F.get(worth, coalition)
        for i in range(n):
            member = coalition.bitwiseAND(1 << i) != 0
            without = F.get(found, coalition.bitwiseXOR(1 << i))
            total = total + F.when(member, without).otherwise(F.lit(0))
        return F.array_append(found, F.call_function("div", total, F.bit_count(coalition)))

    empty = F.array(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << n) - 1)), empty, of_one)


def audit(rows: DataFrame, filters: str, tallies: Mapping[str, str]) -> DataFrame:
    """What every step of every order of the filters does, by ``part``.

    ``filters`` names boolean columns of one letter each, true where a document
    fails (null: it does not); ``tallies`` maps result columns to boolean ones,
    whose true values are counted among the removed.  One row per part, order
    and step: ``part, filter_order, step, kept, removed, redundant,
    unique_fails``, the tallies, and ``shapley``, the sum of what the step's
    filter removes over all orders.  Repeated rows count each, null is a part
    of its own, an empty table has no parts, and other columns are ignored.
    Orders grow with the factorial of the filters: meant for a handful.
    """
    n = len(filters)
    everyone = (1 << n) - 1
    mask = sum(
        (F.when(F.col(name), 1 << i).otherwise(0) for i, name in enumerate(filters)), F.lit(0)
    )
    counts = ["n", *tallies]
    profile = (
        rows.select("part", mask.alias("mask"), *[F.col(c).alias(t) for t, c in tallies.items()])
        .groupBy("part", "mask")
        .agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(t)).alias(t) for t in tallies])
    )
    # At most one cell for each set of filters.
    cells = profile.groupBy("part").agg(F.collect_list(F.struct("mask", *counts)).alias("cells"))

    def worth(count: str) -> Column:
        """By coalition, how many documents at least one of its filters removes."""

        def of_one(coalition: Column) -> Column:
            return F.aggregate(
                "cells",
                F.lit(0).cast("long"),
                lambda total, cell: total
                + F.when(cell["mask"].bitwiseAND(coalition) != 0, cell[count]).otherwise(0),
            )

        return F.transform(F.sequence(F.lit(0), F.lit(everyone)), of_one)

    total = F.aggregate("cells", F.lit(0).cast("long"), lambda t, cell: t + cell["n"])
    games = cells.select("part", total.alias("total"), *[worth(c).alias(f"v_{c}") for c in counts])
    games = games.withColumn("potential", _potential(F.col("v_n"), n))

    orders = F.array(*[F.lit("".join(order)) for order in permutations(filters)])
    steps = (
        games.withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(n))))
        .withColumn("name", F.substr("filter_order", F.col("step"), F.lit(1)))
    )
    # As masks: the step's filter, those before it, and both.
    own, before = F.lit(0), F.lit(0)
    for i, name in enumerate(filters):
        own = F.when(F.col("name") == name, 1 << i).otherwise(own)
        before = before + F.when(F.instr("filter_order", name) < F.col("step"), 1 << i).otherwise(0)
    steps = steps.withColumn("own", own).withColumn("before", before)
    own, before = F.col("own"), F.col("before")
    after = before.bitwiseOR(own)
    others = F.lit(everyone).bitwiseXOR(own)

    def gained(array: str, more: Column, less: Column) -> Column:
        return F.get(F.col(array), more) - F.get(F.col(array), less)

    removed = gained("v_n", after, before)
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.get("v_n", after)).alias("kept"),
        removed.alias("removed"),
        (F.get("v_n", own) - removed).alias("redundant"),
        gained("v_n", F.lit(everyone), others).alias("unique_fails"),
        *[gained(f"v_{t}", after, before).alias(t) for t in tallies],
        gained("potential", F.lit(everyone), others).alias("shapley"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """The audit of filters A to E over ``docs``, with the good and the toxic lost.

    A document is good, or toxic, if any row of ``labels`` with its id has
    quality 1, or toxic 1; without one it is neither.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(
            F.bool_or(F.col("quality") == 1).alias("good"),
            F.bool_or(F.col("toxic") == 1).alias("bad"),
        )
    )
    rows = document_failures(docs, part).join(known, "doc_id", "left")
    return audit(rows, "ABCDE", {"good_lost": "good", "toxic_lost": "bad"})
