"""Near-duplicates by SimHash, found with fuzzy keys of the Golay code.

A fingerprint's 64 bits are three segments.  Of two fingerprints that differ in
at most two bits, some segment is equal in both, and the segment after it
differs in at most two bits and so shares a Golay key.  Hence the keys: each
segment as it is, with each Golay key of the next.  Equal keys are joined and
the distance is checked, so the links are exactly those of the definition.

Copies are folded into one fingerprint first.  A key that very many
fingerprints share is not joined with itself: its fingerprints are linked
through the patterns one bit from them instead, which two fingerprints have in
common exactly if they are at most two bits apart.  One link to the smallest
fingerprint of a pattern then stands for all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbor.llm import golay
from harbor.llm.components import components
from harbor.llm.simhash import fingerprint_texts
from harbor.llm.storage import stored
from harbor.llm.texts import map_texts, slices

#: Largest number of differing bits at which fingerprints link.
RADIUS = 2
SHINGLE_WORDS = 3

#: First bit and length of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))

#: Fingerprints of one key that are still compared pair by pair.
PAIRED = 64


def with_fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp`` for every row; the fingerprint as a signed 64-bit number."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("fp", T.LongType())]
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column = batch.column("text").cast(pa.binary()).to_pylist()
            prints = fingerprint_texts([t or b"" for t in column], size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(prints.view(np.int64))], names=schema.names
            )

    return map_texts(docs.select("doc_id", "text"), made, schema)


def fuzzy_keys(nodes: DataFrame) -> DataFrame:
    """``key, fp`` for each of the keys of each fingerprint, at most 18."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            bits = prints.view(np.uint64)
            parts = [
                (bits >> np.uint64(first)) & np.uint64((1 << length) - 1)
                for first, length in SEGMENTS
            ]
            for exact in range(3):
                near = (exact + 1) % 3
                row, key = golay.keys(parts[near], SEGMENTS[near][1])
                whole = parts[exact][row] << np.uint64(12) | key.astype(np.uint64)
                whole |= np.uint64(exact << 36)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(whole.view(np.int64)), pa.array(prints[row])], names=["key", "fp"]
                )

    return map_texts(nodes.select("fp"), made, "key long, fp long")


def links(nodes: DataFrame, paired: int = PAIRED) -> DataFrame:
    """``a, b`` that connect what fingerprints at most ``RADIUS`` bits apart connect."""
    keys = stored(fuzzy_keys(nodes), "fuzzy-keys")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = keys.join(sizes, "key")
    few = shared.where(F.col("n") <= paired)
    left, right = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    pairs = left.join(right, "key").where(F.col("a") < F.col("b")).where(near).select("a", "b")

    many = shared.where(F.col("n") > paired).select("fp").distinct()
    flips = F.concat(
        F.array(F.lit(0).cast("long")),
        F.transform(
            F.sequence(F.lit(0), F.lit(63)),
            lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i),
        ),
    )
    beside = many.select(
        "fp", F.explode(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f))).alias("z")
    )
    least = beside.groupBy("z").agg(F.min("fp").alias("b"), F.max("fp").alias("__most"))
    through = (
        beside.join(least.where(F.col("b") < F.col("__most")), "z")
        .where(F.col("fp") != F.col("b"))
        .select(F.col("fp").alias("a"), "b")
    )
    return pairs.union(through).distinct()


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fp, component_id``.

    ``component_id`` is the smallest ``doc_id`` that links of at most two
    differing bits reach.  Texts without words, null ones too, have the
    fingerprint zero and link like any other.  A null ``doc_id`` is never the
    smallest; a component without any id has a null one.  Repeated rows and
    ids each keep their row; other columns are ignored; an empty table gives
    an empty result.
    """
    prints = stored(with_fingerprints(docs, size), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    roots = components(links(nodes), "a", "b").select(F.col("node").alias("fp"), "root")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """One document of each component, the one with the smallest id, all columns.

    Rows with that id more than once come down to the smallest of them, by the
    other columns in their order.  Rows without an id cannot be named as
    copies and stay.
    """
    found = near_duplicates(docs, size)
    first = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    others = [c for c in docs.columns if c != "doc_id"]
    rows = docs.join(first, "doc_id", "left_semi")
    one = rows.groupBy("doc_id").agg(F.min(F.struct(*others)).alias("__row"))
    kept = one.select("doc_id", *[F.col("__row")[c].alias(c) for c in others])
    return kept.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def as_hex(fp: str = "fp") -> Column:
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
