"""Near-duplicate texts: alike by 0.8 or more in the sets of their 5-word shingles.

Candidates come from fingerprints of the shingles, through the fuzzy Golay keys
of ``near_dedup``, which find all that differ in at most two bits.  Texts alike
by just 0.8 differ in ten of 64, and keys for that many errors would be shared
by chance, the more the larger the corpus.  Texts further apart are therefore met
through bands of minimum hashes: two texts alike by s share one of ``BANDS``
bands of ``ROWS`` with probability ``1 - (1 - s**ROWS)**BANDS``, 0.9998 at 0.8.
Every candidate pair is then compared on the texts themselves.

Texts with the same shingles are one node from the beginning.  The nodes of one
band, or of fingerprints that links connect, are a group.  A group of up to
``PAIRED`` nodes is compared pair by pair.  The nodes of a larger one are compared
with its smallest and its largest first, which settles most of them; what may be
alike among those still apart is then found exactly, see ``_rest``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbor.llm import near_dedup
from harbor.llm.components import components
from harbor.llm.simhash import fingerprints
from harbor.llm.storage import stored
from harbor.llm.texts import Texts, map_texts, mix, slices, texts_of

SHINGLE_WORDS = 5
SIMILARITY = 0.8

BANDS, ROWS = 16, 4
#: Nodes of one group that are compared pair by pair at once.
PAIRED = 16
#: Nodes with one shingle in common that one block of the join holds; of no effect on results.
BLOCK = 1024

#: Bits that tell sets apart before their texts are compared; of no effect on results.
MARKS = 512

# Far above what products of sizes are rounded by, far below one shingle.
_SLACK = 1e-6

_random = np.random.default_rng(17)
_FACTORS = _random.integers(1 << 62, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: Texts, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of every text, hashed and in order, and where each text's begin.

    A to Z in lower case; a text of fewer words is one shingle, of none has none.
    """
    words = texts.lower().words
    counts = words.counts
    held, made = [], []
    for n in range(1, size + 1):
        at, value = words.windows(n)
        text_of = words.text_of[at]
        if n < size:
            whole = counts[text_of] == n
            text_of, value = text_of[whole], value[whole]
        held.append(text_of)
        made.append(value)
    text_of, value = np.concatenate(held), np.concatenate(made)
    order = np.lexsort((value, text_of))
    text_of, value = text_of[order], value[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (text_of[1:] != text_of[:-1])
    text_of, value = text_of[new], value[new]
    return value, np.searchsorted(text_of, np.arange(len(texts) + 1))


def _bands(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of ``BANDS`` keys per text; texts without shingles all have the same."""
    counts = np.diff(first)
    rows = np.flatnonzero(counts)
    least = np.zeros((BANDS * ROWS, len(counts)), np.uint64)
    if len(rows):
        for i, factor in enumerate(_FACTORS):
            turned = hashes * factor
            turned ^= turned >> np.uint64(29)
            least[i, rows] = np.minimum.reduceat(turned * factor, first[:-1][rows])
    keys = np.zeros((BANDS, len(counts)), np.uint64)
    for band in range(BANDS):
        key = np.full(len(counts), band + 1, np.uint64)
        for row in range(ROWS):
            key = mix(key * _FACTORS[row] + least[band * ROWS + row])
        keys[band] = key
    return keys.T


def _nodes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number for every set of shingles."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes), dtype=np.uint64)])
    counts = np.diff(first).astype(np.uint64)
    return mix((sums[first[1:]] - sums[first[:-1]]) ^ (counts * _FACTORS[0]))


def with_signatures(docs: DataFrame, text: bool = False) -> DataFrame:
    """``doc_id, node``, and ``fp, bands`` or the ``text`` itself, of every row."""
    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("node", T.LongType())]
    if text:
        fields.append(T.StructField("text", T.StringType()))
    else:
        fields.append(T.StructField("fp", T.LongType()))
        fields.append(T.StructField("bands", T.ArrayType(T.LongType())))
    schema = T.StructType(fields)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, first = shingle_sets(texts_of(batch.column("text")))
            columns = [batch.column("doc_id"), pa.array(_nodes(hashes, first).view(np.int64))]
            if text:
                columns.append(batch.column("text"))
            else:
                keys = pa.array(_bands(hashes, first).ravel().view(np.int64))
                offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * BANDS)
                columns.append(pa.array(fingerprints(hashes, first).view(np.int64)))
                columns.append(pa.ListArray.from_arrays(offsets, keys))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_texts(docs.select("doc_id", "text"), made, schema)


def _groups(nodes: DataFrame) -> DataFrame:
    """``key, node, n, least, most`` of the nodes that share a key with others: a
    band, or fingerprints that links connect.
    """
    prints = nodes.select("fp").distinct()
    roots = components(near_dedup.links(prints), "a", "b").withColumnRenamed("node", "fp")
    linked = nodes.join(roots, "fp", "left").select(
        "node", F.xxhash64(F.lit("fp"), F.coalesce("root", "fp")).alias("key")
    )
    banded = nodes.select("node", F.explode("bands").alias("key"))
    keys = stored(banded.unionByName(linked), "keys")
    sizes = keys.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("node").alias("least"), F.max("node").alias("most")
    )
    return keys.join(sizes.where(F.col("n") > 1), "key")


def _first_pairs(groups: DataFrame, paired: int) -> DataFrame:
    """``u, v``: the pairs of small groups, and the nodes of large ones with their two ends."""
    few = groups.where(F.col("n") <= paired).select("key", "node")
    pairs = few.withColumnRenamed("node", "u").join(few.withColumnRenamed("node", "v"), "key")
    many = groups.where(F.col("n") > paired)
    ends = many.select(F.col("node").alias("u"), F.explode(F.array("least", "most")).alias("v"))
    return pairs.select("u", "v").union(ends)


def _apart(groups: DataFrame, roots: DataFrame, paired: int) -> DataFrame:
    """``node, root`` of the nodes of large groups that are not one component yet."""
    many = groups.where(F.col("n") > paired).select("key", "node")
    placed = many.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ends = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    apart = ends.where(F.col("low") < F.col("high")).select("key")
    return placed.join(apart, "key", "left_semi").select("node", "root").distinct()


def _marks(texts: DataFrame) -> DataFrame:
    """``node, marks`` of each ``node, text``: for each of ``MARKS`` remainders of a
    shingle, whether an odd number of the set's shingles have it, in longs.

    Two sets differ in at least as many shingles as their marks in bits.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, first = shingle_sets(texts_of(batch.column("text")))
            n = batch.num_rows
            text_of = np.repeat(np.arange(n), np.diff(first))
            mark = (mix(hashes) % np.uint64(MARKS)).astype(np.int64)
            odd = np.bincount(text_of * MARKS + mark, minlength=n * MARKS) & 1
            longs = np.packbits(odd.astype(np.uint8)).view(np.int64)
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * (MARKS // 64))
            held = pa.ListArray.from_arrays(offsets, pa.array(longs))
            yield pa.RecordBatch.from_arrays([batch.column("node"), held], names=["node", "marks"])

    return map_texts(texts.select("node", "text"), made, "node long, marks array<long>")


def _with_shingles(texts: DataFrame) -> DataFrame:
    """``node, size, shingle``: one row for every shingle of each ``node, text``."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, first = shingle_sets(texts_of(batch.column("text")))
            held = pa.ListArray.from_arrays(
                pa.array(first.astype(np.int32)), pa.array(hashes.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays([batch.column("node"), held], names=["node", "shingles"])

    sets = map_texts(texts.select("node", "text"), made, "node long, shingles array<long>")
    return sets.select("node", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))


def _early(apart: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, shingle, size, left, marks``: the shingles through which nodes may be alike.

    With all shingles in one order, the rarest first, two sets that share a part
    ``SIMILARITY`` of what they hold together have their first common shingle so
    early in both that enough of either is ``left`` from there.
    """
    held = _with_shingles(texts).join(apart.select("node"), "node")
    counts = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("n_nodes"))
    place = F.row_number().over(W.partitionBy("node").orderBy("n_nodes", "shingle"))
    # What is left of the set from the shingle on, itself included.
    left = F.col("size") - place + 1
    early = held.join(counts, "shingle").select("node", "shingle", "size", left.alias("left"))
    early = early.where(F.col("left") >= SIMILARITY * F.col("size") - _SLACK)
    return early.join(_marks(texts), "node")


# What is known of a node at each of its early shingles.
_AT = ("node", "size", "left", "marks")


def _may_be_alike() -> Column:
    """Of two nodes at a common shingle: whether enough of either is left, and their
    marks leave them few enough shingles to differ in.
    """
    both = F.col("size_u") + F.col("size_v")
    left = F.least("left_u", "left_v") >= SIMILARITY / (1 + SIMILARITY) * both - _SLACK
    bits = [
        F.bit_count(F.get("marks_u", F.lit(i)).bitwiseXOR(F.get("marks_v", F.lit(i))))
        for i in range(MARKS // 64)
    ]
    return left & (sum(bits) <= (1 - SIMILARITY) / (1 + SIMILARITY) * both + _SLACK)


def _ends(early: DataFrame) -> DataFrame:
    """``u, v``: the nodes of each shingle with its smallest and its largest."""
    row = F.struct(*_AT)
    ends = early.groupBy("shingle").agg(F.min(row).alias("least"), F.max(row).alias("most"))
    ends = ends.where(F.col("least.node") < F.col("most.node"))
    return (
        early.select("shingle", *[F.col(c).alias(f"{c}_u") for c in _AT])
        .join(ends, "shingle")
        .withColumn("end", F.explode(F.array("least", "most")))
        .select("*", *[F.col("end")[c].alias(f"{c}_v") for c in _AT])
        .where(_may_be_alike())
        .select(F.col("node_u").alias("u"), F.col("node_v").alias("v"))
    )


def _rest(apart: DataFrame, early: DataFrame, block: int = BLOCK) -> DataFrame:
    """``u, v``: all pairs of different roots in ``apart`` that may be alike.

    Whatever has a shingle in common that early is a pair, so none that is alike
    is lost.  Of each shingle's nodes only those beside its commonest root are
    compared with all, in blocks of the others.
    """
    early = early.join(apart, "node")
    roots = early.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("n"))
    shared = (
        roots.groupBy("shingle")
        .agg(F.max_by("root", "n").alias("main"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_roots"))
        .where(F.col("n_roots") > 1)
        .select("shingle", "main", F.ceil(F.col("n") / block).alias("blocks"))
    )
    met = early.join(shared, "shingle")
    one = met.where(F.col("root") != F.col("main")).select(
        "shingle",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        *[F.col(c).alias(f"{c}_u") for c in ("root", *_AT)],
    )
    other = met.select(
        "shingle",
        F.pmod("node", "blocks").alias("block"),
        *[F.col(c).alias(f"{c}_v") for c in ("root", *_AT)],
    )
    return (
        one.join(other, ["shingle", "block"])
        .where(F.col("root_u") != F.col("root_v"))
        .where(_may_be_alike())
        .select(F.col("node_u").alias("u"), F.col("node_v").alias("v"))
    )


def _texts(met: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, text``: one text of every ``node`` in ``met``."""
    ids = nodes.join(met.select("node").distinct(), "node").select("doc_id").distinct()
    texts = with_signatures(docs.join(ids, "doc_id", "left_semi"), text=True)
    return stored(texts.groupBy("node").agg(F.min("text").alias("text")), "candidate-texts")


def _similar(pairs: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs ``u, v`` whose texts are alike enough, each once."""
    pairs = stored(
        pairs.where(F.col("u") != F.col("v"))
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct(),
        "pairs",
    )
    texts = _texts(pairs.select(F.col("u").alias("node")).union(pairs.select("v")), docs, nodes)
    both = pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("one")), "u").join(
        texts.select(F.col("node").alias("v"), F.col("text").alias("text")), "v"
    )

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = []
            for name in ("one", "text"):
                hashes, first = shingle_sets(texts_of(batch.column(name)))
                sets.append([hashes[a:b] for a, b in zip(first[:-1], first[1:])])
            alike = np.zeros(batch.num_rows, dtype=bool)
            for i, (a, b) in enumerate(zip(*sets)):
                shared = len(np.intersect1d(a, b, assume_unique=True))
                alike[i] = shared >= SIMILARITY * (len(a) + len(b) - shared)
            yield batch.select(["u", "v"]).filter(pa.array(alike))

    found = map_texts(both.select("u", "v", "one", "text"), compared, "u long, v long")
    return stored(found, "similar")


def near_duplicates(docs: DataFrame, paired: int = PAIRED) -> DataFrame:
    """One row per row of ``docs`` with an id: ``doc_id, component_id``.

    ``component_id`` is the smallest ``doc_id`` that similar texts lead to.
    Null texts read as empty, and texts without words are alike.  Repeated rows
    and ids each keep their row, rows without an id are left out, other columns
    are ignored, and an empty table gives an empty result.
    """
    known = docs.where(F.col("doc_id").isNotNull())
    signed = stored(with_signatures(known), "signatures")
    nodes = stored(
        signed.groupBy("node").agg(
            F.min("doc_id").alias("doc_id"),
            F.any_value("fp").alias("fp"),
            F.any_value("bands").alias("bands"),
        ),
        "nodes",
    )
    groups = stored(_groups(nodes), "groups")
    alike = _similar(_first_pairs(groups, paired), known, nodes)
    roots = components(alike, "u", "v")
    apart = stored(_apart(groups, roots, paired), "apart")
    if not apart.isEmpty():
        early = stored(_early(apart, _texts(apart, known, nodes)), "early-shingles")
        # A text has many shingles, and each has ends of its own: what is alike
        # mostly becomes one here, so that few pairs are left to be compared.
        alike = alike.union(_similar(_ends(early), known, nodes))
        roots = components(alike, "u", "v")
        apart = stored(_apart(groups, roots, paired), "still-apart")
    if not apart.isEmpty():
        others = _similar(_rest(apart, early), known, nodes)
        roots = components(alike.union(others), "u", "v")
    # A repeated id joins what its texts belong to.
    rooted = nodes.select("node", "doc_id").join(roots, "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    smallest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(smallest, "root").select("node", "component_id")
    return signed.select("doc_id", "node").join(named, "node").select("doc_id", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id, all columns.

    Rows with that id more than once come down to the smallest of them, by the
    other columns in their order.  Rows without an id cannot be named as
    copies and stay.
    """
    found = near_duplicates(docs)
    first = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    others = [c for c in docs.columns if c != "doc_id"]
    rows = docs.join(first, "doc_id", "left_semi")
    one = rows.groupBy("doc_id").agg(F.min(F.struct(*others)).alias("__row"))
    kept = one.select("doc_id", *[F.col("__row")[c].alias(c) for c in others])
    return kept.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))
