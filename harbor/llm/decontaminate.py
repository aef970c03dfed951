"""Benchmark decontamination by SimHash over windows the size of an item.

For an item of ``n`` words, the windows are all runs of ``n`` words of a
document (the whole document where it is shorter).  A window and an item have
64-bit fingerprints of their words.  The bits are cut into four blocks: of two
fingerprints within the radius, some block differs in at most a quarter of the
radius, so an item is listed under every such variant of its four blocks and
windows look their own four blocks up.  That finds all fingerprints within the
radius.  A passage can be similar enough and yet have a fingerprint further
off, so windows and items also look each other up by shingles: of two texts
that share enough of them, the first few in the order of their hashes have one
in common.  Candidates are then compared on the texts themselves.

The similarity is that of the word shingles, each weighted by how often it
occurs: twice the shared weight over the sum of both weights.

A window cannot reach the similarity unless enough of its shingles occur in
items of its size.  A bit filter of all item shingles, of fixed size, tells
that for whole batches of text, so only few windows are fingerprinted.  The
filter may let windows pass in vain and never loses one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbor.llm.storage import stored
from harbor.llm.texts import Texts, map_texts, mix, slices, texts_of

SHINGLE_WORDS = 5
SIMILARITY = 0.8

#: Fingerprints at most this far apart are compared, whatever their shingles.
RADIUS = 15
BLOCKS, BLOCK_BITS = 4, 16

#: Bits of the shingle filter: 2 MB.
FILTER_BITS = 1 << 24

_SIZE_SALT = 0x9E3779B97F4A7C15


def _slots(hashes: np.ndarray, size: int) -> np.ndarray:
    """Place in the filter of shingles of items of ``size`` words; 0 for any size."""
    salt = np.uint64(size * _SIZE_SALT & (2**64 - 1))
    return mix(hashes ^ salt) & np.uint64(FILTER_BITS - 1)


def _shingle_size(size: int) -> int:
    return min(size, SHINGLE_WORDS)


def _needed(window: int, item: int, similarity: float) -> int:
    """Shared shingles without which a window cannot be that similar to an item."""
    s = _shingle_size(item)
    total = max(window - s + 1, 0) + item - s + 1
    return max(1, int(np.ceil(similarity * total / 2 - 1e-9)))


def _first_shingles(values: np.ndarray, n: int) -> np.ndarray:
    """Keys of the ``n`` shingles whose hashes are smallest, a repeated one told by its turn."""
    values = np.sort(values)
    turn = np.arange(len(values)) - np.searchsorted(values, values)
    return mix(values + turn.astype(np.uint64) * np.uint64(_SIZE_SALT))[:n].view(np.int64)


def _item_keys(values: np.ndarray, size: int, similarity: float) -> np.ndarray:
    """Keys of an item for windows of any length, the shortest included."""
    s = _shingle_size(size)
    lengths = range(s, size + 1)
    need = min(n for w in lengths if (n := _needed(w, size, similarity)) <= w - s + 1)
    return _first_shingles(values, len(values) - need + 1)


def _bit_sums(hashes: np.ndarray) -> np.ndarray:
    """Running sums of the words' bits as plus and minus one."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(2 * bits.astype(np.int32) - 1, axis=0, out=sums[1:])
    return sums


def _signed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=-1, bitorder="little").view(np.uint64).ravel()


def item_table(items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``item_id, size, fp, said, slots, keys`` of the items that have words."""
    schema = T.StructType(
        [
            T.StructField("item_id", items.schema["item_id"].dataType),
            T.StructField("size", T.IntegerType()),
            T.StructField("fp", T.LongType()),
            T.StructField("said", T.StringType()),
            T.StructField("slots", T.ArrayType(T.LongType())),
            T.StructField("keys", T.ArrayType(T.LongType())),
        ]
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = texts_of(batch.column("text")).lower()
            words = texts.words
            rows = []
            for i, item in enumerate(batch.column("item_id").to_pylist()):
                a, b = int(words.first[i]), int(words.first[i + 1])
                if a == b:
                    continue
                size = b - a
                at, value = words.windows(_shingle_size(size))
                own = value[(at >= a) & (at < b)]
                slots = np.concatenate([_slots(own, 0), _slots(own, size)])
                fp = _signed(_bit_sums(words.hash[a:b])[-1:])
                keys = _item_keys(own, size, similarity)
                rows.append((item, size, int(fp.view(np.int64)[0]), _said(texts, a, b), slots, keys))
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], batch.schema.field("item_id").type),
                    pa.array(columns[1], pa.int32()),
                    pa.array(columns[2], pa.int64()),
                    pa.array(columns[3], pa.string()),
                    pa.array([s.astype(np.int64) for s in columns[4]], pa.list_(pa.int64())),
                    pa.array(columns[5], pa.list_(pa.int64())),
                ],
                names=schema.names,
            )

    return map_texts(items.select("item_id", "text"), made, schema)


def _said(texts: Texts, a: int, b: int) -> str:
    """Words ``a`` to ``b`` with single spaces."""
    data, start, end = texts.data, texts.words.start, texts.words.end
    return b" ".join(data[s:e].tobytes() for s, e in zip(start[a:b], end[a:b])).decode()


def shingle_filter(items: DataFrame) -> np.ndarray:
    """The filter's bits; what comes to the driver is at most its fixed size."""
    slot = F.col("slot")
    found = (
        items.select(F.explode("slots").alias("slot"))
        .groupBy(F.shiftrightunsigned(slot, 6).alias("place"))
        .agg(
            F.bit_or(
                F.call_function(
                    "shiftleft",
                    F.lit(1).cast("long"),
                    slot.bitwiseAND(F.lit(63)).cast("int"),
                )
            ).alias("bits")
        )
        .toPandas()
    )
    words = np.zeros(FILTER_BITS // 64, np.int64)
    words[found["place"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return np.unpackbits(words.view(np.uint8), bitorder="little").view(bool)


Window = tuple[int, int, int, int, np.ndarray]


def _window_rows(
    texts: Texts, held: np.ndarray, sizes: list[int], similarity: float
) -> Iterator[tuple[int, Window]]:
    """Text number, and of each window to compare first word, length, item size,
    fingerprint and shingle keys."""
    words = texts.words
    for s in sorted({_shingle_size(n) for n in sizes}):
        all_at, all_values = words.windows(s)
        hit = held[_slots(all_values, 0)]
        at, value = all_at[hit], all_values[hit]
        owner = words.text_of[at]
        # Texts with fewer hits than the easiest size needs are done.
        for i in np.unique(owner).tolist():
            mine = owner == i if len(at) < 64 else slice(*np.searchsorted(owner, [i, i + 1]))
            a, b = int(words.first[i]), int(words.first[i + 1])
            place, shingle = at[mine] - a, value[mine]
            sums = None
            for size in (n for n in sizes if _shingle_size(n) == s):
                length = min(size, b - a)
                need = _needed(length, size, similarity)
                if len(place) < need:
                    continue
                flags = np.zeros(b - a - s + 2, np.int64)
                flags[place[held[_slots(shingle, size)]] + 1] = 1
                total = np.cumsum(flags)
                first = np.flatnonzero(
                    total[length - s + 1 :] - total[: len(total) - (length - s + 1)] >= need
                )
                if len(first):
                    sums = _bit_sums(words.hash[a:b]) if sums is None else sums
                    prints = _signed(sums[first + length] - sums[first]).view(np.int64)
                    begin = int(np.searchsorted(all_at, a))
                    n = length - s + 1
                    for f, fp in zip(first.tolist(), prints.tolist()):
                        own = all_values[begin + f : begin + f + n]
                        keys = _first_shingles(own, n - need + 1)
                        yield i, (f, length, size, fp, keys)


def _stretches(
    texts: Texts, rows: Iterator[tuple[int, Window]]
) -> Iterator[tuple[int, int, str, list[Window]]]:
    """Text number, first word, words and windows of each place where windows overlap.

    The words of a place are spelt out once, however many windows cover them.
    """
    by_text: dict[int, list[Window]] = {}
    for i, window in rows:
        by_text.setdefault(i, []).append(window)
    for i, found in by_text.items():
        found.sort(key=lambda w: w[:4])
        held: list[Window] = []
        end = 0
        for window in [*found, None]:
            if held and (window is None or window[0] >= end):
                a = int(texts.words.first[i])
                yield i, held[0][0], _said(texts, a + held[0][0], a + end), held
                held = []
            if window is not None:
                end = max(end, window[0] + window[1]) if held else window[0] + window[1]
                held.append(window)


_WINDOWS = pa.list_(
    pa.struct(
        [
            ("start", pa.int64()),
            ("length", pa.int32()),
            ("size", pa.int32()),
            ("fp", pa.int64()),
            ("keys", pa.list_(pa.int64())),
        ]
    )
)


def windows(docs: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """The places with windows that could be similar enough, overlapping ones together.

    ``doc_id, begin, said, windows``, each window with ``start, length, size, fp,
    keys``; ``start`` counts the words of the document, as ``begin`` does.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(np.packbits(shingle_filter(items)))
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("begin", T.LongType()),
            T.StructField("said", T.StringType()),
            T.StructField(
                "windows",
                T.ArrayType(
                    T.StructType(
                        [
                            T.StructField("start", T.LongType()),
                            T.StructField("length", T.IntegerType()),
                            T.StructField("size", T.IntegerType()),
                            T.StructField("fp", T.LongType()),
                            T.StructField("keys", T.ArrayType(T.LongType())),
                        ]
                    )
                ),
            ),
        ]
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(held.value).view(bool)
        names = ("start", "length", "size", "fp", "keys")
        for batch in slices(batches):
            texts = texts_of(batch.column("text")).lower()
            rows = list(_stretches(texts, _window_rows(texts, bits, sizes, similarity)))
            if rows:
                text_of, begin, said, found = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(text_of)),
                        pa.array(begin, pa.int64()),
                        pa.array(said, pa.string()),
                        pa.array([[dict(zip(names, w)) for w in ws] for ws in found], _WINDOWS),
                    ],
                    names=schema.names,
                )

    return map_texts(docs.select("doc_id", "text"), made, schema)


def _block(fp: str, i: int, flips: Column) -> Column:
    """``block, bits`` of one block of a fingerprint, with each pattern of differing bits."""
    bits = F.shiftrightunsigned(fp, i * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
    return F.transform(
        flips, lambda v: F.struct(F.lit(i).alias("block"), bits.bitwiseXOR(v).alias("bits"))
    )


def _listed(frame: DataFrame, fp: str, variants: list[int]) -> DataFrame:
    """Every row under its blocks and, as one block more, its shingle keys."""
    shingles = F.transform(
        "keys", lambda k: F.struct(F.lit(BLOCKS).alias("block"), k.alias("bits"))
    )
    flips = F.array(*[F.lit(v).cast("long") for v in variants])
    keys = F.concat(*[_block(fp, i, flips) for i in range(BLOCKS)], shingles)
    return frame.select("*", F.inline(keys)).drop("keys")


def _variants(radius: int) -> list[int]:
    """Patterns of the differing bits of a block, by pigeonhole few enough."""
    most = radius // BLOCKS
    return [
        sum(1 << b for b in bits)
        for n in range(most + 1)
        for bits in combinations(range(BLOCK_BITS), n)
    ]


def similarity_of(window: str, item: str) -> float:
    """Shared weight of the word shingles of two texts, from 0 to 1."""
    one, two = window.split(" "), item.split(" ")
    s = _shingle_size(len(two))
    left = Counter(zip(*[one[k:] for k in range(s)]))
    right = Counter(zip(*[two[k:] for k in range(s)]))
    total = left.total() + right.total()
    return 2 * (left & right).total() / total if total else 0.0


@F.pandas_udf(T.DoubleType())
def _similarities(window: pd.Series, item: pd.Series) -> pd.Series:
    return window.combine(item, similarity_of).astype(float)


def leaks(
    docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS
) -> DataFrame:
    """One row per document and item it holds a passage of.

    ``doc_id, item_id, start, n_words, similarity, distance`` of the most
    similar window, of equal ones the first; ``start`` counts words.  Letters A
    to Z are compared in lower case.  Texts and items that are null or have no
    words match nothing; rows with the same id count as one document, and so do
    those without an id; repeated items each have their row once; other columns
    are ignored, and an empty table on either side gives an empty result.
    """
    listed = item_table(items, similarity)
    # Places are told apart by document, first word and words.
    places = stored(
        windows(docs, listed, similarity).withColumn("said_hash", F.xxhash64("said")), "windows"
    )
    index = _listed(
        listed.select("item_id", "size", F.col("fp").alias("item_fp"), "keys"),
        "item_fp",
        _variants(radius),
    )
    said = listed.select(
        "item_id", "size", F.col("fp").alias("item_fp"), F.col("said").alias("item_said")
    )
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))
    # The keys of a window carry its place, not its words.
    place = ["doc_id", "begin", "said_hash"]
    found = places.select(*place, F.inline("windows"))
    met = (
        _listed(found, "fp", [0])
        # The variants multiply the items, so neither side is small enough to broadcast.
        .join(index.hint("merge"), ["size", "block", "bits"])
        .withColumn("distance", distance.cast("int"))
        .where((F.col("block") == BLOCKS) | (F.col("distance") <= radius))
        # Of the blocks and shingles that two meet in, one is enough.
        .dropDuplicates([*place, "start", "length", "size", "item_id", "item_fp"])
    )
    texts = places.select(
        *[F.col(c).alias(f"__{c}") for c in place], F.col("said").alias("stretch")
    )
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in place]
    own = F.slice(
        F.split("stretch", " "), (F.col("start") - F.col("begin") + 1).cast("int"), F.col("length")
    )
    near = (
        met.join(said.hint("merge"), ["item_id", "size", "item_fp"])
        .join(texts, same)
        .withColumn("similarity", _similarities(F.array_join(own, " "), "item_said"))
        .where(F.col("similarity") >= similarity)
    )
    best = F.struct(
        (-F.col("similarity")).alias("order"),
        "start",
        F.col("length").alias("n_words"),
        "similarity",
        "distance",
    )
    return (
        near.groupBy("doc_id", "item_id")
        .agg(F.min(best).alias("best"))
        .select(
            "doc_id", "item_id", "best.start", "best.n_words", "best.similarity", "best.distance"
        )
    )


def drop_leaking(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no passage of an item, with all their columns.

    Rows without an id cannot be named as leaking and stay.
    """
    found = leaks(docs, items).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
