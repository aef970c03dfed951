"""Fragments to messages.

Two ways to find the fragments of a message.  ``gap`` numbers the sentences a
station heard in one second and takes fragment number minus row number as the
message's identity.  ``sequence`` links fragments by the protocol's own
sequential message number.

Copies of a sentence are folded into counts before the first shuffle.  A usual
second is numbered by one window, and as its messages lie where it does, they are
merged there without another shuffle.  A second that holds very many sentences is
numbered in buckets, as many as its measured size asks for, and no task meets the
whole of it.

A message is put together from parts numbered within ``MAX_NUMBER``, so its size
is bounded; fragments numbered beyond, or not at all, are left out
(``without_place``; ingest quarantines them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The columns that identify a message, by their names in the table.
MESSAGE_KEYS = (
    "packet_type",
    "fragment_count",
    "radio_channel",
    "padding",
    "s",
    "port",
    "port_mmsi",
    "timestamp",
)

# Sentences that compete for row numbers.
SECOND_KEYS = ("port_mmsi", "timestamp", "fragment_count")

# Order among sentences with the same fragment number: the digest of these.
TIE_COLUMNS = (
    "radio_channel",
    "padding",
    "message_id",
    "data",
    "packet_type",
    "s",
    "port",
)

SEQUENCE_KEYS = (
    "packet_type",
    "fragment_count",
    "message_id",
    "radio_channel",
    "s",
    "port",
    "port_mmsi",
    "timestamp",
)

#: Fragments numbered further from 0 are no parts of messages; the protocol has one digit.
MAX_NUMBER = 999

#: Sentences of a second, copies too, from which it is numbered in buckets of about as many.
LARGEST_SECOND = 1 << 18
#: So many seconds at most are, the largest ones; any other then holds fewer than
#: this part of all sentences.
BUCKETED_SECONDS = 100_000

# Hexadecimal digits of the digest that can name a bucket.
_MOST_DIGITS = 8
# Copies of one sentence that one row is unfolded into; of no effect on results.
_COPIES_PER_ROW = 4096


def _placed(number: Column) -> Column:
    return F.coalesce(number.between(-MAX_NUMBER, MAX_NUMBER), F.lit(False))


def without_place(sentences: DataFrame) -> DataFrame:
    """The fragments that no message takes in."""
    return sentences.where(~_placed(F.col("fragment_n")))


def tie_digest() -> Column:
    """Digest that orders sentences with the same fragment number."""
    return F.md5(
        F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in TIE_COLUMNS])
    )


# What identifies a fragment or makes up its message.
_FRAGMENT_COLUMNS = tuple(
    dict.fromkeys((*MESSAGE_KEYS, *SECOND_KEYS, "fragment_n", "message_id", "data"))
)
_ORDER = ("fragment_n", "__digest", *TIE_COLUMNS)


def _folded(sentences: DataFrame) -> DataFrame:
    """Different sentences with their number of copies."""
    return (
        sentences.where(_placed(F.col("fragment_n")))
        .select(*_FRAGMENT_COLUMNS)
        .groupBy(*_FRAGMENT_COLUMNS)
        .agg(F.count(F.lit(1)).alias("__copies"))
    )


def _large_seconds(copies: DataFrame) -> DataFrame:
    """The seconds to be numbered in buckets: ``__key_*``, and ``__digits`` of the buckets' names.

    A bucket's name is the first digits of the digest, so one digit more makes
    sixteen of each.  Not more than ``BUCKETED_SECONDS`` rows.
    """
    measured = copies.groupBy(*SECOND_KEYS).agg(
        F.count(F.lit(1)).alias("__rows"), F.sum("__copies").alias("__all")
    )
    digits = F.ceil(F.log(16.0, F.col("__rows") / LARGEST_SECOND)).cast("int")
    return (
        measured.where(F.col("__all") > LARGEST_SECOND)
        .orderBy(F.desc("__all"))
        .limit(BUCKETED_SECONDS)
        .select(
            *[F.col(c).alias(f"__key_{c}") for c in SECOND_KEYS],
            F.least(F.greatest(digits, F.lit(0)), F.lit(_MOST_DIGITS)).alias("__digits"),
        )
    )


def _before(*keys: str) -> Column:
    """How many sentences of the same keys stand before a row, copies counted."""
    earlier = W.partitionBy(*keys).orderBy(*_ORDER).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum("__copies").over(earlier), F.lit(0))


def _split(sentences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The folded sentences of usual seconds, and of large ones with ``__digits``.

    One outer join marks them: an anti join would be pushed below the folding,
    which would then be done anew for each of its uses.
    """
    copies = _folded(sentences)
    same = [F.col(c).eqNullSafe(F.col(f"__key_{c}")) for c in SECOND_KEYS]
    marked = copies.join(F.broadcast(_large_seconds(copies)), same, "left").select(
        *_FRAGMENT_COLUMNS, "__copies", "__digits", tie_digest().alias("__digest")
    )
    return (
        marked.where(F.col("__digits").isNull()),
        marked.where(F.col("__digits").isNotNull()),
    )


def _number_usual(copies: DataFrame) -> DataFrame:
    """Numbered where the second lies: one window over all of it."""
    first = F.col("fragment_n") - F.col("__before")
    step = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))).alias("__step")
    return (
        copies.withColumn("__before", _before(*SECOND_KEYS))
        .select(*_FRAGMENT_COLUMNS, first.alias("__first"), step)
        .select(*_FRAGMENT_COLUMNS, (F.col("__first") - F.col("__step")).alias("generated_id"))
    )


def _number_large(copies: DataFrame) -> DataFrame:
    """Numbered in buckets: place in the bucket, and the sum of the buckets before it."""
    bucket = [*SECOND_KEYS, "fragment_n", "__bucket"]
    placed = copies.withColumn(
        "__bucket", F.substr("__digest", F.lit(1), F.col("__digits"))
    ).withColumn("__before", _before(*bucket))
    totals = placed.groupBy(*bucket).agg(F.sum("__copies").alias("__total"))
    earlier = (
        W.partitionBy(*SECOND_KEYS)
        .orderBy("fragment_n", "__bucket")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    offsets = totals.select(
        *[F.col(c).alias(f"__of_{c}") for c in bucket],
        F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__offset"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in bucket]
    # All copies are numbered as one row; only then are they told apart, those
    # of a very frequent sentence by many tasks.
    first = F.col("fragment_n") - F.col("__offset") - F.col("__before")
    numbered = placed.join(offsets, same).select(
        *_FRAGMENT_COLUMNS, "__digest", "__copies", first.alias("__first")
    )
    few = F.col("__copies") <= _COPIES_PER_ROW
    runs = F.sequence(
        F.lit(0).cast("long"), F.col("__copies") - 1, F.lit(_COPIES_PER_ROW).cast("long")
    )
    spread = (
        numbered.where(~few)
        .withColumn("__run", F.explode(runs))
        .repartition("__digest", "__run")
    )
    once = numbered.where(few).withColumn("__run", F.lit(0).cast("long"))
    end = F.least(F.col("__copies"), F.col("__run") + _COPIES_PER_ROW)
    step = F.explode(F.sequence(F.col("__run") + 1, end)).alias("__step")
    return (
        once.unionByName(spread)
        .select(*_FRAGMENT_COLUMNS, "__first", step)
        .select(*_FRAGMENT_COLUMNS, (F.col("__first") - F.col("__step")).alias("generated_id"))
    )


def number_fragments(sentences: DataFrame) -> DataFrame:
    """Append ``generated_id``: fragment number minus row number.

    Rows are numbered per station, second and fragment count in the order of
    fragment number, ties by digest.  The columns kept are those that identify
    or make up a message; fragments without a place are left out.
    """
    usual, large = _split(sentences)
    return _number_usual(usual).unionByName(_number_large(large))


def _joined(parts: Column) -> Column:
    """Payloads in fragment order."""
    return F.array_join(F.transform(F.array_sort(parts), lambda p: p["data"]), "")


def merge_fragments(numbered: DataFrame) -> DataFrame:
    """Join the payloads that share their keys and ``generated_id``.

    Within such a group every fragment number occurs once, so a group has no
    more parts than there are numbers within ``MAX_NUMBER``.  Those are not held
    to the message's count here; ``IngestRules.parts_in_count`` does that.
    """
    return (
        numbered.groupBy(*MESSAGE_KEYS, "generated_id")
        .agg(F.collect_list(F.struct("fragment_n", "data")).alias("__parts"))
        .select(*MESSAGE_KEYS, _joined(F.col("__parts")).alias("data"))
    )


def assemble_gap(fragments: DataFrame) -> DataFrame:
    """Messages from sentences, all of which take part in the numbering."""
    usual, large = _split(fragments)
    # Apart, as the usual seconds' fragments already lie where they are merged.
    return merge_fragments(_number_usual(usual)).unionByName(
        merge_fragments(_number_large(large))
    )


def assemble_sequence(fragments: DataFrame) -> DataFrame:
    """Messages linked by message number, with ``is_complete``: every number up
    to the count is there, and no other.

    A repeated fragment counts once (the smallest payload is kept) and the
    padding is that of the highest fragment.  Fragments heard in different
    seconds stay apart.
    """
    keys = list(SEQUENCE_KEYS)
    single = fragments.where(_placed(F.col("fragment_n"))).groupBy(*keys, "fragment_n").agg(
        F.min(F.struct("data", "padding")).alias("__part")
    )
    return (
        single.groupBy(*keys)
        .agg(
            F.collect_list(
                F.struct("fragment_n", F.col("__part.data").alias("data"))
            ).alias("__parts"),
            F.max_by("__part.padding", "fragment_n").alias("padding"),
            F.count("fragment_n").alias("__n"),
            F.min("fragment_n").alias("__low"),
            F.max("fragment_n").alias("__high"),
        )
        .select(
            *MESSAGE_KEYS,
            _joined(F.col("__parts")).alias("data"),
            F.coalesce(
                (F.col("__n") == F.col("fragment_count"))
                & (F.col("__low") == 1)
                & (F.col("__high") == F.col("fragment_count")),
                F.lit(False),
            ).alias("is_complete"),
        )
    )


def as_messages(whole: DataFrame, mode: str = "gap") -> DataFrame:
    """One-part sentences as messages, one to one."""
    check_mode(mode)
    columns = [F.col(c) for c in (*MESSAGE_KEYS, "data")]
    if mode == "sequence":
        columns.append(F.lit(True).alias("is_complete"))
    return whole.select(*columns)


def assemble(parts: DataFrame, mode: str = "gap") -> DataFrame:
    """Messages from fragments."""
    check_mode(mode)
    return assemble_gap(parts) if mode == "gap" else assemble_sequence(parts)


def check_mode(mode: str) -> None:
    if mode not in ("gap", "sequence"):
        raise ValueError(f"mode must be 'gap' or 'sequence', not {mode!r}")


def reassemble(
    sentences: DataFrame, mode: str = "gap", bypass: bool = True
) -> DataFrame:
    """Sentence records to messages.

    One-part messages need no partner; with ``bypass`` they are passed on
    without a shuffle.  In ``gap`` mode that gives the same messages as
    numbering them, provided one-part sentences are all numbered 1
    (``IngestRules.lone_parts``); in ``sequence`` mode it is the definition.
    """
    check_mode(mode)
    if mode == "gap" and not bypass:
        return assemble(sentences, mode)
    whole = F.col("fragment_count") == 1
    if mode == "gap":
        whole = whole & (F.col("fragment_n") == 1)
    whole = F.coalesce(whole, F.lit(False))
    return as_messages(sentences.where(whole), mode).unionByName(
        assemble(sentences.where(~whole), mode)
    )
