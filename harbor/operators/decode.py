"""Message tables to typed columns, one projection per message family."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harbor.functions import payload as P
from harbor.functions.readings import to_signed
from harbor.plans import layouts as L
from harbor.plans.layouts import Field, Layout

# Columns of the message table that a decoded table seldom needs.
WORKING_COLUMNS = (
    "dataBinary",
    "data",
    "packet_type",
    "fragment_count",
    "radio_channel",
    "padding",
    "s",
)


def of_types(messages: DataFrame, types: Sequence[int]) -> DataFrame:
    """Rows of the given message types; a partition filter on a stored table."""
    low, high = min(types), max(types)
    if low == high:
        return messages.where(F.col("id") == low)
    if len(types) == high - low + 1:
        return messages.where((F.col("id") >= low) & (F.col("id") <= high))
    return messages.where(F.col("id").isin(*types))


def of_lengths(messages: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """Rows whose payload has one of the given lengths, in characters."""
    if not lengths:
        return messages
    return messages.where(F.length("data").isin(*lengths))


def with_fields(
    messages: DataFrame,
    fields: Sequence[Field],
    shortest: int | None = None,
    trim_text: bool = False,
) -> DataFrame:
    """The input columns followed by one column per field.

    ``shortest`` is a payload length in characters that every row is known to
    have; fields that end beyond it are read with care for missing bits.
    """
    last_bit = max(f.end for f in fields)
    # Four characters fill three bytes.
    n_chars = -(-last_bit // 24) * 4
    kept = messages.columns
    data = F.col("data")
    words = P.word_columns(data, n_chars)
    names = [f"__word_{i}" for i in range(len(words))]
    sure_bits = (shortest or 0) * P.BITS_PER_CHAR
    stage = messages.select(
        *kept,
        *[word.alias(name) for word, name in zip(words, names)],
        (F.length(data) * P.BITS_PER_CHAR).alias("__bits"),
    )
    held = [F.col(name) for name in names]
    numbers = [f for f in fields if f.kind != "text"]
    texts = [f for f in fields if f.kind == "text"]
    # Raw numbers and packed text first, so that each is computed once however
    # often its reading mentions it.
    raw = [
        _raw_number(held, n_chars, f, sure_bits).alias(f"__raw_{f.name}")
        for f in numbers
    ] + [
        P.word_text(held, n_chars, f.start, f.end).alias(f"__raw_{f.name}")
        for f in texts
    ]
    stage = stage.select(*kept, "__bits", *raw)
    return stage.select(
        *kept,
        *[
            (
                _text(f, sure_bits, trim_text)
                if f.kind == "text"
                else _reading(f)
            ).alias(f.name)
            for f in fields
        ],
    )


def _raw_number(
    words: Sequence[Column], n_chars: int, field: Field, sure_bits: int
) -> Column:
    whole = P.word_slice(words, n_chars, field.start, field.end)
    bits = F.col("__bits")
    if sure_bits < field.end:
        # Past the end: the bits that are there, or null when there are none.
        cut = F.call_function(
            "shiftright", whole, (F.lit(field.end) - bits).cast("int")
        )
        whole = F.when(bits >= field.end, whole).when(bits > field.start, cut)
    return whole.cast("int")


def _reading(field: Field) -> Column:
    value = F.col(f"__raw_{field.name}")
    if field.kind == "signed":
        value = to_signed(value, field.width)
    if field.reading is not None:
        value = field.reading(value)
    return value.cast(field.dtype)


def _text(field: Field, sure_bits: int, trim_text: bool) -> Column:
    packed = F.col(f"__raw_{field.name}")
    text = F.translate(packed, P.BASE64, P.TEXT_ALPHABET)
    if sure_bits < field.end:
        bits = F.col("__bits")
        n_whole = F.floor((bits - field.start) / P.BITS_PER_CHAR).cast("int")
        short = F.substr(text, F.lit(1), n_whole)
        # Payloads hold six bits per character, so what a last group lacks
        # depends on the field's position alone.
        rest = -field.start % P.BITS_PER_CHAR
        if rest:
            drop = P.BITS_PER_CHAR - rest
            smaller = "".join(P.TEXT_ALPHABET[v >> drop] for v in range(64))
            group = F.substr(packed, n_whole + 1, F.lit(1))
            short = F.concat(short, F.translate(group, P.BASE64, smaller))
        text = F.when(bits >= field.end, text).when(bits > field.start, short)
    if trim_text:
        text = F.rtrim(F.substring_index(text, "@", 1))
    return text


def decode(
    messages: DataFrame,
    layout: Layout,
    extras: bool = False,
    trim_text: bool = False,
) -> DataFrame:
    """Rows of the layout's family with its fields appended."""
    rows = of_lengths(of_types(messages, layout.types), layout.lengths)
    fields = layout.fields + (layout.extras if extras else ())
    shortest = min(layout.lengths) if layout.lengths else None
    return with_fields(rows, fields, shortest, trim_text)


def decode_position_a(
    messages: DataFrame, extras: bool = False, course_absent: int | None = None
) -> DataFrame:
    """Class A positions, types 1, 2 and 3.

    ``course_absent`` replaces the raw course that reads as null (2600 by
    default; the protocol says 3600).
    """
    layout = L.POSITION_A
    if course_absent is not None:
        swap = L.course(course_absent)
        layout = replace(
            layout,
            fields=tuple(swap if f.name == swap.name else f for f in layout.fields),
        )
    return decode(messages, layout, extras)


def _method_end(frame: DataFrame) -> DataFrame:
    """The same rows; the method generated for what follows is another one.

    Methods above 8000 bytes are never compiled.  An array of one keeps the
    projections on either side from being merged into one.
    """
    row = F.explode(F.array(F.struct(*frame.columns))).alias("__row")
    return frame.select(row).select("__row.*")


def decode_static_voyage(messages: DataFrame, trim_text: bool = False) -> DataFrame:
    """Static and voyage data, type 5, of any payload length.

    Whole payloads, nearly all, are read without a look at their length; only
    the others are read with care for missing bits, numbers before texts.
    """
    fields = L.STATIC_VOYAGE.fields
    n_whole = -(-max(f.end for f in fields) // P.BITS_PER_CHAR)
    rows = of_types(messages, L.STATIC_VOYAGE.types)
    whole = F.coalesce(F.length("data") >= n_whole, F.lit(False))
    full = with_fields(rows.where(whole), fields, n_whole, trim_text)
    texts = [f for f in fields if f.kind == "text"]
    numbers = [f for f in fields if f.kind != "text"]
    cut = with_fields(rows.where(~whole), numbers)
    cut = with_fields(_method_end(cut), texts, trim_text=trim_text)
    return full.unionByName(cut)


def decode_position_b(messages: DataFrame) -> DataFrame:
    """Class B positions, type 18."""
    return decode(messages, L.POSITION_B)


def drop_working(decoded: DataFrame) -> DataFrame:
    """The decoded table without the columns only decoding needs."""
    return decoded.drop(*WORKING_COLUMNS)
