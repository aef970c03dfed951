"""Rows to receiver lines, the inverse of the engine, as Spark columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harbor.functions.checksum import text_checksum
from harbor.functions.payload import (
    BASE64,
    BITS_PER_CHAR,
    PAYLOAD_ALPHABET,
    TEXT_ALPHABET,
    WORD_BITS,
    bits_of,
)


def as_column(value: Column | int | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def bits(value: Column | int, width: int) -> Column:
    """The number as ``width`` bits, two's complement when negative."""
    number = as_column(value).cast("long")
    number = F.when(number < 0, number + (1 << width)).otherwise(number)
    return F.lpad(F.bin(number), width, "0")


def text_bits(text: Column, n_chars: int) -> Column:
    """Six-bit text, filled up with ``@``."""
    filled = F.rpad(text, n_chars, "@")
    packed = F.rpad(F.translate(filled, TEXT_ALPHABET, BASE64), -(-n_chars // 4) * 4, BASE64[0])
    digits = F.hex(F.unbase64(packed))
    words = []
    for at in range(0, n_chars * BITS_PER_CHAR, WORD_BITS):
        width = min(WORD_BITS, n_chars * BITS_PER_CHAR - at)
        n_hex = -(-width // 4)
        word = F.conv(F.substring(digits, 1 + at // 4, n_hex), 16, 2)
        words.append(F.substring(F.lpad(word, n_hex * 4, "0"), 1, width))
    # Other characters may stand for no bits at all.
    return F.when(text.rlike(r"^[\x20-\x5F]*\z"), F.concat(*words)).otherwise(
        bits_of(F.translate(filled, TEXT_ALPHABET, PAYLOAD_ALPHABET))
    )


def armour(all_bits: Column, n_bits: int) -> Column:
    """A string of ``n_bits`` bits as payload characters, zero bits filled in."""
    n_chars = -(-n_bits // BITS_PER_CHAR)
    n_bytes = -(-n_bits // 24) * 3
    filled = F.rpad(all_bits, n_bytes * 8, "0")
    pieces = []
    for at in range(0, n_bytes * 8, WORD_BITS):
        width = min(WORD_BITS, n_bytes * 8 - at)
        piece = F.conv(F.substring(filled, at + 1, width), 2, 16)
        pieces.append(F.lpad(piece, width // 4, "0"))
    packed = F.base64(F.unhex(F.concat(*pieces)))
    return F.substring(F.translate(packed, BASE64, PAYLOAD_ALPHABET), 1, n_chars)


def with_payload(
    rows: DataFrame, name: str, fields: Sequence[tuple[Column | int, int]]
) -> DataFrame:
    """Append the payload of ``(value, width)`` fields as column ``name``.

    A text field is given as its bits, see ``text_field``.
    """
    n_bits = sum(abs(width) for _, width in fields)
    all_bits = F.concat(*[v if w < 0 else bits(v, w) for v, w in fields])
    return (
        rows.withColumn("__bits", all_bits)
        .withColumn(name, armour(F.col("__bits"), n_bits))
        .drop("__bits")
    )


def text_field(text: Column, n_chars: int) -> tuple[Column, int]:
    """A text field for ``with_payload``; the negative width marks ready-made bits."""
    return text_bits(text, n_chars), -n_chars * BITS_PER_CHAR


def tag_block(
    port: Column | int, mmsi: Column | int, epoch: Column | int, station: str = "QUAY"
) -> Column:
    return F.concat(
        F.lit(f"s:{station}//Port="),
        as_column(port).cast("string"),
        F.lit("//MMSI="),
        as_column(mmsi).cast("string"),
        F.lit(",c:"),
        as_column(epoch).cast("string"),
    )


def sentence(
    data: Column,
    count: Column | int = 1,
    number: Column | int = 1,
    sequence: Column | str = "",
    channel: Column | str = "A",
    padding: Column | int = 0,
    talker: str = "AIVDM",
) -> Column:
    return F.concat_ws(
        ",",
        F.lit(talker),
        as_column(count).cast("string"),
        as_column(number).cast("string"),
        as_column(sequence).cast("string"),
        as_column(channel),
        data,
        as_column(padding).cast("string"),
    )


def summed(text: Column) -> Column:
    return F.concat(text, F.lit("*"), text_checksum(text))


def with_line(rows: DataFrame, tags: Column, body: Column) -> DataFrame:
    """Append the receiver line as ``value``."""
    return (
        rows.withColumn("__tags", tags)
        .withColumn("__body", body)
        .withColumn(
            "value",
            F.concat(
                F.lit("\\"), summed(F.col("__tags")), F.lit("\\!"), summed(F.col("__body"))
            ),
        )
        .drop("__tags", "__body")
    )
