"""Scalar functions over text of ``0`` and ``1``, as kept in ``dataBinary``.

The table decoders read the payload itself (see ``payload``); these serve
queries that start from the bits.  Positions are 0-based and half-open.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from harbor.functions.payload import BITS_PER_CHAR


def bit_slice(bits: Column, start: int, end: int) -> Column:
    """Bits ``[start, end)``; what is left of them when the text is shorter."""
    return F.substring(bits, start + 1, end - start)


def parse_uint(bits: Column) -> Column:
    """Bits as an unsigned int; null when there are none or they are not bits."""
    readable = bits.rlike("^0*[01]{1,31}$")
    return F.when(readable, F.conv(bits, 2, 10).cast("int"))


def extract_int(bits: Column, start: int, end: int) -> Column:
    """Unsigned int from bits ``[start, end)``, null when unreadable."""
    return parse_uint(bit_slice(bits, start, end))


def parse_signed(bits: Column) -> Column:
    """Signed number as a double.

    Negative only above half the range, so the exact half stays positive;
    unreadable bits give 0.0.
    """
    value = F.coalesce(parse_uint(bits), F.lit(0)).cast("double")
    half = F.pow(F.lit(2.0), F.length(bits) - 1)
    return F.when(value > half, value - half * 2).otherwise(value)


def extract_signed(bits: Column, start: int, end: int) -> Column:
    """Signed number from bits ``[start, end)``."""
    return parse_signed(bit_slice(bits, start, end))


def six_bit_text(bits: Column) -> Column:
    """Six-bit text of the bits; a short last group is read as a smaller number.

    Null when there are no bits.
    """
    starts = F.sequence(F.lit(1), F.length(bits), F.lit(BITS_PER_CHAR))
    codes = F.transform(
        starts,
        lambda at: F.conv(F.substring(bits, at, F.lit(BITS_PER_CHAR)), 2, 10).cast("int"),
    )
    chars = F.transform(codes, lambda c: F.char(F.when(c < 32, c + 64).otherwise(c)))
    return F.when(F.length(bits) > 0, F.array_join(chars, ""))


def extract_string(bits: Column, start: int, end: int) -> Column:
    """Six-bit text from bits ``[start, end)``, null when past the end."""
    return six_bit_text(bit_slice(bits, start, end))


def message_type_of_bits(bits: Column) -> Column:
    """Message type from the first six bits."""
    return extract_int(bits, 0, BITS_PER_CHAR)


def string_length(text: Column) -> Column:
    """Number of characters."""
    return F.length(text)
