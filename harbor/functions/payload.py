"""Column builders for armoured payloads and their bits.

A payload carries six bits per character.  The decoders never materialise the
bits as text: the payload alphabet is mapped onto the base64 alphabet, which
lets ``unbase64`` pack four characters into three bytes in one JVM call, and
the packed bytes are read back as a few 60-bit words from which every field is
a shift and a mask.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS_PER_CHAR = 6
WORD_BITS = 60
WORD_CHARS = WORD_BITS // BITS_PER_CHAR
WORD_HEX = WORD_BITS // 4


def _sextet_of(char_code: int) -> int:
    """Six-bit value of a payload character, for codes 48 to 119."""
    value = char_code - 48
    return value - 8 if value > 40 else value


# The base64 alphabet of RFC 4648.
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

# Every character that decodes to six bits, and the base64 character of the
# same value.  88 to 95 alias other characters; see PAYLOAD_STRICT.
PAYLOAD_CHARS = "".join(chr(c) for c in range(48, 120))
PAYLOAD_AS_BASE64 = "".join(BASE64[_sextet_of(ord(c))] for c in PAYLOAD_CHARS)

# The 64 characters of the protocol itself, in value order.
PAYLOAD_ALPHABET = "".join(chr(c) for c in (*range(48, 88), *range(96, 120)))

# Regular-expression classes for a payload character.
PAYLOAD_LENIENT = "[0-w]"
PAYLOAD_STRICT = "[0-W`-w]"

# Six-bit text: values 0 to 31 are the characters from '@', 32 to 63 are ASCII.
TEXT_ALPHABET = "".join(chr(v + 64 if v < 32 else v) for v in range(64))


def packed_hex(payload: Column, n_chars: int) -> Column:
    """Hex digits of the first ``n_chars`` characters' bits, zero bits filled in.

    ``n_chars`` must be a multiple of four, so that the bits fill whole bytes.
    """
    filled = F.rpad(payload, n_chars, "0")
    return F.hex(F.unbase64(F.translate(filled, PAYLOAD_CHARS, PAYLOAD_AS_BASE64)))


def _hex_to_long(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("long")


def bits_of(payload: Column) -> Column:
    """Payload characters to a string of ``0`` and ``1``, six per character."""
    by_code = F.array(*[F.lit(format(_sextet_of(ord(c)), "06b")) for c in PAYLOAD_CHARS])
    first = ord(PAYLOAD_CHARS[0])
    return F.array_join(
        F.transform(F.split(payload, ""), lambda char: F.get(by_code, F.ascii(char) - first)),
        "",
    )


def sextet(payload: Column, index: int) -> Column:
    """Value of the payload character at ``index`` (0-based)."""
    value = F.ascii(payload if index == 0 else F.substring(payload, index + 1, 1)) - 48
    return F.when(value > 40, value - 8).otherwise(value)


def message_type(payload: Column) -> Column:
    """Message type, the payload's first six bits; null for an empty payload."""
    return F.when(payload != "", sextet(payload, 0))


def word_columns(payload: Column, n_chars: int) -> list[Column]:
    """The first ``n_chars`` characters as 60-bit words, first bit highest.

    The last word holds what is left of ``6 * n_chars`` bits, so it may be
    narrower than 60.  Select these once and slice them with ``word_slice``.
    """
    n_bits = n_chars * BITS_PER_CHAR
    digits = packed_hex(payload, n_chars)
    return [
        _hex_to_long(F.substring(digits, 1 + start // 4, WORD_HEX))
        for start in range(0, n_bits, WORD_BITS)
    ]


def word_slice(words: Sequence[Column], n_chars: int, start: int, end: int) -> Column:
    """Bits ``[start, end)`` of the words as a bigint; at most 60 bits wide."""
    n_bits = n_chars * BITS_PER_CHAR
    first, last = start // WORD_BITS, (end - 1) // WORD_BITS

    def stop(index: int) -> int:
        return min((index + 1) * WORD_BITS, n_bits)

    tail = words[last]
    if stop(last) > end:
        tail = F.shiftright(tail, stop(last) - end)
    if first == last:
        whole = start == first * WORD_BITS
        return tail if whole else tail.bitwiseAND(F.lit((1 << (end - start)) - 1))
    head = words[first]
    if start > first * WORD_BITS:
        head = head.bitwiseAND(F.lit((1 << (stop(first) - start)) - 1))
    return F.shiftleft(head, end - last * WORD_BITS).bitwiseOR(tail)


def word_text(words: Sequence[Column], n_chars: int, start: int, end: int) -> Column:
    """Bits ``[start, end)`` as base64 characters, one per six bits."""
    pieces = []
    for at in range(start, end, WORD_BITS):
        width = min(WORD_BITS, end - at)
        value = word_slice(words, n_chars, at, at + width)
        # Whole hex digits for every piece, whole bytes for the last one.
        spare = -width % 4 if at + width < end else -(end - start) % 8
        if spare:
            value = F.shiftleft(value, spare)
        pieces.append(F.lpad(F.hex(value), (width + spare) // 4, "0"))
    digits = pieces[0] if len(pieces) == 1 else F.concat(*pieces)
    return F.substring(F.base64(F.unhex(digits)), 1, (end - start) // BITS_PER_CHAR)
