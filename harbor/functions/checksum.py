"""XOR checksums of the segments of a received line.

``xor_checksum`` is a plain column expression.  It meets characters one at a
time, which over whole lines costs more than all the rest of ingest (README and
RESULTS give the figures).  ``line_holds`` therefore sums whole
Arrow batches with numpy: one running XOR over the batch's bytes gives the sum
of every text in it as the XOR of two of its entries.
"""

from __future__ import annotations

import sys
from functools import reduce
from operator import xor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

# The batch functions travel with the job; executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MARK, _STAR, _SLASH = (ord(c) for c in "!*\\")
# Value of a hex digit by its character code, 255 for other characters.
_HEX = np.full(256, 255, dtype=np.uint8)
for _digit in "0123456789abcdefABCDEF":
    _HEX[ord(_digit)] = int(_digit, 16)
# The sums of plain texts, by value.
_DIGITS = pa.array([f"{value:02X}" for value in range(256)])


def xor_checksum(text: Column) -> Column:
    """XOR of the characters of ``text`` as upper-case hex, two digits at least."""
    return F.aggregate(
        F.split(text, ""),
        F.lit(0),
        lambda total, char: total.bitwiseXOR(F.ascii(char)),
        lambda total: F.when(total < 16, F.concat(F.lit("0"), F.hex(total))).otherwise(
            F.hex(total)
        ),
    )


def _text_sums(texts: pa.Array) -> pa.Array:
    """What ``xor_checksum`` gives, of a batch."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
        texts.offset : texts.offset + n + 1
    ]
    data = texts.buffers()[2]
    octets = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, np.uint8)
    octets = octets[offsets[0] : offsets[-1]]
    start, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    running = np.zeros(len(octets) + 1, dtype=np.uint8)
    np.bitwise_xor.accumulate(octets, out=running[1:])
    sums = _DIGITS.take(pa.array(running[end] ^ running[start]))
    # A null comes as no bytes.
    sums = pc.if_else(texts.is_null(), pa.scalar(None, pa.string()), sums)
    # Wide characters are summed as they are, not by their bytes.
    high = np.flatnonzero(octets >= 128)
    wide = np.searchsorted(high, end) > np.searchsorted(high, start)
    if wide.any():
        points = [reduce(xor, map(ord, t.as_py()), 0) for t in texts.filter(pa.array(wide))]
        sums = pc.replace_with_mask(
            sums, pa.array(wide), pa.array([f"{p:02X}" for p in points], pa.string())
        )
    return sums


@F.arrow_udf(StringType())
def _text_sum(texts: pa.Array) -> pa.Array:
    return _text_sums(texts)


def text_checksum(text: Column) -> Column:
    """The same as ``xor_checksum``, by the batch."""
    return _text_sum(text)


def segments(line: Column) -> Column:
    """The ``!``-separated segments of a line, trailing empty ones left out."""
    bare = F.when(line.endswith("!"), F.rtrim(line, F.lit("!"))).otherwise(line)
    return F.split(bare, "!")


def _text_holds(line: str, require_meta: bool) -> bool:
    """The rule in full, for one line of unusual form."""
    listed = line.rstrip("!").split("!")
    if listed == [""] and line:
        return True
    if not require_meta and len(listed) > 1 and listed[0] == "":
        del listed[0]
    for segment in listed:
        text, mark, claimed = (
            segment.removeprefix("\\").removesuffix("\\").rstrip("*").partition("*")
        )
        if not mark or "*" in claimed:
            return False
        units = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), dtype="<u2")
        if f"{int(np.bitwise_xor.reduce(units)):02X}" != claimed.upper():
            return False
    return True


def _first_failure(line: str, require_meta: bool) -> tuple[int, str | None, str] | None:
    """The first segment without its own sum: its number, the sum it claims, and the right one."""
    for number, segment in enumerate(line.rstrip("!").split("!")):
        if number == 0 and segment == "" and not require_meta:
            continue
        parts = segment.removeprefix("\\").removesuffix("\\").rstrip("*").split("*")
        claimed = parts[1] if len(parts) > 1 else None
        units = np.frombuffer(parts[0].encode("utf-16-le", "surrogatepass"), dtype="<u2")
        computed = f"{int(np.bitwise_xor.reduce(units)):02X}"
        if len(parts) != 2 or claimed.upper() != computed:
            return number, claimed, computed
    return None


def _batch_sums(lines: pa.Array, require_meta: bool) -> pa.Array:
    """Whether the sums of each line hold, and the first that does not."""
    holds = _holds(lines, require_meta)
    told: list[tuple | None] = [None] * len(lines)
    for row in np.flatnonzero(~holds).tolist():
        told[row] = _first_failure(lines[row].as_py(), require_meta)
    of_field = [[t and t[i] for t in told] for i in range(3)]
    return pa.StructArray.from_arrays(
        [
            pa.array(holds),
            pa.array(of_field[0], pa.int32()),
            pa.array(of_field[1], pa.string()),
            pa.array(of_field[2], pa.string()),
        ],
        names=["holds", "segment", "claimed", "computed"],
    )


def _batch_holds(lines: pa.Array, require_meta: bool) -> pa.Array:
    return pa.array(_holds(lines, require_meta))


def _code_units(octets: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """UTF-16 code units of UTF-8 text, and the unit at which each byte's character begins.

    None if the text is not UTF-8.
    """
    try:
        text = octets.tobytes().decode("utf-8")
    except UnicodeDecodeError:
        return None
    units = np.frombuffer(text.encode("utf-16-le"), dtype="<u2")
    taken = ((octets & 0xC0) != 0x80).astype(np.int64) + (octets >= 0xF0)
    return units, np.concatenate([[0], np.cumsum(taken)])


def _holds(lines: pa.Array, require_meta: bool) -> np.ndarray:
    lines = lines.cast(pa.large_string())
    n = len(lines)
    offsets = np.frombuffer(lines.buffers()[1], dtype=np.int64)[
        lines.offset : lines.offset + n + 1
    ]
    data = lines.buffers()[2]
    octets = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, np.uint8)
    octets = octets[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    start, end = offsets[:-1], offsets[1:]

    # Characters are summed as UTF-16 units; of plain text those are the bytes.
    units, readable = octets, np.ones(n, dtype=bool)
    high = np.flatnonzero(octets >= 128)
    wide = np.searchsorted(high, end) > np.searchsorted(high, start)
    if len(high):
        made = _code_units(octets)
        if made is None:
            readable = ~wide
        else:
            units, place = made
            start, end = place[start], place[end]

    # Trailing marks end no segment; lines with very many are of unusual form.
    stop = end.copy()
    # A zero after the last line keeps every index in range.
    padded = np.append(units, units.dtype.type(0))
    for _ in range(4):
        stop -= (stop > start) & (padded[stop - 1] == _MARK)
    marks = np.flatnonzero(units == _MARK)
    stars = np.flatnonzero(units == _STAR)
    first_mark, first_star = np.searchsorted(marks, start), np.searchsorted(stars, start)
    n_marks = np.searchsorted(marks, stop) - first_mark
    n_stars = np.searchsorted(stars, stop) - first_star
    plain = readable & (stop > start)
    plain &= padded[stop - 1] != _MARK
    mark = np.append(marks, 0)[np.minimum(first_mark, len(marks))]
    star = np.append(stars, 0)[np.minimum(first_star, len(stars))]
    next_star = np.append(stars, 0)[np.minimum(first_star + 1, len(stars))]
    running = np.zeros(len(units) + 1, dtype=units.dtype)
    np.bitwise_xor.accumulate(units, out=running[1:])
    digit = _HEX[np.minimum(padded, 255)]

    holds = np.zeros(n, dtype=bool)
    longer = np.zeros(n, dtype=bool)  # a sum of wide characters may take more digits

    def segment_holds(
        rows: np.ndarray, left: np.ndarray, at: np.ndarray, right: np.ndarray
    ) -> np.ndarray:
        left, at, right = left[rows], at[rows], right[rows]
        left = left + ((padded[left] == _SLASH) & (left < at))
        right = right - (padded[right - 1] == _SLASH)
        longer[rows] |= wide[rows] & (right - at > 3)
        first, second = digit[at + 1], digit[np.minimum(at + 2, len(units))]
        claimed = first.astype(np.int64) * 16 + second
        return (
            (right - at == 3)
            & (first < 16)
            & (second < 16)
            & (claimed == running[at] ^ running[left])
        )

    # A tag block and a sentence: one mark with a star on either side.
    two = plain & (n_marks == 1) & (n_stars == 2) & (star < mark) & (mark < next_star)
    holds[two] = segment_holds(two, start, star, mark)
    holds[two] &= segment_holds(two, mark + 1, next_star, stop)
    # A sentence alone, whose tag block is empty and holds only by leave.
    bare = plain & (n_marks == 1) & (n_stars == 1) & (mark == start)
    if not require_meta:
        holds[bare] = segment_holds(bare, mark + 1, star, stop)
    one = plain & (n_marks == 0) & (n_stars == 1)
    holds[one] = segment_holds(one, start, star, stop)
    usual = two | bare | one
    for row in np.flatnonzero(~usual | longer):
        text = octets[offsets[row] : offsets[row + 1]].tobytes().decode("utf-8", "replace")
        holds[row] = _text_holds(text, require_meta)
    return holds


@F.arrow_udf(BooleanType())
def _tagged_line_holds(lines: pa.Array) -> pa.Array:
    return _batch_holds(lines, require_meta=True)


@F.arrow_udf(BooleanType())
def _any_line_holds(lines: pa.Array) -> pa.Array:
    return _batch_holds(lines, require_meta=False)


_SUMS = StructType(
    [
        StructField("holds", BooleanType()),
        StructField("segment", IntegerType()),
        StructField("claimed", StringType()),
        StructField("computed", StringType()),
    ]
)


@F.arrow_udf(_SUMS)
def _tagged_line_sums(lines: pa.Array) -> pa.Array:
    return _batch_sums(lines, require_meta=True)


@F.arrow_udf(_SUMS)
def _any_line_sums(lines: pa.Array) -> pa.Array:
    return _batch_sums(lines, require_meta=False)


def line_holds(line: Column, require_meta: bool = True) -> Column:
    """True when every segment of the line passes its own checksum.

    A segment is ``text*sum``, less one backslash on either side; the sum is
    compared without regard to case.  A line of nothing but ``!`` has no
    segment and passes.  With ``require_meta=False`` an empty tag block is
    accepted as well.
    """
    holds = _tagged_line_holds if require_meta else _any_line_holds
    return holds(F.coalesce(line, F.lit("")))


def line_sums(line: Column, require_meta: bool = True) -> Column:
    """``holds`` as ``line_holds`` tells, and of the first segment whose sum does
    not hold ``segment, claimed, computed``.

    Segments count from 0; ``claimed`` is null where there is no sum, and all
    three where every sum holds.
    """
    sums = _tagged_line_sums if require_meta else _any_line_sums
    return sums(F.coalesce(line, F.lit("")))
