"""Where each field of each message family lies, and how it is read.

Bit positions are 0-based and half-open.  A layout is data; ``operators.decode``
turns it into one projection.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column

from harbor.functions import readings as R

Reading = Callable[[Column], Column]


@dataclass(frozen=True)
class Field:
    """One output column.

    ``kind`` is ``int`` (unsigned), ``signed``, or ``text`` (six-bit).
    ``reading`` turns the raw number into the value and ``dtype`` is its type.
    """

    name: str
    start: int
    end: int
    kind: str = "int"
    reading: Reading | None = None
    dtype: str = "int"

    @property
    def width(self) -> int:
        return self.end - self.start


@dataclass(frozen=True)
class Layout:
    """A message family: its type numbers, payload lengths and fields."""

    name: str
    types: tuple[int, ...]
    fields: tuple[Field, ...]
    # Accepted payload lengths in characters; empty when any length will do.
    lengths: tuple[int, ...] = ()
    # Fields read only on request.
    extras: tuple[Field, ...] = ()


def _text(name: str, start: int, end: int) -> Field:
    return Field(name, start, end, kind="text", dtype="string")


def _tenths(name: str, start: int, end: int, absent: int | None = None) -> Field:
    def reading(raw: Column) -> Column:
        known = raw if absent is None else R.unless(raw, absent)
        return known / R.TENTHS

    return Field(name, start, end, reading=reading, dtype="double")


def _degrees(name: str, start: int, end: int, absent: int) -> Field:
    def reading(raw: Column) -> Column:
        return R.unless(raw, int(absent * R.PER_DEGREE)) / R.PER_DEGREE

    return Field(name, start, end, kind="signed", reading=reading, dtype="double")


def _known(name: str, start: int, end: int, absent: int) -> Field:
    return Field(name, start, end, reading=lambda raw: R.unless(raw, absent))


def _second(start: int, end: int) -> Field:
    return Field(
        "timestamp_seconds",
        start,
        end,
        reading=lambda raw: R.unless_above(raw, R.SECOND_MAX),
    )


def course(absent: int = R.COURSE_ABSENT) -> Field:
    """Course over ground; ``absent`` is the raw number read as null."""
    return _tenths("course_over_ground", 116, 128, absent)


REPEAT = Field("repeat_indicator", 6, 8)
MMSI = Field("mmsi", 8, 38)
PART_NUMBER = Field("part_number", 38, 40)

FULL_SLOT = 28  # characters of a 168-bit message
SHORT_SLOT = 27  # characters of a 160-bit message with two pad bits

POSITION_A = Layout(
    name="position_a",
    types=(1, 2, 3),
    lengths=(FULL_SLOT,),
    fields=(
        REPEAT,
        MMSI,
        Field("navigation_status", 38, 42, reading=R.navigation_status, dtype="string"),
        Field("rate_of_turn", 42, 50, "signed", R.rate_of_turn, "double"),
        _tenths("speed_over_ground", 50, 60, R.SPEED_ABSENT),
        Field("position_accuracy", 60, 61),
        _degrees("longitude", 61, 89, R.LONGITUDE_ABSENT),
        _degrees("latitude", 89, 116, R.LATITUDE_ABSENT),
        course(),
        _known("true_heading", 128, 137, R.HEADING_ABSENT),
        _second(137, 143),
        Field("manoeuvre_indicator", 143, 145),
        Field("raim", 148, 149),
    ),
    extras=(
        Field("spare", 145, 148),
        Field("radio_status", 149, 168),
    ),
)

STATIC_VOYAGE = Layout(
    name="static_voyage",
    types=(5,),
    fields=(
        REPEAT,
        MMSI,
        Field("ais_version", 38, 40),
        Field("imo", 40, 70),
        _text("call_sign", 70, 112),
        _text("ship_name", 112, 232),
        Field("type_and_cargo", 232, 240),
        Field("to_bow", 240, 249),
        Field("to_stern", 249, 258),
        Field("to_port", 258, 264),
        Field("to_starboard", 264, 270),
        Field("epfd", 270, 274),
        _known("eta_month", 274, 278, R.ETA_MONTH_ABSENT),
        _known("eta_day", 278, 283, R.ETA_DAY_ABSENT),
        _known("eta_hour", 283, 288, R.ETA_HOUR_ABSENT),
        _known("eta_min", 288, 294, R.ETA_MINUTE_ABSENT),
        _tenths("draught", 294, 302),
        _text("destination", 302, 422),
        Field("data_terminal_ready", 422, 423),
    ),
)

POSITION_B = Layout(
    name="position_b",
    types=(18,),
    lengths=(FULL_SLOT,),
    fields=(
        REPEAT,
        MMSI,
        _tenths("speed_over_ground", 46, 56, R.SPEED_ABSENT),
        Field("position_accuracy", 56, 57),
        _degrees("longitude", 57, 85, R.LONGITUDE_ABSENT),
        _degrees("latitude", 85, 112, R.LATITUDE_ABSENT),
        _known("true_heading", 124, 133, R.HEADING_ABSENT),
        _second(133, 139),
        Field("cs_unit", 141, 142),
        Field("dsc_flag", 143, 144),
        Field("display_flag", 142, 143),
        Field("band_flag", 144, 145),
        Field("message_22_flag", 145, 146),
        Field("assigned", 146, 147),
        Field("raim", 147, 148),
    ),
)

# Both parts of the class B static report, and what either part adds.
STATIC_B = Layout(
    name="static_b",
    types=(24,),
    lengths=(FULL_SLOT, SHORT_SLOT),
    fields=(REPEAT, MMSI, PART_NUMBER),
)

STATIC_B_NAME = (_text("ship_name", 40, 160),)

STATIC_B_DETAIL = (
    Field("ship_type", 40, 48),
    _text("vendor_id", 48, 90),
    _text("call_sign", 90, 132),
    Field("to_bow", 132, 141),
    Field("to_stern", 141, 150),
    Field("to_port", 150, 156),
    Field("to_starboard", 156, 162),
    Field("mothership_mmsi", 132, 162),
)
