"""Rules that turn a raw field number into a reading."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Navigation status by code.  15, the default, has no label.
NAVIGATION_STATUS = {
    0: "Under way using engine",
    1: "At anchor",
    2: "Not under command",
    3: "Restricted maneuverability",
    4: "Constrained by her draught",
    5: "Moored",
    6: "Aground",
    7: "Engaged in Fishing",
    8: "Under way sailing",
    9: "Reserved for future amendment of Navigational Status for HSC",
    10: "Reserved for future amendment of Navigational Status for WIG",
    11: "Reserved for future use",
    12: "Reserved for future use",
    13: "Reserved for future use",
    14: "AIS-SART is active",
}

# Raw readings that stand for "not available".
SPEED_ABSENT = 1023
LONGITUDE_ABSENT = 181
LATITUDE_ABSENT = 91
COURSE_ABSENT = 2600
HEADING_ABSENT = 511
SECOND_MAX = 59
TURN_ABSENT = 128
ETA_MONTH_ABSENT = 0
ETA_DAY_ABSENT = 0
ETA_HOUR_ABSENT = 24
ETA_MINUTE_ABSENT = 60

# Units of the raw readings.
TENTHS = 10.0
PER_DEGREE = 600000.0
TURN_SCALE = 4.733


def navigation_status(code: Column) -> Column:
    """Label of a navigation status code, null for 15."""
    labels = F.create_map(
        *[F.lit(part) for pair in NAVIGATION_STATUS.items() for part in pair]
    )
    return F.try_element_at(labels, code)


def rate_of_turn(signed: Column) -> Column:
    """Degrees per minute from the signed raw turn; +-128 is not available."""
    squared = F.pow(signed / F.lit(TURN_SCALE), F.lit(2.0))
    return F.when(F.abs(signed) == TURN_ABSENT, None).otherwise(
        F.when(signed < 0, -squared).otherwise(squared)
    )


def unless(value: Column, absent: int) -> Column:
    """The value, or null when it is the one that stands for "not available"."""
    return F.nullif(value, F.lit(absent))


def unless_above(value: Column, highest: int) -> Column:
    """The value, or null when it lies above ``highest``."""
    return F.when(value <= highest, value)


def to_signed(raw: Column, width: int) -> Column:
    """Two's complement reading, save that the exact half range stays positive."""
    return F.when(raw > (1 << (width - 1)), raw - (1 << width)).otherwise(raw)
