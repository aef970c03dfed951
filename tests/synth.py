"""Payloads and lines in plain Python, for comparison with the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def number_bits(value: int, width: int) -> str:
    return format(value & ((1 << width) - 1), f"0{width}b")


def text_bits(text: str, n_chars: int) -> str:
    codes = [ord(c) - 64 if ord(c) >= 64 else ord(c) for c in text.ljust(n_chars, "@")]
    return "".join(format(code, "06b") for code in codes)


def armour(bits: str) -> str:
    bits += "0" * (-len(bits) % 6)
    values = [int(bits[i : i + 6], 2) for i in range(0, len(bits), 6)]
    return "".join(chr(v + 48 if v < 40 else v + 56) for v in values)


def payload(*fields: tuple) -> str:
    """Payload of ``(number, width)`` and ``(text, n_chars)`` fields."""
    return armour(
        "".join(text_bits(v, w) if isinstance(v, str) else number_bits(v, w) for v, w in fields)
    )


def xor(text: str) -> str:
    total = 0
    for char in text:
        total ^= ord(char)
    return f"{total:02X}"


def line(
    data: str,
    count: object = 1,
    number: object = 1,
    sequence: object = "",
    channel: str = "A",
    padding: object = 0,
    port: object = 5,
    mmsi: object = 2750009,
    epoch: object = 1500000200,
) -> str:
    tags = f"s:QUAY//Port={port}//MMSI={mmsi},c:{epoch}"
    body = f"AIVDM,{count},{number},{sequence},{channel},{data},{padding}"
    return f"\\{tags}*{xor(tags)}\\!{body}*{xor(body)}"


def frame(spark: SparkSession, lines: list[str]) -> DataFrame:
    return spark.createDataFrame([(text,) for text in lines], "value string")


def fragment(count: int, number: int, data: str, **station: object) -> str:
    return line(data, count, number, sequence=4, channel="B", **station)


# Three messages of two stations, in six sentences and out of order.
_NORTH = {"port": 41, "mmsi": 2190001, "epoch": 1500000123}
_SOUTH = {"port": 7, "mmsi": 2240002, "epoch": 1500000987}
KNOWN_LINES = [
    fragment(3, 2, "Q8w1", **_NORTH),
    line("Q3", port=12, mmsi=2570003, epoch=1500001111),
    fragment(2, 1, "Q0a", **_SOUTH),
    fragment(2, 2, "Q9b", **_SOUTH),
    fragment(3, 1, "Q7v0", **_NORTH),
    fragment(3, 3, "Q5t2", **_NORTH),
]
# A class A position: every field as the tests expect it back.
POSITION = payload(
    (1, 6), (2, 2), (219018271, 30), (5, 4), (-20, 8), (123, 10), (1, 1), (7350123, 28),
    (33660456, 27), (2715, 12), (269, 9), (37, 6), (1, 2), (0, 3), (1, 1), (49205, 19),
)
PASSES = line(POSITION, port=41, mmsi=2190001, epoch=1500000500)
# The same with a digit of either sum changed.
FAILS = PASSES[:-1] + ("0" if PASSES[-1] != "0" else "1")
