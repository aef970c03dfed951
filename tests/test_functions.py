from __future__ import annotations

import random

import pyarrow as pa
from pyspark.sql import functions as F

from harbor.functions import bitstring as B
from harbor.functions import checksum
from harbor.functions import payload as P
from harbor.functions.checksum import _batch_holds, line_holds, xor_checksum
from harbor.functions.readings import navigation_status, rate_of_turn, to_signed
from tests.labels import STATUS_LABELS
from tests.synth import FAILS, KNOWN_LINES, PASSES, armour, frame, text_bits, xor


def values(frame, column):
    return [row[0] for row in frame.select(column).collect()]


def test_every_payload_character_gives_its_six_bits(spark):
    alphabet = [chr(c) for c in (*range(48, 88), *range(96, 120))]
    rows = spark.createDataFrame([(c, v) for v, c in enumerate(alphabet)], "data string, v int")
    got = rows.select("v", P.bits_of(F.col("data")).alias("bits"), P.message_type(F.col("data")).alias("t"))
    for row in got.collect():
        assert row.bits == format(row.v, "06b")
        assert row.t == row.v


def test_characters_outside_the_alphabet_alias_others(spark):
    got = values(frame(spark, ["X", "_", "`"]), P.bits_of(F.col("value")))
    assert got == ["101000", "100111", "101000"]


def test_bits_of_any_length(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice(P.PAYLOAD_ALPHABET) for _ in range(n)) for n in (0, 1, 9, 10, 11, 20, 28, 71, 500)]
    for text, bits in zip(texts, values(frame(spark, texts), P.bits_of(F.col("value")))):
        want = "".join(format(P.PAYLOAD_ALPHABET.index(c), "06b") for c in text)
        assert bits == want


def test_every_six_bit_text_character(spark):
    rows = spark.createDataFrame([(format(v, "06b"), v) for v in range(64)], "bits string, v int")
    for row in rows.select("v", B.six_bit_text(F.col("bits")).alias("char")).collect():
        assert row.char == (chr(row.v + 64) if row.v < 32 else chr(row.v))


def test_slices_past_the_end(spark):
    rows = spark.createDataFrame([("0000010000101",)], "bits string")
    bits = F.col("bits")
    row = rows.select(
        B.extract_int(bits, 10, 20).alias("short"),
        B.extract_int(bits, 13, 20).alias("gone"),
        B.extract_string(bits, 0, 60).alias("text"),
        B.extract_string(bits, 13, 60).alias("no_text"),
        B.parse_uint(F.lit("")).alias("empty"),
        B.parse_uint(F.lit("1" * 32)).alias("too_wide"),
        B.parse_signed(F.lit("")).alias("unreadable"),
    ).first()
    assert (row.short, row.gone, row.text, row.no_text) == (5, None, "ABA", None)
    assert (row.empty, row.too_wide, row.unreadable) == (None, None, 0.0)


def test_exact_half_range_stays_positive(spark):
    rows = spark.createDataFrame([(v,) for v in (127, 128, 129, 255)], "raw int")
    assert values(rows, to_signed(F.col("raw"), 8)) == [127, 128, -127, -1]
    texts = spark.createDataFrame([(format(v, "08b"),) for v in (127, 128, 129, 255)], "b string")
    assert values(texts, B.parse_signed(F.col("b"))) == [127.0, 128.0, -127.0, -1.0]


def test_rate_of_turn(spark):
    rows = spark.createDataFrame([(v,) for v in (0, 127, -127, 128)], "raw int")
    got = values(rows, rate_of_turn(F.col("raw")))
    assert got[0] == 0.0 and got[3] is None
    assert got[1] == -got[2] == (127 / 4.733) ** 2


def test_navigation_status_15_has_no_label(spark):
    rows = spark.range(16).select(F.col("id").cast("int").alias("code")).orderBy("code")
    got = values(rows, navigation_status(F.col("code")))
    assert got == list(STATUS_LABELS)


def test_known_sums(spark):
    rows = frame(spark, [*KNOWN_LINES, PASSES, FAILS])
    assert values(rows, line_holds(F.col("value"))) == [True] * 7 + [False]


def test_xor_checksum(spark):
    texts = ["", "A", "AB", "AIVDM,1,1,,A,x,0", "é€"]
    assert values(frame(spark, texts), xor_checksum(F.col("value"))) == [xor(t) for t in texts]


def reference_holds(line: str) -> bool:
    """Segment by segment, trailing empty pieces dropped on both splits."""
    if line and not line.strip("!"):
        return True
    for segment in line.rstrip("!").split("!"):
        segment = segment[1:] if segment.startswith("\\") else segment
        segment = segment[:-1] if segment.endswith("\\") else segment
        pieces = segment.rstrip("*").split("*")
        if len(pieces) != 2 or xor(pieces[0]) != pieces[1].upper():
            return False
    return True


def test_line_checksum_against_brute_force():
    rng = random.Random(7)

    def segment() -> str:
        text = "".join(rng.choice("ab,1é\\") for _ in range(rng.randrange(8)))
        total = xor(text) if rng.random() < 0.8 else rng.choice(["4G", "7", "", "123"])
        made = text + "*" + (total.lower() if rng.random() < 0.3 else total)
        made += "*" if rng.random() < 0.1 else ""
        return rng.choice(["", "\\"]) + made + rng.choice(["", "\\"])

    lines = ["", "!", "!!", "*00", "*00!*00", "\\*00\\!\\*00\\", "*", "\\", "!a*61"]
    for _ in range(20000):
        lines.append("!".join(segment() for _ in range(rng.choice([1, 2, 2, 2, 3]))) + rng.choice(["", "", "!"]))
    got = _batch_holds(pa.array(lines), True).to_pylist()
    assert got == [reference_holds(text) for text in lines]
    assert any(got) and not all(got)
    sliced = _batch_holds(pa.array(lines)[500:900], True).to_pylist()
    assert sliced == got[500:900]


def test_word_slices_at_every_position(spark):
    rng = random.Random(5)
    bits = "".join(rng.choice("01") for _ in range(168))
    rows = frame(spark, [armour(bits)])
    words = P.word_columns(F.col("value"), 28)
    staged = rows.select(*[w.alias(f"w{i}") for i, w in enumerate(words)])
    held = [F.col(f"w{i}") for i in range(len(words))]
    spans = [(s, s + n) for n in (1, 2, 6, 30, 60) for s in range(0, 168 - n + 1, 7)]
    row = staged.select(*[P.word_slice(held, 28, s, e).alias(f"{s}_{e}") for s, e in spans]).first()
    for s, e in spans:
        assert row[f"{s}_{e}"] == int(bits[s:e], 2), (s, e)


def test_text_bits_helper_matches_engine(spark):
    text = "HELLO [WORLD] 42?"
    rows = spark.createDataFrame([(text_bits(text, len(text)),)], "bits string")
    assert values(rows, B.six_bit_text(F.col("bits"))) == [text]


def _sum_of(text: str) -> str:
    total = 0
    for unit in memoryview(text.encode("utf-16-le")).cast("H"):
        total ^= unit
    return f"{total:02X}"


def test_sums_of_a_batch_against_one_line_at_a_time():
    """Characters of one to four bytes, sums of two to four digits, odd forms."""
    made = random.Random(5)

    def segment():
        pool = "a1,é漢😀\\ÿā" if made.random() < 0.7 else "ABCxyz,;"
        text = "".join(made.choice(pool) for _ in range(made.randint(0, 9)))
        claimed = _sum_of(text.removeprefix("\\").removesuffix("\\"))
        if made.random() < 0.3:
            claimed = made.choice([claimed.lower(), claimed + "0", "00", "zz", claimed[:1], ""])
        star = made.choice(["*", "*", "*", "**", ""])
        return made.choice(["", "\\"]) + text + star + claimed + made.choice(["", "\\"])

    n_held = 0
    for _ in range(200):
        lines = []
        for _ in range(60):
            parts = [segment() for _ in range(made.choice([1, 2, 2, 2, 3]))]
            line = "!".join(parts) + "!" * made.choice([0, 0, 0, 1, 6])
            lines.append("!" + line if made.random() < 0.1 else line)
        for require_meta in (True, False):
            got = checksum._holds(pa.array(lines), require_meta).tolist()
            assert got == [checksum._text_holds(line, require_meta) for line in lines]
            n_held += sum(got)
    assert n_held > 500


def test_failed_sums_are_those_of_the_rule():
    rows = pa.array(["\\a*61\\!b*62", "\\a*61\\!漢*6f22", "\\a*60\\!b*62", "a", "", "!b*62"])
    told = checksum._batch_sums(rows, True).to_pylist()
    assert [t["holds"] for t in told] == [True, True, False, False, False, False]
    assert [tuple(t.values())[1:] for t in told[2:]] == [
        (0, "60", "61"), (0, None, "61"), (0, None, "00"), (0, None, "00"),
    ]
    assert checksum._batch_sums(rows, False).to_pylist()[5]["holds"]
