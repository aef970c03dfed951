"""Awkward documents, and what the driver's contract says of some, by brute force."""

from __future__ import annotations

import os

import pytest

TABLES = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(TABLES), reason="needs the test tables")

PROSE = (
    "the quick brown fox jumps over the lazy dog while nine small cats watch from afar and seven "
    "tall birds sing softly near an old stone bridge at dusk"
)
LONG = " ".join(f"word{i % 977}x{i}" for i in range(40_000))

ROWS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "eins zwei"),
    (6, PROSE),
    (6, PROSE),  # a repeated row
    (7, PROSE),  # a copy
    (None, PROSE + " again"),
    (None, None),
    (8, LONG),
    (9, "ünïcödé ▁ 漢字 \x00 \u2028 line\r\nend\n" * 3),
]
#: Columns that operators give their results too.
CLASHES = (
    "kept score spans fp component_id n_words label held_out base_failed ids decoded "
    "fingerprint n_bytes root chunk part start size similarity"
).split()


def documents(spark, rows=ROWS):
    """As the table ``documents``, with clashing columns besides."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, "
    schema += ", ".join(f"{c} string" for c in CLASHES)
    filled = [
        (i, t, "en", "s", None if t is None else len(t), *["clash"] * len(CLASHES))
        for i, t in rows
    ]
    return spark.createDataFrame(filled, schema)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, score string")


def ids_of(frame):
    return sorted((r["doc_id"] for r in frame.select("doc_id").collect()), key=lambda i: (i is None, i))


ALL_IDS = sorted((i for i, _ in ROWS), key=lambda i: (i is None, i))
