"""Rows to receiver lines, at any size of the table."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from harbor.functions.checksum import text_checksum, xor_checksum
from harbor.functions.payload import PAYLOAD_ALPHABET, TEXT_ALPHABET, bits_of
from trials import lines as L
from trials.encode import sentence, text_bits, with_line

TEXTS = ["", "A", "a b", "P000123", "WITH_~", "é", "日本", "😀x", "A`{", "\n", "AB\n", "[\\]^_", "X" * 30, "@@", None]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(3)


def test_sums_by_the_batch(texts):
    text = F.col("text")
    found = texts.select("text", xor_checksum(text).alias("a"), text_checksum(text).alias("b")).collect()
    assert len(found) == len(TEXTS)
    assert all(r.a == r.b for r in found)
    assert texts.limit(0).select(text_checksum(text)).count() == 0


@pytest.mark.parametrize("n_chars", [7, 20])
def test_bits_of_texts(texts, n_chars):
    filled = F.rpad("text", n_chars, "@")
    plain = bits_of(F.translate(filled, TEXT_ALPHABET, PAYLOAD_ALPHABET))
    found = texts.select(plain.alias("a"), text_bits(F.col("text"), n_chars).alias("b")).collect()
    assert len(found) == len(TEXTS)
    assert all(r.a == r.b for r in found)


def test_a_file_in_one_piece_becomes_lines_on_all_cores(spark, tmp_path):
    """message_type_counts: one row group, that one task reads."""
    start = datetime.datetime(2024, 1, 1)
    rows = [(i, start, i % 7, 1.5) for i in range(50)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, value double")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    made = L.events(spark, str(tmp_path))
    assert made.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert {r.event_id for r in made.select("event_id").collect()} == set(range(50))


def test_lines_are_summed_by_the_batch(texts, capsys):
    """messages_sequence, raw_messages: not character by character."""
    with_line(texts, F.lit("s:QUAY"), sentence(F.col("text"))).select("value").explain()
    plan = capsys.readouterr().out
    assert "ArrowEvalPython" in plan and "aggregate(" not in plan
