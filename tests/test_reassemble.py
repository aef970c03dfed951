from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest

from harbor.operators import reassemble as R
from harbor.operators.ingest import IngestRules, read_sentences
from harbor.messages import messages_from_lines
from tests.synth import frame, line

SCHEMA = (
    "packet_type string, fragment_count int, fragment_n int, message_id int,"
    " radio_channel string, data string, padding int, s string, port int, port_mmsi int,"
    " timestamp timestamp"
)
KEYS = ("packet_type", "fragment_count", "radio_channel", "padding", "s", "port", "port_mmsi")


def sentence(**given):
    row = dict(
        packet_type="AIVDM", fragment_count=2, fragment_n=1, message_id=0, radio_channel="A",
        data="1", padding=0, s="QUAY", port=1, port_mmsi=7, timestamp=None,
    )
    row.update(given)
    return row


def sentences(spark, rows):
    order = [part.split()[0] for part in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(row[c] for c in order) for row in rows], SCHEMA)


def gap_by_hand(rows):
    """Number the sentences of each station and second, then merge."""
    seconds = defaultdict(list)
    for row in rows:
        seconds[row["port_mmsi"], row["timestamp"], row["fragment_count"]].append(row)
    merged = defaultdict(list)
    for group in seconds.values():
        def order(row):
            ties = "|".join("" if row[c] is None else str(row[c]) for c in R.TIE_COLUMNS)
            return row["fragment_n"], hashlib.md5(ties.encode()).hexdigest()
        for i, row in enumerate(sorted(group, key=order), 1):
            key = tuple(row[c] for c in KEYS) + (row["timestamp"], row["fragment_n"] - i)
            merged[key].append((row["fragment_n"], row["data"]))
    return Counter(
        key[:-1] + ("".join(d for _, d in sorted(parts)),) for key, parts in merged.items()
    )


def as_counter(frame):
    rows = frame.select(*KEYS, "timestamp", "data").collect()
    return Counter(tuple(row) for row in rows)


@pytest.mark.parametrize("copies_per_row", [3, 4096])
def test_gap_against_brute_force_with_hot_groups(spark, monkeypatch, copies_per_row):
    monkeypatch.setattr(R, "_COPIES_PER_ROW", copies_per_row)
    monkeypatch.setattr(R, "LARGEST_SECOND", 40)
    rng = random.Random(11)
    rows = []
    for _ in range(600):  # one busy second holds most of the rows, nulls among the keys
        rows.append(
            sentence(
                fragment_count=rng.choice([2, 2, 3, None]),
                fragment_n=rng.choice([1, 2, 3]),
                message_id=rng.choice([None, 1, 2]),
                radio_channel=rng.choice("AB"),
                data=rng.choice("123456789"),
                padding=rng.choice([0, 0, 2, None]),
                port_mmsi=rng.choice([7, 7, 7, None, rng.randrange(100)]),
            )
        )
    rows += [sentence(data="9")] * 300 + [sentence(data="9", fragment_n=2)] * 20
    want = gap_by_hand(rows)
    assert as_counter(R.reassemble(sentences(spark, rows), bypass=False)) == want
    assert any(len(key[-1]) > 1 for key in want)


def test_one_part_messages_bypass_gives_the_same(spark):
    rows = [sentence(fragment_count=1, data=d) for d in "112233"] + [
        sentence(fragment_n=n, data=str(n)) for n in (1, 2)
    ]
    table = sentences(spark, rows)
    want = as_counter(R.reassemble(table, bypass=False))
    assert as_counter(R.reassemble(table)) == want
    assert sum(want.values()) == 7


def test_two_messages_in_one_second(spark):
    """Gap mode merges across them, sequence mode does not."""
    rows = [
        sentence(fragment_n=1, message_id=1, data="1a"),
        sentence(fragment_n=2, message_id=1, data="2a"),
        sentence(fragment_n=1, message_id=2, data="1b"),
        sentence(fragment_n=2, message_id=2, data="2b"),
    ]
    table = sentences(spark, rows)
    gap = sorted(r.data for r in R.reassemble(table).collect())
    assert len(gap) == 3 and sorted(map(len, gap)) == [2, 2, 4]
    linked = R.reassemble(table, "sequence").collect()
    assert sorted((r.data, r.is_complete) for r in linked) == [("1a2a", True), ("1b2b", True)]


def test_padding_keeps_fragments_apart_in_gap_mode_only(spark):
    rows = [sentence(data="1"), sentence(data="2", fragment_n=2, padding=2)]
    table = sentences(spark, rows)
    assert sorted(r.data for r in R.reassemble(table).collect()) == ["1", "2"]
    (row,) = R.reassemble(table, "sequence").collect()
    assert (row.data, row.padding, row.is_complete) == ("12", 2, True)


def test_numbers_above_the_count_do_not_complete_a_message(spark):
    rows = [sentence(data="1"), sentence(data="2", fragment_n=5)]
    (row,) = R.reassemble(sentences(spark, rows), "sequence").collect()
    assert (row.data, row.is_complete) == ("12", False)


def test_lone_fragment_is_kept(spark):
    table = sentences(spark, [sentence(data="2", fragment_n=2)])
    assert [r.data for r in R.reassemble(table).collect()] == ["2"]
    assert [(r.data, r.is_complete) for r in R.reassemble(table, "sequence").collect()] == [("2", False)]


def test_repeated_fragments_count_once_in_sequence_mode(spark):
    rows = [sentence(data="1b"), sentence(data="1a")] * 3 + [sentence(data="2", fragment_n=2)]
    (row,) = R.reassemble(sentences(spark, rows), "sequence").collect()
    assert (row.data, row.is_complete) == ("1a2", True)


def test_misnumbered_one_part_messages(spark):
    lines = [line("15"), line("16", count=1, number=2)]
    rows = frame(spark, lines)
    assert [r.data for r in messages_from_lines(rows).collect()] == ["15"]
    # With every sentence numbered, the two share an identity and merge.
    all_in = messages_from_lines(rows, rules=IngestRules(lone_parts=False))
    assert [r.data for r in all_in.collect()] == ["1516"]
    apart = messages_from_lines(rows, mode="sequence")
    assert sorted(r.data for r in apart.collect()) == ["15", "16"]


def test_empty_merged_message_has_no_type(spark):
    lines = [line("", count=2, number=1), line("", count=2, number=2)]
    (row,) = messages_from_lines(frame(spark, lines)).collect()
    assert (row.data, row.dataBinary, row.id) == ("", "", None)


def test_lines_and_sentences_agree(spark):
    rng = random.Random(2)
    lines = [
        line(str(rng.randrange(10, 99)), 2, rng.choice([1, 2]), rng.randrange(3), epoch=rng.randrange(5))
        for _ in range(200)
    ] + [line("15")] * 5
    rows = frame(spark, lines)
    for mode in ("gap", "sequence"):
        direct = as_counter(messages_from_lines(rows, mode))
        staged = as_counter(R.reassemble(read_sentences(rows), mode))
        assert direct == staged


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        R.reassemble(sentences(spark, [sentence()]), "other")


def test_a_million_parts_of_one_message(spark):
    """What is numbered beyond the bound is left out, and the rest is one short row."""
    parts = spark.range(1, 1_000_001).selectExpr(
        "'AIVDM' AS packet_type", "2 AS fragment_count", "cast(id AS int) AS fragment_n",
        "1 AS message_id", "'A' AS radio_channel", "cast(id % 7 AS string) AS data",
        "0 AS padding", "'QUAY' AS s", "1 AS port", "7 AS port_mmsi", "timestamp_seconds(5) AS timestamp",
    )
    want = "".join(str(i % 7) for i in range(1, R.MAX_NUMBER + 1))
    for mode in ("gap", "sequence"):
        (row,) = R.reassemble(parts, mode).collect()
        assert row.data == want
    assert R.without_place(parts).count() == 1_000_000 - R.MAX_NUMBER


@pytest.mark.parametrize("n", [4_000, 40_000])
def test_buckets_do_not_grow_with_their_second(spark, monkeypatch, n):
    monkeypatch.setattr(R, "LARGEST_SECOND", 1_000)
    rows = spark.range(n).selectExpr(
        "'AIVDM' AS packet_type", "2 AS fragment_count", "cast(1 + id % 2 AS int) AS fragment_n",
        "1 AS message_id", "'A' AS radio_channel", "cast(id AS string) AS data",
        "0 AS padding", "'QUAY' AS s", "1 AS port", "7 AS port_mmsi", "timestamp_seconds(5) AS timestamp",
    )
    usual, large = R._split(rows)
    assert usual.isEmpty()
    sizes = large.selectExpr("fragment_n", "substr(__digest, 1, __digits) AS bucket").groupBy(
        "fragment_n", "bucket"
    ).count()
    assert max(r["count"] for r in sizes.collect()) <= 1_000
    numbers = R.number_fragments(rows).selectExpr("fragment_n - generated_id AS number")
    assert sorted(r.number for r in numbers.collect()) == list(range(1, n + 1))


def test_usual_seconds_are_merged_where_they_are_numbered(spark):
    rows = [sentence(fragment_n=n, data=str(n), port_mmsi=i) for i in range(50) for n in (1, 2)]
    made = R.reassemble(sentences(spark, rows), bypass=False)
    assert len(made.collect()) == 50
    plan = made._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # One exchange folds copies, one brings the second together.
    assert plan.count("+- Exchange") == 2 and plan.count("Window") == 1
