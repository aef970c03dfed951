from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from harbor import jobs
from harbor.operators import conform as C
from harbor.operators import ingest
from harbor.operators.ranks import with_rank
from harbor.sources.checked_csv import read_checked, write_by_family
from tests.synth import FAILS, KNOWN_LINES, PASSES, POSITION, frame, line


def report(frame):
    return {r["column"]: (r.n_rows, r.n_different) for r in frame.collect()}


def table(spark, rows):
    return spark.createDataFrame(rows, "k int, x double, name string")


def test_compare_by_key(spark):
    left = table(spark, [(1, 1.0, "a"), (2, 2.0, "b"), (3, None, "c"), (4, 4.0, None), (None, 5.0, "e")])
    right = table(spark, [(1, 1.0005, "a"), (2, 2.1, "B"), (3, None, "c"), (4, None, None), (None, 5.0, "e")])
    got = report(C.compare_by_key(left, right, ["k"], {"x": 1e-3}))
    assert got == {
        "x": (5, 2), "name": (5, 1), "(left only)": (0, 0), "(right only)": (0, 0), "(ambiguous)": (0, 0),
    }


def test_compare_by_key_with_repeated_keys(spark):
    left = table(spark, [(1, 1.0, "a")] * 2 + [(2, 2.0, "b"), (2, 3.0, "b"), (3, 1.0, "c"), (5, 1.0, "e")])
    right = table(spark, [(1, 1.0, "a")] * 2 + [(2, 2.0, "b"), (2, 9.0, "b"), (4, 1.0, "d"), (4, 1.0, "d"), (5, 1.0, "e")])
    got = report(C.compare_by_key(left, right, ["k"]))
    assert got == {
        "x": (3, 0), "name": (3, 0), "(left only)": (1, 1), "(right only)": (2, 2), "(ambiguous)": (4, 4),
    }


def test_different_rows(spark):
    left = table(spark, [(1, 1.0, "a"), (1, 1.0, "a"), (None, None, None), (2, 2.0, "b")])
    right = table(spark, [(1, 1.0, "a"), (None, None, None), (3, 3.0, "c")])
    got = {(r.k, r.side) for r in C.different_rows(left, right).collect()}
    assert got == {(2, "left"), (3, "right")}
    assert C.same_rows(left, left.distinct()) and not C.same_rows(left, right)


def test_rename_select_keeps_the_tables_order(spark):
    got = C.rename_select(table(spark, [(1, 1.0, "a")]), {"name": "n", "k": "key", "absent": "z"})
    assert got.columns == ["key", "n"]


def test_absent_values(spark):
    rows = spark.createDataFrame(
        [(511, 720.2, 60, 102.4, 181.0, 91.0, 260.0, 0, 0, 24, 60, 1),
         (510, -720.1, 59, 102.3, 180.0, 90.0, 360.0, 1, 1, 23, 59, 1)],
        "true_heading int, rot double, timestamp int, sog double, x double, y double, cog double,"
        " eta_month int, eta_day int, eta_hour int, eta_minute int, other int",
    )
    absent, present = C.with_absent_as_null(rows).collect()
    assert list(absent) == [None] * 11 + [1]
    assert list(present) == [510, -720.1, 59, 102.3, 180.0, 90.0, 360.0, 1, 1, 23, 59, 1]


def test_corrections(spark):
    rows = spark.createDataFrame([(True, "a`b", 1), (None, None, None)], "f boolean, t string, n int")
    assert [tuple(r) for r in C.corrected(rows).collect()] == [(1, "a'b", 1), (None, None, None)]
    assert rows.select(C.dashes(F.lit("a_b-c"))).first()[0] == "a-b-c"


def test_csv_by_family(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, None, 'x "y", z'), (3, None, "p"), (5, None, "q"), (24, 0, "r"), (24, 1, "s")],
        "id int, part_num int, rawInput string",
    )
    path = str(tmp_path / "checked")
    write_by_family(rows, path)
    back = read_checked(spark, path, "id int, part_num int, rawInput string, family string")
    got = {(r.family, r.rawInput) for r in back.collect()}
    assert got == {("123", 'x "y", z'), ("123", "p"), ("5", "q"), ("24_0", "r"), ("24_1", "s")}
    inferred = read_checked(spark, path)
    assert dict(inferred.dtypes)["id"] == "int"


def test_messages_from_a_checked_table(spark):
    rows = frame(spark, [PASSES, FAILS, KNOWN_LINES[0]]).withColumnRenamed("value", "rawInput")
    checked = ingest.sentences_as_messages(rows, "rawInput")
    assert sorted(r.data for r in checked.collect()) == sorted([POSITION, "Q8w1"])
    assert ingest.sentences_as_messages(rows, "rawInput", check_sums=False).count() == 3


def test_rebuilding_takes_any_fragment_number(spark):
    lines = [line("15", number=2), line("16", number=""), line("17", 2, "x"), line("", 1, 2)]
    got = ingest.sentences_as_messages(frame(spark, lines)).collect()
    assert sorted(r.data for r in got) == ["15", "16", "17"]


def test_swapped_nulls_and_mixed_types(spark):
    """Under a repeated key, rows are alike only if their values are."""
    schema = "k int, a int, b int"
    left = spark.createDataFrame([(1, None, 5), (1, 1, 1)], schema)
    swapped = spark.createDataFrame([(1, 5, None), (1, 1, 1)], schema)
    assert report(C.compare_by_key(left, swapped, ["k"]))["(ambiguous)"] == (4, 4)
    wider = left.select("k", F.col("a").cast("double").alias("a"), "b")
    got = report(C.compare_by_key(left, wider, ["k"]))
    assert got["(ambiguous)"] == (0, 0) and got["a"] == (2, 0)


def test_jobs_end_to_end(spark, tmp_path):
    source, target = tmp_path / "lines", str(tmp_path / "messages")
    source.mkdir()
    (source / "a.dat").write_text("\n".join([PASSES, FAILS, *KNOWN_LINES, "!", ""]))
    jobs.main(
        ["ingest", str(source / "*.dat"), target, "--quarantine", str(tmp_path / "left_out"),
         "--counts", str(tmp_path / "counts")]
    )
    stored = spark.read.parquet(target)
    assert stored.columns[-1] == "id"
    assert sorted(r.id for r in stored.collect()) == [1, 33, 33, 33]
    left_out = {r.outcome for r in spark.read.parquet(str(tmp_path / "left_out")).collect()}
    assert left_out == {"checksum", "no_sentence"}
    counts = spark.read.parquet(str(tmp_path / "counts")).collect()
    assert sum(r.n_lines for r in counts if r.outcome == "accepted") == 7
    for family in jobs.DECODERS:
        jobs.main(["decode", family, target, str(tmp_path / f"decoded_{family}")])
    table = spark.read.parquet(str(tmp_path / "decoded_123"))
    assert [r.mmsi for r in table.collect()] == [219018271]


def test_job_flags(spark, tmp_path):
    source = tmp_path / "lines"
    source.mkdir()
    lines = [
        PASSES, PASSES[PASSES.index("!") :], FAILS, line("15X"), line("15", number=2),
        line("15", 2, 3), line("15", 2, 1),
    ]
    (source / "a.dat").write_text("\n".join(lines))

    def n_messages(*flags):
        target = str(tmp_path / f"messages{''.join(flags)}")
        jobs.main(["ingest", str(source), target, *flags])
        return spark.read.parquet(target).count()

    plain = n_messages()
    assert n_messages("--bare") == plain + 1
    assert n_messages("--unchecked", "--no-bits", "--no-compact") == plain + 2
    assert n_messages("--strict") == plain - 1
    assert n_messages("--parts-in-count") == plain - 1
    assert n_messages("--mode", "sequence") == plain
    assert n_messages("--number-all") >= 1

    target = str(tmp_path / "messages")
    decoded = str(tmp_path / "decoded")
    jobs.main(["decode", "123", target, decoded, "--extras", "--course-absent", "3600"])
    assert "radio_status" in spark.read.parquet(decoded).columns
    jobs.main(["decode", "5", target, decoded + "5", "--trim-text"])
    jobs.main(["decode", "24", target, decoded + "24", "--trim-text", "--by-number-only"])
    with pytest.raises(SystemExit):
        jobs.main(["decode", "18", target, decoded + "18", "--extras"])


def test_compare_job(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, None, 219018271, 12.3, PASSES), (1, None, 219018271, 99.0, FAILS)],
        "id int, part_num int, mmsi int, sog double, rawInput string",
    )
    path, target = str(tmp_path / "checked"), str(tmp_path / "report")
    write_by_family(rows, path)
    jobs.main(
        ["compare", "123", path, target, "--names", "mmsi=mmsi,speed_over_ground=sog",
         "--keys", "mmsi", "--tolerances", "sog=0.001"]
    )
    got = report(spark.read.parquet(target))
    assert got["(ambiguous)"] == (3, 3)


def test_repeated_keys_within_and_beyond_the_tolerance(spark):
    schema = "k int, name string, x double"
    left = spark.createDataFrame(
        [(1, "a", 1.0), (1, "a", 2.0), (1, "b", 5.0), (None, "c", 1.0), (None, "c", None), (2, "d", 1.0)],
        schema,
    )
    right = spark.createDataFrame(
        [(1, "b", 5.0), (1, "a", 2.0005), (1, "a", 1.5), (None, "c", None), (None, "c", 1.0), (3, "e", 1.0)],
        schema,
    )
    plain = report(C.compare_by_key(left, right, ["k"], {"x": 0.001}))
    assert plain["(ambiguous)"] == (6, 6)
    ranked = report(C.compare_by_key(left, right, ["k"], {"x": 0.001}, by_rank=True))
    assert ranked["(ambiguous)"] == (0, 0)
    assert ranked["x"] == (5, 1) and ranked["name"] == (5, 0)
    assert ranked["(left only)"] == ranked["(right only)"] == (1, 1)
    more = left.union(left.where("k = 2"))
    assert report(C.compare_by_key(more, left, ["k"], by_rank=True))["(left only)"] == (1, 1)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_ranks_across_ranges(spark, partitions):
    """One key holds most of the rows; no window sees all of it."""
    made = random.Random(3)
    rows = [(made.choice([None, 1, 1, 1, 1, 2]), made.choice([None, *range(50)]), i) for i in range(900)]
    table = spark.createDataFrame(rows, "k int, v int, id int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = with_rank(table, ["k"], ["v", "id"], "n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    by_key = {}
    for k, v, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        by_key.setdefault(k, []).append(i)
    assert {(r.k, r.n): r.id for r in got} == {
        (k, n): i for k, ids in by_key.items() for n, i in enumerate(ids, 1)
    }
