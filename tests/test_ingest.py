from __future__ import annotations

from pyspark.sql import functions as F

from harbor import jobs
from harbor.operators import ingest as I
from harbor.operators.ingest import IngestRules
from harbor.messages import messages_from_lines, messages_from_staged, stage_lines
from tests.synth import KNOWN_LINES, PASSES, frame, line, xor


def body_line(body: str) -> str:
    tags = "s:QUAY//Port=1//MMSI=2,c:3"
    return f"\\{tags}*{xor(tags)}\\!{body}*{xor(body)}"


def outcomes(spark, lines, rules=I.DEFAULT_RULES):
    return [row.outcome for row in I.judged(frame(spark, lines), rules).collect()]


CASES = {
    PASSES: "accepted",
    PASSES + "!": "accepted",
    PASSES.lower().replace("s:quay", "s:QUAY"): "checksum",
    PASSES[PASSES.index("!") :]: "checksum",  # no tag block
    "": "checksum",
    "!": "no_sentence",
    PASSES[: PASSES.index("!")]: "no_sentence",
    body_line("AIVDM,1,1,,A,15"): "few_fields",
    body_line("AIVDM,1,1,,A,,0"): "empty_payload",
    body_line("AIVDM,2,1,,A,,0"): "accepted",  # a part may be empty
    body_line("AIVDM,1,1,,A,15x,0"): "alphabet",
    body_line("AIVDM,1,1,,A,15X,0"): "accepted",
    body_line("AIVDM,1,2,,A,15,0"): "fragment_number",
    body_line("AIVDM,2,,,A,15,0"): "fragment_number",
    body_line("AIVDM,2, 1,,A,15,0"): "fragment_number",
    body_line("AIVDM,2,3000000000,,A,15,0"): "fragment_number",
    body_line("AIVDM,,1,,A,15,0"): "accepted",
    body_line("AIVDM,+1,01,,A,15,0"): "accepted",
}


def test_outcomes(spark):
    assert outcomes(spark, list(CASES)) == list(CASES.values())


def test_accepted_lines_are_those_with_that_outcome(spark):
    rows = frame(spark, list(CASES))
    kept = I.read_sentences(rows).count()
    split = I.whole_messages(rows).count() + I.message_parts(rows).count()
    left_out = I.quarantine(rows).count()
    n_accepted = sum(outcome == "accepted" for outcome in CASES.values())
    assert kept == split == n_accepted
    assert left_out == len(CASES) - n_accepted


def test_rules(spark):
    bare = PASSES[PASSES.index("!") :]
    assert outcomes(spark, [bare], IngestRules(require_meta=False)) == ["accepted"]
    loose = IngestRules(check_sums=False)
    assert outcomes(spark, [PASSES.replace(",A,", ",B,", 1)], loose) == ["accepted"]
    strict = IngestRules(strict_alphabet=True)
    assert outcomes(spark, [body_line("AIVDM,1,1,,A,15X,0")], strict) == ["alphabet"]
    lone = IngestRules(lone_parts=False)
    assert outcomes(spark, [body_line("AIVDM,1,2,,A,15,0")], lone) == ["accepted"]


def test_extra_segments_must_hold_as_well(spark):
    good, bad = PASSES + "!a*61", PASSES + "!a*62"
    assert outcomes(spark, [good, bad]) == ["accepted", "checksum"]


def test_parse_known_line(spark):
    row = I.parse_sentences(frame(spark, [KNOWN_LINES[0]])).first().asDict()
    epoch = row.pop("timestamp").timestamp()
    tags, _, body = KNOWN_LINES[0].partition("!")
    assert row == {
        "packet_type": "AIVDM",
        "fragment_count": 3,
        "fragment_n": 2,
        "message_id": 4,
        "radio_channel": "B",
        "data": "Q8w1",
        "padding": 0,
        "checksum_packet": body[-2:],
        "s": "QUAY",
        "port": 41,
        "port_mmsi": 2190001,
        "checksum_meta": tags[-3:-1],
    }
    assert epoch == 1500000123


def test_unreadable_tags_are_null(spark):
    tags = "x:1//Port=//MMSI=99999999999,d:5"
    row = I.parse_sentences(frame(spark, [f"\\{tags}*00\\!a,b,c,d,e,f,g*1"])).first()
    assert (row.s, row.port, row.port_mmsi, row.timestamp) == ("", None, None, None)
    assert (row.fragment_count, row.padding, row.checksum_meta) == (None, None, "00")


def test_epoch_beyond_an_int_is_null(spark):
    rows = frame(spark, [line("15", epoch=2147483647), line("15", epoch=2147483648)])
    got = [r.t for r in I.parse_sentences(rows).select(F.unix_seconds("timestamp").alias("t")).collect()]
    assert got == [2147483647, None]


def test_six_known_lines_make_three_messages(spark):
    got = messages_from_lines(frame(spark, KNOWN_LINES)).collect()
    assert {(r.fragment_count, r.data, r.id) for r in got} == {
        (1, "Q3", 33),
        (2, "Q0aQ9b", 33),
        (3, "Q7v0Q8w1Q5t2", 33),
    }
    assert len(got) == 3
    assert all(len(r.dataBinary) == 6 * len(r.data) for r in got)


def test_every_line_is_in_the_messages_or_left_out(spark):
    """In both modes, and staged or not; one-part lines numbered otherwise included."""
    odd = [body_line("AIVDM,1,2,,A,15,0"), body_line("AIVDM,1,1234567890,,A,15,0")]
    rows = frame(spark, [*CASES, *odd, *odd, odd[1]])
    for mode in ("gap", "sequence"):
        rules = I.effective(I.DEFAULT_RULES, mode)
        n_left_out = I.quarantine(rows, rules).count()
        any_number = mode == "sequence"
        routed = I.routed(rows, I.effective(I.DEFAULT_RULES, mode), any_number)
        n = {r["route"]: r["count"] for r in routed.groupBy("route").count().collect()}
        assert n[I.LEFT_OUT] == n_left_out and sum(n.values()) == rows.count()
        assert n[I.WHOLE] == I.whole_messages(rows, rules, any_number).count()
        assert n[I.PART] == I.message_parts(rows, rules, any_number).count()
    messages = messages_from_lines(frame(spark, odd * 3), "sequence")
    assert messages.count() == 6  # one to one, however long the number


def test_staged_lines_make_the_same_messages(spark, tmp_path):
    rows = frame(spark, [*CASES, *KNOWN_LINES])
    for mode in ("gap", "sequence"):
        for rules in (I.DEFAULT_RULES, IngestRules(lone_parts=False, parts_in_count=True)):
            path = str(tmp_path / f"{mode}-{rules.lone_parts}")
            staged = stage_lines(rows, path, mode, rules)
            got = messages_from_staged(staged, mode, rules)
            want = messages_from_lines(rows, mode, rules)
            assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_parts_outside_the_count(spark):
    rules = IngestRules(parts_in_count=True)
    lines = [body_line(f"AIVDM,2,{n},,A,15,0") for n in (0, 1, 2, 3)]
    assert outcomes(spark, lines, rules) == ["fragment_number", "accepted", "accepted", "fragment_number"]
    assert I.message_parts(frame(spark, lines), rules).count() == 2
    assert outcomes(spark, lines) == ["accepted"] * 4


def test_quarantine_tells_the_sum_that_failed(spark):
    bad = PASSES[:-2] + "ZZ"
    body = bad[bad.index("!") + 1 : -3]
    rows = I.quarantine(frame(spark, [bad, "junk", body_line("AIVDM,1,1,,A,,0")])).collect()
    got = {r.value: (r.outcome, r.segment, r.claimed, r.computed) for r in rows}
    assert got[bad] == ("checksum", 1, "ZZ", xor(body))
    assert got["junk"] == ("checksum", 0, None, xor("junk"))
    assert got[body_line("AIVDM,1,1,,A,,0")] == ("empty_payload", None, None, None)


def test_quarantine_sums_each_line_once(spark):
    plan = I.quarantine(frame(spark, [PASSES]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_counts(spark):
    rows = frame(spark, [PASSES, PASSES, body_line("AIVDM,1,1,,A,,0"), "junk"])
    got = {(r.outcome, r.id): r.n_lines for r in I.ingest_counts(rows).collect()}
    assert got == {("accepted", 1): 2, ("empty_payload", None): 1, ("checksum", None): 1}


def test_whole_lines_are_not_exchanged(spark):
    plan = I.whole_messages(frame(spark, [PASSES]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    # The pattern is tested below the checksum.
    assert plan.index("ArrowEvalPython") < plan.rindex("RLIKE(value")


def test_numbers_beyond_the_bound_are_left_out(spark):
    near, far = body_line("AIVDM,2,-0999,,A,15,0"), body_line("AIVDM,2,1000,,A,15,0")
    assert outcomes(spark, [near, far]) == ["accepted", "fragment_number"]
    rows = frame(spark, [near, far])
    assert I.message_parts(rows).count() == I.read_sentences(rows).count() == 1
    assert I.sentences_as_messages(rows).count() == 2  # nothing is merged there


def test_a_line_is_split_once_and_told_why(spark):
    bad = PASSES[:-2] + "zz"
    lines = [bad, "\\a*61\\!b*63", "no sum", "", "\\a*61\\!é*E9", "\\a*61\\!é*e8!"]
    found = {r.value: r for r in I.quarantine(frame(spark, lines)).collect()}
    assert {(r.segment, r.claimed) for r in found.values()} == {
        (1, "zz"), (1, "63"), (0, None), (1, "e8"),
    } | {(None, None)}
    assert found["\\a*61\\!b*63"].computed == "62" and found["\\a*61\\!é*e8!"].computed == "E9"
    assert found["\\a*61\\!é*E9"].outcome == "few_fields"
    plan = I.quarantine(frame(spark, lines))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 3  # a line, its sentence, and the last field


def test_ingest_job_leaves_no_staging_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "shared_folder", lambda _: str(tmp_path / "shared"))
    frame(spark, [*CASES, *KNOWN_LINES]).write.text(str(tmp_path / "lines"))
    paths = [str(tmp_path / name) for name in ("lines", "messages", "left_out")]
    jobs.ingest_job(spark, *paths, counts=str(tmp_path / "counts"))
    assert not list((tmp_path / "shared").iterdir())
    rows = spark.read.text(paths[0])
    assert spark.read.parquet(paths[1]).count() == messages_from_lines(rows).count()
    left_out, counts = spark.read.parquet(paths[2]), spark.read.parquet(str(tmp_path / "counts"))
    assert left_out.exceptAll(I.quarantine(rows)).isEmpty()
    assert counts.exceptAll(I.ingest_counts(rows)).isEmpty()
    assert left_out.columns == I.quarantine(rows).columns
