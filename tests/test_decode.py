from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from harbor.operators import decode as D
from harbor.operators import static_reports as S
from harbor.messages import messages_from_lines
from tests.labels import STATUS_LABELS
from tests.synth import PASSES, frame, line, number_bits, payload, text_bits


def messages(spark, payloads, epochs=None):
    epochs = epochs or range(1000, 1000 + len(payloads))
    lines = [line(data, epoch=epoch) for data, epoch in zip(payloads, epochs)]
    return messages_from_lines(frame(spark, lines))


def by_time(table):
    return [row.asDict() for row in table.orderBy("timestamp").collect()]


def position_a(**given):
    field = dict(
        type=1, repeat=0, mmsi=1, status=0, turn=0, speed=0, accuracy=0, lon=0, lat=0,
        course=0, heading=0, second=0, manoeuvre=0, spare=0, raim=0, radio=0,
    )
    field.update(given)
    widths = (6, 2, 30, 4, 8, 10, 1, 28, 27, 12, 9, 6, 2, 3, 1, 19)
    return payload(*zip(field.values(), widths))


def test_known_position(spark):
    (row,) = by_time(D.drop_working(D.decode_position_a(messages_from_lines(frame(spark, [PASSES])))))
    assert row.pop("timestamp").timestamp() == 1500000500
    assert row == {
        "port": 41, "port_mmsi": 2190001, "id": 1, "repeat_indicator": 2,
        "mmsi": 219018271, "navigation_status": "Moored", "rate_of_turn": -((20 / 4.733) ** 2),
        "speed_over_ground": 12.3, "position_accuracy": 1, "longitude": 7350123 / 600000,
        "latitude": 33660456 / 600000, "course_over_ground": 271.5, "true_heading": 269,
        "timestamp_seconds": 37, "manoeuvre_indicator": 1, "raim": 1,
    }


def test_position_boundaries(spark):
    cases = [
        (dict(turn=127), "rate_of_turn", (127 / 4.733) ** 2),
        (dict(turn=-127), "rate_of_turn", -((127 / 4.733) ** 2)),
        (dict(turn=-128), "rate_of_turn", None),
        (dict(speed=1022), "speed_over_ground", 102.2),
        (dict(speed=1023), "speed_over_ground", None),
        (dict(course=2600), "course_over_ground", None),
        (dict(course=3600), "course_over_ground", 360.0),
        (dict(lon=181 * 600000), "longitude", None),
        (dict(lon=-180 * 600000), "longitude", -180.0),
        (dict(lon=190 * 600000), "longitude", 190.0),
        (dict(lon=-(1 << 27)), "longitude", (1 << 27) / 600000.0),
        (dict(lat=91 * 600000), "latitude", None),
        (dict(lat=-1), "latitude", -1 / 600000.0),
        (dict(heading=510), "true_heading", 510),
        (dict(heading=511), "true_heading", None),
        (dict(second=59), "timestamp_seconds", 59),
        (dict(second=60), "timestamp_seconds", None),
        (dict(type=3, mmsi=(1 << 30) - 1), "mmsi", (1 << 30) - 1),
    ] + [(dict(status=s), "navigation_status", STATUS_LABELS[s]) for s in range(16)]
    rows = by_time(D.decode_position_a(messages(spark, [position_a(**c[0]) for c in cases])))
    assert len(rows) == len(cases)
    for row, (given, column, want) in zip(rows, cases):
        assert row[column] == want, given


def test_position_options(spark):
    table = messages(spark, [position_a(course=2600, spare=5, radio=70000), position_a(course=3600)])
    rows = by_time(D.decode_position_a(table, extras=True, course_absent=3600))
    assert [r["course_over_ground"] for r in rows] == [260.0, None]
    assert (rows[0]["spare"], rows[0]["radio_status"]) == (5, 70000)


def test_random_positions_round_trip(spark):
    rng = random.Random(4)
    given = [
        dict(
            type=rng.choice([1, 2, 3]), repeat=rng.randrange(4), mmsi=rng.randrange(1 << 30),
            speed=rng.randrange(1023), accuracy=rng.randrange(2),
            lon=rng.randrange(-108000000, 108000000), lat=rng.randrange(-54000000, 54000000),
            heading=rng.randrange(511), second=rng.randrange(60), manoeuvre=rng.randrange(4),
            raim=rng.randrange(2), radio=rng.randrange(1 << 19),
        )
        for _ in range(200)
    ]
    rows = by_time(D.decode_position_a(messages(spark, [position_a(**g) for g in given]), extras=True))
    for row, g in zip(rows, given):
        assert (row["id"], row["repeat_indicator"], row["mmsi"]) == (g["type"], g["repeat"], g["mmsi"])
        assert row["speed_over_ground"] == g["speed"] / 10.0
        assert (row["longitude"], row["latitude"]) == (g["lon"] / 600000.0, g["lat"] / 600000.0)
        assert (row["true_heading"], row["timestamp_seconds"]) == (g["heading"], g["second"])
        assert (row["manoeuvre_indicator"], row["raim"]) == (g["manoeuvre"], g["raim"])
        assert (row["position_accuracy"], row["radio_status"]) == (g["accuracy"], g["radio"])


def test_other_lengths_and_types_are_left_out(spark):
    full = position_a()
    table = messages(spark, [full, full[:27], full + "0", position_a(type=4)])
    assert D.decode_position_a(table).count() == 1
    assert D.decode_position_b(table).count() == 0


def test_class_b_position(spark):
    values = (18, 2, 300000001, 0, 55, 1, -600000, 1200000, 0, 90, 30, 0, 1, 0, 1, 0, 1, 0, 1, 0)
    widths = (6, 2, 30, 8, 10, 1, 28, 27, 12, 9, 6, 2, 1, 1, 1, 1, 1, 1, 1, 20)
    (row,) = by_time(D.drop_working(D.decode_position_b(messages(spark, [payload(*zip(values, widths))]))))
    del row["timestamp"]
    assert row == {
        "port": 5, "port_mmsi": 2750009, "id": 18, "repeat_indicator": 2, "mmsi": 300000001,
        "speed_over_ground": 5.5, "position_accuracy": 1, "longitude": -1.0, "latitude": 2.0,
        "true_heading": 90, "timestamp_seconds": 30, "cs_unit": 1, "dsc_flag": 1,
        "display_flag": 0, "band_flag": 0, "message_22_flag": 1, "assigned": 0, "raim": 1,
    }


VOYAGE = payload(
    (5, 6), (0, 2), (400000001, 30), (1, 2), (9000001, 30), ("CALL  1", 7), ("SHIP NAME", 20),
    (70, 8), (100, 9), (20, 9), (10, 6), (11, 6), (1, 4), (0, 4), (0, 5), (24, 5), (60, 6),
    (85, 8), ("NORTH_SEA, 12", 20), (1, 1), (0, 1),
)


def test_voyage(spark):
    (row,) = by_time(D.drop_working(D.decode_static_voyage(messages(spark, [VOYAGE]))))
    del row["timestamp"]
    assert row == {
        "port": 5, "port_mmsi": 2750009, "id": 5, "repeat_indicator": 0, "mmsi": 400000001,
        "ais_version": 1, "imo": 9000001, "call_sign": "CALL  1",
        "ship_name": "SHIP NAME@@@@@@@@@@@", "type_and_cargo": 70, "to_bow": 100,
        "to_stern": 20, "to_port": 10, "to_starboard": 11, "epfd": 1, "eta_month": None,
        "eta_day": None, "eta_hour": None, "eta_min": None, "draught": 8.5,
        "destination": "NORTH_SEA, 12@@@@@@@", "data_terminal_ready": 1,
    }
    (row,) = by_time(D.decode_static_voyage(messages(spark, [VOYAGE]), trim_text=True))
    assert (row["ship_name"], row["destination"]) == ("SHIP NAME", "NORTH_SEA, 12")


def test_voyage_of_every_length(spark):
    """Each field reads what is left of its bits, as a smaller number."""
    lengths = range(7, len(VOYAGE) + 4)
    texts = [(VOYAGE + "000")[:n] for n in lengths]
    bits = {
        "imo": (40, 70), "to_starboard": (264, 270), "data_terminal_ready": (422, 423),
        "type_and_cargo": (232, 240), "mmsi": (8, 38),
    }
    strings = {"call_sign": (70, 112), "ship_name": (112, 232), "destination": (302, 422)}
    rows = by_time(D.decode_static_voyage(messages(spark, texts)))
    assert len(rows) == len(texts)
    for row in rows:
        whole = row["dataBinary"]
        for name, (start, end) in bits.items():
            part = whole[start:end]
            assert row[name] == (int(part, 2) if part else None), (name, len(whole))
        for name, (start, end) in strings.items():
            part = whole[start:end]
            groups = [int(part[i : i + 6], 2) for i in range(0, len(part), 6)]
            want = "".join(chr(v + 64 if v < 32 else v) for v in groups) if part else None
            assert row[name] == want, (name, len(whole))


def name_part(mmsi, name, n_chars=28):
    return payload((24, 6), (0, 2), (mmsi, 30), (0, 2), (name, 20), (0, 8))[:n_chars]


def detail_part(mmsi, n_chars=28):
    return payload(
        (24, 6), (1, 2), (mmsi, 30), (1, 2), (37, 8), ("VENDOR1", 7), ("CALL123", 7),
        (10, 9), (20, 9), (3, 6), (4, 6), (0, 6),
    )[:n_chars]


def test_static_reports_join(spark):
    given = [
        (name_part(1, "ONE"), 10), (detail_part(1), 10),
        (detail_part(2), 20), (name_part(2, "LATE"), 21),
        (name_part(3, "FIRST"), 30), (name_part(3, "SECOND"), 30), (name_part(3, "SECOND"), 30),
        (detail_part(3, 27), 30),
        (name_part(4, "NO TIME"), ""), (detail_part(4), ""),
    ]
    table = messages(spark, [g[0] for g in given], [g[1] for g in given])
    got = S.decode_static_reports(table, trim_text=True)
    assert got.columns[:2] == ["mmsi", "timestamp"] and got.columns[-1] == "ship_name"
    pairs = sorted((r.mmsi, r.ship_name or "") for r in got.collect())
    assert pairs == [(1, "ONE"), (2, ""), (3, "FIRST"), (3, "SECOND"), (4, "")]
    row = got.where("mmsi = 1").first()
    assert (row.ship_type, row.vendor_id, row.call_sign) == (37, "VENDOR1", "CALL123")
    assert (row.to_bow, row.to_stern, row.to_port, row.to_starboard) == (10, 20, 3, 4)
    assert row.mothership_mmsi == (10 << 21) + (20 << 12) + (3 << 6) + 4
    assert S.name_parts(table).count() == 5


def test_short_name_part_counts_as_both(spark):
    table = messages(spark, [name_part(1, "SHORT", 27), name_part(2, "LONG"), detail_part(3, 27)])
    assert sorted(r.mmsi for r in S.name_parts(table).collect()) == [1, 2]
    assert sorted(r.mmsi for r in S.detail_parts(table).collect()) == [1, 3]
    assert [r.mmsi for r in S.detail_parts(table, by_number_only=True).collect()] == [3]
    parts = {r.mmsi: r.part_number for r in S.with_part_number(table).collect()}
    assert parts == {1: 0, 2: 0, 3: 1}
    row = S.detail_parts(table).where("mmsi = 1").first()
    assert row.ship_type == int((text_bits("SHORT", 20))[:8], 2)


def test_stored_table_is_read_by_partition_and_column(spark, tmp_path):
    from harbor.sources.tables import read_messages, write_messages

    path = str(tmp_path / "messages")
    write_messages(messages(spark, [position_a(), position_a(type=3), VOYAGE]), path)
    table = D.drop_working(D.decode_position_a(read_messages(spark, path)))
    plan = table._jdf.queryExecution().executedPlan().toString()
    scan = next(text for text in plan.splitlines() if "FileScan" in text)
    assert "PartitionFilters: [isnotnull(id" in scan
    assert "dataBinary" not in scan.split("ReadSchema")[1]
    assert "Exchange" not in plan and "EvalPython" not in plan
    assert table.count() == 2


def test_empty_and_whole_words(spark):
    assert number_bits(-1, 4) == "1111"
    assert D.decode_position_a(messages(spark, [VOYAGE])).count() == 0


@pytest.mark.parametrize("name", ["data", "dataBinary", "packet_type", "fragment_count", "radio_channel", "padding", "s"])
def test_drop_working(spark, name):
    table = messages(spark, [position_a()])
    assert name in table.columns
    assert name not in D.drop_working(table).columns


def test_time_stays(spark):
    table = D.drop_working(messages(spark, [position_a()], [42]))
    assert table.select(F.unix_seconds("timestamp")).first()[0] == 42


def test_generated_methods_are_short_enough_to_be_compiled(spark, tmp_path):
    """HotSpot compiles no method above 8000 bytes."""
    path = str(tmp_path / "messages")
    spark.createDataFrame(
        [("5" * 71, 5, 1)], "data string, id int, timestamp int"
    ).write.parquet(path)
    stored = spark.read.parquet(path)
    debug = getattr(spark._jvm, "org.apache.spark.sql.execution.debug.package")
    for decoded in (
        D.decode_static_voyage(stored),
        D.decode_position_a(stored),
        D.decode_position_b(stored),
        S.detail_parts(stored),
    ):
        plan = D.drop_working(decoded)._jdf.queryExecution().executedPlan()
        stages = debug.codegenStringSeq(plan)
        assert stages.size() > 0
        for i in range(stages.size()):
            assert 0 < stages.apply(i)._3().maxMethodCodeSize() < 8000
