"""Trial queries, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harbor import jobs
from harbor.functions import bitstring as B
from harbor.functions.readings import navigation_status
from harbor.operators import conform, decode, ingest, reassemble, static_reports
from harbor.operators.ingest import IngestRules
from harbor.messages import messages_from_lines, messages_from_staged, stage_lines
from harbor.sources.checked_csv import read_checked, write_by_family
from harbor.sources.tables import read_messages, read_table, write_messages, write_table
from trials import fields as D
from trials import lines as L

Query = Callable[[SparkSession, str], DataFrame]


def with_epoch(frame: DataFrame) -> DataFrame:
    """``timestamp`` as ``epoch``, which reads the same in every time zone."""
    return frame.select(
        *[c for c in frame.columns if c != "timestamp"],
        F.unix_seconds("timestamp").alias("epoch"),
    )


def rounded(frame: DataFrame) -> DataFrame:
    """Rate of turn to six decimals; powers differ in the last bit by engine."""
    return frame.withColumn("rate_of_turn", F.round("rate_of_turn", 6))


def decoded(frame: DataFrame) -> DataFrame:
    return with_epoch(decode.drop_working(frame))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_lines(L.event_lines(spark, sf_dir))


# Sources and sinks


def source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.event_lines(spark, sf_dir)


def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = L.shared_folder(spark) + "/messages"
    lines = L.event_lines(spark, sf_dir).union(L.order_lines(spark, sf_dir))
    write_messages(messages_from_lines(lines), path, compact=True)
    stored = read_messages(spark, path)
    return decode.of_types(stored, (1, 2, 3)).select(
        "id", "data", "dataBinary", "port_mmsi", F.unix_seconds("timestamp").alias("epoch")
    )


def decoded_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = L.shared_folder(spark)
    write_messages(messages_from_lines(L.order_lines(spark, sf_dir)), base + "/messages")
    table = decode.decode_position_b(read_messages(spark, base + "/messages"))
    write_table(decode.drop_working(table), base + "/decoded")
    return with_epoch(read_table(spark, base + "/decoded"))


def csv_by_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = L.shared_folder(spark) + "/checked"
    lines = L.event_lines(spark, sf_dir).union(L.customer_lines(spark, sf_dir))
    messages = messages_from_lines(lines)
    positions = decode.decode_position_a(messages).select(
        "id", F.lit(None).cast("int").alias("part_num"), "mmsi", "navigation_status", "data"
    )
    reports = static_reports.with_part_number(messages).select(
        "id",
        F.col("part_number").alias("part_num"),
        "mmsi",
        F.lit('a "quoted", text').alias("navigation_status"),
        "data",
    )
    write_by_family(positions.unionByName(reports), path)
    return read_checked(
        spark,
        path,
        "id int, part_num int, mmsi int, navigation_status string, data string, family string",
    )


# Filters


def checksum_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.checksum_filter(L.spoilt_lines(spark, sf_dir))


def bare_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = IngestRules(require_meta=False)
    return with_epoch(ingest.read_sentences(L.spoilt_lines(spark, sf_dir), rules))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.quarantine(L.faulty_lines(spark, sf_dir))


# Parsing, reassembly, unpacking


def parse_sentence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_epoch(ingest.parse_sentences(L.event_lines(spark, sf_dir)))


def reassemble_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_epoch(reassemble.reassemble(L.fragments(spark, sf_dir), bypass=False))


def reassemble_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_epoch(reassemble.reassemble(L.fragments(spark, sf_dir), mode="sequence"))


def reassemble_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More copies of one sentence than are unfolded together."""
    return with_epoch(reassemble.reassemble(L.hot_fragments(spark, sf_dir), bypass=False))


def messages_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = L.fragment_lines(spark, sf_dir, D.MIXED)
    return with_epoch(messages_from_lines(lines, "sequence", keep_bits=False))


def staged_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages by way of staged lines."""
    rules = IngestRules()
    lines = L.fragment_lines(spark, sf_dir, D.MIXED)
    staged = stage_lines(lines, L.shared_folder(spark) + "/staged", "sequence", rules)
    return with_epoch(messages_from_staged(staged, "sequence", rules, keep_bits=False))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = L.spoilt_lines(spark, sf_dir).union(L.fragment_lines(spark, sf_dir))
    return with_epoch(messages_from_lines(lines, keep_bits=False))


def unpack_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_messages(spark, sf_dir).select("data", "dataBinary", "id")


def message_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        L.event_lines(spark, sf_dir)
        .union(L.order_lines(spark, sf_dir))
        .union(L.part_lines(spark, sf_dir))
        .union(L.customer_lines(spark, sf_dir))
    )
    messages = messages_from_lines(lines, keep_bits=False)
    return messages.groupBy("id").agg(F.count(F.lit(1)).alias("n_messages"))


def drop_working(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_epoch(decode.drop_working(event_messages(spark, sf_dir)))


# Scalar functions over bit text


def bit_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    bits = F.col("dataBinary")
    return (
        event_messages(spark, sf_dir)
        .where(F.col("id").between(1, 3))
        .select(
            B.message_type_of_bits(bits).alias("id"),
            B.extract_int(bits, 8, 38).alias("mmsi"),
            B.extract_signed(bits, 42, 50).alias("turn"),
            B.extract_signed(bits, 61, 89).alias("lon"),
            B.extract_int(bits, 168, 170).alias("past_end"),
            B.string_length(bits).alias("n_bits"),
            navigation_status(B.extract_int(bits, 38, 42)).alias("status"),
        )
    )


def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = messages_from_lines(L.part_lines(spark, sf_dir))
    bits = F.col("dataBinary")
    return messages.select(
        F.unix_seconds("timestamp").alias("epoch"),
        B.extract_string(bits, 70, 112).alias("call_sign"),
        B.extract_string(bits, 302, 422).alias("destination"),
        B.extract_string(bits, 432, 438).alias("past_end"),
    )


# Decoding


def decode_123(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = event_messages(spark, sf_dir)
    return rounded(decoded(decode.decode_position_a(messages, extras=True)))


def decode_123_course(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = decode.decode_position_a(event_messages(spark, sf_dir), course_absent=3600)
    return table.select("mmsi", F.unix_seconds("timestamp").alias("epoch"), "course_over_ground")


def nav_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = decode.decode_position_a(event_messages(spark, sf_dir))
    return table.groupBy("navigation_status").agg(F.count(F.lit(1)).alias("n_messages"))


def positions_by_ship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receiver lines to one row per ship: the engine end to end."""
    table = decode.decode_position_a(event_messages(spark, sf_dir))
    return table.groupBy("mmsi").agg(
        F.count(F.lit(1)).alias("n_positions"),
        F.min("longitude").alias("west"),
        F.max("longitude").alias("east"),
        F.min("latitude").alias("south"),
        F.max("latitude").alias("north"),
        F.max("speed_over_ground").alias("top_speed"),
        F.min(F.unix_seconds("timestamp")).alias("first_heard"),
        F.max(F.unix_seconds("timestamp")).alias("last_heard"),
    )


def decode_18(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = messages_from_lines(L.order_lines(spark, sf_dir))
    return decoded(decode.decode_position_b(messages))


def decode_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = messages_from_lines(L.part_lines(spark, sf_dir))
    return decoded(decode.decode_static_voyage(messages))


def decode_5_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = messages_from_lines(L.supplier_lines(spark, sf_dir), mode="sequence")
    return decoded(decode.decode_static_voyage(messages, trim_text=True))


def _customer_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_lines(L.customer_lines(spark, sf_dir))


def decode_24_part_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded(static_reports.with_part_number(_customer_messages(spark, sf_dir)))


def decode_24_part_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_epoch(static_reports.name_parts(_customer_messages(spark, sf_dir)))


def decode_24_part_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded(static_reports.detail_parts(_customer_messages(spark, sf_dir)))


def decode_24(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decoded(static_reports.decode_static_reports(_customer_messages(spark, sf_dir)))


def decode_24_by_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = _customer_messages(spark, sf_dir)
    return decoded(
        static_reports.decode_static_reports(messages, by_number_only=True, trim_text=True)
    )


# Conformance


def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.ingest_counts(L.faulty_lines(spark, sf_dir))


def _raw_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spoilt lines as the ``rawInput`` column of a CSV table."""
    path = L.shared_folder(spark) + "/raw_input"
    L.spoilt_lines(spark, sf_dir).select(F.col("value").alias("rawInput")).write.option(
        "header", True
    ).option("escape", '"').csv(path)
    return read_checked(spark, path, "rawInput string")


def rebuild_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.sentences_as_messages(_raw_input(spark, sf_dir), "rawInput")
    return with_epoch(rows).select("data", "id", "fragment_n", "port_mmsi", "epoch")


def rebuild_unchecked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.sentences_as_messages(
        _raw_input(spark, sf_dir), "rawInput", check_sums=False
    )
    return with_epoch(rows).select("data", "id", "radio_channel", "port_mmsi", "epoch")


NEW_NAMES = {
    "id": "id",
    "repeat_indicator": "repeat_indicator",
    "mmsi": "mmsi",
    "longitude": "x",
    "latitude": "y",
    "navigation_status": "nav_status",
    "speed_over_ground": "sog",
    "course_over_ground": "cog",
    "raim": "raim",
}


def rename_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = decode.decode_position_a(event_messages(spark, sf_dir))
    return conform.rename_select(table, NEW_NAMES)


def _event_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = L.events(spark, sf_dir)
    return rows.select(
        F.col("radio_raw").cast("int").alias("number"),
        F.col("epoch"),
        F.col("mmsi_raw").cast("int").alias("mmsi"),
        F.col("speed_raw"),
        F.col("lat_raw"),
        "event_id",
    )


def _checked_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An independent table with known deviations from the decoded one."""
    event, speed, lat = F.col("event_id"), F.col("speed_raw"), F.col("lat_raw")
    sog = F.when(speed != 1023, speed / F.lit(10.0))
    return (
        _event_numbers(spark, sf_dir)
        .select(
            F.when(event % 13 == 0, -1 - F.col("number")).otherwise(F.col("number")).alias("number"),
            "epoch",
            F.when(event % 19 == 0, F.col("mmsi") + 1).otherwise(F.col("mmsi")).alias("mmsi"),
            F.when(event % 11 == 0, sog + 0.01).otherwise(sog).alias("sog"),
            F.when(lat != 54600000, lat / F.lit(600000.0) + 1e-12).alias("y"),
            F.explode(
                F.when(event % 17 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
            ).alias("copy"),
        )
        .drop("copy")
    )


def _decoded_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = decode.decode_position_a(event_messages(spark, sf_dir), extras=True)
    return table.select(
        F.col("radio_status").alias("number"),
        F.unix_seconds("timestamp").alias("epoch"),
        "mmsi",
        F.col("speed_over_ground").alias("sog"),
        F.col("latitude").alias("y"),
    )


def compare_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = conform.compare_by_key(
        _decoded_positions(spark, sf_dir),
        _checked_positions(spark, sf_dir),
        ["number", "epoch"],
        {"y": 1e-11},
        tolerance=1e-3,
    )
    return report.withColumn("max_difference", F.round("max_difference", 6))


def compare_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tables by hour alone, a key of very many rows each."""
    hour = F.floor(F.col("epoch") / 3600).alias("hour")
    report = conform.compare_by_key(
        _decoded_positions(spark, sf_dir).select(hour, "mmsi", "sog", "y"),
        _checked_positions(spark, sf_dir).select(hour, "mmsi", "sog", "y"),
        ["hour"],
        {"mmsi": 0, "y": 1e-11},
        tolerance=1e-3,
        by_rank=True,
    )
    return report.withColumn("max_difference", F.round("max_difference", 6))


CHAIN_NAMES = {
    "radio_status": "number",
    "mmsi": "mmsi",
    "speed_over_ground": "sog",
    "longitude": "x",
}


def conformance_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A checked CSV table, its raw lines rebuilt, decoded, renamed and compared."""
    path = L.shared_folder(spark) + "/checked_lines"
    event, speed = F.col("event_id"), F.col("speed_raw")
    sog = F.when(speed != 1023, speed / F.lit(10.0))
    L.spoilt_events(spark, sf_dir).select(
        F.col("radio_raw").alias("number"),
        F.col("mmsi_raw").alias("mmsi"),
        F.when(event % 11 == 0, sog + 0.01).otherwise(sog).alias("sog"),
        (F.col("lon_raw") / F.lit(600000.0)).alias("x"),
        F.col("value").alias("rawInput"),
    ).write.option("header", True).option("escape", '"').csv(path)
    report = jobs.compared(
        read_checked(spark, path, "number int, mmsi int, sog double, x double, rawInput string"),
        "123",
        CHAIN_NAMES,
        ["number", "mmsi"],
        {"sog": 1e-3, "x": 1e-9},
        extras=True,
    )
    return report.withColumn("max_difference", F.round("max_difference", 6))


def strict_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = IngestRules(strict_alphabet=True)
    rows = ingest.read_sentences(L.event_lines(spark, sf_dir), rules)
    return with_epoch(rows).select("data", "port_mmsi", "epoch")


def compare_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = ["number", "epoch", "mmsi"]
    return conform.different_rows(
        _decoded_positions(spark, sf_dir).select(*keep),
        _checked_positions(spark, sf_dir).select(*keep),
    )


def null_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")

    def cycle(*values: float) -> Column:
        chosen = F.array(*[F.lit(float(v)) for v in values])
        return F.element_at(chosen, (event % len(values) + 1).cast("int"))

    table = L.table(spark, sf_dir, "events").select(
        "event_id",
        cycle(510, 511, 0).alias("true_heading"),
        cycle(720.1, 720.2, -720.2, -720.1, 0).alias("rot"),
        cycle(59, 60, 63).alias("timestamp"),
        cycle(102.3, 102.4, 0).alias("sog"),
        cycle(181, 180.9, -181).alias("x"),
        cycle(91, 90.9, -91).alias("y"),
        cycle(260, 259.9, 360).alias("cog"),
        cycle(0, 1, 12).alias("eta_month"),
        cycle(0, 1, 31).alias("eta_day"),
        cycle(24, 23, 0).alias("eta_hour"),
        cycle(60, 59, 0).alias("eta_minute"),
    )
    return conform.with_absent_as_null(table)


def text_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = L.table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("value") > 10).alias("is_large"),
        F.translate("event_type", "i", "`").alias("kind"),
        F.concat_ws("_", "event_type", "props").alias("label"),
    )
    return conform.corrected(table).withColumn("label", conform.dashes(F.col("label")))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        source_lines,
        partitioned_roundtrip,
        decoded_roundtrip,
        csv_by_family,
        checksum_filter,
        bare_sentences,
        quarantine,
        parse_sentence,
        reassemble_gap,
        reassemble_sequence,
        reassemble_hot,
        messages_sequence,
        staged_sequence,
        raw_messages,
        unpack_bits,
        message_type_counts,
        drop_working,
        bit_functions,
        text_functions,
        decode_123,
        decode_123_course,
        nav_status,
        positions_by_ship,
        decode_18,
        decode_5,
        decode_5_fragments,
        decode_24_part_number,
        decode_24_part_a,
        decode_24_part_b,
        decode_24,
        decode_24_by_number,
        ingest_counts,
        rebuild_messages,
        rebuild_unchecked,
        rename_select,
        compare_tables,
        compare_ranked,
        conformance_chain,
        strict_sentences,
        compare_rows,
        null_rules,
        text_rules,
    )
}
