"""The given tables as receiver lines."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harbor.sources import shared
from harbor.sources.lines import read_lines

from trials import fields as D
from trials.encode import sentence, tag_block, text_field, with_line, with_payload


#: Parts in which rows become lines, by the cores there are.
PARTS_PER_CORE = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the one the cluster names for shared intermediate data."""
    return f"{shared.shared_folder(spark)}/trial-{uuid.uuid4().hex}"


def stored(lines: DataFrame) -> DataFrame:
    """The lines written as text and read back, as the engine would meet them."""
    spark = lines.sparkSession
    path = shared_folder(spark) + "/lines"
    lines.select("value").write.text(path)
    return read_lines(spark, path)


def epoch_of(column: str) -> Column:
    """Whole seconds of a timestamp without a zone."""
    start = F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
    return F.timestamp_diff("SECOND", start, F.col(column))


def _expr(text: str) -> Column:
    # The one spelling that differs: whole division.
    return F.expr(text.replace("//", "div"))


def _fields(layout) -> list[tuple[Column, int]]:
    return [
        text_field(F.col(name), -width) if width < 0 else (F.col(name), width)
        for name, _, width in layout
    ]


def _spread(rows: DataFrame) -> DataFrame:
    """The rows in a few equal parts per core, however few the table's files have.

    A line takes many times what a row does, and a file is read by as many tasks
    as it has row groups at most.
    """
    return rows.repartition(PARTS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism)


def _with_fields(rows: DataFrame, layout) -> DataFrame:
    return _spread(rows).select("*", *[_expr(text).alias(name) for name, text, _ in layout])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their raw fields, payload, tag block and line."""
    rows = _with_fields(
        table(spark, sf_dir, "events").withColumn("epoch", epoch_of("ts")),
        D.EVENT_POSITION,
    )
    rows = with_payload(rows, "data", _fields(D.EVENT_POSITION)).withColumn(
        "tags", tag_block(_expr(D.EVENT_PORT), _expr(D.EVENT_STATION), F.col("epoch"))
    )
    return with_line(rows, F.col("tags"), sentence(F.col("data")))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(events(spark, sf_dir))


def spoilt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).withColumn("value", _expr(D.SPOILT))


def spoilt_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spoilt_events(spark, sf_dir).select("value"))


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_line(events(spark, sf_dir), F.col("tags"), _expr(D.FAULTY_BODY))
    return stored(rows.select(_expr(D.FAULTY_LINE).alias("value")))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_fields(table(spark, sf_dir, "orders"), D.ORDER_POSITION)
    epoch = epoch_of("o_orderdate") + F.col("o_orderkey") % 86400
    tags = tag_block(_expr(D.ORDER_PORT), _expr(D.ORDER_STATION), epoch)
    rows = with_payload(rows, "data", _fields(D.ORDER_POSITION))
    return stored(with_line(rows, tags, sentence(F.col("data"))))


def part_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_fields(table(spark, sf_dir, "part"), D.PART_VOYAGE)
    rows = with_payload(rows, "data", _fields(D.PART_VOYAGE))
    data = F.substr(F.rpad("data", 72, "0"), F.lit(1), _expr(D.PART_CHARS))
    tags = tag_block(_expr(D.PART_PORT), _expr(D.PART_STATION), _expr(D.PART_EPOCH))
    return stored(with_line(rows, tags, sentence(data)))


def supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static and voyage data in two fragments, padding only on the second."""
    suppliers = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    rows = _with_fields(suppliers, D.SUPPLIER_VOYAGE)
    rows = with_payload(rows, "data", _fields(D.SUPPLIER_VOYAGE))
    tags = tag_block(
        _expr(D.SUPPLIER_PORT), _expr(D.SUPPLIER_STATION), _expr(D.SUPPLIER_EPOCH)
    )
    parts = rows.select(
        tags.alias("tags"),
        _expr(D.SUPPLIER_SEQUENCE).alias("sequence"),
        F.explode(
            F.array(
                F.struct(
                    F.lit(1).alias("number"),
                    F.substring("data", 1, 60).alias("data"),
                    F.lit(0).alias("padding"),
                ),
                F.struct(
                    F.lit(2).alias("number"),
                    F.substring("data", 61, 60).alias("data"),
                    F.lit(2).alias("padding"),
                ),
            )
        ).alias("part"),
    )
    body = sentence(
        F.col("part.data"),
        2,
        F.col("part.number"),
        F.col("sequence"),
        padding=F.col("part.padding"),
    )
    return stored(with_line(parts, F.col("tags"), body))


def customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class B static reports, in the six variants."""
    rows = _with_fields(table(spark, sf_dir, "customer"), D.CUSTOMER_DETAIL).select(
        "*",
        _expr(D.CUSTOMER_VARIANT).alias("variant"),
        _expr(D.CUSTOMER_MMSI).alias("mmsi_raw"),
        _expr(D.CUSTOMER_NAME).alias("name_text"),
        _expr(D.CUSTOMER_EPOCH).alias("epoch"),
    )
    head = [(F.lit(24), 6), (F.col("c_custkey") % 4, 2), (F.col("mmsi_raw"), 30)]
    name, other = F.col("name_text"), F.concat(F.lit("X"), F.col("name_text"))
    number_0, number_1, spare = (F.lit(0), 2), (F.lit(1), 2), (F.lit(0), 8)
    rows = with_payload(rows, "name", [*head, number_0, text_field(name, 20), spare])
    rows = with_payload(rows, "other", [*head, number_0, text_field(other, 20), spare])
    rows = with_payload(rows, "detail", [*head, number_1, *_fields(D.CUSTOMER_DETAIL)])
    variant, epoch = F.col("variant"), F.col("epoch")
    parts = F.filter(
        F.array(
            F.struct(F.col("detail").alias("data"), epoch.alias("epoch")),
            F.struct(
                F.when(variant == 3, None)
                .when(variant == 2, F.substring("name", 1, 27))
                .otherwise(F.col("name"))
                .alias("data"),
                F.when(variant == 1, epoch + 1000000).otherwise(epoch).alias("epoch"),
            ),
            F.struct(F.when(variant == 4, F.col("other")).alias("data"), epoch.alias("epoch")),
        ),
        lambda p: p["data"].isNotNull(),
    )
    exploded = rows.select(
        "variant",
        _expr(D.CUSTOMER_PORT).alias("port"),
        _expr(D.CUSTOMER_STATION).alias("station"),
        F.explode(parts).alias("part"),
    )
    told = F.when(F.col("variant") == 5, F.lit("")).otherwise(
        F.col("part.epoch").cast("string")
    )
    tags = tag_block(F.col("port"), F.col("station"), told)
    return stored(with_line(exploded, tags, sentence(F.col("part.data"))))


def fragment_lines(
    spark: SparkSession, sf_dir: str, fields: dict[str, str] = D.FRAGMENT
) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        *[_expr(text).alias(name) for name, text in fields.items()]
    )
    tags = tag_block(F.col("port"), F.col("port_mmsi"), F.col("epoch"))
    body = sentence(
        F.col("data"),
        F.col("fragment_count"),
        F.col("fragment_n"),
        F.col("message_id"),
        F.col("radio_channel"),
        F.col("padding"),
    )
    return stored(with_line(rows, tags, body))


def hot_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sentences of one station and second, most of them copies of two."""
    return table(spark, sf_dir, "events").select(
        F.lit("AIVDM").alias("packet_type"),
        F.lit(2).alias("fragment_count"),
        *[_expr(text).cast(kind).alias(name) for name, kind, text in D.HOT_FRAGMENT],
        F.lit(0).alias("message_id"),
        F.lit("A").alias("radio_channel"),
        F.lit(0).alias("padding"),
        F.lit("QUAY").alias("s"),
        F.lit(1).alias("port"),
        F.lit(2).alias("port_mmsi"),
        F.timestamp_seconds(F.lit(1500000600)).alias("timestamp"),
    )


def fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as sentence records, without the detour over text."""
    return table(spark, sf_dir, "lineitem").select(
        F.lit("AIVDM").alias("packet_type"),
        *[
            _expr(text)
            .cast("string" if name in ("data", "radio_channel") else "int")
            .alias(name)
            for name, text in D.FRAGMENT.items()
            if name != "epoch"
        ],
        F.lit("QUAY").alias("s"),
        F.timestamp_seconds(_expr(D.FRAGMENT["epoch"])).alias("timestamp"),
    )

