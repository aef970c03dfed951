"""What each table row says as a message: raw field numbers by SQL expression.

The texts are read by both engines, so each field has one definition; only the
epoch differs, as the two have no common function for it.
"""

from __future__ import annotations

# (name, expression, width in bits); a text field counts characters.
EVENT_POSITION = (
    ("type", "1 + event_id % 3", 6),
    ("repeat_raw", "event_id % 4", 2),
    ("mmsi_raw", "200000000 + user_id", 30),
    ("status_raw", "event_id % 16", 4),
    ("turn_raw", "event_id % 256 - 128", 8),
    ("speed_raw", "CAST(floor(value * 10) AS BIGINT) % 1024", 10),
    ("accuracy_raw", "user_id % 2", 1),
    (
        "lon_raw",
        "CASE WHEN event_id % 97 = 0 THEN 108600000"
        " ELSE (event_id * 7919) % 216000001 - 108000000 END",
        28,
    ),
    (
        "lat_raw",
        "CASE WHEN event_id % 89 = 0 THEN 54600000"
        " ELSE (event_id * 104729) % 108000001 - 54000000 END",
        27,
    ),
    (
        "course_raw",
        "CASE WHEN event_id % 83 = 0 THEN 2600 ELSE (event_id * 13) % 3601 END",
        12,
    ),
    ("heading_raw", "event_id % 512", 9),
    ("second_raw", "event_id % 64", 6),
    ("manoeuvre_raw", "event_id % 3", 2),
    ("spare_raw", "event_id % 8", 3),
    ("raim_raw", "event_id % 2", 1),
    ("radio_raw", "event_id % 524288", 19),
)
EVENT_PORT = "user_id % 200"
EVENT_STATION = "2320700 + event_id % 50"

ORDER_POSITION = (
    ("type", "18", 6),
    ("repeat_raw", "o_orderkey % 4", 2),
    ("mmsi_raw", "300000000 + o_custkey", 30),
    ("reserved_raw", "o_orderkey % 256", 8),
    ("speed_raw", "CAST(floor(o_totalprice) AS BIGINT) % 1024", 10),
    ("accuracy_raw", "o_custkey % 2", 1),
    (
        "lon_raw",
        "CASE WHEN o_orderkey % 97 = 0 THEN 108600000"
        " ELSE (o_orderkey * 7919) % 216000001 - 108000000 END",
        28,
    ),
    (
        "lat_raw",
        "CASE WHEN o_orderkey % 89 = 0 THEN 54600000"
        " ELSE (o_orderkey * 104729) % 108000001 - 54000000 END",
        27,
    ),
    ("course_raw", "(o_orderkey * 13) % 3601", 12),
    ("heading_raw", "(o_orderkey * 7) % 512", 9),
    ("second_raw", "(o_orderkey * 5) % 64", 6),
    ("regional_raw", "o_orderkey % 4", 2),
    ("unit_raw", "o_orderkey % 2", 1),
    ("display_raw", "o_orderkey % 3 % 2", 1),
    ("dsc_raw", "o_orderkey % 5 % 2", 1),
    ("band_raw", "o_orderkey % 7 % 2", 1),
    ("m22_raw", "o_orderkey % 11 % 2", 1),
    ("assigned_raw", "o_orderkey % 13 % 2", 1),
    ("raim_raw", "o_orderkey % 17 % 2", 1),
    ("radio_raw", "o_orderkey % 1048576", 20),
)
ORDER_PORT = "o_custkey % 200"
ORDER_STATION = "2320700 + o_custkey % 50"

# The text fields stand between the numbers, see PART_ORDER.
PART_VOYAGE = (
    ("type", "5", 6),
    ("repeat_raw", "p_partkey % 4", 2),
    ("mmsi_raw", "400000000 + p_partkey", 30),
    ("version_raw", "p_partkey % 4", 2),
    ("imo_raw", "9000000 + p_partkey", 30),
    ("call_text", "concat('P', lpad(CAST(p_partkey AS STRING), 6, '0'))", -7),
    ("name_text", "upper(p_name)", -20),
    ("cargo_raw", "p_size + 40", 8),
    ("bow_raw", "p_partkey % 512", 9),
    ("stern_raw", "(p_partkey * 3) % 512", 9),
    ("port_raw", "p_partkey % 64", 6),
    ("starboard_raw", "(p_partkey * 5) % 64", 6),
    ("fix_raw", "p_partkey % 16", 4),
    ("month_raw", "p_partkey % 13", 4),
    ("day_raw", "p_partkey % 32", 5),
    ("hour_raw", "p_partkey % 25", 5),
    ("minute_raw", "p_partkey % 61", 6),
    ("draught_raw", "CAST(floor(p_retailprice) AS BIGINT) % 256", 8),
    ("destination_text", "upper(concat(p_brand, ' ', p_type, ' _TO SEA'))", -20),
    ("dte_raw", "p_partkey % 2", 1),
    ("spare_raw", "1", 1),
)
PART_PORT = "p_partkey % 200"
PART_STATION = "2320700 + p_partkey % 50"
PART_EPOCH = "1500000600 + p_partkey"
# Payload characters kept: 426, 420, 348 and 432 bits.
PART_CHARS = (
    "CASE p_partkey % 4 WHEN 0 THEN 71 WHEN 1 THEN 70 WHEN 2 THEN 58 ELSE 72 END"
)

SUPPLIER_VOYAGE = (
    ("type", "5", 6),
    ("repeat_raw", "s_suppkey % 4", 2),
    ("mmsi_raw", "500000000 + s_suppkey", 30),
    ("version_raw", "s_suppkey % 4", 2),
    ("imo_raw", "8000000 + s_suppkey", 30),
    ("call_text", "concat('S', lpad(CAST(s_suppkey AS STRING), 6, '0'))", -7),
    ("name_text", "upper(s_name)", -20),
    ("cargo_raw", "s_suppkey % 100", 8),
    ("bow_raw", "s_suppkey % 512", 9),
    ("stern_raw", "(s_suppkey * 3) % 512", 9),
    ("port_raw", "s_suppkey % 64", 6),
    ("starboard_raw", "(s_suppkey * 5) % 64", 6),
    ("fix_raw", "s_suppkey % 16", 4),
    ("month_raw", "s_suppkey % 13", 4),
    ("day_raw", "s_suppkey % 32", 5),
    ("hour_raw", "s_suppkey % 25", 5),
    ("minute_raw", "s_suppkey % 61", 6),
    ("draught_raw", "CAST(floor(abs(s_acctbal)) AS BIGINT) % 256", 8),
    ("destination_text", "upper(n_name)", -20),
    ("dte_raw", "s_suppkey % 2", 1),
    ("spare_raw", "0", 1),
)
SUPPLIER_PORT = "s_suppkey % 200"
SUPPLIER_STATION = "2320700 + s_suppkey % 50"
# Two ships share each second.
SUPPLIER_EPOCH = "1500000600 + s_suppkey // 100"
SUPPLIER_SEQUENCE = "s_suppkey % 10"

# Customers report in two parts; the variant decides how.
#   0: both parts in one second        1: the name in another second
#   2: a short name part               3: no name part
#   4: two names in one second         5: neither line carries a time
CUSTOMER_VARIANT = "c_custkey % 6"
CUSTOMER_MMSI = "600000000 + c_custkey"
CUSTOMER_NAME = "upper(c_name)"
CUSTOMER_EPOCH = "1500000600 + c_custkey"
CUSTOMER_PORT = "c_custkey % 200"
CUSTOMER_STATION = "2320700 + c_custkey % 50"
CUSTOMER_DETAIL = (
    ("kind_raw", "c_custkey % 256", 8),
    ("vendor_text", "substr(upper(c_mktsegment), 1, 7)", -7),
    ("call_text", "concat('C', lpad(CAST(c_custkey AS STRING), 6, '0'))", -7),
    ("bow_raw", "c_custkey % 512", 9),
    ("stern_raw", "(c_custkey * 3) % 512", 9),
    ("port_raw", "c_custkey % 64", 6),
    ("starboard_raw", "(c_custkey * 5) % 64", 6),
    ("spare_raw", "0", 6),
)

# Line items as fragments of the message named by their order.
FRAGMENT = {
    "fragment_count": "3 + l_orderkey % 5",
    "fragment_n": "l_linenumber",
    "message_id": "l_orderkey % 10",
    "radio_channel": "CASE WHEN l_linestatus = 'O' THEN 'A' ELSE 'B' END",
    "data": "concat('1', lpad(CAST(l_partkey AS STRING), 7, '0'),"
    " lpad(CAST(l_suppkey AS STRING), 5, '0'))",
    "padding": "CASE WHEN l_quantity > 45 THEN 2 ELSE 0 END",
    "port": "l_orderkey % 200",
    "port_mmsi": "l_orderkey",
    "epoch": "1500000600 + l_orderkey % 1000",
}

# The same lines with one-part messages among them, some with long numbers.
MIXED = FRAGMENT | {
    "fragment_count": "CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 3 + l_orderkey % 5 END",
    "fragment_n": "CASE WHEN l_orderkey % 9 = 0 THEN 1234567890 ELSE l_linenumber END",
}

# Sentences of one second: name, type, expression.
HOT_FRAGMENT = (
    ("fragment_n", "int", "CASE WHEN event_id % 10 = 0 THEN 2 ELSE 1 END"),
    (
        "data",
        "string",
        "CASE WHEN event_id % 10 = 0 THEN concat('2', CAST(event_id % 7 AS STRING))"
        " WHEN event_id % 3 = 0 THEN '12' ELSE '13' END",
    ),
)

# How an event's line is spoilt after its sums were taken.
SPOILT = (
    "CASE event_id % 10"
    " WHEN 0 THEN replace(value, ',,A,', ',,B,')"
    " WHEN 3 THEN concat(substr(value, 1, length(value) - 2), lower(right(value, 2)))"
    " WHEN 5 THEN replace(value, ',c:', ',d:')"
    " WHEN 7 THEN substr(value, instr(value, '!'))"
    " WHEN 8 THEN concat(value, '!')"
    " ELSE value END"
)
SPOILT_PASSES = "event_id % 10 NOT IN (0, 5, 7)"

# A sentence per event with correct sums and, for seven in eight, a fault.
FAULTY_BODY = (
    "CASE event_id % 8"
    " WHEN 0 THEN concat('AIVDM,1,1,,A,', data)"
    " WHEN 1 THEN 'AIVDM,1,1,,A,,0'"
    " WHEN 2 THEN concat('AIVDM,1,1,,A,', data, 'x,0')"
    " WHEN 3 THEN concat('AIVDM,1,2,,A,', data, ',0')"
    " WHEN 5 THEN concat('AIVDM,2,x,,A,', data, ',0')"
    " ELSE concat('AIVDM,1,1,,A,', data, ',0') END"
)
FAULTY_LINE = (
    "CASE event_id % 8"
    " WHEN 4 THEN substr(value, 1, instr(value, '!') - 1)"
    " WHEN 6 THEN replace(value, ',c:', ',d:')"
    " ELSE value END"
)
FAULTY_OUTCOME = (
    "CASE event_id % 8 WHEN 0 THEN 'few_fields' WHEN 1 THEN 'empty_payload'"
    " WHEN 2 THEN 'alphabet' WHEN 3 THEN 'fragment_number' WHEN 4 THEN 'no_sentence'"
    " WHEN 5 THEN 'fragment_number' WHEN 6 THEN 'checksum' ELSE 'accepted' END"
)
