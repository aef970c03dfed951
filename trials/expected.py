"""The expected result of each trial query, in SQL over the given tables.

Results come from the source columns.  Where a query returns receiver lines
or bits, the SQL builds them from the fields with its own arithmetic.
"""

from __future__ import annotations

from trials import fields as D
from trials.catalog import NEW_NAMES


def bits(expression: str, width: int) -> str:
    return (
        f"lpad(bin(CASE WHEN ({expression}) < 0 THEN ({expression}) + {1 << width}"
        f" ELSE ({expression}) END), {width}, '0')"
    )


def text_bits(expression: str, n_chars: int) -> str:
    """Six-bit text as bits: letters and '@' count from 0, the rest is ASCII."""
    return (
        f"array_to_string(list_transform(string_split(rpad({expression}, {n_chars}, '@'), ''),"
        " lambda c: lpad(bin(CASE WHEN ascii(c) >= 64 THEN ascii(c) - 64 ELSE ascii(c) END),"
        " 6, '0')), '')"
    )


def layout_bits(layout) -> str:
    return " || ".join(
        text_bits(name, -width) if width < 0 else bits(name, width)
        for name, _, width in layout
    )


def number(expression: str) -> str:
    return f"('0b' || {expression})::BIGINT"


def text_of_bits(expression: str, start: int, n_chars: int) -> str:
    code = number(f"substr({expression}, {start + 1} + 6 * i, 6)")
    return (
        f"array_to_string(list_transform(range(0, {n_chars}),"
        f" lambda i: chr((CASE WHEN {code} < 32 THEN {code} + 64 ELSE {code} END)::INTEGER)), '')"
    )


def armour(expression: str, n_chars: int) -> str:
    value = number(f"substr({expression}, 1 + 6 * i, 6)")
    return (
        f"array_to_string(list_transform(range(0, {n_chars}),"
        f" lambda i: chr((CASE WHEN {value} < 40 THEN {value} + 48"
        f" ELSE {value} + 56 END)::INTEGER)), '')"
    )


def summed(expression: str) -> str:
    return (
        f"({expression}) || '*' || printf('%02X', list_reduce(list_transform("
        f"string_split({expression}, ''), lambda c: ascii(c)), lambda a, b: xor(a, b)))"
    )


def tag_block(port: str, station: str, epoch: str) -> str:
    return (
        f"concat('s:QUAY//Port=', {port}, '//MMSI=', {station}, ',c:', {epoch})"
    )


def fields_of(layout) -> str:
    return ", ".join(f"{text} AS {name}" for name, text, _ in layout)


EPOCH = "epoch_us({})//1000000"

EVENTS = f"""
e AS (
  SELECT *, {EPOCH.format("ts")} AS epoch, {fields_of(D.EVENT_POSITION)} FROM events
)"""
EVENTS_PACKED = f"""{EVENTS},
b AS (SELECT *, {layout_bits(D.EVENT_POSITION)} AS all_bits FROM e),
p AS (
  SELECT *, {armour("all_bits", 28)} AS data,
    {tag_block(D.EVENT_PORT, D.EVENT_STATION, "epoch")} AS tags
  FROM b
)"""


def with_line(source: str, body: str) -> str:
    return (
        f"SELECT *, chr(92) || {summed('tags')} || chr(92) || '!' || {summed('body')} AS value"
        f" FROM (SELECT * EXCLUDE (value), {body} AS body FROM {source})"
    )


EVENT_LINES = f"""{EVENTS_PACKED},
l AS ({with_line("p", "concat('AIVDM,1,1,,A,', data, ',0')")})"""
SPOILT = f"""{EVENT_LINES},
s AS (SELECT * EXCLUDE (value), {D.SPOILT} AS value FROM l)"""
FAULTY = f"""{EVENTS_PACKED},
l AS ({with_line("p", D.FAULTY_BODY)}),
s AS (SELECT * EXCLUDE (value), {D.FAULTY_LINE} AS value, {D.FAULTY_OUTCOME} AS outcome FROM l)"""

# The label of each navigation status.
STATUS = """CASE status_raw
    WHEN 0 THEN 'Under way using engine'
    WHEN 1 THEN 'At anchor'
    WHEN 2 THEN 'Not under command'
    WHEN 3 THEN 'Restricted maneuverability'
    WHEN 4 THEN 'Constrained by her draught'
    WHEN 5 THEN 'Moored'
    WHEN 6 THEN 'Aground'
    WHEN 7 THEN 'Engaged in Fishing'
    WHEN 8 THEN 'Under way sailing'
    WHEN 9 THEN 'Reserved for future amendment of Navigational Status for HSC'
    WHEN 10 THEN 'Reserved for future amendment of Navigational Status for WIG'
    WHEN 11 THEN 'Reserved for future use'
    WHEN 12 THEN 'Reserved for future use'
    WHEN 13 THEN 'Reserved for future use'
    WHEN 14 THEN 'AIS-SART is active' END"""


def degrees(name: str, absent: int) -> str:
    return f"nullif({name}, {absent * 600000})::DOUBLE / 600000.0::DOUBLE"


def tenths(name: str, absent: int | None = None) -> str:
    known = name if absent is None else f"nullif({name}, {absent})"
    return f"{known}::DOUBLE / 10.0::DOUBLE"


EVENT_READINGS = f"""
  type::INTEGER AS id,
  ({D.EVENT_PORT})::INTEGER AS port,
  ({D.EVENT_STATION})::INTEGER AS port_mmsi,
  epoch::BIGINT AS epoch,
  repeat_raw::INTEGER AS repeat_indicator,
  mmsi_raw::INTEGER AS mmsi,
  {STATUS} AS navigation_status,
  round(CASE WHEN turn_raw = -128 THEN NULL
    ELSE sign(turn_raw) * pow(turn_raw / 4.733::DOUBLE, 2) END, 6)::DOUBLE AS rate_of_turn,
  {tenths("speed_raw", 1023)} AS speed_over_ground,
  accuracy_raw::INTEGER AS position_accuracy,
  {degrees("lon_raw", 181)} AS longitude,
  {degrees("lat_raw", 91)} AS latitude,
  {tenths("course_raw", 2600)} AS course_over_ground,
  nullif(heading_raw, 511)::INTEGER AS true_heading,
  CASE WHEN second_raw <= 59 THEN second_raw END::INTEGER AS timestamp_seconds,
  manoeuvre_raw::INTEGER AS manoeuvre_indicator,
  raim_raw::INTEGER AS raim,
  spare_raw::INTEGER AS spare,
  radio_raw::INTEGER AS radio_status"""

ORDERS = f"""
o AS (
  SELECT *, {EPOCH.format("o_orderdate")} + o_orderkey % 86400 AS epoch,
    {fields_of(D.ORDER_POSITION)}
  FROM orders
)"""
ORDER_READINGS = f"""
  18::INTEGER AS id,
  ({D.ORDER_PORT})::INTEGER AS port,
  ({D.ORDER_STATION})::INTEGER AS port_mmsi,
  epoch::BIGINT AS epoch,
  repeat_raw::INTEGER AS repeat_indicator,
  mmsi_raw::INTEGER AS mmsi,
  {tenths("speed_raw", 1023)} AS speed_over_ground,
  accuracy_raw::INTEGER AS position_accuracy,
  {degrees("lon_raw", 181)} AS longitude,
  {degrees("lat_raw", 91)} AS latitude,
  nullif(heading_raw, 511)::INTEGER AS true_heading,
  CASE WHEN second_raw <= 59 THEN second_raw END::INTEGER AS timestamp_seconds,
  unit_raw::INTEGER AS cs_unit,
  dsc_raw::INTEGER AS dsc_flag,
  display_raw::INTEGER AS display_flag,
  band_raw::INTEGER AS band_flag,
  m22_raw::INTEGER AS message_22_flag,
  assigned_raw::INTEGER AS assigned,
  raim_raw::INTEGER AS raim"""


def _code(char: str) -> str:
    return f"(CASE WHEN ascii({char}) >= 64 THEN ascii({char}) - 64 ELSE ascii({char}) END)"


def _cut_text(text: str, n_chars: int) -> str:
    """Text cut in its next character, of which the four high bits are left."""
    return f"substr({text}, 1, {n_chars}) || chr(({_code(f'substr({text}, {n_chars + 1}, 1)')} // 4 + 64)::INTEGER)"


def voyage_readings(port: str, station: str, epoch: str, destination: str, dte: str) -> str:
    return f"""
  5::INTEGER AS id,
  ({port})::INTEGER AS port,
  ({station})::INTEGER AS port_mmsi,
  ({epoch})::BIGINT AS epoch,
  repeat_raw::INTEGER AS repeat_indicator,
  mmsi_raw::INTEGER AS mmsi,
  version_raw::INTEGER AS ais_version,
  imo_raw::INTEGER AS imo,
  cargo_raw::INTEGER AS type_and_cargo,
  bow_raw::INTEGER AS to_bow,
  stern_raw::INTEGER AS to_stern,
  port_raw::INTEGER AS to_port,
  starboard_raw::INTEGER AS to_starboard,
  fix_raw::INTEGER AS epfd,
  nullif(month_raw, 0)::INTEGER AS eta_month,
  nullif(day_raw, 0)::INTEGER AS eta_day,
  nullif(hour_raw, 24)::INTEGER AS eta_hour,
  nullif(minute_raw, 60)::INTEGER AS eta_min,
  {tenths("draught_raw")} AS draught,
  {destination} AS destination,
  {dte} AS data_terminal_ready"""


PARTS = f"""
v AS (
  SELECT *, rpad(destination_text, 20, '@') AS goal, rpad(call_text, 7, '@') AS call_sign,
    rpad(name_text, 20, '@') AS ship_name
  FROM (SELECT *, {fields_of(D.PART_VOYAGE)} FROM part)
)"""
PART_GOAL = (
    f"CASE p_partkey % 4 WHEN 1 THEN {_cut_text('goal', 19)}"
    f" WHEN 2 THEN {_cut_text('goal', 7)} ELSE goal END"
)
PART_DTE = "CASE WHEN p_partkey % 4 IN (0, 3) THEN dte_raw END::INTEGER"

SUPPLIERS = f"""
v AS (
  SELECT *, call_text AS call_sign, left(name_text, 20) AS ship_name
  FROM (
    SELECT *, {fields_of(D.SUPPLIER_VOYAGE)}
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
  )
)"""

# One row per line a customer sends; part 0 lines carry a name.
CUSTOMERS = f"""
c AS (
  SELECT *, {D.CUSTOMER_VARIANT} AS variant, {D.CUSTOMER_MMSI} AS mmsi_raw,
    {D.CUSTOMER_NAME} AS name_text, {D.CUSTOMER_EPOCH} AS sent,
    {fields_of(D.CUSTOMER_DETAIL)}
  FROM customer
),
r AS (
  SELECT *, CASE WHEN variant = 5 THEN NULL ELSE sent END AS epoch,
    CASE WHEN part = 0 THEN {text_bits("name", 20)} END AS name_bits
  FROM (
    SELECT *, 1 AS part, 168 AS n_bits, NULL AS name FROM c
    UNION ALL
    SELECT * REPLACE (CASE WHEN variant = 1 THEN sent + 1000000 ELSE sent END AS sent),
      0 AS part, CASE WHEN variant = 2 THEN 162 ELSE 168 END AS n_bits, name_text AS name
    FROM c WHERE variant <> 3
    UNION ALL
    SELECT *, 0 AS part, 168 AS n_bits, 'X' || name_text AS name FROM c WHERE variant = 4
  )
),
a AS (
  SELECT DISTINCT rpad(name, 20, '@') AS ship_name, mmsi_raw::INTEGER AS mmsi,
    epoch::BIGINT AS epoch
  FROM r WHERE part = 0
)"""
# The bits of a short name part, read as a detail part, from bit 40 on.
_SHORT = "(name_bits || '00')"


def _detail(column: str, start: int, end: int) -> str:
    as_name = number(f"substr({_SHORT}, {start - 40 + 1}, {end - start})")
    return f"CASE WHEN part = 1 THEN {column} ELSE {as_name} END::INTEGER"


def _detail_text(column: str, start: int) -> str:
    as_name = text_of_bits(_SHORT, start - 40, 7)
    return f"CASE WHEN part = 1 THEN rpad({column}, 7, '@') ELSE {as_name} END"


_MOTHERSHIP = (
    "bow_raw * 2097152 + stern_raw * 4096 + port_raw * 64 + starboard_raw"
)
REPORT_COMMON = f"""
  24::INTEGER AS id,
  ({D.CUSTOMER_PORT})::INTEGER AS port,
  ({D.CUSTOMER_STATION})::INTEGER AS port_mmsi,
  epoch::BIGINT AS epoch,
  (c_custkey % 4)::INTEGER AS repeat_indicator,
  mmsi_raw::INTEGER AS mmsi,
  part::INTEGER AS part_number"""
REPORT_DETAIL = f"""{REPORT_COMMON},
  {_detail("kind_raw", 40, 48)} AS ship_type,
  {_detail_text("vendor_text", 48)} AS vendor_id,
  {_detail_text("call_text", 90)} AS call_sign,
  {_detail("bow_raw", 132, 141)} AS to_bow,
  {_detail("stern_raw", 141, 150)} AS to_stern,
  {_detail("port_raw", 150, 156)} AS to_port,
  {_detail("starboard_raw", 156, 162)} AS to_starboard,
  {_detail(_MOTHERSHIP, 132, 162)} AS mothership_mmsi"""
DETAILS = f"""{CUSTOMERS},
d AS (SELECT {REPORT_DETAIL} FROM r WHERE part = 1 OR n_bits = 162)"""
DETAILS_BY_NUMBER = f"""{CUSTOMERS},
d AS (SELECT {REPORT_DETAIL} FROM r WHERE part = 1)"""


FRAGMENTS = f"""
f AS (
  SELECT 'AIVDM' AS packet_type, {", ".join(f"{t} AS {n}" for n, t in D.FRAGMENT.items())},
    'QUAY' AS s
  FROM lineitem
)"""
MESSAGE_KEYS = """packet_type, fragment_count::INTEGER AS fragment_count, radio_channel,
  padding::INTEGER AS padding, s, port::INTEGER AS port, port_mmsi::INTEGER AS port_mmsi,
  epoch::BIGINT AS epoch"""
NUMBERED = """
n AS (
  SELECT *, fragment_n - row_number() OVER (
      PARTITION BY port_mmsi, epoch, fragment_count
      ORDER BY fragment_n, md5(concat_ws('|', radio_channel, padding, message_id, data,
        packet_type, s, port))) AS generated_id
  FROM f
),
g AS (
  SELECT packet_type, fragment_count, radio_channel, padding, s, port, port_mmsi, epoch,
    string_agg(data, '' ORDER BY fragment_n) AS data
  FROM n
  GROUP BY packet_type, fragment_count, radio_channel, padding, s, port, port_mmsi, epoch,
    generated_id
)"""
GAP = f"{FRAGMENTS},{NUMBERED}"
HOT = f"""
f AS (
  SELECT 'AIVDM' AS packet_type, 2 AS fragment_count, 0 AS message_id, 'A' AS radio_channel,
    0 AS padding, 'QUAY' AS s, 1 AS port, 2 AS port_mmsi, 1500000600 AS epoch,
    {", ".join(f"{text} AS {name}" for name, _, text in D.HOT_FRAGMENT)}
  FROM events
),{NUMBERED}"""
SEQUENCE_KEYS = """packet_type, fragment_count, message_id, radio_channel, s, port, port_mmsi,
    epoch"""
LINKED = f"""
u AS (
  SELECT * FROM f
  QUALIFY row_number() OVER (PARTITION BY {SEQUENCE_KEYS}, fragment_n ORDER BY data, padding) = 1
),
g AS (
  SELECT {SEQUENCE_KEYS}, string_agg(data, '' ORDER BY fragment_n) AS data,
    arg_max(padding, fragment_n) AS padding,
    count(*) = fragment_count AND min(fragment_n) = 1 AND max(fragment_n) = fragment_count
      AS is_complete
  FROM u GROUP BY {SEQUENCE_KEYS}
)"""
MIXED = f"""
a AS (
  SELECT 'AIVDM' AS packet_type, {", ".join(f"{t} AS {n}" for n, t in D.MIXED.items())},
    'QUAY' AS s
  FROM lineitem
),
f AS (SELECT * FROM a WHERE fragment_count <> 1),{LINKED}"""


CHECKED = f"""{EVENTS},
k AS (
  SELECT radio_raw::INTEGER AS number, epoch::BIGINT AS epoch, mmsi_raw::INTEGER AS mmsi,
    {tenths("speed_raw", 1023)} AS sog, {degrees("lat_raw", 91)} AS y
  FROM e
),
m AS (
  SELECT CASE WHEN event_id % 13 = 0 THEN -1 - radio_raw ELSE radio_raw END::INTEGER AS number,
    epoch::BIGINT AS epoch,
    CASE WHEN event_id % 19 = 0 THEN mmsi_raw + 1 ELSE mmsi_raw END::INTEGER AS mmsi,
    CASE WHEN event_id % 11 = 0 THEN {tenths("speed_raw", 1023)} + 0.01::DOUBLE
      ELSE {tenths("speed_raw", 1023)} END AS sog,
    {degrees("lat_raw", 91)} + 1e-12::DOUBLE AS y
  FROM e, range(0, 2) t(copy)
  WHERE copy = 0 OR event_id % 17 = 0
)"""


def _compared(column: str, tolerance: str) -> str:
    return f"""
SELECT '{column}' AS "column", count(*)::BIGINT AS n_rows,
  coalesce(sum(CASE WHEN lx IS NULL AND rx IS NULL THEN 0 WHEN lx IS NULL OR rx IS NULL THEN 1
    WHEN abs(lx::DOUBLE - rx::DOUBLE) > {tolerance}::DOUBLE THEN 1 ELSE 0 END), 0)::BIGINT AS n_different,
  round(max(abs(lx::DOUBLE - rx::DOUBLE)), 6) AS max_difference
FROM (SELECT k.{column} AS lx, q.{column} AS rx FROM k JOIN q USING (number, epoch))"""


COMPARE = f"""WITH {CHECKED},
q AS (
  SELECT number, epoch, any_value(mmsi) AS mmsi, any_value(sog) AS sog, any_value(y) AS y
  FROM m GROUP BY number, epoch HAVING count(*) = 1
),
w AS (SELECT number, epoch, count(*) AS n FROM m GROUP BY number, epoch)
{_compared("mmsi", "0.001")} UNION ALL {_compared("sog", "0.001")}
UNION ALL {_compared("y", "1e-11")}
UNION ALL
SELECT '(left only)', count(*)::BIGINT, count(*)::BIGINT, NULL
FROM k LEFT JOIN w USING (number, epoch) WHERE w.n IS NULL
UNION ALL
SELECT '(right only)', coalesce(sum(w.n), 0)::BIGINT, coalesce(sum(w.n), 0)::BIGINT, NULL
FROM w LEFT JOIN k USING (number, epoch) WHERE k.mmsi IS NULL
UNION ALL
SELECT '(ambiguous)', coalesce(sum(w.n + 1), 0)::BIGINT, coalesce(sum(w.n + 1), 0)::BIGINT, NULL
FROM w JOIN k USING (number, epoch) WHERE w.n > 1"""


def _ranked(name: str, table: str) -> str:
    order = "mmsi NULLS FIRST, sog NULLS FIRST, y NULLS FIRST"
    return f"""{name} AS (
  SELECT epoch // 3600 AS hour, mmsi, sog, y,
    row_number() OVER (PARTITION BY epoch // 3600 ORDER BY {order}) AS place
  FROM {table}
)"""


def _ranked_column(column: str, tolerance: str) -> str:
    return f"""
SELECT '{column}' AS "column", count(*)::BIGINT AS n_rows,
  coalesce(sum(CASE WHEN a.{column} IS NULL AND b.{column} IS NULL THEN 0
    WHEN a.{column} IS NULL OR b.{column} IS NULL THEN 1
    WHEN abs(a.{column}::DOUBLE - b.{column}::DOUBLE) > {tolerance}::DOUBLE THEN 1
    ELSE 0 END), 0)::BIGINT AS n_different,
  round(max(abs(a.{column}::DOUBLE - b.{column}::DOUBLE)), 6) AS max_difference
FROM a JOIN b USING (hour, place)"""


def _ranked_only(label: str, one: str, other: str) -> str:
    return f"""
SELECT '({label} only)', count(*)::BIGINT, count(*)::BIGINT, NULL
FROM {one} WHERE NOT EXISTS (
  FROM {other} WHERE {other}.hour = {one}.hour AND {other}.place = {one}.place)"""


COMPARE_RANKED = f"""WITH {CHECKED}, {_ranked("a", "k")}, {_ranked("b", "m")}
{_ranked_column("mmsi", "0")} UNION ALL {_ranked_column("sog", "0.001")}
UNION ALL {_ranked_column("y", "1e-11")}
UNION ALL {_ranked_only("left", "a", "b")} UNION ALL {_ranked_only("right", "b", "a")}
UNION ALL SELECT '(ambiguous)', 0::BIGINT, 0::BIGINT, NULL"""


def _cycle(absent: str, *values: float) -> str:
    chosen = " ".join(f"WHEN {i} THEN {float(v)}" for i, v in enumerate(values))
    value = f"(CASE event_id % {len(values)} {chosen} END)::DOUBLE"
    return f"CASE WHEN {value} {absent} THEN NULL ELSE {value} END"


_MIXED_MESSAGES = f"""WITH {MIXED}
SELECT {MESSAGE_KEYS}, data, true AS is_complete, 1::INTEGER AS id FROM a WHERE fragment_count = 1
UNION ALL
SELECT {MESSAGE_KEYS}, data, is_complete, 1::INTEGER FROM g"""

SQL: dict[str, str] = {
    "source_lines": f"WITH {EVENT_LINES} SELECT value FROM l",
    "partitioned_roundtrip": f"""WITH {EVENTS_PACKED}
SELECT type::INTEGER AS id, data, all_bits AS "dataBinary",
  ({D.EVENT_STATION})::INTEGER AS port_mmsi, epoch::BIGINT AS epoch FROM p""",
    "decoded_roundtrip": f"WITH {ORDERS} SELECT {ORDER_READINGS} FROM o",
    "csv_by_family": f"""WITH {EVENTS_PACKED}, {CUSTOMERS}
SELECT type::INTEGER AS id, NULL::INTEGER AS part_num, mmsi_raw::INTEGER AS mmsi,
  {STATUS} AS navigation_status, data, '123' AS family FROM p
UNION ALL
SELECT 24::INTEGER, part::INTEGER, mmsi_raw::INTEGER, 'a "quoted", text',
  {armour("line_bits", 28)}[1:n_bits // 6], '24_' || part
FROM (
  SELECT *, {bits("24", 6)} || {bits("c_custkey % 4", 2)} || {bits("mmsi_raw", 30)}
    || {bits("part", 2)} || CASE WHEN part = 0 THEN name_bits || '00000000'
    ELSE {layout_bits(D.CUSTOMER_DETAIL)} END AS line_bits
  FROM r
)""",
    "checksum_filter": f"WITH {SPOILT} SELECT value FROM s WHERE {D.SPOILT_PASSES}",
    "bare_sentences": f"""WITH {SPOILT}
SELECT 'AIVDM' AS packet_type, 1::INTEGER AS fragment_count, 1::INTEGER AS fragment_n,
  NULL::INTEGER AS message_id, 'A' AS radio_channel, data, 0::INTEGER AS padding,
  CASE event_id % 10 WHEN 8 THEN substr(value, length(value) - 2, 2)
    ELSE right(value, 2) END AS checksum_packet,
  CASE WHEN bare THEN '' ELSE 'QUAY' END AS s,
  CASE WHEN NOT bare THEN {D.EVENT_PORT} END::INTEGER AS port,
  CASE WHEN NOT bare THEN {D.EVENT_STATION} END::INTEGER AS port_mmsi,
  CASE WHEN NOT bare THEN epoch END::BIGINT AS epoch,
  CASE WHEN bare THEN '' ELSE substr(value, instr(value, '*') + 1, 2) END AS checksum_meta
FROM (SELECT *, event_id % 10 = 7 AS bare FROM s)
WHERE event_id % 10 NOT IN (0, 5)""",
    # The tag block's sum fails where its letter c, the time's, became a d.
    "quarantine": f"""WITH {FAULTY},
q AS (
  SELECT value, outcome, CASE WHEN outcome = 'checksum'
    THEN substr(value, instr(value, '*') + 1, 2) END AS claimed
  FROM s WHERE outcome <> 'accepted'
)
SELECT value, outcome, CASE WHEN claimed IS NOT NULL THEN 0 END::INTEGER AS segment, claimed,
  printf('%02X', xor(('0x' || claimed)::INTEGER, xor(ascii('c'), ascii('d')))) AS computed
FROM q""",
    "parse_sentence": f"""WITH {EVENT_LINES}
SELECT 'AIVDM' AS packet_type, 1::INTEGER AS fragment_count, 1::INTEGER AS fragment_n,
  NULL::INTEGER AS message_id, 'A' AS radio_channel, data, 0::INTEGER AS padding,
  right(value, 2) AS checksum_packet, 'QUAY' AS s, ({D.EVENT_PORT})::INTEGER AS port,
  ({D.EVENT_STATION})::INTEGER AS port_mmsi, epoch::BIGINT AS epoch,
  substr(value, instr(value, '*') + 1, 2) AS checksum_meta
FROM l""",
    "reassemble_gap": f"WITH {GAP} SELECT {MESSAGE_KEYS}, data FROM g",
    "reassemble_sequence": f"""WITH {FRAGMENTS},{LINKED}
SELECT {MESSAGE_KEYS}, data, is_complete FROM g""",
    "reassemble_hot": f"WITH {HOT} SELECT {MESSAGE_KEYS}, data FROM g",
    "messages_sequence": _MIXED_MESSAGES,
    "staged_sequence": _MIXED_MESSAGES,
    "raw_messages": f"""WITH {EVENTS_PACKED}, {GAP}
SELECT 'AIVDM' AS packet_type, 1::INTEGER AS fragment_count, 'A' AS radio_channel,
  0::INTEGER AS padding, 'QUAY' AS s, ({D.EVENT_PORT})::INTEGER AS port,
  ({D.EVENT_STATION})::INTEGER AS port_mmsi, epoch::BIGINT AS epoch, data,
  type::INTEGER AS id
FROM p WHERE {D.SPOILT_PASSES}
UNION ALL
SELECT {MESSAGE_KEYS}, data, 1::INTEGER FROM g""",
    "unpack_bits": f"""WITH {EVENTS_PACKED}
SELECT data, all_bits AS "dataBinary", type::INTEGER AS id FROM p""",
    "message_type_counts": f"""WITH {CUSTOMERS}
SELECT id::INTEGER AS id, sum(n)::BIGINT AS n_messages FROM (
  SELECT 1 + event_id % 3 AS id, count(*) AS n FROM events GROUP BY 1
  UNION ALL SELECT 18, count(*) FROM orders
  UNION ALL SELECT 5, count(*) FROM part
  UNION ALL SELECT 24, count(*) FROM r
) GROUP BY id""",
    "drop_working": f"""WITH {EVENTS}
SELECT ({D.EVENT_PORT})::INTEGER AS port, ({D.EVENT_STATION})::INTEGER AS port_mmsi,
  epoch::BIGINT AS epoch, type::INTEGER AS id FROM e""",
    "bit_functions": f"""WITH {EVENTS}
SELECT type::INTEGER AS id, mmsi_raw::INTEGER AS mmsi,
  CASE WHEN turn_raw = -128 THEN 128 ELSE turn_raw END::DOUBLE AS turn,
  lon_raw::DOUBLE AS lon, NULL::INTEGER AS past_end, 168::INTEGER AS n_bits,
  {STATUS} AS status
FROM e""",
    "text_functions": f"""WITH {PARTS}
SELECT ({D.PART_EPOCH})::BIGINT AS epoch, call_sign, {PART_GOAL} AS destination,
  NULL::VARCHAR AS past_end FROM v""",
    "decode_123": f"WITH {EVENTS} SELECT {EVENT_READINGS} FROM e",
    "decode_123_course": f"""WITH {EVENTS}
SELECT mmsi_raw::INTEGER AS mmsi, epoch::BIGINT AS epoch,
  {tenths("course_raw", 3600)} AS course_over_ground FROM e""",
    "nav_status": f"""WITH {EVENTS}
SELECT {STATUS} AS navigation_status, count(*)::BIGINT AS n_messages FROM e GROUP BY 1""",
    "positions_by_ship": f"""WITH {EVENTS}, d AS (SELECT {EVENT_READINGS} FROM e)
SELECT mmsi, count(*)::BIGINT AS n_positions, min(longitude) AS west, max(longitude) AS east,
  min(latitude) AS south, max(latitude) AS north, max(speed_over_ground) AS top_speed,
  min(epoch) AS first_heard, max(epoch) AS last_heard
FROM d GROUP BY mmsi""",
    "decode_18": f"WITH {ORDERS} SELECT {ORDER_READINGS} FROM o",
    "decode_5": f"""WITH {PARTS}
SELECT {voyage_readings(D.PART_PORT, D.PART_STATION, D.PART_EPOCH, PART_GOAL, PART_DTE)},
  call_sign, ship_name FROM v""",
    "decode_5_fragments": f"""WITH {SUPPLIERS}
SELECT {voyage_readings(
    D.SUPPLIER_PORT, D.SUPPLIER_STATION, D.SUPPLIER_EPOCH, "destination_text", "dte_raw::INTEGER"
)}, call_sign, ship_name, true AS is_complete FROM v""",
    "decode_24_part_number": f"WITH {CUSTOMERS} SELECT {REPORT_COMMON} FROM r",
    "decode_24_part_a": f"WITH {CUSTOMERS} SELECT ship_name, mmsi, epoch FROM a",
    "decode_24_part_b": f"WITH {DETAILS} SELECT * FROM d",
    "decode_24": f"""WITH {DETAILS}
SELECT d.*, a.ship_name FROM d LEFT JOIN a ON d.mmsi = a.mmsi AND d.epoch = a.epoch""",
    "decode_24_by_number": f"""WITH {DETAILS_BY_NUMBER}
SELECT d.* REPLACE (rtrim(split_part(vendor_id, '@', 1)) AS vendor_id,
    rtrim(split_part(call_sign, '@', 1)) AS call_sign),
  rtrim(split_part(a.ship_name, '@', 1)) AS ship_name
FROM d LEFT JOIN a ON d.mmsi = a.mmsi AND d.epoch = a.epoch""",
    "ingest_counts": f"""WITH {EVENTS}
SELECT {D.FAULTY_OUTCOME} AS outcome,
  CASE WHEN event_id % 8 IN (1, 4) THEN NULL ELSE type END::INTEGER AS id,
  count(*)::BIGINT AS n_lines
FROM e GROUP BY 1, 2""",
    "rebuild_messages": f"""WITH {SPOILT}
SELECT data, type::INTEGER AS id, 1::INTEGER AS fragment_n,
  ({D.EVENT_STATION})::INTEGER AS port_mmsi, epoch::BIGINT AS epoch
FROM s WHERE {D.SPOILT_PASSES}""",
    "rebuild_unchecked": f"""WITH {SPOILT}
SELECT data, type::INTEGER AS id, CASE event_id % 10 WHEN 0 THEN 'B' ELSE 'A' END AS radio_channel,
  CASE WHEN event_id % 10 <> 7 THEN {D.EVENT_STATION} END::INTEGER AS port_mmsi,
  CASE WHEN event_id % 10 NOT IN (5, 7) THEN epoch END::BIGINT AS epoch
FROM s""",
    "rename_select": f"""WITH {EVENTS}, d AS (SELECT {EVENT_READINGS} FROM e)
SELECT {", ".join(f"{old} AS {new}" for old, new in NEW_NAMES.items())} FROM d""",
    "compare_tables": COMPARE,
    "compare_ranked": COMPARE_RANKED,
    "conformance_chain": f"""WITH {EVENTS},
k AS (
  SELECT {D.SPOILT_PASSES} AS kept, event_id % 11 = 0 AND speed_raw <> 1023 AS off,
    speed_raw::DOUBLE / 10.0::DOUBLE AS sog, speed_raw <> 1023 AS known
  FROM e
)
SELECT 'sog' AS "column", count(*) FILTER (kept)::BIGINT AS n_rows,
  count(*) FILTER (kept AND off)::BIGINT AS n_different,
  round(max(CASE WHEN off THEN abs(sog + 0.01::DOUBLE - sog) ELSE 0 END)
    FILTER (kept AND known), 6) AS max_difference FROM k
UNION ALL SELECT 'x', count(*) FILTER (kept)::BIGINT, 0::BIGINT, 0::DOUBLE FROM k
UNION ALL SELECT '(left only)', 0::BIGINT, 0::BIGINT, NULL
UNION ALL SELECT '(right only)', count(*) FILTER (NOT kept)::BIGINT,
  count(*) FILTER (NOT kept)::BIGINT, NULL FROM k
UNION ALL SELECT '(ambiguous)', 0::BIGINT, 0::BIGINT, NULL""",
    "strict_sentences": f"""WITH {EVENTS_PACKED}
SELECT data, ({D.EVENT_STATION})::INTEGER AS port_mmsi, epoch::BIGINT AS epoch FROM p
WHERE regexp_full_match(data, '[0-W`-w]+')""",
    "compare_rows": f"""WITH {CHECKED}, l AS (SELECT number, epoch, mmsi FROM k),
r AS (SELECT number, epoch, mmsi FROM m)
SELECT *, 'left' AS side FROM (SELECT * FROM l EXCEPT SELECT * FROM r)
UNION ALL
SELECT *, 'right' FROM (SELECT * FROM r EXCEPT SELECT * FROM l)""",
    "null_rules": f"""SELECT event_id,
  {_cycle("= 511", 510, 511, 0)} AS true_heading,
  {_cycle("NOT BETWEEN -720.1 AND 720.1", 720.1, 720.2, -720.2, -720.1, 0)} AS rot,
  {_cycle("> 59", 59, 60, 63)} AS "timestamp",
  {_cycle("> 102.3", 102.3, 102.4, 0)} AS sog,
  {_cycle("= 181", 181, 180.9, -181)} AS x,
  {_cycle("= 91", 91, 90.9, -91)} AS y,
  {_cycle("= 260", 260, 259.9, 360)} AS cog,
  {_cycle("= 0", 0, 1, 12)} AS eta_month,
  {_cycle("= 0", 0, 1, 31)} AS eta_day,
  {_cycle("= 24", 24, 23, 0)} AS eta_hour,
  {_cycle("= 60", 60, 59, 0)} AS eta_minute
FROM events""",
    "text_rules": """SELECT event_id, (value > 10)::INTEGER AS is_large,
  replace(replace(event_type, 'i', '`'), '`', '''') AS kind,
  replace(event_type || '_' || props, '_', '-') AS label
FROM events""",
}
