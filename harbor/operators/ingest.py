"""Raw lines to sentence records, with the lines left out accounted for.

A line is a tag block and a sentence, ``\\tags*sum\\!sentence*sum``.  A line is
``accepted``, or left out for one of these reasons:

* ``checksum``: some segment does not carry its own checksum;
* ``no_sentence``: nothing follows the tag block;
* ``few_fields``: fewer than seven fields, or no checksum in the seventh;
* ``empty_payload``: a single-part message without a payload;
* ``alphabet``: a payload character that does not stand for six bits;
* ``fragment_number``: no readable fragment number or one beyond
  ``reassemble.MAX_NUMBER``, a one-part message numbered other than 1, or, if
  asked for, a number outside the message's count.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harbor.functions.checksum import line_holds, line_sums, segments
from harbor.functions.payload import PAYLOAD_LENIENT, PAYLOAD_STRICT, bits_of, message_type
from harbor.operators.reassemble import MAX_NUMBER

ACCEPTED = "accepted"

SENTENCE_COLUMNS = (
    "packet_type",
    "fragment_count",
    "fragment_n",
    "message_id",
    "radio_channel",
    "data",
    "padding",
    "checksum_packet",
    "s",
    "port",
    "port_mmsi",
    "timestamp",
    "checksum_meta",
)

# Tag-block patterns; each reads the first place it fits.
META_STATION = r"s:(.*)//P"
META_PORT = r"Port=(\d*)"
META_MMSI = r"MMSI=(\d*)"
META_TIME = r"c:(\d*)"
META_CHECKSUM = r"\*([\d\w]*)"


@dataclass(frozen=True)
class IngestRules:
    """What a line must satisfy.

    ``check_sums=False`` skips the checksum filter.  ``require_meta=False``
    accepts lines without a tag block.  ``strict_alphabet`` also rejects the
    eight payload characters outside the protocol's alphabet.  ``lone_parts``
    rejects one-part messages numbered other than 1, which lets one-part
    messages bypass reassembly.  ``parts_in_count`` rejects fragments numbered
    below 1 or above their count, which bounds what is joined into a message
    more tightly than ``MAX_NUMBER`` does.  ``lone_aside`` is set where one-part
    messages are not numbered at all, so that any number of theirs will do.
    """

    check_sums: bool = True
    require_meta: bool = True
    strict_alphabet: bool = False
    lone_parts: bool = True
    parts_in_count: bool = False
    lone_aside: bool = False

    @property
    def alphabet(self) -> str:
        return PAYLOAD_STRICT if self.strict_alphabet else PAYLOAD_LENIENT


DEFAULT_RULES = IngestRules()


def effective(rules: IngestRules, mode: str) -> IngestRules:
    """The rules as a reassembly mode applies them.

    In ``sequence`` mode one-part messages pass whatever their number.
    """
    if mode == "sequence":
        return replace(rules, lone_parts=False, lone_aside=True)
    return rules


def parse_int(text: Column) -> Column:
    """Decimal int, null when unreadable or out of range."""
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))


def parse_digits(digits: Column) -> Column:
    """Int from text known to hold digits only; null when empty or out of range."""
    return F.when(digits != "", digits.try_cast("int"))


def parse_epoch(digits: Column) -> Column:
    """Epoch seconds to a timestamp, null when absent or out of int range."""
    return F.timestamp_seconds(parse_digits(digits))


def _fields_split(lines: DataFrame, *keep: str) -> DataFrame:
    """``__meta``, ``__n_parts``, ``__fields`` and the two ends of the last field, ``__tail``.

    Every split of a line is made here, once.
    """
    parts = lines.select(*keep, segments(F.col("value")).alias("__parts"))
    split = parts.select(
        *keep,
        F.size("__parts").alias("__n_parts"),
        F.get("__parts", F.lit(0)).alias("__meta"),
        F.split(F.get("__parts", F.lit(1)), ",").alias("__fields"),
    )
    last = F.rtrim(F.get("__fields", F.lit(6)), F.lit("*"))
    return split.select("*", F.split(last, "\\*").alias("__tail"))


def _sentence_columns() -> list[Column]:
    """The thirteen columns, from what ``_fields_split`` gives."""
    meta = F.col("__meta")
    field = [F.get("__fields", F.lit(i)) for i in range(6)]
    return [
        field[0].alias("packet_type"),
        parse_int(field[1]).alias("fragment_count"),
        parse_int(field[2]).alias("fragment_n"),
        parse_int(field[3]).alias("message_id"),
        field[4].alias("radio_channel"),
        field[5].alias("data"),
        parse_int(F.get("__tail", F.lit(0))).alias("padding"),
        F.get("__tail", F.lit(1)).alias("checksum_packet"),
        F.regexp_extract(meta, META_STATION, 1).alias("s"),
        parse_digits(F.regexp_extract(meta, META_PORT, 1)).alias("port"),
        parse_digits(F.regexp_extract(meta, META_MMSI, 1)).alias("port_mmsi"),
        parse_epoch(F.regexp_extract(meta, META_TIME, 1)).alias("timestamp"),
        F.regexp_extract(meta, META_CHECKSUM, 1).alias("checksum_meta"),
    ]


def parse_sentences(lines: DataFrame, column: str = "value", *keep: str) -> DataFrame:
    """Lines to the thirteen sentence columns, after any columns in ``keep``.

    Nothing is filtered; what a line does not have is null.
    """
    named = lines.select(*keep, F.col(column).alias("value")) if column != "value" else lines
    return _fields_split(named, *keep).select(*keep, *_sentence_columns())


# A field that reads as 1, one that reads as a number within
# MAX_NUMBER, and one that may read as an int.
_ONE = "[+]?0*1"
_PLACE = f"[+-]?0*[0-9]{{1,{len(str(MAX_NUMBER))}}}"
_INT = "[+-]?[0-9]+"
_ANY = "[^,!]*"


def _shape(payload: str, count: str, number: str) -> str:
    """Pattern of a line with all its fields, the payload in the alphabet."""
    fields = ",".join([_ANY, count, number, _ANY, _ANY, payload])
    return f"^[^!]*!{fields},{_ANY}?\\*+[^,!*]"


def is_whole_message(
    line: Column, rules: IngestRules = DEFAULT_RULES, any_number: bool = False
) -> Column:
    """True for the usual line: part 1 of 1 with a readable, non-empty payload.

    One regular expression on the raw text, so that such lines can be routed
    past reassembly before anything is parsed.  With ``any_number`` the part
    may be numbered otherwise.
    """
    number = _INT if any_number else _ONE
    return line.rlike(_shape(f"{rules.alphabet}+", _ONE, number))


def is_message_part(line: Column, rules: IngestRules = DEFAULT_RULES) -> Column:
    """True for the other usable lines, by the raw text alone.

    Their count is not 1, or they break ``lone_parts`` where that is allowed;
    a part may be empty as long as it is not a message by itself.
    """
    part = line.rlike(_shape(f"{rules.alphabet}*", f"(?!{_ONE},){_ANY}", _PLACE))
    if rules.lone_parts:
        return part
    number = _INT if rules.lone_aside else _PLACE
    return part | line.rlike(_shape(f"{rules.alphabet}+", _ONE, number))


def sums_hold(line: Column, rules: IngestRules) -> Column:
    return line_holds(line, rules.require_meta) if rules.check_sums else F.lit(True)


def _accepted(lines: DataFrame, fitting: Column, rules: IngestRules) -> DataFrame:
    """Sentence records of the lines that fit and whose sums hold.

    The pattern is tested in the JVM first, on the scan; only lines that fit
    it are summed.
    """
    return parse_sentences(lines.where(fitting).where(sums_hold(F.col("value"), rules)))


def _numbered(sentences: DataFrame, rules: IngestRules) -> DataFrame:
    """What the patterns leave to be said of the number, if anything.

    A filter on parsed columns is pushed below the checksums and splits every
    line there, so there is none where the pattern says it all.
    """
    number, count = F.col("fragment_n"), F.col("fragment_count")
    if rules.lone_aside:
        # It may have more digits than an int holds.
        sentences = sentences.where(number.isNotNull())
    if rules.parts_in_count:
        sentences = sentences.where(_number_ok(number, count, rules))
    return sentences


def _lone(count: Column) -> Column:
    return F.coalesce(count == 1, F.lit(False))


def _number_ok(number: Column, count: Column, rules: IngestRules) -> Column:
    """Whether a sentence's number, null if unreadable, gives it a place."""
    placed = number.between(-MAX_NUMBER, MAX_NUMBER)
    if rules.parts_in_count:
        placed = placed & (_lone(count) | F.coalesce((number >= 1) & (number <= count), F.lit(False)))
    if rules.lone_aside:
        placed = placed | _lone(count)
    if rules.lone_parts:
        placed = placed & (~_lone(count) | (number == 1))
    return number.isNotNull() & placed


WHOLE, PART, LEFT_OUT = "whole", "part", "left_out"


#: What a message or a part of one is made of.
MESSAGE_COLUMNS = (
    "packet_type",
    "fragment_count",
    "fragment_n",
    "message_id",
    "radio_channel",
    "data",
    "padding",
    "s",
    "port",
    "port_mmsi",
    "timestamp",
)
#: What a line left out is told with: the first sum that does not hold, if any.
FAILED_SUM = ("segment", "claimed", "computed")


def examined(lines: DataFrame, rules: IngestRules = DEFAULT_RULES, sums: bool = True) -> DataFrame:
    """Every line summed once, split once and judged: ``value, outcome``, the
    first sum that does not hold, the type ``id`` of its own payload, and the
    sentence columns.

    What is split goes through an array of one, which no filter on the outcome
    can be pushed below, where all of it would be done again.  ``sums=False``
    leaves out which sums failed.
    """
    line = F.col("value")
    if rules.check_sums and sums:
        told = line_sums(line, rules.require_meta)
    else:
        told = F.struct(sums_hold(line, rules).alias("holds"), *_no_sum())
    split = _fields_split(lines.select("value", told.alias("__sums")), "value", "__sums")
    once = F.array(F.struct("__sums", "__n_parts", "__meta", "__fields", "__tail"))
    known = split.select("value", F.explode(once).alias("__line")).select("value", "__line.*")
    keep = ["value", *[F.col("__sums")[f].alias(f) for f in FAILED_SUM]]
    typed = known.select(
        *keep,
        F.col("__sums.holds").alias("__holds"),
        "__n_parts",
        "__fields",
        "__tail",
        *_sentence_columns(),
    )
    return typed.select(
        "value",
        outcome(rules).alias("outcome"),
        *FAILED_SUM,
        first_type(F.col("data")).alias("id"),
        *SENTENCE_COLUMNS,
    )


def _no_sum() -> list[Column]:
    kinds = ("int", "string", "string")
    return [F.lit(None).cast(kind).alias(name) for name, kind in zip(FAILED_SUM, kinds)]


def routed(lines: DataFrame, rules: IngestRules, any_number: bool) -> DataFrame:
    """Every line as it is staged, by ``route``: a message by itself, a part of one, or left out.

    ``outcome`` and ``id`` of all of them, to be counted; the text and the sum
    that failed of those left out; the message columns of the others.
    """
    accepted = F.col("outcome") == ACCEPTED
    lone = _lone(F.col("fragment_count"))
    whole = lone if any_number else lone & (F.col("fragment_n") == 1)
    return examined(lines, rules).select(
        F.when(~accepted, F.col("value")).alias("value"),
        "outcome",
        *FAILED_SUM,
        "id",
        *[F.when(accepted, F.col(c)).alias(c) for c in MESSAGE_COLUMNS],
        F.when(~accepted, LEFT_OUT).when(whole, WHOLE).otherwise(PART).alias("route"),
    )


def whole_messages(
    lines: DataFrame, rules: IngestRules = DEFAULT_RULES, any_number: bool = False
) -> DataFrame:
    """Sentence records of the accepted lines that are messages by themselves."""
    line = F.col("value")
    return _numbered(_accepted(lines, is_whole_message(line, rules, any_number), rules), rules)


def message_parts(
    lines: DataFrame, rules: IngestRules = DEFAULT_RULES, any_number: bool = False
) -> DataFrame:
    """Sentence records of the other accepted lines."""
    line = F.col("value")
    whole = is_whole_message(line, rules, any_number)
    return _numbered(_accepted(lines, ~whole & is_message_part(line, rules), rules), rules)


def read_sentences(lines: DataFrame, rules: IngestRules = DEFAULT_RULES) -> DataFrame:
    """Sentence records of all accepted lines."""
    line = F.col("value")
    fitting = is_whole_message(line, rules) | is_message_part(line, rules)
    return _numbered(_accepted(lines, fitting, rules), rules)


def outcome(rules: IngestRules = DEFAULT_RULES) -> Column:
    """``accepted``, or the first reason why the line is left out.

    From the columns that ``examined`` has of a line.
    """
    fields = F.col("__fields")
    number, count, data = F.col("fragment_n"), F.col("fragment_count"), F.col("data")
    few = (F.size(fields) < 7) | F.get("__tail", F.lit(1)).isNull()
    return (
        F.when(~F.col("__holds"), "checksum")
        .when(F.col("__n_parts") < 2, "no_sentence")
        .when(few, "few_fields")
        .when(_lone(count) & (data == ""), "empty_payload")
        .when(~data.rlike(f"^{rules.alphabet}*$"), "alphabet")
        .when(~_number_ok(number, count, rules), "fragment_number")
        .otherwise(ACCEPTED)
    )


def judged(lines: DataFrame, rules: IngestRules = DEFAULT_RULES) -> DataFrame:
    """``value, outcome`` of every line."""
    return examined(lines, rules, sums=False).select("value", "outcome")


def checksum_filter(lines: DataFrame, require_meta: bool = True) -> DataFrame:
    """Lines all of whose segments carry their own checksum."""
    return lines.where(line_holds(F.col("value"), require_meta))


def quarantine(lines: DataFrame, rules: IngestRules = DEFAULT_RULES) -> DataFrame:
    """The lines left out: ``value, outcome`` and the sum that did not hold."""
    return left_out(examined(lines, rules))


def left_out(found: DataFrame) -> DataFrame:
    """The lines left out, of ``examined`` or staged lines."""
    return found.where(F.col("outcome") != ACCEPTED).select("value", "outcome", *FAILED_SUM)


def ingest_counts(lines: DataFrame, rules: IngestRules = DEFAULT_RULES) -> DataFrame:
    """Lines per outcome and message type of the line's own payload."""
    return counted(examined(lines, rules, sums=False))


def counted(found: DataFrame) -> DataFrame:
    """Lines per outcome and message type, of ``examined`` or staged lines."""
    return found.groupBy("outcome", "id").agg(F.count(F.lit(1)).alias("n_lines"))


def first_type(data: Column) -> Column:
    """Message type of a payload, null when its first character carries none."""
    return F.when(data.rlike(f"^{PAYLOAD_LENIENT}"), message_type(data))


def unpack(messages: DataFrame, keep_bits: bool = True) -> DataFrame:
    """Append ``dataBinary`` and the message type ``id``.

    ``keep_bits=False`` leaves ``dataBinary`` out: it is six times the payload
    and the decoders do not need it.
    """
    data = F.col("data")
    columns = list(messages.columns)
    if keep_bits:
        columns.append(bits_of(data).alias("dataBinary"))
    return messages.select(*columns, message_type(data).alias("id"))


def sentences_as_messages(
    lines: DataFrame,
    column: str = "value",
    check_sums: bool = True,
    keep_bits: bool = True,
) -> DataFrame:
    """Each line as a message of its own, fragments left unmerged.

    Used to rebuild messages from the raw line kept in a checked table.  As
    nothing is merged, any fragment number will do, unreadable ones too.
    """
    rules = IngestRules(check_sums=check_sums, lone_parts=False)
    lines = lines.select(F.col(column).alias("value"))
    line, alphabet = F.col("value"), rules.alphabet
    fitting = line.rlike(_shape(f"{alphabet}+", _ONE, _ANY)) | line.rlike(
        _shape(f"{alphabet}*", f"(?!{_ONE},){_ANY}", _ANY)
    )
    return unpack(_accepted(lines, fitting, rules), keep_bits)
