"""Chat formatting: turns as marked text that parses back to the same turns.

::

    ### User: text
    </turn>

A text may itself hold ``### `` or ``</turn>``.  Every turn is rendered as it
is, parsed again and compared with its source; where they differ, each control
string in the text gets a backslash, before any it already has, and the turn is
compared again.  The parser takes a control string as structure unless a
backslash precedes it, and removes one backslash from the others.

The work is built from column functions alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, END = "### ", "</turn>"

_CONTROL = f"(?:{HEAD}|{END})"
# Where a run of backslashes, or of none, begins: not tried again within the run.
_RUN = r"(?<!\\)"
_BARE = rf"{_RUN}{_CONTROL}"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_RUN}(\\*+{_CONTROL})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_RUN}\\(\\*+{_CONTROL})", "$1")


def _name(role: Column) -> Column:
    """A role of small letters with a capital; any other in hexadecimal digits."""
    capital = F.concat(F.upper(F.substring(role, 1, 1)), F.substring(role, 2, 1 << 30))
    return F.when(role.rlike(r"^[a-z]+\z"), capital).otherwise(F.concat(F.lit("="), F.hex(role)))


def _role(name: Column) -> Column:
    small = F.concat(F.lower(F.substring(name, 1, 1)), F.substring(name, 2, 1 << 30))
    coded = F.decode(F.unhex(F.substring(name, 2, 1 << 30)), "UTF-8")
    return F.when(name.startswith("="), coded).otherwise(small)


def render(role: Column, text: Column) -> Column:
    """One turn; the text must be escaped where it conflicts."""
    return F.concat(F.lit(HEAD), _name(role), F.lit(": "), text, F.lit(f"\n{END}\n"))


def parse_turn(piece: Column) -> Column:
    """``role, text`` of what stands before an end mark; null if it is no turn."""
    pattern = rf"(?s)^{HEAD}([A-Z][a-z]*|=[0-9A-F]*): (.*)\n\z"
    text = F.regexp_extract(piece, pattern, 2)
    turn = F.struct(
        _role(F.regexp_extract(piece, pattern, 1)).alias("role"), unescape(text).alias("text")
    )
    return F.when(piece.rlike(pattern) & ~text.rlike(_BARE), turn)


def parse(formatted: Column) -> Column:
    """All turns of a formatted text, in order, as ``role, text``."""
    pieces = F.split(formatted, rf"(?<!\\){END}\n?")
    # After the last end mark comes an empty piece.
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), parse_turn)


def _parsed_alone(rendered: Column) -> Column:
    turns = parse(rendered)
    return F.when(F.size(turns) == 1, F.get(turns, F.lit(0)))


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per ``conv_id``: ``formatted``, and ``turns`` read back from it.

    Turns stand by ``turn``, ties by role and text; a missing number comes
    first.  Null roles and texts read as empty, repeated rows are turns of
    their own, null is an id like any other, and other columns are ignored.  A
    formatted conversation is one string, so one conversation must fit a row.
    """
    source = F.struct(F.col("role"), F.col("text"))
    clean = rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    plain = _parsed_alone(render(F.col("role"), F.col("text")))
    body = F.when(plain.eqNullSafe(source), F.col("text")).otherwise(escape(F.col("text")))
    turns = clean.withColumn("__turn", render(F.col("role"), body))
    whole = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "__turn"))).alias("__rows")
    )
    formatted = whole.select(
        "conv_id",
        F.array_join(F.col("__rows")["__turn"], "").alias("formatted"),
        F.transform("__rows", lambda r: F.struct(r["role"], r["text"])).alias("__source"),
    ).withColumn("turns", parse(F.col("formatted")))
    same = F.col("turns") == F.col("__source").cast("array<struct<role:string,text:string>>")
    checked = F.when(same, F.col("turns")).otherwise(
        F.raise_error(F.concat(F.lit("turns do not read back: "), F.col("conv_id").cast("string")))
    )
    return formatted.select("conv_id", "formatted", checked.alias("turns"))


def loss_text(turns: Column) -> Column:
    """The text a model is trained to produce: all assistant texts."""
    spoken = F.filter(turns, lambda t: t["role"] == "assistant")
    return F.array_join(F.transform(spoken, lambda t: t["text"]), "")
