"""From raw lines to message tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harbor.operators.ingest import (
    DEFAULT_RULES,
    PART,
    WHOLE,
    IngestRules,
    effective,
    message_parts,
    read_sentences,
    routed,
    unpack,
    whole_messages,
)
from harbor.operators.reassemble import as_messages, assemble, check_mode


def stage_lines(lines: DataFrame, path: str, mode: str, rules: IngestRules) -> DataFrame:
    """Judge and parse every line once and keep it, by route, under ``path``.

    The one pass over an archive: messages, lines left out and counts are all
    made from what is kept, each from the folders and columns it needs.
    """
    check_mode(mode)
    # Where all sentences are numbered together, there are no whole ones.
    found = routed(lines, effective(rules, mode), mode == "sequence")
    found.write.partitionBy("route").parquet(path)
    return lines.sparkSession.read.schema(found.schema).parquet(path)


def messages_from_staged(
    staged: DataFrame,
    mode: str = "gap",
    rules: IngestRules = DEFAULT_RULES,
    keep_bits: bool = True,
) -> DataFrame:
    """The message table of staged lines, the same as of the lines themselves."""
    check_mode(mode)

    def sentences(*routes: str) -> DataFrame:
        return staged.where(F.col("route").isin(*routes))

    if mode == "gap" and not rules.lone_parts:
        return unpack(assemble(sentences(WHOLE, PART), mode), keep_bits)
    whole = as_messages(sentences(WHOLE), mode)
    return unpack(whole.unionByName(assemble(sentences(PART), mode)), keep_bits)


def messages_from_lines(
    lines: DataFrame,
    mode: str = "gap",
    rules: IngestRules = DEFAULT_RULES,
    keep_bits: bool = True,
) -> DataFrame:
    """Raw lines (column ``value``) to the message table.

    Most lines are messages by themselves.  They are told apart on the raw
    text, go through without a shuffle, and only fragments are exchanged; each
    line's checksum is computed on one of the two branches.  With
    ``rules.lone_parts`` off every sentence takes part in the ``gap`` numbering.
    """
    check_mode(mode)
    if mode == "gap" and not rules.lone_parts:
        return unpack(assemble(read_sentences(lines, rules), mode), keep_bits)
    any_number = mode == "sequence"
    rules = effective(rules, mode)
    whole = as_messages(whole_messages(lines, rules, any_number), mode)
    parts = assemble(message_parts(lines, rules, any_number), mode)
    return unpack(whole.unionByName(parts), keep_bits)
