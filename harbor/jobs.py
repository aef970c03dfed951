"""Jobs for ``spark-submit``: ingest lines, decode a family, compare with a checked table.

The session is the submitter's; nothing here sets masters, memory or
parallelism.
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harbor.messages import messages_from_staged, stage_lines
from harbor.operators import conform, decode, ingest, static_reports
from harbor.operators.ingest import LEFT_OUT, IngestRules
from harbor.sources.checked_csv import read_checked
from harbor.sources.lines import read_lines
from harbor.sources.shared import remove, shared_folder
from harbor.sources.tables import read_messages, write_messages, write_table

Decoder = Callable[..., DataFrame]

DECODERS: dict[str, Decoder] = {
    "123": decode.decode_position_a,
    "5": decode.decode_static_voyage,
    "18": decode.decode_position_b,
    "24": static_reports.decode_static_reports,
}
# The options each decoder has.
OPTIONS = {
    "123": ("extras", "course_absent"),
    "5": ("trim_text",),
    "18": (),
    "24": ("trim_text", "by_number_only"),
}


def ingest_job(
    spark: SparkSession,
    source: str,
    target: str,
    quarantine: str | None = None,
    mode: str = "gap",
    rules: IngestRules = IngestRules(),
    keep_bits: bool = True,
    compact: bool = True,
    counts: str | None = None,
) -> None:
    """Lines under ``source`` to a message table; lines left out and counts, if asked for.

    The lines are read once, into a staging table of parsed sentences in shared
    storage, which is removed when the job ends, well or not.
    """
    path = f"{shared_folder(spark)}/lines-{uuid.uuid4().hex}"
    try:
        staged = stage_lines(read_lines(spark, source), path, mode, rules)
        made = messages_from_staged(staged, mode, rules, keep_bits)
        write_messages(made, target, compact=compact)
        if quarantine:
            left_out = staged.where(F.col("route") == LEFT_OUT)
            write_table(ingest.left_out(left_out), quarantine)
        if counts:
            write_table(ingest.counted(staged), counts)
    finally:
        remove(spark, path)


def decode_job(
    spark: SparkSession, family: str, source: str, target: str, **options: object
) -> None:
    """A message table to the decoded table of one family."""
    table = DECODERS[family](read_messages(spark, source), **options)
    write_table(decode.drop_working(table), target)


def compare_job(
    spark: SparkSession,
    family: str,
    source: str,
    target: str,
    names: Mapping[str, str],
    keys: Sequence[str],
    tolerances: Mapping[str, float],
    raw: str = "rawInput",
    by_rank: bool = False,
    **options: object,
) -> None:
    """A checked CSV table against what this engine makes of its raw lines.

    The lines in column ``raw`` are rebuilt into messages and decoded, decoded
    columns get the checked table's ``names``, and the report of the comparison
    by ``keys`` is written.
    """
    checked = read_checked(spark, source)
    write_table(compared(checked, family, names, keys, tolerances, raw, by_rank, **options), target)


def compared(
    checked: DataFrame,
    family: str,
    names: Mapping[str, str],
    keys: Sequence[str],
    tolerances: Mapping[str, float],
    raw: str = "rawInput",
    by_rank: bool = False,
    **options: object,
) -> DataFrame:
    """The report of ``compare_job`` for a checked table."""
    messages = ingest.sentences_as_messages(checked, raw)
    decoded = conform.rename_select(DECODERS[family](messages, **options), names)
    wanted = conform.with_absent_as_null(checked).select(*decoded.columns)
    return conform.compare_by_key(decoded, wanted, keys, tolerances, by_rank=by_rank)


def _pairs(text: str, value: Callable[[str], object] = str) -> dict:
    return {k: value(v) for k, _, v in (part.partition("=") for part in text.split(",")) if k}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="harbor")
    jobs = parser.add_subparsers(dest="job", required=True)
    raw = jobs.add_parser("ingest", help="receiver lines to a message table")
    raw.add_argument("source")
    raw.add_argument("target")
    raw.add_argument("--quarantine", help="where to keep the lines left out")
    raw.add_argument("--counts", help="where to keep the lines per outcome and type")
    raw.add_argument("--mode", choices=("gap", "sequence"), default="gap")
    raw.add_argument("--no-bits", action="store_true", help="leave dataBinary out")
    raw.add_argument("--no-compact", action="store_true", help="a file per task and type")
    raw.add_argument("--bare", action="store_true", help="accept lines without a tag block")
    raw.add_argument("--strict", action="store_true", help="protocol alphabet only")
    raw.add_argument("--unchecked", action="store_true", help="skip the checksums")
    raw.add_argument("--number-all", action="store_true", help="number one-part messages too")
    raw.add_argument("--parts-in-count", action="store_true", help="no number above the count")
    decoder = argparse.ArgumentParser(add_help=False)
    decoder.add_argument("family", choices=sorted(DECODERS))
    decoder.add_argument("--extras", action="store_true", help="123: spare bits, radio status")
    decoder.add_argument("--course-absent", type=int, help="123: raw course that is null")
    decoder.add_argument("--trim-text", action="store_true", help="5, 24: cut texts at @")
    decoder.add_argument("--by-number-only", action="store_true", help="24: parts by number")
    one = jobs.add_parser("decode", parents=[decoder], help="messages to a decoded table")
    one.add_argument("source")
    one.add_argument("target")
    both = jobs.add_parser("compare", parents=[decoder], help="a checked CSV table with ours")
    both.add_argument("source")
    both.add_argument("target")
    both.add_argument("--names", required=True, type=_pairs, help="ours=theirs, with commas")
    both.add_argument("--keys", required=True, type=lambda t: t.split(","), help="their names")
    both.add_argument("--tolerances", default={}, type=partial(_pairs, value=float))
    both.add_argument("--raw", default="rawInput", help="column of the raw line")
    both.add_argument("--by-rank", action="store_true", help="pair the rows of repeated keys")
    return parser


def main(arguments: Sequence[str] | None = None) -> None:
    given = _parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"harbor-{given.job}").getOrCreate()
    if given.job == "ingest":
        rules = IngestRules(
            check_sums=not given.unchecked,
            require_meta=not given.bare,
            strict_alphabet=given.strict,
            lone_parts=not given.number_all,
            parts_in_count=given.parts_in_count,
        )
        ingest_job(
            spark,
            given.source,
            given.target,
            given.quarantine,
            given.mode,
            rules,
            not given.no_bits,
            not given.no_compact,
            given.counts,
        )
        return
    told = {
        name: getattr(given, name)
        for name in ("extras", "course_absent", "trim_text", "by_number_only")
        if getattr(given, name)
    }
    if unknown := sorted(set(told) - set(OPTIONS[given.family])):
        raise SystemExit(f"family {given.family} has no option {', '.join(unknown)}")
    if given.job == "decode":
        decode_job(spark, given.family, given.source, given.target, **told)
    else:
        compare_job(
            spark,
            given.family,
            given.source,
            given.target,
            given.names,
            given.keys,
            given.tolerances,
            given.raw,
            given.by_rank,
            **told,
        )


if __name__ == "__main__":
    main()
