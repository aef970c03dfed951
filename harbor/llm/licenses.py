"""License scans: ordered signatures, gated by keywords, overlaps resolved.

A text becomes its words, in small letters, each with a space on either side, so
that a signature can only fit whole words.  A signature is tried where the text
holds its keyword, and hardly any text passes the gate before that.  Every place
where one fits is a detection, from one word to another.  A detection is
suppressed

* by one of a better kind that shares a word with it (priority), and
* by one of its own kind that contains it, the same span counting for the
  signature that stands first (containment),

whether or not that one is suppressed itself.  Both are told from two running
bounds over the detections in order: how far those before reach, and where those
after begin, by kind.  They are made by doubling, so the work grows with the
detections and not with their square.

The work is built from column functions alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harbor.llm.license_rules import KINDS, SIGNATURES, Signature

# What separates words once letters are small, and the base phrases.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = (
    Signature("mit", "name", "mit", "mit license"),
    Signature("apache", "name", "apache", "apache license"),
    Signature("gpl", "name", "general", "general public license"),
)

#: Every match of a signature holds one of these; other texts are passed over.
GATE = (
    "licen", "gpl", "bsd", "mpl", "asl", "cddl", "cecill", "wtfpl", "cc0", "cc  by", "commons",
    "attribution", "domain", "rights", "proprietary", "unauthorized", "advertising", "endorse",
    "misrepresented", "eclipse", "classpath", "modules", "perl", "tivoization", "rail", "permission",
    "redistribut", "consortium", "apache", "openssl", "scripts  sil",
)

#: How sure a detection of each kind makes us that the text is under a license.
WEIGHTS = (1.0, 0.95, 0.85, 0.7, 0.3)

_OPEN, _CLOSE = "\x01", "\x02"
_NO_START = (1 << 31) - 1


def spread(pattern: str) -> str:
    """A signature's pattern as it meets ``said``, whose words have two spaces between them."""
    return pattern.replace(" ", "  ")


def _listed(signatures: Sequence[Signature]) -> Column:
    """The signatures as one constant, read by the SQL parser in one go."""
    structs = [
        f"named_struct('label', '{s.label}', 'kind', {KINDS.index(s.kind)}, 'turn', {turn}, "
        f"'keyword', '{s.keyword}', 'pattern', r' ({spread(s.pattern)}) ')"
        for turn, s in enumerate(signatures)
    ]
    return F.expr(f"array({', '.join(structs)})")


def _said(text: Column) -> Column:
    """The words of a text in small letters, each with a space on either side."""
    plain = F.octet_length(text) == F.length(text)
    # Only A to Z change; the quicker function changes others as well.
    small = F.when(plain, F.lower(text)).otherwise(
        F.translate(text, ascii_uppercase, ascii_lowercase)
    )
    words = F.trim(F.regexp_replace(small, SEPARATORS, "  "))
    return F.when(words == "", "").otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _places(said: Column, pattern: Column) -> Column:
    """``start, end`` in words of every match: marks are put around it and looked up."""
    marked = F.regexp_replace(said, pattern, F.lit(f" {_OPEN}$1{_CLOSE} "))
    words = F.split(F.trim(marked), "  ")

    def where(test, shift: int) -> Column:
        numbers = F.transform(words, lambda w, i: F.when(test(w), i + shift))
        return F.filter(numbers, lambda i: i.isNotNull())

    starts = where(lambda w: w.startswith(_OPEN), 0)
    ends = where(lambda w: w.endswith(_CLOSE), 1)
    return F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), e.alias("end")))


def _detections(said: Column, signatures: Column) -> Column:
    """All detections in order: by start, the longer first, then by kind and turn."""

    def of_one(s: Column) -> Column:
        return F.transform(
            _places(said, s["pattern"]),
            lambda place: F.struct(
                place["start"].alias("start"),
                (-place["end"]).alias("back"),
                s["kind"].alias("kind"),
                s["turn"].alias("turn"),
                s["label"].alias("label"),
            ),
        )

    fitting = F.filter(
        signatures, lambda s: F.contains(said, s["keyword"]) & F.rlike(said, s["pattern"])
    )
    return F.array_sort(F.flatten(F.transform(fitting, of_one)))


def _by_kind(value) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(len(KINDS) - 1)), value)


def _running(first: Column, size: Column, backward: bool, better) -> Column:
    """The best so far of every kind, at every place of an array of arrays."""
    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(size, F.lit(1)))).cast("int"))

    def doubled(bounds: Column, k: Column) -> Column:
        step = F.call_function("shiftleft", F.lit(1), k)

        def with_other(own: Column, i: Column) -> Column:
            other = F.get(bounds, i + step if backward else i - step)
            return F.zip_with(own, F.coalesce(other, own), better)

        return F.transform(bounds, with_other)

    return F.aggregate(rounds, first, doubled)


def _surviving(found: Column, reach: Column, begin: Column) -> Column:
    """The detections that nothing suppresses."""

    def survives(d: Column, i: Column) -> Column:
        before, after = F.get(reach, i - 1), F.get(begin, i + 1)
        beaten = F.exists(
            F.sequence(F.lit(0), F.lit(len(KINDS) - 1)),
            lambda k: (k < d["kind"])
            & (
                F.coalesce(F.get(before, k) > d["start"], F.lit(False))
                | F.coalesce(F.get(after, k) < -d["back"], F.lit(False))
            ),
        )
        inside = F.coalesce(F.get(before, d["kind"]) >= -d["back"], F.lit(False))
        return ~(beaten | inside)

    return F.filter(found, survives)


def find_licenses(docs: DataFrame, signatures: Sequence[Signature] = SIGNATURES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, base, detections, score``.

    ``base`` lists ``label, start`` of the base phrases, all places; ``detections``
    lists ``label, kind, start, end`` of the signatures that are not suppressed,
    in words from 0, the end exclusive.  ``score`` is the weight of the best kind
    found, a base phrase counting as a name, and 0 where nothing is.

    Null reads as empty, and an empty text has no words; repeated rows are
    scanned each, a missing id stays missing, an empty table gives an empty
    result, and other columns are ignored.  Given signatures must hold one of
    ``GATE``.
    """
    said = F.col("said")
    texts = docs.select("doc_id", _said(F.coalesce("text", F.lit(""))).alias("said"))
    pairs = F.length(said) - F.length(F.replace(said, F.lit("  "), F.lit(" ")))
    n_words = F.when(said == "", 0).otherwise(pairs + 1).cast("long")
    passes = F.lit(False)
    for stem in GATE:
        passes = passes | F.contains(said, F.lit(stem))
    # Each step is one select, so that no column is worked out twice.
    gated = texts.select("doc_id", "said", n_words.alias("n_words"), passes.alias("passes"))
    nothing = F.expr(
        "cast(array() as array<struct<start:int,back:int,kind:int,turn:int,label:string>>)"
    )
    found = gated.select(
        "doc_id",
        "n_words",
        F.when(F.col("passes"), _detections(said, _listed(BASE))).otherwise(nothing).alias("base"),
        F.when(F.col("passes"), _detections(said, _listed(signatures)))
        .otherwise(nothing)
        .alias("found"),
    )
    size = F.size("found")
    ends = F.transform(
        "found", lambda d: _by_kind(lambda k: F.when(d["kind"] == k, -d["back"]).otherwise(0))
    )
    starts = F.transform(
        "found", lambda d: _by_kind(lambda k: F.when(d["kind"] == k, d["start"]).otherwise(_NO_START))
    )
    bounded = found.select(
        "*",
        _running(ends, size, False, lambda a, b: F.greatest(a, b)).alias("reach"),
        _running(starts, size, True, lambda a, b: F.least(a, b)).alias("begin"),
    )
    kept = bounded.select(
        "doc_id",
        "n_words",
        "base",
        _surviving(F.col("found"), F.col("reach"), F.col("begin")).alias("kept"),
    )
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    best = F.array_min(F.transform(F.concat("kept", "base"), lambda d: d["kind"]))
    names = F.array(*[F.lit(k) for k in KINDS])
    return kept.select(
        "doc_id",
        "n_words",
        F.transform(
            "base", lambda d: F.struct(d["label"].alias("label"), d["start"].alias("start"))
        ).alias("base"),
        F.transform(
            "kept",
            lambda d: F.struct(
                d["label"].alias("label"),
                F.get(names, d["kind"]).alias("kind"),
                d["start"].alias("start"),
                (-d["back"]).alias("end"),
            ),
        ).alias("detections"),
        F.coalesce(F.get(weights, best), F.lit(0.0)).alias("score"),
    )
