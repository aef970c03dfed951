"""Secret scans: fixed patterns, and entropy over the strings they miss.

A candidate is a run of at least ``WINDOW`` characters of the alphabets keys
are written in.  Inside it, each character class has its own runs; over each a
window slides, whose Shannon entropy is kept up to date from the counts of the
character that enters and the one that leaves.  Windows at or above the class's
threshold make up spans of kind ``entropy``.  What a pattern already reports is
taken out of them, and what remains is reported unless the allow-list explains
it: a host and values meant as examples are passed over, and what stands beside
them is scanned by itself.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from harbor.llm.texts import Texts, map_texts, slices, texts_of

KINDS = ("assign", "access", "hex", "entropy")

# The base patterns and the least length of what they find.
_KEYWORD = rb"password|passwd|secret|token|api_?key"
_ASSIGN = re.compile(
    rf"""(?a:(?i:({_KEYWORD.decode()}))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24

WINDOW = 20

MASK = "[secret]"


@dataclass(frozen=True)
class CharClass:
    """An alphabet and the entropy, in bits a character, that a window needs."""

    pattern: re.Pattern
    least: float


CLASSES = (
    CharClass(re.compile(rf"[0-9a-f]{{{WINDOW},}}"), 3.0),
    CharClass(re.compile(rf"[0-9A-F]{{{WINDOW},}}"), 3.0),
    CharClass(re.compile(rf"[0-9a-z]{{{WINDOW},}}"), 3.3),
    CharClass(re.compile(rf"[0-9A-Z]{{{WINDOW},}}"), 3.3),
    CharClass(re.compile(rf"[0-9A-Za-z+/_-]{{{WINDOW},}}"), 3.7),
)

#: Strings that look random and are not secret: words and numbers joined by
#: punctuation, also words joined by their capitals.
_WORD = re.compile(
    r"[A-Za-z][a-z]*|[A-Z]+|[0-9]+"
    r"|[a-z]*(?:[A-Z][a-z]{2,}|Of|To|In|Is|At|By|On|Or|As|An|It|No|Up|Id|If)+"
)
_RUN = re.compile(r"[A-Za-z0-9]+")  # between punctuation
#: The name of a host at the beginning of a candidate; a path may follow.
_HOST = re.compile(r"(?:[A-Za-z0-9-]+\.)+(?:com|net|org|edu|gov|io)(?=/|\Z)")
#: Values meant as examples, judged by the part of a path or assignment they stand in.
_PART = re.compile(r"[^/=.]+")
_EXAMPLE = re.compile(r"(?i)example|placeholder|0123456789|abcdefgh|xxxxxx")

_CANDIDATE = np.zeros(256, dtype=bool)
_CANDIDATE[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-")] = True

_TERM = [0.0] + [n * log2(n) for n in range(1, WINDOW + 1)]


def high_windows(text: str, least: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Maximal spans covered by windows of at least that entropy."""
    counts: dict[str, int] = {}
    total = 0.0  # sum of n log n over the counts
    spans: list[tuple[int, int]] = []
    limit = (log2(window) - least) * window + 1e-9
    for end, entering in enumerate(text, 1):
        n = counts.get(entering, 0)
        total += _TERM[n + 1] - _TERM[n]
        counts[entering] = n + 1
        start = end - window
        if start < 0:
            continue
        if total <= limit:
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((start, end))
        leaving = text[start]
        n = counts[leaving]
        total += _TERM[n - 1] - _TERM[n]
        counts[leaving] = n - 1
    return spans


Range = tuple[int, int]


def _beside(size: int, taken: Sequence[Range]) -> list[Range]:
    """What is left of ``size`` characters when some ranges are taken out."""
    left, at = [], 0
    for start, end in sorted(taken):
        if start > at:
            left.append((at, start))
        at = max(at, end)
    return [*left, (at, size)] if at < size else left


def _common(some: list[Range], others: list[Range]) -> Iterator[tuple[Range, Range]]:
    """Where ranges in order meet others in order, with the one of the others."""
    i = 0
    for low, high in others:
        while i < len(some) and some[i][1] <= low:
            i += 1
        k = i
        while k < len(some) and some[k][0] < high:
            yield (max(some[k][0], low), min(some[k][1], high)), (low, high)
            k += 1


def _all_words(text: str, start: int, end: int) -> bool:
    """Whether every run of letters and digits there is a word or a number."""
    return all(_WORD.fullmatch(run.group()) for run in _RUN.finditer(text, start, end))


class _Runs:
    """Whether spans of a candidate, their outer runs whole, are words and numbers."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.ends = [run.end() for run in _RUN.finditer(text)]
        self.starts = [run.start() for run in _RUN.finditer(text)]
        self.known: dict[Range, bool] = {}

    def explain(self, start: int, end: int, low: int, high: int) -> bool:
        """Of a span within ``low`` to ``high``; each whole stretch is looked at once."""
        first = bisect_left(self.starts, start) - 1  # the run the character before is in
        if first >= 0 and start <= self.ends[first]:
            start = min(max(self.starts[first], low), start)
        last = bisect_right(self.ends, end)  # the run the character behind is in
        if last < len(self.ends) and self.starts[last] <= end:
            end = max(min(self.ends[last], high), end)
        if (start, end) not in self.known:
            self.known[start, end] = _all_words(self.text, start, end)
        return self.known[start, end]


def entropy_spans(candidate: str, known: Sequence[Range] = ()) -> list[Range]:
    """Spans in one candidate string outside of known ones that nothing explains."""
    if _all_words(candidate, 0, len(candidate)):
        return []
    passed = [m.span() for m in [_HOST.match(candidate)] if m]
    if _EXAMPLE.search(candidate):
        passed += [m.span() for m in _PART.finditer(candidate) if _EXAMPLE.search(m.group())]
    found = []
    for low, high in _beside(len(candidate), passed):
        for kind in CLASSES:
            for run in kind.pattern.finditer(candidate, low, high):
                for start, end in high_windows(run.group(), kind.least):
                    found.append((run.start() + start, run.start() + end))
    merged: list[Range] = []
    for start, end in sorted(found):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    if not merged:
        return []
    free = _beside(len(candidate), [*passed, *known])
    runs = _Runs(candidate)
    return [span for span, part in _common(merged, free) if not runs.explain(*span, *part)]


def _candidates(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of the candidate runs, in bytes."""
    held = np.concatenate([[False], _CANDIDATE[texts.data], [False]])
    change = np.flatnonzero(held[1:] != held[:-1])
    # Runs end where a text does.
    edges = texts.offsets[1:-1]
    inside = edges[held[edges] & held[edges + 1]] if len(edges) else edges
    change = np.sort(np.concatenate([change, np.repeat(np.unique(inside), 2)]))
    start, end = change[::2], change[1::2]
    long = end - start >= WINDOW
    start, end = start[long], end[long]
    return start, end, np.searchsorted(texts.offsets, start, side="right") - 1


Span = tuple[int, int, int]  # start, end, index of the kind


def scan_texts(texts: Texts) -> dict[int, list[Span]]:
    """Spans by text, in code points; texts without any are left out."""
    found: dict[int, list[Span]] = {}
    data = texts.data.tobytes()
    lowered = texts.lower().data.tobytes()
    begins = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
    offsets = texts.offsets

    named = np.array([m.start() for m in re.finditer(_KEYWORD, lowered)], dtype=np.int64)
    for i in np.unique(np.searchsorted(offsets, named, side="right") - 1).tolist():
        text = data[offsets[i] : offsets[i + 1]].decode()
        spans = [
            (m.start(), m.end(), 0)
            for m in _ASSIGN.finditer(text)
            if len(m.group(2)) >= MIN_ASSIGNED
        ]
        if spans:
            found[i] = spans

    start, end, text_of = _candidates(texts)
    for a, b, i in zip(start.tolist(), end.tolist(), text_of.tolist()):
        candidate = data[a:b].decode("ascii")
        at = int(begins[a] - begins[offsets[i]])
        spans = [
            (at + m.start(), at + m.end(), kind)
            for kind, pattern, least in ((1, _ACCESS, MIN_ACCESS), (2, _HEX, MIN_HEX))
            for m in pattern.finditer(candidate)
            if m.end() - m.start() >= least
        ]
        known = [
            (max(s - at, 0), min(e - at, b - a))
            for s, e, _ in found.get(i, []) + spans
            if s < at + b - a and at < e
        ]
        spans += [(at + s, at + e, 3) for s, e in entropy_spans(candidate, known)]
        if spans:
            found.setdefault(i, []).extend(spans)
    for spans in found.values():
        spans.sort(key=lambda s: (s[0], s[2], s[1]))
    return found


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in spans)


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, counts, ``base_sha256, spans``.

    ``spans`` lists ``kind:start:end`` in code points, by start and then kind;
    ``base_sha256`` is the digest of that list without kind ``entropy``.  Null
    reads as empty, empty texts have no spans, repeated rows are scanned each,
    other columns are ignored and an empty table gives an empty result.
    """
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
        + [T.StructField(f"n_{k}", T.LongType()) for k in KINDS[:3]]
        + [T.StructField(f, T.StringType()) for f in ("base_sha256", "spans")]
    )

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = scan_texts(texts_of(batch.column("text")))
            rows = [found.get(i, []) for i in range(batch.num_rows)]
            counts = [
                pa.array([sum(s[2] == k for s in spans) for spans in rows], pa.int64())
                for k in range(3)
            ]
            base = [_joined([s for s in spans if s[2] < 3]) for spans in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *counts,
                    pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base]),
                    pa.array([_joined(spans) for spans in rows]),
                ],
                names=schema.names,
            )

    return map_texts(docs.select("doc_id", "text"), report, schema)


def mask(text: str, spans: list[Span]) -> str:
    parts, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``MASK``.

    Overlapping spans are replaced once; texts without spans, null ones too,
    and all other columns are left as they are, but ``n_chars``, where there is
    such a column, follows the changed texts.
    """
    names = docs.columns

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = scan_texts(texts_of(batch.column("text")))
            if not found:
                yield batch
                continue
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            texts = columns["text"].to_pylist()
            for i, spans in found.items():
                texts[i] = mask(texts[i], spans)
            columns["text"] = pa.array(texts, batch.schema.field("text").type)
            if "n_chars" in columns:
                sizes = columns["n_chars"].to_pylist()
                for i in found:
                    sizes[i] = len(texts[i])
                columns["n_chars"] = pa.array(sizes, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], schema=batch.schema)

    return map_texts(docs, masked, docs.schema)
