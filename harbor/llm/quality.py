"""Quality rules as a short-circuit cascade.

A text is measured once for the base rule.  What passes it meets further rules,
each of which scans text again; a rule sees only the texts that the rules
before it left.  Their order is planned on a sample: first the rule that
rejects most for its cost.  The order changes how much is scanned and never the
verdict, which is that all rules pass.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbor.llm.texts import SPACE, Texts, map_texts, slices, texts_of

# Base rule: at least so many words; at most so many hundredths of them in
# windows of so many words that the text holds twice.
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30

#: Rows of the sample that the order of the rules is planned on, about.
SAMPLE_ROWS = 2000

SYMBOLS = b"#*$%&|<>"


@dataclass
class Measures:
    """What the base rule needs to know of each text."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray

    @property
    def base_failed(self) -> np.ndarray:
        repeats = 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words
        return (self.n_words < MIN_WORDS) | repeats


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _groups(text_of: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by text and value, and where in that order a new value begins."""
    order = np.lexsort((value, text_of))
    text_of, value = text_of[order], value[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (text_of[1:] != text_of[:-1])
    return order, new


def _duplicate_lines(texts: Texts) -> np.ndarray:
    start, end, text_of = texts.lines()
    order, new = _groups(text_of, texts.hashes(start, end))
    return np.bincount(text_of[order][~new], minlength=len(texts))


def _repeated_words(texts: Texts) -> np.ndarray:
    words = texts.words
    at, value = words.windows(REPEAT_WINDOW)
    order, new = _groups(words.text_of[at], value)
    # A window is repeated if it has an equal neighbour in the order.
    repeated = ~new
    repeated[:-1] |= ~new[1:]
    edge = np.zeros(len(words) + 1, np.int64)
    first = at[order][repeated]
    np.add.at(edge, first, 1)
    np.add.at(edge, first + REPEAT_WINDOW, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(words.text_of[covered], minlength=len(texts))


def measure(texts: Texts) -> Measures:
    # A continuation byte does not begin a code point.
    begins = (texts.data & 0xC0) != 0x80
    return Measures(
        n_words=texts.words.counts,
        word_chars=texts.per_text(begins & ~SPACE[texts.data]),
        n_symbols=texts.count(SYMBOLS),
        n_dup_lines=_duplicate_lines(texts),
        n_repeat_words=_repeated_words(texts),
    )


@dataclass(frozen=True)
class Rule:
    """``rejects`` flags texts; it gets their bytes and their number of words."""

    name: str
    rejects: Callable[[Texts, np.ndarray], np.ndarray]


def _symbols(texts: Texts, n_words: np.ndarray) -> np.ndarray:
    return 10 * texts.count(SYMBOLS) > n_words


def _exclaims(texts: Texts, n_words: np.ndarray) -> np.ndarray:
    return 4 * texts.count(b"!") > n_words


def _shouts(texts: Texts, n_words: np.ndarray) -> np.ndarray:
    capital = texts.per_text((texts.data >= 65) & (texts.data <= 90))
    small = texts.per_text((texts.data >= 97) & (texts.data <= 122))
    return capital > small


def _stutters(texts: Texts, n_words: np.ndarray) -> np.ndarray:
    words = texts.words
    same = words.hash[1:] == words.hash[:-1]
    same &= words.text_of[1:] == words.text_of[:-1]
    return 5 * np.bincount(words.text_of[1:][same], minlength=len(texts)) > n_words


def _odd_words(texts: Texts, n_words: np.ndarray) -> np.ndarray:
    size = texts.per_text(((texts.data & 0xC0) != 0x80) & ~SPACE[texts.data])
    return (size < 2 * n_words) | (size > 14 * n_words)


def _repeats_lines(texts: Texts, n_words: np.ndarray) -> np.ndarray:
    _, _, text_of = texts.lines()
    n_lines = np.bincount(text_of, minlength=len(texts))
    return 3 * _duplicate_lines(texts) > n_lines


RULES = (
    Rule("symbols", _symbols),
    Rule("exclaims", _exclaims),
    Rule("shouts", _shouts),
    Rule("stutters", _stutters),
    Rule("odd_words", _odd_words),
    Rule("repeats_lines", _repeats_lines),
)


def passes(texts: Texts, n_words: np.ndarray, rules: Sequence[Rule]) -> np.ndarray:
    """Whether each text passes all rules; a rule sees what those before it left."""
    left = np.arange(len(texts))
    for rule in rules:
        if not len(left):
            break
        some = texts if len(left) == len(texts) else texts.take(left)
        left = left[~rule.rejects(some, n_words[left])]
    passed = np.zeros(len(texts), dtype=bool)
    passed[left] = True
    return passed


def judge(texts: Texts, rules: Sequence[Rule]) -> tuple[Measures, np.ndarray]:
    """The measures of each text and whether it is kept."""
    measures = measure(texts)
    kept = np.zeros(len(texts), dtype=bool)
    open_ = np.flatnonzero(~measures.base_failed)
    kept[open_] = passes(texts.take(open_), measures.n_words[open_], rules)
    return measures, kept


def plan(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules in the order of rejections per second, measured on a sample.

    Every rule is timed on the whole sample that passes the base rule, in the
    tasks; one row per rule comes back.
    """

    def trial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rejected, spent = np.zeros(len(rules)), np.zeros(len(rules))
        for batch in slices(batches):
            texts = texts_of(batch.column("text"))
            measures = measure(texts)
            rest = np.flatnonzero(~measures.base_failed)
            for i, rule in enumerate(rules):
                some = texts.take(rest)
                begun = time.process_time()
                rejected[i] += rule.rejects(some, measures.n_words[rest]).sum()
                spent[i] += time.process_time() - begun
        yield pa.RecordBatch.from_pydict(
            {"rule": [r.name for r in rules], "rejected": rejected, "spent": spent}
        )

    total = docs.count()
    sample = docs.select("text").sample(min(1.0, rows / max(total, 1)), seed=3)
    found = (
        map_texts(sample, trial, "rule string, rejected double, spent double")
        .groupBy("rule")
        .agg(F.sum("rejected").alias("rejected"), F.sum("spent").alias("spent"))
        .collect()
    )
    gain = {r["rule"]: r["rejected"] / (r["spent"] + 1e-6) for r in found}
    return sorted(rules, key=lambda r: (-gain.get(r.name, 0.0), r.name))


def quality_report(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the measures, ``base_failed, kept``.

    Null and empty texts have no words and fail the base rule.  Repeated rows
    are judged each; other columns are ignored; an empty table gives an empty
    result.  ``rules`` in the order to run, planned on the table by default.
    """
    rules = plan(docs) if rules is None else list(rules)
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType(
        [T.StructField("doc_id", id_type)]
        + [T.StructField(m, T.LongType()) for m in MEASURES]
        + [T.StructField(f, T.BooleanType()) for f in ("base_failed", "kept")]
    )

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            measures, kept = judge(texts_of(batch.column("text")), rules)
            columns = [pa.array(getattr(measures, m), pa.int64()) for m in MEASURES]
            flags = [pa.array(measures.base_failed), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, *flags], names=schema.names
            )

    return map_texts(docs.select("doc_id", "text"), report, schema)


def keep_good(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` whose ``text`` is kept, with all their columns."""
    rules = plan(docs) if rules is None else list(rules)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            _, kept = judge(texts_of(batch.column("text")), rules)
            yield batch.filter(pa.array(kept))

    return map_texts(docs, keep, docs.schema)
