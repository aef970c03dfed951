"""Whole texts as arrays: words, lines and hashes of a batch of rows at once.

A word is a run of characters outside ``\\x20 \\x09-\\x0D``.  All of these are
ASCII, so words are found on the UTF-8 bytes, many rows in one numpy pass, and
no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# Bytes of text looked at together.  It bounds the arrays, not the rows: a
# longer text is a slice by itself.
SLICE_BYTES = 1 << 18

#: Bytes of rows sent to a task's Python at a time.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers.get("up", ())) < size:
        length = max(size, 2 * SLICE_BYTES)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(length, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that all bits depend on all bits."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


@dataclass
class Texts:
    """The UTF-8 bytes of several texts, text ``i`` at ``offsets[i:i + 2]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def take(self, rows: np.ndarray) -> Texts:
        sizes = self.offsets[rows + 1] - self.offsets[rows]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        source = np.repeat(self.offsets[rows] - offsets[:-1], sizes) + np.arange(offsets[-1])
        return Texts(self.data[source], offsets)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def count(self, characters: bytes) -> np.ndarray:
        """Occurrences of any of some ASCII characters in each text."""
        table = np.zeros(256, dtype=bool)
        table[list(characters)] = True
        return self.per_text(table[self.data])

    def lower(self) -> Texts:
        """With A to Z in lower case."""
        capital = (self.data >= 65) & (self.data <= 90)
        return Texts(self.data + (capital * np.uint8(32)), self.offsets)

    @cached_property
    def _prefix(self) -> np.ndarray:
        up, _ = _tables(len(self.data) + 1)
        terms = (self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)]
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each byte string ``data[start:end]``."""
        _, down = _tables(len(self.data) + 1)
        return mix((self._prefix[end] - self._prefix[start]) * down[start])

    @cached_property
    def words(self) -> Words:
        solid = ~SPACE[self.data]
        first = np.zeros(len(self.data) + 1, dtype=bool)
        first[self.offsets] = True
        before = np.concatenate([[False], solid[:-1]]) & ~first[:-1]
        after = np.concatenate([solid[1:], [False]]) & ~first[1:]
        start = np.flatnonzero(solid & ~before)
        end = np.flatnonzero(solid & ~after) + 1
        # The words keep a twin: a cycle would stay in memory until a collection.
        twin = Texts(self.data, self.offsets)
        twin._prefix = self._prefix
        return Words(twin, start, end, np.searchsorted(start, self.offsets))

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text number of the lines that hold a word."""
        cuts = np.flatnonzero(self.data == 10)
        start = np.union1d(cuts + 1, self.offsets[:-1])
        start = start[start < len(self.data)]
        text_of = np.searchsorted(self.offsets, start, side="right") - 1
        cut = np.append(cuts, len(self.data))[np.searchsorted(cuts, start)]
        end = np.minimum(cut, self.offsets[text_of + 1])
        solid = np.concatenate([[0], np.cumsum(~SPACE[self.data])])
        held = solid[end] > solid[start]
        return start[held], end[held], text_of[held]


@dataclass
class Words:
    """The words of several texts, those of text ``i`` at ``first[i:i + 2]``."""

    texts: Texts
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def text_of(self) -> np.ndarray:
        """Which text each word belongs to."""
        return np.repeat(np.arange(len(self.texts)), self.counts)

    @cached_property
    def hash(self) -> np.ndarray:
        return self.texts.hashes(self.start, self.end)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every window of ``size`` words in one text."""
        if len(self) < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        last = len(self) - size + 1
        at = np.flatnonzero(self.text_of[:last] == self.text_of[size - 1 :])
        value = np.zeros(last, np.uint64)
        for shift in range(size):
            value = value * np.uint64(_BASE) + self.hash[shift : shift + last]
        return at, mix(value[at])


def texts_of(column: pa.Array) -> Texts:
    """The texts of an Arrow column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, places, data = column.buffers()
    size = len(column)
    if not size:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + size + 1]
    if data is None or offsets[-1] == offsets[0]:
        return Texts(np.zeros(0, np.uint8), np.zeros(size + 1, np.int64))
    held = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return Texts(held, offsets - offsets[0])


def map_texts(frame: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``frame.mapInArrow``, a few megabytes of rows at a time.

    Batches are cut by rows otherwise, and with long texts hold tens of
    megabytes, several times over.  A session that allows batches larger than
    ``BATCH_BYTES`` is set to that; it changes no result.
    """
    conf = frame.sparkSession.conf
    allowed = conf.get(_BATCH_SETTING).rstrip("b")
    if allowed.lstrip("-").isdigit() and not 0 < int(allowed) <= BATCH_BYTES:
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return frame.mapInArrow(function, schema)


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of about ``limit`` bytes of text."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        total = np.concatenate([[0], np.cumsum(size.to_numpy(zero_copy_only=False))])
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(total, total[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to
