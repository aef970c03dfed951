"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred vectors, one a row, are a matrix X that no machine holds.  Starting
from a direction v, products Xv and X'u alternate and build orthonormal u and v
with ``X V = U B``, B bidiagonal.  From its singular values and vectors come the
components ``V Q`` and their deviations.

The long vectors u are never kept.  Each is X times a short vector w, known
from the recurrence, so ``u'p`` is ``w'X'p`` for any p.  A step is one job: tasks
multiply their rows by a direction, and by the product in turn, and what comes
back is ``X'p`` and ``p'p``, a sum over all rows.  That frees the new u from every
earlier one; the v, short ones, are orthogonalised twice against all others.
Where nothing is left to go on with, or the leading values are settled, a block
of B ends and the next begins with a fresh direction, which finds what the first
could not (equal deviations).  Its products with earlier u are kept in B, a
column of more than two entries.  Directions begin as X'u of a u drawn anew for
every row, and so have no part along which the vectors do not spread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbor.llm.storage import stored
from harbor.llm.texts import map_texts

#: Entries are counted in units of 1/64.  The contract counts them from -1,000,000,
#: which every use of them takes off again.
UNITS = 64
COMPONENTS = 32

# An entry up to this size, times 64, is a whole number that a double holds.
_LARGEST = float(1 << 46)
# A rest is nothing, and a component settled, at this part of the largest deviation.
_NOTHING, _SETTLED = 1e-13, 1e-15
# Deviations below this part of the largest cannot be told from none.
_RANK = 1e-11
_HALF = 26  # bits of the lower part of an exact sum


def _finite(vector: str) -> Column:
    bad = F.exists(
        vector,
        lambda e: e.isNull() | F.isnan(e) | (F.abs(e.cast("double")) > _LARGEST),
    )
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad


@dataclass(frozen=True)
class Fit:
    """Counts and sums of the vectors, and their components, one a row."""

    n: int
    sums: tuple[int, ...]
    width: int
    components: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray

    @property
    def centre(self) -> np.ndarray:
        return np.array([s / max(self.n, 1) for s in self.sums])

    def whitening(self) -> np.ndarray:
        """Times a centred vector: its whitened coordinates."""
        return self.components / self.deviations[:, None]


def _matrix(column: pa.Array, size: int, width: int) -> np.ndarray:
    """The vectors of a binary column; rows all hold ``size`` numbers."""
    column = column.cast(pa.large_binary())
    _, places, data = column.buffers()
    if not len(column):
        return np.zeros((0, size), np.int64)
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    held = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return held.view(np.int32 if width == 4 else np.int64).reshape(-1, size)


def whole_vectors(frame: DataFrame, vector: str, key: str) -> tuple[DataFrame, int, int]:
    """``key, x``: the usable vectors in units, stored; their size and bytes a number.

    Left out are vectors that are null, empty, hold a null, a NaN or an
    infinity (an entry beyond 2**46 counts as one), or are not of the commonest
    length (of equally common ones the longest).
    """
    rows = frame.select(F.col(key).alias("key"), F.col(vector).alias("v")).where(_finite("v"))
    top = F.max(F.array_max(F.transform("v", lambda e: F.abs(e.cast("double")))))
    sizes = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"), top.alias("top"))
    common = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    size = common["size"] if common else 1
    width = 4 if not common or common["top"] * UNITS < 2**31 - 1 else 8
    kind = np.int32 if width == 4 else np.int64

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            x = np.floor(flat * UNITS).astype(kind)
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * (size * width)
            column = pa.Array.from_buffers(
                pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(x)]
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=["key", "x"])

    schema = T.StructType(
        [T.StructField("key", frame.schema[key].dataType), T.StructField("x", T.BinaryType())]
    )
    made = map_texts(rows.where(F.size("v") == size), packed, schema)
    return stored(made, "vectors"), size, width


def _summed(table: DataFrame, of_batch, size: int, width: int, places: int) -> np.ndarray:
    """The sum over all rows of what ``of_batch`` makes of some rows, an array of that size.

    A task sends one number for each place of the sum; Spark adds them up.
    """

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(places)
        for batch in batches:
            total += of_batch(_matrix(batch.column(0), size, width))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(places, dtype=np.int32)), pa.array(total)],
            names=["place", "value"],
        )

    sums = map_texts(table.select("x"), of_task, "place int, value double")
    rows = sums.groupBy("place").agg(F.sum("value").alias("value")).collect()
    result = np.zeros(places)
    for row in rows:
        result[row["place"]] = row["value"]
    return result


def exact_sums(table: DataFrame, size: int, width: int) -> tuple[int, list[int]]:
    """How many vectors, and the exact sum of every dimension."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals = 0, [0] * size
        for batch in batches:
            x = _matrix(batch.column(0), size, width).astype(np.int64)
            high = (x >> _HALF).sum(axis=0).tolist()
            low = (x & ((1 << _HALF) - 1)).sum(axis=0).tolist()
            totals = [t + (h << _HALF) + l for t, h, l in zip(totals, high, low)]
            n += len(x)
        if n:
            values = pa.array([Decimal(n), *map(Decimal, totals)], pa.decimal128(38, 0))
            places = pa.array(range(-1, size), pa.int32())
            yield pa.RecordBatch.from_arrays([places, values], names=["place", "value"])

    sums = map_texts(table.select("x"), of_task, "place int, value decimal(38, 0)")
    rows = sums.groupBy("place").agg(F.sum("value").alias("value")).collect()
    found = {r["place"]: int(r["value"]) for r in rows}
    return found.get(-1, 0), [found.get(i, 0) for i in range(size)]


class Bidiagonal:
    """The state of a bidiagonalisation: V, W with ``U = X W``, ``X'U``, and B."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.v = np.zeros((size, 0))
        self.w = np.zeros((size, 0))
        self.z = np.zeros((size, 0))
        self.b = np.zeros((0, 0))
        self.block = 0  # first step of the present block
        self.rests: dict[int, float] = {}  # by last step of a block, what it did not follow
        self.next: np.ndarray | None = None  # where the next step goes
        self.beta = 0.0  # entry of B between the last step and the next

    @property
    def steps(self) -> int:
        return len(self.b)

    def _free(self, vector: np.ndarray) -> np.ndarray:
        for _ in range(2):
            vector = vector - self.v @ (self.v.T @ vector)
        return vector

    def begin(self, drawn: np.ndarray) -> bool:
        """A block from a direction; false if that holds nothing new."""
        length = np.linalg.norm(drawn)
        fresh = self._free(drawn / length) if length else drawn
        if not length or np.linalg.norm(fresh) <= _NOTHING:
            return False
        fresh = self._free(fresh / np.linalg.norm(fresh))
        self.next = fresh / np.linalg.norm(fresh)
        return True

    @property
    def direction(self) -> np.ndarray:
        """What X is next multiplied by: v less the last u's share."""
        return self.next - self.beta * self.w[:, -1] if self.beta else self.next

    def take(self, y: np.ndarray, square: float) -> None:
        """One step, from ``y = X'p`` and ``p'p`` of the product ``p``."""
        v, direction = self.next, self.direction
        shared = self.w.T @ y  # with each u so far
        alpha = float(np.sqrt(max(square - shared @ shared, 0.0)))
        largest = max(alpha, float(np.abs(self.b).max(initial=0.0)))
        if alpha > _NOTHING * largest:
            w = (direction - self.w @ shared) / alpha
            z = (y - self.z @ shared) / alpha
        else:
            alpha, w, z = 0.0, np.zeros(self.size), np.zeros(self.size)
        k = self.steps
        grown = np.zeros((k + 1, k + 1))
        grown[:k, :k] = self.b
        grown[:k, k] = shared
        grown[k, k] = alpha
        if k:
            grown[k - 1, k] += self.beta
        self.b = grown
        self.v = np.column_stack([self.v, v])
        self.w, self.z = np.column_stack([self.w, w]), np.column_stack([self.z, z])
        self.beta = 0.0
        rest = self._free(z - alpha * v)
        self.beta = float(np.linalg.norm(rest))
        if self.beta > _NOTHING * largest:
            self.next = self._free(rest / self.beta)
            self.next /= np.linalg.norm(self.next)
        else:
            self.end_block()

    def end_block(self) -> None:
        self.rests[self.steps - 1] = self.beta
        self.beta = 0.0
        self.block = self.steps
        self.next = None

    def decomposed(self) -> tuple[np.ndarray, np.ndarray]:
        """Singular values of X from the largest, and its right vectors as rows."""
        _, values, right = np.linalg.svd(self.b)
        return values, (self.v @ right.T).T

    def settled(self, wanted: int) -> bool:
        """Whether the leading values no longer change, nor those of the present block."""
        if self.next is None or self.steps in (self.block, self.size) or self.steps < wanted:
            return False
        left, values, _ = np.linalg.svd(self.b)
        rests = np.zeros(self.steps)
        rests[list(self.rests)] = list(self.rests.values())
        rests[-1] = self.beta
        open_by = np.sqrt(((rests[:, None] * left[:, :wanted]) ** 2).sum(axis=0))
        known = self._leading()
        return bool(
            open_by.max() <= _SETTLED * values[0]
            and (known[1] <= _SETTLED * values[0] or sum(known) < values[wanted - 1])
        )

    def _leading(self) -> tuple[float, float]:
        """The largest value of the present block alone, and how far it is from settled."""
        left, values, _ = np.linalg.svd(self.b[self.block :, self.block :])
        return float(values[0]), float(self.beta * abs(left[-1, 0]))

    def news_below(self, wanted: int) -> bool:
        """Whether the present block holds nothing as large as the leading values."""
        return sum(self._leading()) < np.linalg.svd(self.b, compute_uv=False)[wanted - 1]


def fit(table: DataFrame, size: int, width: int, components: int = COMPONENTS) -> Fit:
    """Components of the stored vectors, at most ``components`` and no more than their rank.

    Steps go on until the leading components are settled to double precision
    and a block begun anew holds nothing as large, at most ``size`` in all;
    each is one job over the table.
    """
    n, sums = exact_sums(table, size, width)
    none = np.zeros((0, size))
    if n < 2:
        return Fit(n, tuple(sums), width, none, np.zeros(0), np.zeros(0))
    centre = np.array([s / n for s in sums])
    (trace,) = _summed(table, lambda x: ((x - centre) ** 2).sum(), size, width, 1)
    random = np.random.default_rng(0)
    made = Bidiagonal(size)
    wanted = min(components, size)
    while trace and made.steps < size:
        if made.next is None:
            slope = random.standard_normal(size)

            def drawn(x: np.ndarray) -> np.ndarray:
                turn = (x - centre) @ slope
                return (x - centre).T @ (np.sin(turn) + np.cos(turn))

            if not made.begin(_summed(table, drawn, size, width, size)):
                break
        direction = made.direction

        def products(x: np.ndarray) -> np.ndarray:
            centred = x - centre
            p = centred @ direction
            return np.append(centred.T @ p, p @ p)

        *y, square = _summed(table, products, size, width, size + 1)
        made.take(np.array(y), square)
        if made.settled(wanted):
            if made.block and made.news_below(wanted):
                break
            made.end_block()
    if not made.steps:
        return Fit(n, tuple(sums), width, none, np.zeros(0), np.zeros(0))
    values, vectors = made.decomposed()
    keep = np.flatnonzero(values[:wanted] > _RANK * values[0])
    vectors = vectors[keep]
    # Either sign would do; the largest entry of each is made positive.
    largest = np.abs(vectors).argmax(axis=1)
    vectors = vectors * np.sign(vectors[np.arange(len(keep)), largest])[:, None]
    return Fit(
        n, tuple(sums), width, vectors, values[keep] / np.sqrt(n), values[keep] ** 2 / trace
    )


def identity_error(table: DataFrame, made: Fit) -> float:
    """Largest entry of the whitened vectors' covariance less the identity, measured."""
    centre, whitening = made.centre, made.whitening()
    k = len(whitening)
    if not k:
        return 0.0

    def gram(x: np.ndarray) -> np.ndarray:
        white = (x - centre) @ whitening.T
        return np.concatenate([(white.T @ white).ravel(), white.sum(axis=0)])

    found = _summed(table, gram, len(made.sums), made.width, k * k + k)
    mean = found[k * k :] / made.n
    covariance = found[: k * k].reshape(k, k) / made.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


def _deviations(x: np.ndarray, made: Fit) -> pa.Array:
    """``sum((n*x - S)**2)`` of each row, exactly; null where no long holds it."""
    sums = np.array(made.sums, dtype=object)
    reach = made.n * max(int(np.abs(x).max(initial=0)), 1) + int(np.abs(sums).max())
    if reach**2 * len(sums) < 1 << 63:
        apart = made.n * x.astype(np.int64) - sums.astype(np.int64)
        return pa.array((apart**2).sum(axis=1), pa.int64())
    rows = ((made.n * x.astype(object) - sums) ** 2).sum(axis=1)
    return pa.array([int(r) if r < 1 << 63 else None for r in rows], pa.int64())


def whiten(frame: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Whitened coordinates of every usable vector: one row per vector and component.

    ``key, component, n, deviation, whitened, explained, identity_error``, as the
    contract of the query states them; ``component`` counts from 1 and none is
    given that the vectors have no spread in, so fewer than two different
    vectors, or an empty table, give no rows.  A ``deviation`` that no long
    holds is null.  Repeated rows and repeated or missing keys are vectors of
    their own; which vectors are left out is told at ``whole_vectors``; other
    columns are ignored.
    """
    table, size, width = whole_vectors(frame, vector, key)
    made = fit(table, size, width)
    error = identity_error(table, made)
    k = len(made.components)
    schema = T.StructType(
        [
            T.StructField(key, frame.schema[key].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            *[
                T.StructField(name, T.DoubleType())
                for name in ("whitened", "explained", "identity_error")
            ],
        ]
    )

    def coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, whitening = made.centre, made.whitening()
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            x = _matrix(batch.column(1), size, width)
            row = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(row), made.n, np.int64)),
                    _deviations(x, made).take(pa.array(row)),
                    pa.array(((x - centre) @ whitening.T).ravel()),
                    pa.array(np.tile(made.explained, len(x))),
                    pa.array(np.full(len(row), error)),
                ],
                names=schema.names,
            )

    return map_texts(table, coordinates, schema)
