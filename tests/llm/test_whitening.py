"""Embedding whitening against a full eigendecomposition."""

from __future__ import annotations

import numpy as np
import pytest

from harbor.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, component string, n string, whitened string"


def frame(spark, rows):
    filled = [(i, None if v is None else [*v], "clash", "clash", "clash") for i, v in rows]
    return spark.createDataFrame(filled, SCHEMA)


def whole_numbers(vectors):
    return [[int(np.floor(64 * np.float64(e))) + 1_000_000 for e in v] for v in vectors]


def check(spark, rows, vectors):
    """The result for ``rows`` against all of ``vectors``, the usable ones in order."""
    got = whitening.whiten(frame(spark, rows)).toPandas()
    x = whole_numbers(vectors)
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array(x, float) - np.array(sums) / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1], components[:, ::-1]
    k = min(32, int((values > 1e-20 * values[0]).sum()))
    white = centred @ components[:, :k] / np.sqrt(values[:k])
    assert len(got) == n * k and set(got.component) == set(range(1, k + 1))
    assert (got.n == n).all() and got.identity_error.max() < 1e-9
    got = got.sort_values("vec_id", kind="stable")  # a row's components stay together
    found = got.whitened.to_numpy().reshape(n, k)
    sign = np.sign((found * white).sum(axis=0))
    assert np.abs(found - white * sign).max() < 1e-8
    assert np.allclose(got.explained.to_numpy()[:k], values[:k] / values.sum(), rtol=1e-9)
    exact = [sum((n * e - s) ** 2 for e, s in zip(v, sums)) for v in x]
    assert got.deviation.tolist()[::k] == exact


@pytest.mark.parametrize("size", [1, 5, 40])
def test_against_a_full_decomposition(spark, size):
    random = np.random.default_rng(size)
    vectors = (random.standard_normal((200, size)) * np.linspace(3, 1, size)).tolist()
    bad = [
        None, [], [None] * size, [float("nan")] * size, [1.0] * (size - 1) + [float("inf")],
        [-float("inf")] + [0.0] * (size - 1), [0.5] * (size + 1),
    ]
    rows = [*enumerate(vectors), *((1000 + i, v) for i, v in enumerate(bad))]
    check(spark, rows, vectors)


def test_repeated_rows_count_each(spark):
    random = np.random.default_rng(7)
    vectors = random.standard_normal((30, 6)).tolist()
    vectors = [v for v in vectors for _ in range(3)]
    check(spark, [(i // 3, v) for i, v in enumerate(vectors)], vectors)


def test_missing_keys_stay(spark):
    rows = [(None, [1.0, 2.0]), (None, [2.0, 1.0]), (3, [0.0, 0.0])]
    got = whitening.whiten(frame(spark, rows)).toPandas()
    assert got.vec_id.isna().sum() == 4 and len(got) == 6


def test_large_entries_are_exact(spark):
    """Beyond 32 bits, and deviations beyond a long."""
    rows = [(i, [1e10 + i, float(i * i)]) for i in range(5)]
    table, size, width = whitening.whole_vectors(frame(spark, rows), "embedding", "vec_id")
    n, sums = whitening.exact_sums(table, size, width)
    x = [[e - 1_000_000 for e in v] for v in whole_numbers([v for _, v in rows])]
    assert (n, width, sums) == (5, 8, [sum(c) for c in zip(*x)])
    far = [(0, [0.0, 0.0]), (1, [1e9, 1.0])]
    got = whitening.whiten(frame(spark, far)).toPandas()
    assert got.deviation.isna().all() and np.allclose(got.whitened.abs(), 1)


@pytest.mark.parametrize("rows", [
    [], [(1, [1.0, 2.0])], [(1, None), (2, [])], [(i, [1.0, 2.0]) for i in range(4)],
])
def test_no_spread_gives_no_rows(spark, rows):
    got = whitening.whiten(frame(spark, rows))
    assert got.count() == 0 and got.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
    ]


def bidiagonalised(x, wanted):
    """What ``fit`` does, over a local matrix."""
    random = np.random.default_rng(0)
    made = whitening.Bidiagonal(x.shape[1])
    while made.steps < x.shape[1]:
        if made.next is None:
            turn = x @ random.standard_normal(x.shape[1])
            if not made.begin(x.T @ (np.sin(turn) + np.cos(turn))):
                break
        p = x @ made.direction
        made.take(x.T @ p, p @ p)
        if made.settled(wanted):
            if made.block and made.news_below(wanted):
                break
            made.end_block()
    return made


def local(name):
    random = np.random.default_rng(3)
    if name == "quick decay":
        return random.standard_normal((900, 200)) * np.exp(-np.arange(200) / 15)
    if name == "equal deviations":
        x = np.zeros((600, 150))
        for i in range(40):
            x[2 * i, i], x[2 * i + 1, i] = 9, -9
        x[80:, 40:] = 0.01 * random.standard_normal((520, 110))
        return x
    if name == "few vectors":
        return random.standard_normal((12, 100))
    return random.standard_normal((900, 200))


@pytest.mark.parametrize("name", ["quick decay", "equal deviations", "few vectors", "no decay"])
def test_bidiagonalisation(name):
    x = local(name)
    x = x - x.mean(axis=0)
    made = bidiagonalised(x, 32)
    values, vectors = made.decomposed()
    k = min(32, len(values))
    want = np.linalg.svd(x, compute_uv=False)
    assert np.allclose(values[:k], want[:k], rtol=0, atol=1e-12 * want[0])
    for value, vector in zip(values[:k], vectors[:k]):
        assert np.linalg.norm(x.T @ (x @ vector) - value**2 * vector) < 1e-12 * want[0] ** 2
    if name == "quick decay":
        assert made.steps < 100  # it need not go through all 200
    assert np.allclose(made.v.T @ made.v, np.eye(made.steps), atol=1e-12)
