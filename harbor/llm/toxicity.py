"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as the sum of embeddings: of the word and of the characters at
its beginning and end, each looked up by hash.  The network reads windows of
words, each overlapping the next by half, forwards and backwards; attention
pools the states of a window into one vector, and that gives the window's
logit.  A text is scored from all its windows: their highest logits, their mean
and their number go through a logistic regression.

Everything is trained here, in numpy, on a bounded sample of labelled rows, and
has a fixed size, so it is sent along with the tasks that score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harbor.llm.texts import SLICE_BYTES, Texts, Words, map_texts, slices, texts_of

WINDOW, STRIDE = 32, 16
ROWS, WIDTH, HIDDEN, ATTENTION = 1 << 15, 16, 8, 8

#: Most labelled rows of each class to train on.
SAMPLE_PER_CLASS = 1000
#: Most windows of a text that one pass of the training looks at.
WINDOWS_PER_TEXT = 12
#: After so many passes, only the most toxic windows of a toxic text count as such.
EVEN_PASSES, TOP_WINDOWS = 2, 2
PASSES, BATCH, RATE = 6, 256, 4e-3
#: Share of a word's embeddings left out at random while training.
DROPPED = 0.25
#: Windows scored together.
TOGETHER = 1024
THRESHOLD = 0.3

#: Rows whose ``crc32(doc_id) mod 4`` is this are never trained on.
HELD_OUT = 2

#: Bytes at the beginning (positive) and end (negative) of a word that are inputs.
_ENDS = (3, 6, 8, -4)

_WORDLIKE = np.zeros(256, dtype=bool)
_WORDLIKE[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123))] = True
_WORDLIKE[128:] = True

Params = dict[str, np.ndarray]


def _words(texts: Texts) -> Words:
    """Runs of letters and digits, A to Z in lower case."""
    texts = texts.lower()
    blanked = Texts(np.where(_WORDLIKE[texts.data], texts.data, np.uint8(32)), texts.offsets)
    return blanked.words


def _inputs(words: Words) -> np.ndarray:
    start, end, texts = words.start, words.end, words.texts
    hashes = [words.hash]
    for size in _ENDS:
        a = start if size > 0 else np.maximum(start, end + size)
        b = np.minimum(end, start + size) if size > 0 else end
        hashes.append(texts.hashes(a, b) + np.uint64(1_000_003 * (size + 64)))
    return (np.stack(hashes, axis=1) % np.uint64(ROWS - 1)).astype(np.int32) + 1


def inputs(texts: Texts, together: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and each word's rows of the embedding table.

    Row 0 of the table is no word, as is the last of the rows returned.
    """
    counts, rows = [np.zeros(0, np.int64)], []
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(texts.offsets, texts.offsets[at] + together, side="right")) - 1
        to = max(to, at + 1)
        words = _words(texts.take(np.arange(at, to)))
        counts.append(words.counts)
        rows.append(_inputs(words))
        at = to
    rows.append(np.zeros((1, 1 + len(_ENDS)), np.int32))
    return np.concatenate(counts), np.concatenate(rows)


def window_starts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and first word, within its text, of all windows."""
    n = np.maximum(1, -(-(counts - WINDOW) // STRIDE) + 1)
    n = np.where(counts > 0, n, 0)
    text_of = np.repeat(np.arange(len(counts)), n)
    first = np.concatenate([[0], np.cumsum(n)])
    return text_of, (np.arange(len(text_of)) - first[text_of]) * STRIDE


def places(counts: np.ndarray, text_of: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Word numbers of windows, ``WINDOW x windows``; past a text, the number of words."""
    first = np.cumsum(counts) - counts
    place = at + np.arange(WINDOW)[:, None]
    return np.where(place < counts[text_of], place + first[text_of], counts.sum())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    y = np.tanh(0.5 * x)
    y *= 0.5
    y += 0.5
    return y


def new_params(seed: int = 5) -> Params:
    rng = np.random.default_rng(seed)

    def drawn(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    params = {"embed": (rng.standard_normal((ROWS, WIDTH)) * 0.05).astype(np.float32)}
    params["embed"][0] = 0
    for way in "fb":
        params[f"{way}_in"] = drawn(WIDTH, 3 * HIDDEN).T.copy()
        params[f"{way}_gates"] = drawn(HIDDEN, 2 * HIDDEN).T.copy()
        params[f"{way}_new"] = drawn(HIDDEN, HIDDEN).T.copy()
        params[f"{way}_bias"] = np.zeros((3 * HIDDEN, 1), np.float32)
    params["look"] = drawn(2 * HIDDEN, ATTENTION).T.copy()
    params["focus"] = drawn(ATTENTION, 1)[:, 0]
    params["out"] = drawn(2 * HIDDEN, 1)[:, 0]
    params["out_bias"] = np.zeros(1, np.float32)
    return params


def embedded(p: Params, rows: np.ndarray) -> np.ndarray:
    """``words x WIDTH``: each word's sum of embeddings."""
    x = p["embed"][rows[:, 0]]
    for k in range(1, rows.shape[1]):
        x += p["embed"][rows[:, k]]
    return x


def _read(
    p: Params, way: str, x: np.ndarray, source: np.ndarray, held: np.ndarray, tape: list | None
) -> np.ndarray:
    """States of one direction, ``steps x HIDDEN x windows``, in order of the words."""
    steps = range(WINDOW) if way == "f" else range(WINDOW - 1, -1, -1)
    # Each word is fed once, however many windows it is in.
    fed = np.take(p[f"{way}_in"] @ x.T + p[f"{way}_bias"], source, axis=1)
    gates_, new = p[f"{way}_gates"], p[f"{way}_new"]
    h = np.zeros((HIDDEN, source.shape[1]), np.float32)
    states = np.empty((WINDOW, *h.shape), np.float32)
    for t in steps:
        gates = _sigmoid(fed[: 2 * HIDDEN, t] + gates_ @ h)
        z, r = gates[:HIDDEN], gates[HIDDEN:]
        c = np.tanh(fed[2 * HIDDEN :, t] + new @ (r * h))
        if tape is not None:
            tape.append((t, h, z, r, c))
        h = h + z * held[t] * (c - h)
        states[t] = h
    return states


def logits(p: Params, x: np.ndarray, source: np.ndarray, tape: dict | None = None) -> np.ndarray:
    """One logit per window of embedded words; the last row of ``x`` stands for none."""
    held = (source < len(x) - 1).astype(np.float32)
    tapes = {way: [] for way in "fb"} if tape is not None else {}
    states = np.concatenate(
        [_read(p, way, x, source, held, tapes.get(way)) for way in "fb"], axis=1
    )
    looked = np.tanh(p["look"] @ states)
    score = np.where(held > 0, p["focus"] @ looked, np.float32(-1e9))
    weight = np.exp(score - score.max(axis=0))
    weight /= weight.sum(axis=0)
    pooled = np.einsum("tn,thn->hn", weight, states)
    if tape is not None:
        tape |= {"x": x, "source": source, "held": held, "states": states, "looked": looked}
        tape |= {"weight": weight, "pooled": pooled, **tapes}
    return p["out"] @ pooled + p["out_bias"][0]


def gradients(p: Params, tape: dict, slope: np.ndarray) -> Params:
    """Of the sum of losses, whose derivative by each logit is ``slope``.

    ``embed`` is that of the rows of ``x``, yet to be added up by table row.
    """
    g: Params = {"out": tape["pooled"] @ slope, "out_bias": np.array([slope.sum()])}
    pooled = p["out"][:, None] * slope
    states, weight, looked = tape["states"], tape["weight"], tape["looked"]
    by_weight = (states * pooled).sum(axis=1)
    by_score = weight * (by_weight - (weight * by_weight).sum(axis=0))
    g["focus"] = np.einsum("tn,tan->a", by_score, looked)
    inner = by_score[:, None] * p["focus"][:, None] * (1 - looked**2)
    g["look"] = np.einsum("tan,thn->ah", inner, states)
    by_state = weight[:, None] * pooled + p["look"].T @ inner
    x, source = tape["x"], tape["source"]
    by_x = np.zeros((source.size, WIDTH), np.float32)
    for way, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
        gates, new = p[f"{way}_gates"], p[f"{way}_new"]
        by_fed = np.zeros((3 * HIDDEN, *source.shape), np.float32)
        g_gates, g_new = np.zeros_like(gates), np.zeros_like(new)
        by_h = np.zeros((HIDDEN, source.shape[1]), np.float32)
        for t, h, z, r, c in reversed(tape[way]):
            by_h = by_h + by_state[t, part]
            held = tape["held"][t]
            by_c = by_h * z * held * (1 - c**2)
            by_rh = new.T @ by_c
            by_z = by_h * (c - h) * held * z * (1 - z)
            by_r = by_rh * h * r * (1 - r)
            by_gates = np.concatenate([by_z, by_r])
            by_fed[:, t] = np.concatenate([by_gates, by_c])
            g_gates += by_gates @ h.T
            g_new += by_c @ (r * h).T
            by_h = by_h * (1 - z * held) + by_rh * r + gates.T @ by_gates
        flat = by_fed.reshape(3 * HIDDEN, -1)
        g[f"{way}_in"] = flat @ x[source.ravel()]
        g[f"{way}_bias"] = flat.sum(axis=1, keepdims=True)
        g[f"{way}_gates"], g[f"{way}_new"] = g_gates, g_new
        by_x += flat.T @ p[f"{way}_in"]
    g["embed"] = np.zeros_like(x)
    np.add.at(g["embed"], source.ravel(), by_x)
    return g


def _learn(
    p: Params,
    rows: np.ndarray,
    source: np.ndarray,
    label: np.ndarray,
    rng: np.random.Generator | None = None,
) -> Params:
    """Gradients of the mean loss of a batch of windows."""
    used, source = np.unique(np.append(source, len(rows) - 1), return_inverse=True)
    source = source[:-1].reshape(WINDOW, -1)
    rows = rows[used]
    if rng is not None:
        rows = rows * (rng.random(rows.shape, np.float32) >= DROPPED)
    tape: dict = {}
    logit = logits(p, embedded(p, rows), source, tape)
    slope = (_sigmoid(logit) - label) / len(label)
    g = gradients(p, tape, slope.astype(np.float32))
    by_word, g["embed"] = g["embed"], np.zeros_like(p["embed"])
    for k in range(rows.shape[1]):
        np.add.at(g["embed"], rows[:, k], by_word)
    g["embed"][0] = 0
    return g


def window_logits(
    p: Params, counts: np.ndarray, rows: np.ndarray, text_of: np.ndarray, at: np.ndarray
) -> np.ndarray:
    parts = [np.zeros(0, np.float32)]
    for i in range(0, len(text_of), TOGETHER):
        source = places(counts, text_of[i : i + TOGETHER], at[i : i + TOGETHER])
        held = source < len(rows) - 1
        low, high = source[0].min(), source[held].max() + 1
        x = embedded(p, np.concatenate([rows[low:high], rows[-1:]]))
        parts.append(logits(p, x, np.where(held, source - low, high - low)))
    return np.concatenate(parts)


def _adam(p: Params, g: Params, memory: dict, rate: float) -> None:
    memory["n"] = n = memory.get("n", 0) + 1
    for name, grad in g.items():
        m, v = memory.setdefault(name, (np.zeros_like(p[name]), np.zeros_like(p[name])))
        m *= 0.9
        m += 0.1 * grad
        v *= 0.99
        v += 0.01 * grad**2
        scale = rate * np.sqrt(1 - 0.99**n) / (1 - 0.9**n)
        p[name] -= (scale * m / (np.sqrt(v) + 1e-7)).astype(np.float32)


def _rank(logit: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """Place of each window among those of its text, the highest logit first."""
    order = np.lexsort((-logit, text_of))
    n = np.bincount(text_of, minlength=1)
    first = np.cumsum(n) - n
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order)) - first[text_of[order]]
    return rank


def features(logit: np.ndarray, text_of: np.ndarray, n_texts: int) -> np.ndarray:
    """Of each text: its three highest window logits, mean, and log of their number."""
    order = np.lexsort((-logit, text_of))
    logit, text_of = logit[order], text_of[order]
    n = np.bincount(text_of, minlength=n_texts)
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    found = np.zeros((n_texts, 5))
    held = n > 0
    for k in range(3):
        # A text with fewer windows repeats its last.
        place = np.minimum(first + k, first + np.maximum(n, 1) - 1)[held]
        found[held, k] = logit[place]
    found[:, 3] = np.bincount(text_of, logit, minlength=n_texts) / np.maximum(n, 1)
    found[:, 4] = np.log1p(n)
    return found


@dataclass
class Model:
    params: Params
    weights: np.ndarray  # of the features and a constant
    centre: np.ndarray
    spread: np.ndarray
    rate: float  # of label 1, for texts without words

    def scores(self, texts: Texts) -> np.ndarray:
        """One score per text, from all its windows."""
        counts, rows = inputs(texts)
        text_of, at = window_starts(counts)
        logit = window_logits(self.params, counts, rows, text_of, at)
        return self._of(features(logit, text_of, len(texts)), counts > 0)

    def _of(self, found: np.ndarray, worded: np.ndarray) -> np.ndarray:
        z = (found - self.centre) / self.spread @ self.weights[:-1] + self.weights[-1]
        return np.where(worded, _sigmoid(z), min(self.rate, THRESHOLD / 2))


def _regression(found: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method, slightly ridged."""
    x = np.hstack([found, np.ones((len(found), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1e-2 * max(weight.sum(), 1) / 100)
    ridge[-1] = 1e-6
    for _ in range(30):
        q = _sigmoid(x @ w)
        slope = x.T @ (weight * (q - label)) + ridge * w
        curve = (x.T * (weight * np.maximum(q * (1 - q), 1e-6))) @ x + np.diag(ridge)
        w = w - np.clip(np.linalg.solve(curve, slope), -2, 2)
    return w


def train(texts: Texts, label: np.ndarray, rate: float, seed: int = 11) -> Model:
    """A model of labelled texts; ``rate`` is that of label 1 among all of them."""
    rng = np.random.default_rng(seed)
    p = new_params()
    counts, rows = inputs(texts)
    text_of, at = window_starts(counts)
    n_texts = len(texts)
    if n_texts and len(text_of) and 0 < label.sum() < n_texts:
        memory: dict = {}
        share = np.bincount(text_of, minlength=n_texts)
        for number in range(PASSES):
            # All windows of short texts, as many of the longer ones.
            chance = np.minimum(1, WINDOWS_PER_TEXT / np.maximum(share, 1))[text_of]
            used = rng.random(len(text_of)) < chance
            if number >= EVEN_PASSES:
                logit = window_logits(p, counts, rows, text_of, at)
                toxic = label[text_of] == 1
                used = np.where(toxic, _rank(logit, text_of) < TOP_WINDOWS, used)
            picked = rng.permutation(np.flatnonzero(used))
            for i in range(0, len(picked), BATCH):
                some = picked[i : i + BATCH]
                source = places(counts, text_of[some], at[some])
                g = _learn(p, rows, source, label[text_of[some]], rng)
                _adam(p, g, memory, RATE * (1 - number / PASSES))
    model = Model(p, np.zeros(6), np.zeros(5), np.ones(5), rate)
    if n_texts == 0 or not 0 < label.sum() < n_texts:
        model.weights[-1] = -4.0
        return model
    logit = window_logits(p, counts, rows, text_of, at)
    found = features(logit, text_of, n_texts)
    model.centre, model.spread = found.mean(axis=0), found.std(axis=0) + 1e-6
    # Each class counts as much as it does among all labelled rows.
    weight = np.where(label == 1, rate / label.mean(), (1 - rate) / (1 - label.mean()))
    model.weights = _regression((found - model.centre) / model.spread, label, weight)
    return model


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 4 == HELD_OUT


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Train on at most ``per_class`` labelled rows of each class, never held-out ones.

    The rows are those whose id has the smallest hash.  Labels other than 0 and
    1, repeated or without a document do not count.
    """
    usable = (
        labels.where(F.col("toxic").isin(0, 1) & ~is_held_out())
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("label"), F.max("toxic").alias("__most"))
        .where(F.col("label") == F.col("__most"))
        .select("doc_id", "label")
    )
    counts = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    chosen = [
        usable.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        for k in (0, 1)
    ]
    # Twice per_class ids at most.
    sample = F.broadcast(chosen[0].union(chosen[1]))
    found = docs.select("doc_id", "text").join(sample, "doc_id").groupBy("doc_id", "label")
    frame = found.agg(F.min("text").alias("text")).orderBy("doc_id").toArrow()
    rate = counts.get(1, 0) / max(sum(counts.values()), 1)
    return train(texts_of(frame.column("text")), frame.column("label").to_numpy(), rate)


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Null and empty texts, and texts without letters or digits, get a score
    below the threshold.  ``held_out`` of a null id is null.  Repeated rows are
    scored each, other columns are ignored, and an empty table gives an empty
    result.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            score = sent.value.scores(texts_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score, pa.float64())], names=schema.names
            )

    done = map_texts(docs.select("doc_id", "text"), scored, schema)
    return done.select(
        "doc_id",
        is_held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
