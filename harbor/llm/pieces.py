"""SentencePiece segmentation: the best, the N best, and back to the text.

The lattice of a text has an arc wherever a piece of the vocabulary fits, and
one for each character that is no piece by itself, written as byte pieces.
Pieces hold spaces only at their beginning, so the lattice falls apart into
chunks, a run of spaces and what follows it, which are segmented alone and,
within a task, once.

Forward Viterbi over all new chunks at a time gives their best segmentations,
and with the scores from behind what the next best one loses.  Only the chunks
of a text that lose least can be segmented otherwise in its N best; theirs are
listed by an A-star search from the end, for which the forward scores are the
exact cost of what remains, and merged best first over the text.

The vocabulary is a model file's; its bytes go along with the tasks.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from harbor.llm.texts import Texts, map_texts, slices, texts_of

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 3

#: Bytes of text segmented together, and most chunks a task remembers.
TOGETHER = 1 << 19
REMEMBERED = 250_000
#: Longer chunks are segmented one by one.
LONGEST = 64

SPACE_MARK = "▁"
_SPACE, _NEWLINE = 0x20, 0x0A
_BYTES = -1  # an arc of byte pieces


@dataclass
class Vocabulary:
    """Pieces as UTF-8 with plain spaces, by id; byte pieces by their byte."""

    pieces: dict[bytes, int]
    scores: np.ndarray
    byte_ids: np.ndarray
    unknown_score: float

    @cached_property
    def spelled(self) -> list[bytes]:
        table = [b""] * len(self.scores)
        for piece, i in self.pieces.items():
            table[i] = piece
        for byte, i in enumerate(self.byte_ids.tolist()):
            table[i] = bytes([byte])
        return table

    @cached_property
    def by_length(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Length, sorted hashes and ids of the pieces, shortest first."""
        lengths: dict[int, list[bytes]] = {}
        for piece in self.pieces:
            if len(piece) <= LONGEST:
                lengths.setdefault(len(piece), []).append(piece)
        found = []
        for length, pieces in sorted(lengths.items()):
            joined = Texts(np.frombuffer(b"".join(pieces), np.uint8), np.zeros(2, np.int64))
            start = np.arange(len(pieces)) * length
            hashes = joined.hashes(start, start + length)
            order = np.argsort(hashes)
            ids = np.array([self.pieces[p] for p in pieces])
            found.append((length, hashes[order], ids[order]))
        return found

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.pieces))

    @cached_property
    def listed_scores(self) -> list[float]:
        return self.scores.tolist()


def read_vocabulary(model: bytes) -> Vocabulary:
    """From the bytes of a model file; unused, control and unknown pieces left out."""
    import sentencepiece

    read = sentencepiece.SentencePieceProcessor(model_proto=model)
    pieces, byte_ids = {}, np.zeros(256, np.int64)
    scores = np.array([read.get_score(i) for i in range(read.get_piece_size())])
    for i in range(len(scores)):
        piece = read.id_to_piece(i)
        if read.is_byte(i):
            byte_ids[int(piece[1:-1], 16)] = i
        elif not (read.is_control(i) or read.is_unknown(i) or read.is_unused(i)):
            spelled = piece.replace(SPACE_MARK, " ")
            if " " in spelled.lstrip(" ") or "\n" in spelled:
                raise ValueError(f"piece {piece!r} does not end at a space")
            pieces[spelled.encode()] = i
    used = scores[list(pieces.values())]
    return Vocabulary(pieces, scores, byte_ids, float(used[used > -1e8].min() - 10))


# One chunk at a time: the lattice as it is written down.


def _width(lead: int) -> int:
    return 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


def arcs_into(chunk: bytes, vocabulary: Vocabulary) -> list[list[tuple[int, int, float]]]:
    """For each end, ``start, id, score`` of the arcs, the longest first."""
    into: list[list[tuple[int, int, float]]] = [[] for _ in range(len(chunk) + 1)]
    start = 0
    while start < len(chunk):
        width = _width(chunk[start])
        for end in range(start + 1, min(len(chunk), start + vocabulary.longest) + 1):
            piece = vocabulary.pieces.get(chunk[start:end])
            if piece is not None:
                into[end].append((start, piece, vocabulary.listed_scores[piece]))
        if chunk[start : start + width] not in vocabulary.pieces:
            into[start + width].append((start, _BYTES, vocabulary.unknown_score))
        start += width
    return into


def forward(into: list[list[tuple[int, int, float]]]) -> list[float]:
    """Best score from the beginning to each place, minus infinity off the lattice."""
    best = [0.0] + [-np.inf] * (len(into) - 1)
    for end in range(1, len(into)):
        best[end] = max((best[s] + score for s, _, score in into[end]), default=-np.inf)
    return best


class _Path:
    """A way from a place to the chunk's end: its first arc and the way after it.

    ``leap`` is a way further on, so that two ways are compared in a number of
    steps that grows with the logarithm of their lengths.
    """

    __slots__ = ("start", "piece", "after", "depth", "leap")

    def __init__(self, start: int, piece: int, after: _Path | None):
        self.start, self.piece, self.after = start, piece, after
        if after is None:
            self.depth, self.leap = 0, self
            return
        self.depth = after.depth + 1
        far = after.leap
        even = after.depth - far.depth == far.depth - far.leap.depth
        self.leap = far.leap if even else after

    def _at_depth(self, depth: int) -> _Path:
        path = self
        while path.depth > depth:
            path = path.leap if path.leap.depth >= depth else path.after
        return path

    def __lt__(self, other: _Path) -> bool:
        """Whether the arcs, the last first, begin earlier where they first differ."""
        depth = min(self.depth, other.depth)
        one, two = self._at_depth(depth), other._at_depth(depth)
        if one is two:
            return self.depth < other.depth
        while one.after is not two.after:
            one, two = (one.leap, two.leap) if one.leap is not two.leap else (one.after, two.after)
        return one.start < two.start


def _spelled(path: _Path, chunk: bytes, vocabulary: Vocabulary) -> list[int]:
    """The ids of a way from the chunk's beginning."""
    ids: list[int] = []
    while path.after is not None:
        if path.piece == _BYTES:
            ids += vocabulary.byte_ids[list(chunk[path.start : path.after.start])].tolist()
        else:
            ids.append(path.piece)
        path = path.after
    return ids


def n_best(chunk: bytes, vocabulary: Vocabulary, n: int) -> list[tuple[float, list[int]]]:
    """The ``n`` best segmentations of a chunk, best first, as score and ids.

    Of equal scores the one whose last pieces are longer comes first.  Ways
    share what follows, and no place is left more than ``n`` times, so time and
    memory grow with the length of the chunk.
    """
    into = arcs_into(chunk, vocabulary)
    best = forward(into)
    queue = [(-best[-1], _Path(len(chunk), _BYTES, None), 0.0)]
    left = [0] * (len(chunk) + 1)
    found = []
    while queue and len(found) < n:
        _, path, behind = heapq.heappop(queue)
        at = path.start
        if at == 0:
            found.append((behind, _spelled(path, chunk, vocabulary)))
            continue
        if left[at] == n:
            continue
        left[at] += 1
        for start, piece, score in into[at]:
            if left[start] < n and best[start] > -np.inf:
                total = behind + score
                heapq.heappush(queue, (-(best[start] + total), _Path(start, piece, path), total))
    return found


# Many chunks at a time.


@dataclass
class Segmented:
    """Chunks by sorted hash: ids in ``pool``, best score, loss of the next best."""

    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    first: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    count: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    score: np.ndarray = field(default_factory=lambda: np.zeros(0))
    loss: np.ndarray = field(default_factory=lambda: np.zeros(0))
    pool: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))

    def joined(self, other: Segmented) -> Segmented:
        hashes = np.concatenate([self.hashes, other.hashes])
        order = np.argsort(hashes, kind="stable")
        return Segmented(
            hashes[order],
            np.concatenate([self.first, other.first + len(self.pool)])[order],
            np.concatenate([self.count, other.count])[order],
            np.concatenate([self.score, other.score])[order],
            np.concatenate([self.loss, other.loss])[order],
            np.concatenate([self.pool, other.pool]),
        )


def _relaxed(
    n: int, columns: int, chunk: np.ndarray, source: np.ndarray, target: np.ndarray,
    score: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Best scores ``n x columns`` by place, and the arc taken into each place."""
    best = np.full((n, columns), -np.inf)
    best[:, 0] = 0
    taken = np.full((n, columns), -1, np.int64)
    # By place, then chunk, then where the arc begins.
    order = np.argsort((target * n + chunk) * columns + source)
    bounds = np.flatnonzero(np.diff(target[order])) + 1
    for some in np.split(order, bounds) if len(order) else []:
        value = best[chunk[some], source[some]] + score[some]
        new = np.concatenate([[True], chunk[some][1:] != chunk[some][:-1]])
        begin = np.flatnonzero(new)
        most = np.maximum.reduceat(value, begin)
        # The first that reaches it is the longest.
        reach = np.flatnonzero(value == np.repeat(most, np.diff(np.append(begin, len(some)))))
        group = np.cumsum(new)[reach] - 1
        lead = reach[np.concatenate([[True], group[1:] != group[:-1]])] if len(reach) else reach
        place = target[some[0]]
        best[chunk[some[begin]], place] = most
        taken[chunk[some[lead]], place] = some[lead]
    return best, taken


def segment(texts: Texts, start: np.ndarray, end: np.ndarray, v: Vocabulary) -> Segmented:
    """Best segmentation of every chunk ``data[start:end]``, none over ``LONGEST`` bytes."""
    n, size = len(start), end - start
    columns = int(size.max(initial=0)) + 1
    chunk = np.repeat(np.arange(n), size)
    place = np.arange(len(chunk)) - np.repeat(np.cumsum(size) - size, size)
    at = start[chunk] + place
    lead = (texts.data[at] & 0xC0) != 0x80
    chunk, place, at = chunk[lead], place[lead], at[lead]
    width = np.select([texts.data[at] < b for b in (0x80, 0xE0, 0xF0)], [1, 2, 3], 4)
    alone = np.zeros(len(at), dtype=bool)
    parts = []
    for length, hashes, ids in v.by_length:
        fits = np.flatnonzero(place + length <= size[chunk])
        if not len(fits):
            continue
        hashed = texts.hashes(at[fits], at[fits] + length)
        found = np.minimum(np.searchsorted(hashes, hashed), len(hashes) - 1)
        hit = hashes[found] == hashed
        fits, found = fits[hit], found[hit]
        alone[fits[width[fits] == length]] = True
        parts.append((fits, np.full(len(fits), length), ids[found]))
    rest = np.flatnonzero(~alone)
    parts.append((rest, width[rest], np.full(len(rest), _BYTES)))
    which, length, ids = (np.concatenate(x) for x in zip(*parts))
    score = np.where(ids == _BYTES, v.unknown_score, v.scores[ids])
    arc_chunk, source = chunk[which], place[which]
    target = source + length
    ahead, taken = _relaxed(n, columns, arc_chunk, source, target, score)

    # From behind, places count down to the chunk's end at 0.
    over = size[arc_chunk]
    behind, _ = _relaxed(n, columns, arc_chunk, over - target, over - source, score)
    through = ahead[arc_chunk, source] + score + behind[arc_chunk, over - target]
    best = ahead[np.arange(n), size]

    on_path = np.zeros(len(which), dtype=bool)
    steps = []
    at_place, open_ = size.copy(), np.flatnonzero(size > 0)
    while len(open_):
        arc = taken[open_, at_place[open_]]
        on_path[arc] = True
        steps.append((open_, arc))
        at_place[open_] = source[arc]
        open_ = open_[at_place[open_] > 0]
    next_best = np.full(n, -np.inf)
    np.maximum.at(next_best, arc_chunk[~on_path], through[~on_path])

    # The path's ids in order of the text, byte arcs as their bytes.
    arcs = np.flatnonzero(on_path)
    arcs = arcs[np.lexsort((source[arcs], arc_chunk[arcs]))]
    spelled = ids[arcs] == _BYTES
    many = np.where(spelled, length[arcs], 1)
    pool = np.repeat(ids[arcs], many)
    step = np.arange(len(pool)) - np.repeat(np.cumsum(many) - many, many)
    written = np.repeat(spelled, many)
    byte_at = (start[arc_chunk[arcs]] + source[arcs]).repeat(many) + step
    pool = np.where(written, v.byte_ids[texts.data[byte_at]], pool).astype(np.int32)
    count = np.bincount(arc_chunk[arcs], many, minlength=n).astype(np.int64)
    hashes = texts.hashes(start, end)
    made = Segmented(hashes, np.cumsum(count) - count, count, best, best - next_best, pool)
    order = np.argsort(hashes)
    for name in ("hashes", "first", "count", "score", "loss"):
        setattr(made, name, getattr(made, name)[order])
    return made


def _with_space(texts: Texts) -> Texts:
    """A space before every text that is not empty, as the vocabulary expects."""
    filled = np.diff(texts.offsets) > 0
    data = np.insert(texts.data, texts.offsets[:-1][filled], np.uint8(_SPACE))
    return Texts(data, texts.offsets + np.concatenate([[0], np.cumsum(filled)]))


def _chunks(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the chunks: at texts, runs of spaces, and around line ends."""
    data = texts.data
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[texts.offsets] = True
    space, line = data == _SPACE, data == _NEWLINE
    begins[1:-1] |= space[1:] & ~space[:-1]
    begins[1:-1] |= line[1:] | line[:-1]
    edges = np.flatnonzero(begins)
    return edges[:-1], edges[1:]


#: Place among the best ids, how many of them go, and what comes instead.
Change = tuple[int, int, list[int]]


def changed_ids(ids: np.ndarray, changes: list[Change]) -> np.ndarray:
    """The ids of a segmentation from the best one's, changes in order of their place."""
    parts, done = [], 0
    for at, n, new in changes:
        parts += [ids[done:at], np.array(new, ids.dtype)]
        done = at + n
    return np.concatenate([*parts, ids[done:]])


class Encoder:
    """Segments texts; remembers chunks from one call to the next."""

    def __init__(self, vocabulary: Vocabulary, n: int = N_BEST):
        self.vocabulary, self.n = vocabulary, n
        self.known = Segmented()
        self.lists: dict[bytes, list[tuple[float, list[int]]]] = {}

    def _n_best(self, chunk: bytes) -> list[tuple[float, list[int]]]:
        if len(self.lists) > REMEMBERED:
            self.lists.clear()
        if chunk not in self.lists:
            self.lists[chunk] = n_best(chunk, self.vocabulary, self.n)
        return self.lists[chunk]

    def _long(self, texts: Texts, start: int, end: int) -> Segmented:
        lists = self._n_best(texts.data[start:end].tobytes())
        (score, ids), loss = lists[0], np.inf
        if len(lists) > 1:
            loss = score - lists[1][0]
        hashed = texts.hashes(np.array([start]), np.array([end]))
        one = np.array([len(ids)])
        return Segmented(
            hashed, np.zeros(1, np.int64), one, np.array([score]), np.array([loss]),
            np.array(ids, np.int32),
        )

    def _learn(self, texts: Texts, start: np.ndarray, end: np.ndarray) -> None:
        """Segment the chunks not yet known."""
        hashes = texts.hashes(start, end)
        hashes, at = np.unique(hashes, return_index=True)
        if len(self.known.hashes) > REMEMBERED:
            self.known = Segmented()
        place = np.searchsorted(self.known.hashes, hashes)
        known = np.zeros(len(hashes), dtype=bool)
        inside = place < len(self.known.hashes)
        known[inside] = self.known.hashes[place[inside]] == hashes[inside]
        start, end = start[at[~known]], end[at[~known]]
        short = end - start <= LONGEST
        if short.any():
            made = segment(texts, start[short], end[short], self.vocabulary)
            self.known = self.known.joined(made)
        for a, b in zip(start[~short].tolist(), end[~short].tolist()):
            self.known = self.known.joined(self._long(texts, a, b))

    def encode(self, texts: Texts) -> list[tuple[np.ndarray, list[float]]]:
        """For each text the ids of its best segmentation and the N best scores."""
        return [(ids, [s for s, _ in best]) for ids, best in self.encode_n_best(texts)]

    def spells_the_same(self, ids: np.ndarray, changes: list[Change]) -> bool:
        """Whether changes leave the text that ``ids`` decode to."""
        spelled = self.vocabulary.spelled
        return all(
            b"".join([spelled[i] for i in ids[at : at + n].tolist()])
            == b"".join([spelled[i] for i in new])
            for at, n, new in changes
        )

    def encode_n_best(
        self, texts: Texts
    ) -> list[tuple[np.ndarray, list[tuple[float, list[Change]]]]]:
        """The best ids, and of each of the N best the score and its changes to them."""
        texts = _with_space(texts)
        start, end = _chunks(texts)
        self._learn(texts, start, end)
        which = np.searchsorted(self.known.hashes, texts.hashes(start, end))
        count, first = self.known.count[which], self.known.first[which]
        edges = np.concatenate([[0], np.cumsum(count)])
        source = np.repeat(first - edges[:-1], count) + np.arange(edges[-1])
        ids = self.known.pool[source]
        score, loss = self.known.score[which], self.known.loss[which]
        bounds = np.searchsorted(start, texts.offsets)
        found = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            whole = float(score[a:b].sum())
            own = loss[a:b]
            few = np.argsort(own, kind="stable")[: self.n - 1] if b > a else []
            few = [int(k) for k in few if own[k] < np.inf]
            lists = {
                k: self._n_best(texts.data[start[a + k] : end[a + k]].tobytes()) for k in few
            }
            ranked = [
                (
                    score,
                    [
                        (int(edges[a + k] - edges[a]), int(count[a + k]), new)
                        for k, new in sorted(changed.items())
                    ],
                )
                for score, changed in _merged(whole, lists, self.n)
            ]
            found.append((ids[edges[a] : edges[b]], ranked))
        return found

    def decode(self, ids: list[int]) -> bytes:
        """The text of some ids."""
        spelled = self.vocabulary.spelled
        return b"".join([spelled[i] for i in ids])[1:]


def _merged(
    whole: float, lists: dict[int, list[tuple[float, list[int]]]], n: int
) -> list[tuple[float, dict[int, list[int]]]]:
    """The N best choices of one segmentation per chunk, from the chunks' lists."""
    keys = list(lists)
    queue = [(0.0, (0,) * len(keys))]
    seen, found = {queue[0][1]}, []
    while queue and len(found) < n:
        lost, ranks = heapq.heappop(queue)
        changed = {k: lists[k][r][1] for k, r in zip(keys, ranks) if r}
        found.append((whole - lost, changed))
        for i, k in enumerate(keys):
            if ranks[i] + 1 < len(lists[k]):
                more = (*ranks[:i], ranks[i] + 1, *ranks[i + 1 :])
                if more not in seen:
                    seen.add(more)
                    step = lists[k][ranks[i]][0] - lists[k][ranks[i] + 1][0]
                    heapq.heappush(queue, (lost + step, more))
    return found


#: A ``Change`` as a column.
CHANGE = T.StructType(
    [
        T.StructField("at", T.IntegerType()),
        T.StructField("n_gone", T.IntegerType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ]
)


def _digest(ids: np.ndarray) -> str:
    return hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest()


def _model_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(
    docs: DataFrame, model_file: str = MODEL_FILE, n: int = N_BEST, keep_ids: bool = True
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, ids, n_pieces, ids_sha256, scores, decoded``
    and ``others, n_best_sha256``.

    ``ids`` is the best segmentation of the whole text, ``others`` the rest of
    the ``n`` best, each as the runs ``at, n_gone, ids`` in which it differs
    from ``ids`` (``decode`` puts them in); both are left out with
    ``keep_ids=False``.  ``ids_sha256`` is the digest of the best as 32-bit
    numbers, low byte first, ``n_best_sha256`` that of each of the ``n`` best
    and ``scores`` their scores, best first, and ``decoded`` tells whether all
    of them decode to the text.  Null and empty texts have no pieces and the
    one score 0.  Repeated rows are encoded each, other columns are ignored,
    and an empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_model_bytes(model_file))
    fields = [
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_pieces", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("scores", T.ArrayType(T.DoubleType())),
        T.StructField("decoded", T.BooleanType()),
        T.StructField("others", T.ArrayType(T.ArrayType(CHANGE))),
        T.StructField("n_best_sha256", T.ArrayType(T.StringType())),
    ]
    schema = T.StructType([f for f in fields if keep_ids or f.name not in ("ids", "others")])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(read_vocabulary(sent.value), n)
        for batch in slices(batches, limit=TOGETHER):
            texts = texts_of(batch.column("text"))
            rows = encoder.encode_n_best(texts)
            whole = texts.data.tobytes()
            digests, same = [], []
            for (ids, ranked), a, b in zip(rows, texts.offsets[:-1], texts.offsets[1:]):
                digests.append([_digest(changed_ids(ids, changes)) for _, changes in ranked])
                same.append(
                    encoder.decode(ids.tolist()) == whole[a:b]
                    and all(encoder.spells_the_same(ids, changes) for _, changes in ranked)
                )
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_pieces": pa.array([len(ids) for ids, _ in rows], pa.int64()),
                "ids_sha256": pa.array([d[0] for d in digests], pa.string()),
                "scores": pa.array([[s for s, _ in best] for _, best in rows], pa.list_(pa.float64())),
                "decoded": pa.array(same, pa.bool_()),
                "n_best_sha256": pa.array(digests, pa.list_(pa.string())),
            }
            if keep_ids:
                edges = np.cumsum([0, *(len(ids) for ids, _ in rows)])
                columns["ids"] = pa.ListArray.from_arrays(
                    pa.array(edges, pa.int32()),
                    pa.array(np.concatenate([np.zeros(0, np.int32), *(ids for ids, _ in rows)])),
                )
                columns["others"] = pa.array(
                    [
                        [[dict(zip(CHANGE.names, c)) for c in changes] for _, changes in best[1:]]
                        for _, best in rows
                    ],
                    to_arrow_type(fields[-2].dataType),
                )
            yield pa.RecordBatch.from_arrays(
                [columns[name] for name in schema.names], names=schema.names
            )

    return map_texts(docs.select("doc_id", "text"), encoded, schema)


def decode(encoded: DataFrame, model_file: str = MODEL_FILE, rank: int = 0) -> DataFrame:
    """``text`` from ``ids`` in place of that column; null and no ids give an empty text.

    ``rank`` chooses among the N best: from 1 on, the ids are first changed as
    ``others`` says, and rows with fewer segmentations have a null text.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(_model_bytes(model_file))

    @F.pandas_udf(T.StringType())
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(read_vocabulary(sent.value))
        for ids in batches:
            yield ids.map(lambda i: "" if i is None else encoder.decode(i).decode())

    chosen = F.col("ids")
    if rank:
        start = F.struct(F.array().cast("array<int>").alias("ids"), F.lit(0).alias("done"))
        other = F.get(F.col("others"), rank - 1)
        chosen = F.aggregate(
            other,
            start,
            lambda made, c: F.struct(
                F.concat(
                    made["ids"], F.slice("ids", made["done"] + 1, c["at"] - made["done"]), c["ids"]
                ).alias("ids"),
                (c["at"] + c["n_gone"]).alias("done"),
            ),
            lambda made: F.concat(
                made["ids"], F.slice("ids", made["done"] + 1, F.size("ids") - made["done"])
            ),
        )
        return encoded.withColumn("text", F.when(other.isNotNull(), text_of(chosen))).drop("ids")
    return encoded.withColumn("text", text_of(chosen)).drop("ids")
