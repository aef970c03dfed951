"""SimHash fingerprints of word shingles."""

from __future__ import annotations

import re

import numpy as np
import xxhash

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SEED = 42

_CAPITALS = bytes(range(65, 91))
_LOWER = bytes.maketrans(_CAPITALS, _CAPITALS.lower())


def shingles_hashed(text: bytes, size: int) -> np.ndarray:
    """XXH64 of each shingle of a UTF-8 text, A to Z in lower case.

    A shingle is ``size`` words joined by single spaces.  Fewer words make one
    shingle, no words none.
    """
    words = _WORD.findall(text.translate(_LOWER))
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    start = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) + 1 for w in words], out=start[1:])
    begins = start[: max(1, len(words) - size + 1)].tolist()
    ends = (start[min(size, len(words)) :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array(
        [digest(joined[a:b], SEED) for a, b in zip(begins, ends)], dtype=np.uint64
    )


def fingerprints(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One fingerprint per text; those of text ``i`` are ``hashes[first[i]:first[i + 1]]``.

    A bit is 1 if it is set in over half of the hashes; without hashes it is 0.
    """
    counts = np.diff(first)
    held = np.flatnonzero(counts)
    made = np.zeros(len(counts), np.uint64)
    if len(held):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, first[:-1][held], axis=0, dtype=np.int64)
        set_ = 2 * ones > counts[held, None]
        made[held] = np.packbits(set_, axis=1, bitorder="little").view(np.uint64).ravel()
    return made


def fingerprint_texts(texts: list[bytes], size: int) -> np.ndarray:
    hashes = [shingles_hashed(t, size) for t in texts]
    first = np.concatenate([[0], np.cumsum([len(h) for h in hashes], dtype=np.int64)])
    return fingerprints(np.concatenate([np.zeros(0, np.uint64), *hashes]), first.astype(np.int64))
