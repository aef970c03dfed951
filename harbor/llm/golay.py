"""Fuzzy hashing with the binary Golay code.

The code is perfect: each of the 2**23 words lies within three bits of exactly
one of its 4096 codewords.  A word's keys are the indices of the codewords that
the word and its neighbours at one bit decode to, six or one of them.  Two
words at most two bits apart have a neighbour in common, and so share a key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH, CHECKS = 23, 11
_GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= _GENERATOR << (bit - CHECKS)
    return word


# The remainder of a word is that of its upper bits plus its lower bits.
_UPPER = np.array([_remainder(high << CHECKS) for high in range(1 << 12)], dtype=np.uint32)
# Each remainder belongs to one error of at most three bits.
_ERROR = np.zeros(1 << CHECKS, dtype=np.uint32)
for _weight in (1, 2, 3):
    for _bits in combinations(range(LENGTH), _weight):
        _error = sum(1 << b for b in _bits)
        _ERROR[_remainder(_error)] = _error


def decode(words: np.ndarray) -> np.ndarray:
    """Index, below 4096, of the codeword nearest to each 23-bit word."""
    words = words.astype(np.uint32)
    check = _UPPER[words >> CHECKS] ^ (words & np.uint32((1 << CHECKS) - 1))
    return (words ^ _ERROR[check]) >> CHECKS


def keys(words: np.ndarray, bits: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Row and key of every key of each word, of which ``bits`` bits may differ."""
    flips = np.array([0, *(1 << b for b in range(bits))], dtype=np.uint32)
    found = np.sort(decode(words.astype(np.uint32)[:, None] ^ flips), axis=1)
    new = np.ones(found.shape, dtype=bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    row, column = np.nonzero(new)
    return row, found[row, column]
