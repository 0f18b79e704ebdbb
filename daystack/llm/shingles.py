"""Sets of word shingles as 64-bit hashes.

Words are runs of anything but ASCII white space, with A-Z in lower case.  A text of fewer words than
a shingle has is one shingle of all its words.  Two shingles count as equal when their hashes are.
"""

from __future__ import annotations

import numpy as np
from xxhash import xxh3_64_intdigest, xxh3_128_digest

WORDS = 5
#: Bytes of a set's signature: of 10^10 sets, two share one with odds of 1 to 25,000.
SIGNATURE = 10

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2, _HALF = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(33)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which each bit depends on all."""
    x = (x ^ (x >> _HALF)) * _MIX1
    x = (x ^ (x >> _HALF)) * _MIX2
    return x ^ (x >> _HALF)


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The text's distinct shingles, ascending."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(h))
    s = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        s = s * _ODD + h[k : len(h) - width + 1 + k]
    return np.unique(mixed(s))


def signature(shingles: np.ndarray) -> bytes:
    return xxh3_128_digest(shingles.tobytes())[:SIGNATURE]
