"""Texts as numbers: code points, word hashes and word shingles, all by whole-array arithmetic.

Hashes are 64-bit.  A segment's hash comes from prefix sums of a polynomial in
an odd base modulo 2**64, so any segment costs the same, whatever its length.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Code points handled at once; longer texts go in pieces that end between words.
BLOCK = 1 << 19
SHINGLE = 5


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        have = np.ones(size, U64)
        have[1:] = U64(base)
        _POWERS[base] = have = np.cumprod(have, dtype=U64)
    return have[:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(mix(values.astype(U64) + U64(1)) * powers(BASE, len(values)), out=sums[1:])
    return sums


def segment_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal segments have equal hashes, wherever they stand."""
    lengths = (ends - starts).astype(U64)
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts] + lengths)


@lru_cache(1)
def letters_and_digits() -> np.ndarray:
    """Of every code point, whether it is a letter or a digit."""
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    return edge[0::2], edge[1::2]


def blocks(cp: np.ndarray, inside: np.ndarray):
    """(start, end) of pieces of about BLOCK code points that don't cut a word."""
    at, n = 0, len(cp)
    while at < n:
        end = min(at + BLOCK, n)
        while end < n and inside[end - 1] and inside[end]:
            ahead = np.flatnonzero(~inside[end : end + BLOCK])
            end = end + int(ahead[0]) if len(ahead) else min(end + BLOCK, n)
        yield at, end
        at = end


def hashed_runs(cp: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every run of True."""
    found = []
    for a, b in blocks(cp, inside):
        starts, ends = runs(inside[a:b])
        if len(starts):
            found.append((segment_hashes(prefix_sums(cp[a:b]), starts, ends), starts + a, ends + a))
    if not found:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return found[0] if len(found) == 1 else tuple(np.concatenate(x) for x in zip(*found, strict=True))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words (runs of letters and digits) of the lower-cased text, in order."""
    cp = codepoints(text.lower())
    return hashed_runs(cp, letters_and_digits()[cp])[0]


def shingle_hashes(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Hashes of the runs of n words; fewer than n words make one shingle, no word none."""
    if len(words) == 0:
        return words
    n = min(n, len(words))
    last = len(words) - n + 1
    out = words[:last].copy()
    for k in range(1, n):
        out = out * U64(BASE) + words[k : k + last]
    return mix(out)


def text_shingles(text: str, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and how often each stands in the text."""
    return np.unique(shingle_hashes(word_hashes(text), n), return_counts=True)
