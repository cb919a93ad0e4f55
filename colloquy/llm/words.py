"""Words of whole texts as 64-bit hashes, a batch at a time in numpy.

A word is a run of bytes 0-9, a-z and 0x80 and above after A-Z are lowered,
that is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text. Hashes
are the same in every process. Two different words share a hash with a chance
of about 2**-64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_LOWER = np.zeros(256, np.uint8)
for _b in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _LOWER[_b] = _b
for _b in range(0x41, 0x5B):
    _LOWER[_b] = _b + 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_LETTER = mix(np.arange(256, dtype=U64) * U64(_BASE) + U64(1))
_P, _P_INV = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("p", ())) < n:
        size = max(1 << 20, 1 << (n - 1).bit_length())
        for key, base in (("p", _P), ("q", _P_INV)):
            a = np.full(size, base, U64)
            a[0] = 1
            _POWERS[key] = np.multiply.accumulate(a)
    return _POWERS["p"][:n], _POWERS["q"]


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Order-dependent 64-bit hash of ``values[start:end]`` for every span (empty span: hash of length 0)."""
    p, q = _powers(max(len(values), 1))
    h = np.zeros(len(values) + 1, U64)
    np.cumsum(values * p[:len(values)], out=h[1:])
    at = np.minimum(starts, max(len(values) - 1, 0))
    return mix((h[ends] - h[starts]) * q[at] + (ends - starts).astype(U64) * U64(_BASE))


@dataclass
class Words:
    """Words of some texts in order; ``first[i]:first[i + 1]`` are the words of text i."""
    hashes: np.ndarray
    row: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    n = len(offsets) - 1
    if not len(data):
        z = np.zeros(0, np.int64)
        return Words(np.zeros(0, U64), z, np.zeros(n + 1, np.int64), z, z)
    low = _LOWER[data]
    inside = low != 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    stop[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    hashes = span_hash(_LETTER[low], start, end)
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(hashes, row, np.searchsorted(row, np.arange(n + 1)), start, end)


def ngrams(w: Words, offsets: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of the words at i + each offset, for every i where all lie in one text.

    ``(0, 1)`` are bigrams, ``(0, 2)`` skip-grams with one word left out.
    """
    reach = offsets[-1]
    m = len(w.hashes) - reach
    if m <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    acc = np.zeros(m, U64)
    for o in offsets:
        acc = (acc + w.hashes[o:o + m]) * U64(_P) + U64(o + 1)
    keep = w.row[:m] == w.row[reach:reach + m]
    return mix(acc[keep]), w.row[:m][keep]
