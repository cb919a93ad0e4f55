"""Seeded random numbers that depend on a text alone, wherever and beside whatever it is read."""

from __future__ import annotations

import hashlib

import numpy as np


def text_key(text, seed: int) -> int:
    """64 bits of a text (null: empty) and a seed."""
    return int.from_bytes(hashlib.blake2b(f"{seed}|{text or ''}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def uniform(keys: np.ndarray, draw: int) -> np.ndarray:
    """Numbers in [0, 1) of the keys (unsigned 64 bits) and the number of the draw (splitmix64's finalizer)."""
    z = keys + np.uint64((draw + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0 ** -53
