"""A keyed pseudorandom permutation of 0 .. n - 1."""

from __future__ import annotations

import numpy as np

from lodeworks.llm.byte_words import mixed

ROUNDS = 4


def feistel(places: np.ndarray, n: int, key: int) -> np.ndarray:
    """Where each of `places` < n goes: a Feistel network over the next even number of bits.

    A place that lands at n or beyond walks on along its cycle until it is back below n.
    """
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    shift, mask = np.uint64(half), np.uint64((1 << half) - 1)
    keys = mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))
    out = np.asarray(places).astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        left, right = out[walking] >> shift, out[walking] & mask
        for k in keys:
            left, right = right, left ^ (mixed(right + k) & mask)
        out[walking] = (left << shift) | right
        walking = walking[out[walking] >= n]
    return out.astype(np.int64)
