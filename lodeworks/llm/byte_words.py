"""Words of many texts at once, as NumPy arrays over their UTF-8 bytes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Lower case for A-Z, and which bytes belong to words: [^\x00-\x2F\x3A-\x60\x7B-\x7F]
# in lower case is 0-9, a-z and whatever is not ASCII.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[ord("0") : ord("9") + 1] = IN_WORD[ord("a") : ord("z") + 1] = IN_WORD[128:] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD1B54A32D192ED03)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and the n + 1 places where texts start; NULL is empty."""
    wide = column.cast(pa.large_binary()).fill_null(b"")
    wide = pa.concat_arrays([wide]) if wide.offset else wide
    offsets = np.frombuffer(wide.buffers()[1], np.int64, len(wide) + 1, wide.offset * 8)
    data = wide.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass(frozen=True)
class Words:
    """`hashes`: 64 bits for each word; `first`: text t has the words first[t] to first[t + 1]."""

    hashes: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    heads: np.ndarray | None = None


def words_of(column: pa.Array, head: int = 0) -> Words:
    """The words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of each text, A-Z in lower case.

    With `head`, also a hash of each word's first bytes.
    """
    raw, offsets = texts_of(column)
    raw = LOWER[raw]
    inside = IN_WORD[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True  # a word ends with its text
    left = np.zeros(len(raw) + 1, bool)
    left[1:] = inside
    starts = np.flatnonzero(inside & (~left[:-1] | edge[:-1]))
    right = np.zeros(len(raw) + 1, bool)
    right[: len(raw)] = inside
    ends = np.flatnonzero(inside & (~right[1:] | edge[1:])) + 1
    # A polynomial over the bytes, from prefix sums, shifted to the word's start.
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(raw)), out=sums[1:])
    back = powers(_INVERSE, len(raw) + 1)[starts]
    hashes = mixed((sums[ends] - sums[starts]) * back)
    heads = mixed((sums[np.minimum(starts + head, ends)] - sums[starts]) * back) if head else None
    return Words(hashes, np.searchsorted(starts, offsets), starts, ends, heads)


def runs(hashes: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """A hash for each run of `length` neighbours; the last length - 1 places have none."""
    n = max(0, len(hashes) - length + 1)
    out = np.full(n, np.uint64(length))
    for k in range(length):
        out = (out ^ np.uint64(salt)) * _STEP + hashes[k : k + n]
    return mixed(out)


def runs_at(hashes: np.ndarray, starts: np.ndarray, length: int, salt: int = 0) -> np.ndarray:
    """The same for the runs at `starts` alone."""
    out = np.full(len(starts), np.uint64(length))
    for k in range(length):
        out = (out ^ np.uint64(salt)) * _STEP + hashes[starts + k]
    return mixed(out)


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n places lie in one of the runs of `length` that begin at `starts`."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + length, n), -1)
    return np.cumsum(change[:n]) > 0
