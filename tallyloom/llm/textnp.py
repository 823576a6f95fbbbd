"""Words, hashes and shingle sets of one text as numpy arrays; runs inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_PLACES = np.random.default_rng(20240608).integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty."""
    return [b"" if x is None else x for x in batch.column(column).cast(pa.large_binary()).to_pylist()]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit moves every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of bytes other than ASCII white space."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, from one prefix sum over the text."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per word of the lower-cased (A-Z only) text."""
    data = np.frombuffer(text.lower(), np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    starts, ends = word_bounds(data)
    return range_hashes(data, starts, ends)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; a shorter text is one shingle, an empty one none."""
    w = word_hashes(text)
    if not len(w):
        return w
    size = min(words, len(w))
    n = len(w) - size + 1
    h = np.full(n, np.uint64(size))
    for k in range(size):
        h = h + w[k:k + n] * _PLACES[k]
    h = np.sort(mix(h))
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)
