"""A minimal perfect hash of 64-bit keys: levels of bit vectors, numbered by the bits set before."""

from __future__ import annotations

import numpy as np

from tallyloom.llm.textnp import mix

ROOM = 2  # bits per remaining key on a level
_STEP = 0x9E3779B97F4A7C15


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + np.uint64(_STEP * (level + 1) % 2**64)) % np.uint64(size)).astype(np.int64)


class MinimalHash:
    """Maps each key it was built from to a number of its own in [0, number of keys); other keys map anywhere or to -1."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes = sizes
        self.bits = bits
        self.before = np.concatenate(([0], np.cumsum(bits)))  # set bits before each place

    @classmethod
    def of(cls, keys: np.ndarray) -> MinimalHash:
        """Built from distinct unsigned 64-bit keys."""
        sizes, levels = [], []
        while len(keys):
            size = ROOM * len(keys)
            at = _places(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = start + _places(keys[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.before[at[hit]]
            left, start = left[~hit], start + size
            if not len(left):
                break
        return out

    def packed(self) -> bytes:
        return np.array([len(self.sizes), *self.sizes], np.int64).tobytes() + np.packbits(self.bits).tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> MinimalHash:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, n, offset=8).tolist()
        bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=8 * (n + 1)), count=sum(sizes))
        return cls(sizes, bits.astype(bool))
