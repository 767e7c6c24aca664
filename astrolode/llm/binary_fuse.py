"""Static 3-wise binary-fuse filters with 8-bit fingerprints, about 9 bits a key.

Every key has three slots in neighbouring segments; the XOR of the three equals the key's
fingerprint. Built once over a fixed set of keys: keys in the set always pass, others with a
probability of 1/256. Keys are 64-bit digests; a seed is changed until building succeeds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

_U = np.uint64
SEEDS = 100


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A seeded 64-bit finaliser (xor, shift, multiply)."""
    h = keys + _U(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def _shape(count: int) -> tuple[int, int]:
    """Segment length (a power of two) and number of segments for so many keys."""
    if count < 2:
        return 4, 3
    length = min(1 << 18, 1 << int(math.log(count) / math.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(count))
    return length, max(3, math.ceil(count * factor / length) + 2)


def _slots(h: np.ndarray, length: int, segments: int) -> tuple[np.ndarray, ...]:
    # The upper 32 bits choose the first slot; bits of their own move the others within the next
    # segments. Bits shared by two of them tie slots together, and large sets no longer peel.
    first = (h >> _U(32)) * _U((segments - 2) * length) >> _U(32)
    mask = _U(length - 1)
    return (
        first.astype(np.int64),
        (first + _U(length) ^ h >> _U(18) & mask).astype(np.int64),
        (first + _U(2 * length) ^ h & mask).astype(np.int64),
    )


def _mark(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> _U(32)) ^ (h >> _U(47))).astype(np.uint8)


@dataclass(frozen=True)
class BinaryFuse:
    seed: int
    length: int
    segments: int
    cells: bytes

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        keys = np.unique(keys.astype(_U))
        length, segments = _shape(len(keys))
        for seed in range(SEEDS):
            cells = _peel(_mix(keys, seed), length, segments)
            if cells is not None:
                return cls(seed, length, segments, cells.tobytes())
        raise RuntimeError("no seed gave a filter")

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """Which keys may be in the set."""
        h = _mix(keys.astype(_U), self.seed)
        cells = np.frombuffer(self.cells, np.uint8)
        a, b, c = _slots(h, self.length, self.segments)
        return (cells[a] ^ cells[b] ^ cells[c]) == _mark(h)


def _peel(h: np.ndarray, length: int, segments: int) -> np.ndarray | None:
    """Cells such that each key's slots give its mark, or None if these hashes cannot be peeled.

    Whole layers are peeled at once: every slot that holds one key frees that key.
    """
    size, count = length * segments, len(h)
    slots = np.stack(_slots(h, length, segments))
    degree = np.bincount(slots.ravel(), minlength=size)
    names = np.zeros(size, np.int64)  # XOR of the keys in a slot; the key itself if it is one
    for row in slots:
        np.bitwise_xor.at(names, row, np.arange(count))
    layers: list[tuple[np.ndarray, np.ndarray]] = []
    freed = 0
    while freed < count:
        single = np.flatnonzero(degree == 1)
        if not len(single):
            return None
        keys, at = np.unique(names[single], return_index=True)
        layers.append((keys, single[at]))
        freed += len(keys)
        for row in slots[:, keys]:
            np.subtract.at(degree, row, 1)
            np.bitwise_xor.at(names, row, keys)
    cells = np.zeros(size, np.uint8)
    marks = _mark(h)
    # Backwards: a key's own slot is free until then, and no two of a layer share theirs.
    for keys, own in reversed(layers):
        a, b, c = slots[:, keys]
        others = cells[a] ^ cells[b] ^ cells[c] ^ cells[own]
        cells[own] = marks[keys] ^ others
    return cells
