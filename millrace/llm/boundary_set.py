"""A sorted set of offsets in containers of 65,536 values, with selection by rank.

Offsets are split by their high bits. The low 16 bits of each part stand in the smallest of three
containers: a sorted array, a bitmap of 1,024 words, or runs (start, length). Cumulative
cardinalities over the containers say which one holds the k-th offset; a select inside that
container gives it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PART = 1 << 16
BITMAP_BYTES = PART // 8


@dataclass
class ArrayContainer:
    values: np.ndarray

    def select(self, k: int) -> int:
        return int(self.values[k])


@dataclass
class BitmapContainer:
    words: np.ndarray
    #: Set bits before each word.
    before: np.ndarray

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        word = int(self.words[at])
        for _ in range(k - int(self.before[at])):
            word &= word - 1  # without its lowest set bit
        return at * 64 + (word & -word).bit_length() - 1


@dataclass
class RunContainer:
    starts: np.ndarray
    #: Values before each run.
    before: np.ndarray

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[at]) + k - int(self.before[at])


def container(values: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container for sorted distinct values below 65,536, at least one."""
    firsts = np.concatenate(([0], np.flatnonzero(np.diff(values) != 1) + 1))
    array_bytes = 2 * len(values)
    if 4 * len(firsts) < min(array_bytes, BITMAP_BYTES):
        return RunContainer(values[firsts].astype(np.uint16), firsts)
    if array_bytes <= BITMAP_BYTES:
        return ArrayContainer(values.astype(np.uint16))
    bits = np.zeros(PART, bool)
    bits[values] = True
    words = np.packbits(bits, bitorder="little").view("<u8")
    counts = bits.reshape(-1, 64).sum(1)
    return BitmapContainer(words, np.cumsum(counts) - counts)


class BoundarySet:
    """Distinct offsets in ascending order; ``select(k)`` is the k-th, from 0."""

    def __init__(self, offsets: np.ndarray):
        offsets = np.asarray(offsets, np.int64)
        self.keys, first = np.unique(offsets >> 16, return_index=True)
        ends = np.append(first, len(offsets))
        #: Offsets before each container, and all at the end.
        self.before = ends
        self.containers = [container(offsets[a:b] & (PART - 1)) for a, b in zip(ends[:-1], ends[1:])]

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return (int(self.keys[at]) << 16) + self.containers[at].select(k - int(self.before[at]))
