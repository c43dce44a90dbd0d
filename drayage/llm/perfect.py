"""Minimal perfect hashing of a set of whole numbers, with array operations."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bits of a level for each key that is still without a place.
ROOM = 2


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    """Numbers each of ``n`` keys by an own number below ``n``.

    A level is a set of bits: a key has its place at the first level where no other key fell on
    its bit, and its number is the count of bits set before. ``index`` gives any number, or -1,
    for numbers that are no keys, so callers compare the key stored there.
    """

    sizes: np.ndarray
    words: np.ndarray

    def __post_init__(self):
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]
        self.first = np.r_[0, np.cumsum(self.sizes // 64)]

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """The hash of distinct ``keys``."""
        sizes, words, left = [], [], keys
        while len(left):
            size = 64 * -(-ROOM * len(left) // 64)
            at = _places(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, "<u8"))

    def index(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        waiting = np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            at = _places(keys[waiting], level, size)
            word, bit = self.first[level] + (at >> 6), (at & 63).astype(np.uint64)
            bits = self.words[word]
            hit = (bits >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(bits & ((np.uint64(1) << bit) - np.uint64(1)))
            out[waiting[hit]] = (self.before[word] + below)[hit]
            waiting = waiting[~hit]
            if not len(waiting):
                break
        return out
