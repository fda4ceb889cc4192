"""Minimal perfect hash of 64-bit keys by levels of collision-free bits, in numpy arrays.

A level has about two bits per key left. A key whose position no other key shares sets its bit there;
the others go on to the next level. The index of a key is the rank of its bit over all levels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BITS_PER_KEY = 2


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (keys + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


@dataclass
class PerfectHash:
    bits: list[np.ndarray]  # per level, 64-bit words
    before: np.ndarray  # set bits before each word, over all levels

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct unsigned 64-bit numbers."""
        levels = []
        while len(keys):
            words = max(1, -(-BITS_PER_KEY * len(keys) // 64))
            place = (_mixed(keys, len(levels)) % np.uint64(64 * words)).astype("int64")
            alone = np.bincount(place, minlength=64 * words) == 1
            levels.append(np.packbits(alone, bitorder="little").view("uint64"))
            keys = keys[~alone[place]]
        return cls(levels, cls._ranks(levels))

    @staticmethod
    def _ranks(levels: list[np.ndarray]) -> np.ndarray:
        ones = np.bitwise_count(np.concatenate(levels) if levels else np.empty(0, "uint64")).astype("uint32")
        return (np.cumsum(ones, dtype="uint32") - ones).astype("uint32")

    def index(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key; some index or -1 for what was never a key."""
        found = np.full(len(keys), -1, "int64")
        left, base = np.arange(len(keys)), 0
        for level, bits in enumerate(self.bits):
            place = _mixed(keys[left], level) % np.uint64(64 * len(bits))
            word, bit = (place >> np.uint64(6)).astype("int64"), place & np.uint64(63)
            here = (bits[word] >> bit) & np.uint64(1) == 1
            lower = bits[word[here]] & ((np.uint64(1) << bit[here]) - np.uint64(1))
            found[left[here]] = self.before[base + word[here]] + np.bitwise_count(lower)
            left, base = left[~here], base + len(bits)
            if not len(left):
                break
        return found

    def to_bytes(self) -> bytes:
        head = np.array([len(self.bits), *[len(b) for b in self.bits]], "<u4").tobytes()
        return head + b"".join(b.tobytes() for b in self.bits)

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[PerfectHash, int]:
        """The structure, and how many bytes it took."""
        n = int(np.frombuffer(data, "<u4", 1)[0])
        sizes, at, levels = np.frombuffer(data, "<u4", n, 4), 4 * (n + 1), []
        for size in sizes.tolist():
            levels.append(np.frombuffer(data, "<u8", size, at))
            at += 8 * size
        return cls(levels, cls._ranks(levels)), at
