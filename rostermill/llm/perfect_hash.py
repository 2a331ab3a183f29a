"""A minimal perfect hash over 64-bit keys, as nested bit arrays.

Level by level, the keys that are left are hashed into twice as many bits; a
key alone on its bit owns it, the others go on. A key's number is the count of
owned bits before its own over all levels, so n keys get the numbers 0 to
n - 1. The keys themselves are not stored.
"""

from __future__ import annotations

import struct

import numpy as np

from rostermill.llm.wordscan import mix

_SPREAD = 2
_LEVELS = 64
_COUNTS = np.array([bin(b).count("1") for b in range(256)], dtype=np.int64)


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Bit arrays by level, with owned bits counted up to each byte."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self._before = []
        seen = 0
        for bits in levels:
            ones = _COUNTS[bits]
            self._before.append(seen + np.cumsum(ones) - ones)
            seen += int(ones.sum())
        self.size = seen

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct 64-bit keys."""
        left, levels = keys, []
        while len(left):
            if len(levels) == _LEVELS:
                raise ValueError("keys are not distinct")
            size = -(-_SPREAD * len(left) // 8) * 8
            place = _place(left, len(levels), size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[place]]
        return cls(levels)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; an unknown key gets any number, or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            if not len(left):
                break
            place = _place(keys[left], level, 8 * len(bits))
            byte = bits[place >> 3]
            owned = (byte >> (place & 7) & 1).astype(bool)
            below = byte & ((1 << (place & 7)) - 1)
            rank = self._before[level][place >> 3] + _COUNTS[below]
            out[left[owned]] = rank[owned]
            left = left[~owned]
        return out

    def to_bytes(self) -> bytes:
        head = struct.pack("<I", len(self.levels)) + struct.pack(f"<{len(self.levels)}Q", *map(len, self.levels))
        return head + b"".join(bits.tobytes() for bits in self.levels)

    @classmethod
    def from_bytes(cls, data: memoryview) -> tuple[PerfectHash, int]:
        """The hash at the start of ``data`` and the bytes it takes."""
        (count,) = struct.unpack_from("<I", data)
        sizes = struct.unpack_from(f"<{count}Q", data, 4)
        at, levels = 4 + 8 * count, []
        for size in sizes:
            levels.append(np.frombuffer(data[at : at + size], dtype=np.uint8))
            at += size
        return cls(levels), at
