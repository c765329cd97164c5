"""Minimal perfect hash tables over 128-bit keys in flat numpy arrays.

n distinct keys get the slots 0 to n - 1. On each level the keys left are hashed to a bit
array; those that fall alone on a place take the next slots, the others go on to the next
level. The stored keys verify each answer, so a key that is not in the table gets no slot.
"""

from __future__ import annotations

import numpy as np

_SPREAD = 2
_MIX = np.uint64(0x9E3779B97F4A7C15)


def keys_of(digests: list[bytes]) -> np.ndarray:
    """(n, 2) numbers from digests of 16 bytes."""
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    mixed = (keys[:, 0] ^ (keys[:, 1] * _MIX)) + np.uint64((level + 1) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1)
    mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX
    return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(size)).astype(np.int64)


class SlotTable:
    """Slots of distinct keys, given as an (n, 2) array of uint64."""

    def __init__(self, keys: np.ndarray) -> None:
        self._levels: list[tuple[np.ndarray, np.ndarray]] = []
        self._stored = np.empty_like(keys)
        left, first = keys, 0
        while len(left):
            place = _places(left, len(self._levels), _SPREAD * len(left))
            alone = np.bincount(place, minlength=_SPREAD * len(left)) == 1
            slot_at = first - 1 + np.cumsum(alone)
            placed = alone[place]
            self._stored[slot_at[place[placed]]] = left[placed]
            first += int(placed.sum())
            left = left[~placed]
            self._levels.append((alone, slot_at))
            if len(self._levels) > 200:
                raise ValueError("keys are not distinct")

    def __len__(self) -> int:
        return len(self._stored)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that are not in the table."""
        result = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for level, (alone, slot_at) in enumerate(self._levels):
            place = _places(keys[open_], level, len(alone))
            hit = alone[place]
            result[open_[hit]] = slot_at[place[hit]]
            open_ = open_[~hit]
        met = np.flatnonzero(result >= 0)
        wrong = met[(self._stored[result[met]] != keys[met]).any(axis=1)]
        result[wrong] = -1
        return result
