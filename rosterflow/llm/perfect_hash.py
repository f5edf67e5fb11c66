"""Minimal perfect hash of 128-bit digests, as flat arrays.

Every level hashes the digests that are still without a slot into a bit array of twice their
number; a digest alone in its place takes the slot that is the place's rank among such places,
the others go on to the next level. So n digests take the slots 0 to n - 1. A slot keeps its
digest, and a look-up compares it, so that a digest which is not in the table finds no slot.
"""

from __future__ import annotations

import numpy as np

from rosterflow.llm.arrays import mix

#: Levels after which two digests must be equal: each level leaves less than half of the others.
MOST_LEVELS = 200


def _places(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    salt = mix(np.full(1, level + 1, np.uint64))
    return (mix(mix(a.view(np.uint64) ^ salt) + b.view(np.uint64)) % np.uint64(size)).astype(np.int64)


class SlotTable:
    """Slots of the distinct digests ``(a, b)``, two arrays of longs; ``slot[i]`` is that of digest ``i``."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.slot, self.levels = np.empty(len(a), np.int64), []
        left, given = np.arange(len(a)), 0
        while len(left):
            if len(self.levels) == MOST_LEVELS:
                raise ValueError("two entries of a slot table have one digest")
            size = 2 * len(left) + 1
            at = _places(a[left], b[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            slots = given + np.cumsum(alone) - 1
            self.levels.append((alone, slots))
            placed = alone[at]
            self.slot[left[placed]] = slots[at[placed]]
            given += int(alone.sum())
            left = left[~placed]
        self.a, self.b = np.empty_like(a), np.empty_like(b)
        self.a[self.slot], self.b[self.slot] = a, b

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 for those that are not in the table."""
        found, left = np.full(len(a), -1, np.int64), np.arange(len(a))
        for level, (alone, slots) in enumerate(self.levels):
            at = _places(a[left], b[left], level, len(alone))
            hit = alone[at]
            slot, who = slots[at[hit]], left[hit]
            same = (self.a[slot] == a[who]) & (self.b[slot] == b[who])
            found[who[same]] = slot[same]
            left = left[~hit]
        return found
