"""Sorted sets of offsets in Roaring style: containers of 2^16 offsets as array, bitmap or runs.

The high bits of an offset choose its container, the low 16 bits are stored in whichever of three forms takes
the fewest bytes: an array (2 a member), a bitmap (8192) or runs of consecutive members (4 a run).
Cumulative cardinalities over the containers lead ``select`` to the container that
holds a rank; the container answers with its local select.
"""

from __future__ import annotations

import numpy as np

BITS = 16
SPAN = 1 << BITS


class Array:
    """Low bits of the members, in order."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])

    def rank(self, low: int) -> int:
        return int(np.searchsorted(self.low, low))


class Bitmap:
    """One bit per offset in 64-bit words, with the members before each word."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(SPAN, dtype=bool)
        bits[low] = True
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def _bits(self, word: int) -> np.ndarray:
        return np.unpackbits(self.words[word : word + 1].view(np.uint8), bitorder="little")

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, "right")) - 1
        return word * 64 + int(np.flatnonzero(self._bits(word))[k - int(self.before[word])])

    def rank(self, low: int) -> int:
        word = low >> 6
        return int(self.before[word]) + int(self._bits(word)[: low & 63].sum())


class Runs:
    """First member of each run of consecutive members, with the members before it."""

    def __init__(self, low: np.ndarray, at: np.ndarray):
        self.first = low[at].astype(np.uint16)
        self.before = np.append(at, len(low))

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.first[run]) + k - int(self.before[run])

    def rank(self, low: int) -> int:
        run = int(np.searchsorted(self.first, low, "right")) - 1
        if run < 0:
            return 0
        return min(int(self.before[run + 1]), int(self.before[run]) + low - int(self.first[run]))


def container(low: np.ndarray) -> Array | Bitmap | Runs:
    """The smallest form of the ascending members of one container."""
    at = np.concatenate(([0], np.flatnonzero(np.diff(low) != 1) + 1))
    if 4 * len(at) < min(2 * len(low), SPAN // 8):
        return Runs(low, at)
    return Array(low) if 2 * len(low) <= SPAN // 8 else Bitmap(low)


class BoundarySet:
    """The set of the ascending, distinct ``offsets``."""

    def __init__(self, offsets: np.ndarray):
        at = np.concatenate(([0], np.flatnonzero(np.diff(offsets >> BITS)) + 1, [len(offsets)])) if len(offsets) else np.zeros(1, int)
        self.keys = offsets[at[:-1]] >> BITS
        self.before = at  # cumulative cardinalities
        self.containers = [container(offsets[a:b] & (SPAN - 1)) for a, b in zip(at[:-1], at[1:])]

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The k-th smallest member, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        c = int(np.searchsorted(self.before, k, "right")) - 1
        return (int(self.keys[c]) << BITS) + self.containers[c].select(k - int(self.before[c]))

    def rank(self, offset: int) -> int:
        """How many members are smaller than ``offset``."""
        c = int(np.searchsorted(self.keys, offset >> BITS))
        if c == len(self.keys) or self.keys[c] != offset >> BITS:
            return int(self.before[c])
        return int(self.before[c]) + self.containers[c].rank(offset & (SPAN - 1))
