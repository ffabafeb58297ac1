"""Vectorised word and character n-gram arrays over Arrow batches of texts.

A batch is cut into chunks of whole texts of about ``CHUNK_BYTES`` (a longer text
is a chunk of its own), so memory follows the longest text, not the batch.
Every text ends with a newline separator, which is white space, so no word or
line runs from one text into the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

#: The six ASCII white space characters, \x20 and \x09-\x0D.
_SPACES = np.array([32, 9, 10, 11, 12, 13])
SPACE = np.zeros(256, dtype=bool)
SPACE[_SPACES] = True

#: ASCII lower-casing of bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_powers = (np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64))


@dataclass
class Chunk:
    """Texts ``first`` .. ``first + n - 1`` of a batch, as UTF-8 bytes with a newline after each."""

    first: int
    starts: np.ndarray  # n + 1 offsets into data
    data: np.ndarray  # uint8

    @property
    def n(self) -> int:
        return len(self.starts) - 1


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES, rows: int = 1 << 20) -> Iterator[Chunk]:
    """Chunks of a string array, of at most ``rows`` texts; a null counts as an empty text."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        raw = text.as_buffer() if text.is_valid else b""
        if held and (size + len(raw) > limit or len(held) >= rows):
            yield _chunk(first, held)
            held, size, first = [], 0, i
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield _chunk(first, held)


def _chunk(first: int, held: list) -> Chunk:
    held.append(b"")  # a separator after the last text, too
    starts = np.concatenate(([0], np.cumsum([len(x) + 1 for x in held[:-1]])))
    return Chunk(first, starts, np.frombuffer(b"\n".join(held), dtype=np.uint8))


def code_points(chunk: Chunk) -> Chunk:
    """The same texts as uint32 code points."""
    wide = np.frombuffer(chunk.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    before = np.concatenate(([0], np.cumsum((chunk.data & 0xC0) != 0x80)))
    return Chunk(chunk.first, before[chunk.starts], wide)


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True; the last element must be False."""
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    return edge[0::2], edge[1::2]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the output."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = 1 << int(n - 1).bit_length()
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for base in (_BASE, inverse):
            t = np.full(size, np.uint64(base))
            t[0] = 1
            tables.append(np.cumprod(t))
        _powers = tuple(tables)
    return _powers[0][:n], _powers[1][:n]


def run_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """64-bit hash of each slice data[s:e]: equal slices have equal hashes wherever they stand."""
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    return mix((total[e] - total[s]) * inverse[s])


def gram_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of each window of n elements (len(data) - n + 1 of them)."""
    if len(data) < n:
        return np.zeros(0, dtype=np.uint64)
    wide = data.astype(np.uint64) + np.uint64(1)
    h = wide[: len(data) - n + 1].copy()
    for k in range(1, n):
        h *= np.uint64(_BASE)
        h += wide[k : len(data) - n + 1 + k]
    return mix(h)


def combine(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive hashes."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out *= np.uint64(_BASE)
        out += h[k : len(h) - n + 1 + k]
    return mix(out)


def window_owner(owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For windows of n consecutive items: which lie in one text, and that text."""
    if len(owner) < n:
        return np.zeros(0, dtype=bool), np.zeros(0, dtype=owner.dtype)
    first, last = owner[: len(owner) - n + 1], owner[n - 1 :]
    return first == last, first
