"""Byte-pair encoding by a score-ordered agenda of adjacent symbol pairs, over many texts at once.

A text is a row of symbols, one per character.  Its agenda holds every adjacent pair that together is a piece of the vocabulary,
by score, the leftmost of equal scores first; the best pair is merged and its neighbours' new pairs enter, until none is left.
No pair can be merged over a boundary whose two characters no piece holds side by side, so texts fall into
segments (about words) that are encoded apart and, when equal, once per chunk of texts.

Segments of up to ``SHORT`` characters keep their agendas in one array: each round, every segment takes its best
pair by a segmented minimum over (rank, position) and links its neighbours.  Longer ones use a heap each, so a text without any boundary costs
n log n.  Characters that are no piece become the pieces of their UTF-8 bytes.
"""

from __future__ import annotations

import heapq
import struct

import numpy as np

from .textbatch import run_hashes

SPACE = "▁"
SHORT = 64
NONE = np.int64(1) << 62
NORMAL, UNKNOWN, BYTE = 1, 2, 6


def _fields(raw: bytes):
    """(field number, value) of a protocol buffer message; fixed fields as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, raw[at : at + size]
        at += size


def read_model(path: str) -> tuple[list[tuple[str, float, int]], dict, dict]:
    """Pieces (text, score, type), trainer and normalizer fields of a model file."""
    with open(path, "rb") as f:
        raw = f.read()
    pieces, trainer, normalizer = [], {}, {}
    for number, value in _fields(raw):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append((piece[1].decode("utf-8"), struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normalizer = dict(_fields(value))
    return pieces, trainer, normalizer


class Pieces:
    """Merge tables of a merge-type vocabulary.

    Symbols are piece ids, then one number per character that pieces hold without being pieces themselves, then
    ``other + code point``.  Pairs of symbols are looked up by key in a table of slots."""

    def __init__(self, path: str):
        pieces, trainer, normalizer = read_model(path)
        if trainer.get(3, 1) != 2 or not trainer.get(35, 0):
            raise ValueError("the vocabulary must be of merge type with byte pieces")
        if normalizer.get(2) or not normalizer.get(3, 1) or normalizer.get(4, 1) or not normalizer.get(5, 1) or trainer.get(24, 0):
            raise ValueError("texts must be left as they are but for a space in front")
        if any(kind in (4, 5) for _, _, kind in pieces):
            raise ValueError("user-defined and unused pieces are not merged by score alone")
        self.bytes = np.zeros(256, dtype=np.int32)
        normal: dict[str, int] = {}
        for i, (text, _, kind) in enumerate(pieces):
            if kind == NORMAL:
                normal.setdefault(text, i)
            elif kind == BYTE:
                self.bytes[int(text[3:5], 16)] = i
        chars = sorted({c for text in normal for c in text if c not in normal})
        symbol = normal | {c: len(pieces) + k for k, c in enumerate(chars)}
        self.other = len(pieces) + len(chars)
        self.first = len(pieces)  # symbols from here on are characters that are no piece
        self.char = np.arange(0x110000, dtype=np.int32) + self.other  # symbol of each code point
        self.code = np.zeros(self.other, dtype=np.int32)  # code point of the characters among the symbols
        for text, i in symbol.items():
            if len(text) == 1:
                self.char[ord(text)], self.code[i] = i, ord(text)
        # pairs are ranked by score; equal scores share a rank, so that the leftmost of them is first
        scores = sorted({-pieces[i][1] for i in normal.values()})
        rank = {s: k for k, s in enumerate(scores)}
        merges = [(symbol[text[:k]] << 32 | symbol[text[k:]], rank[-pieces[i][1]] << 32 | i) for text, i in normal.items()
                  for k in range(1, len(text)) if text[:k] in symbol and text[k:] in symbol]
        self.merged = dict(merges)
        self._fill_slots()
        # characters that stand side by side in some piece, by class
        alphabet = sorted({c for text in normal if len(text) > 1 for c in text})
        self.kind = np.zeros(0x110000, dtype=np.uint16)
        self.kind[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.beside = np.zeros((len(alphabet) + 1, len(alphabet) + 1), dtype=bool)
        for text in normal:
            k = self.kind[[ord(c) for c in text]]
            self.beside[k[:-1], k[1:]] = True
        self.size = len(pieces)

    def _fill_slots(self) -> None:
        """The pairs in a table with free slots; a pair whose slot is taken goes to the next free one."""
        self.bits = max(8, (8 * len(self.merged)).bit_length())
        self.key = np.full((1 << self.bits) + len(self.merged), -1, dtype=np.int64)
        self.merge = np.full(len(self.key), NONE)
        key, merge = (np.array(list(x), dtype=np.int64) for x in (self.merged.keys(), self.merged.values()))
        slot = self._slot(key)
        while len(key):
            first = np.zeros(len(key), dtype=bool)
            first[np.unique(slot, return_index=True)[1]] = True
            first &= self.key[slot] == -1
            self.key[slot[first]], self.merge[slot[first]] = key[first], merge[first]
            key, merge, slot = key[~first], merge[~first], slot[~first] + 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """rank << 32 | piece of each pair, NONE if the two are no piece together."""
        key = left.astype(np.int64) << 32 | right
        slot = self._slot(key)
        there = self.key[slot]
        hit = there == key
        out = np.where(hit, self.merge[slot], NONE)
        more = np.flatnonzero(~hit & (there != -1))
        while len(more):
            slot[more] += 1
            there = self.key[slot[more]]
            hit = there == key[more]
            out[more[hit]] = self.merge[slot[more[hit]]]
            more = more[~hit & (there != -1)]
        return out

    def encode_long(self, symbols: list[int]) -> list[int]:
        """Symbols after all merges of one segment, by a heap."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        held, agenda = list(symbols), []

        def enter(left: int, right: int) -> None:
            if left >= 0 and right < n:
                found = self.merged.get(held[left] << 32 | held[right])
                if found is not None:
                    heapq.heappush(agenda, (found >> 32, left, right, held[left], held[right], found & 0xFFFFFFFF))

        for k in range(n - 1):
            enter(k, k + 1)
        while agenda:
            _, left, right, a, b, piece = heapq.heappop(agenda)
            if held[left] != a or held[right] != b or after[left] != right:
                continue  # one of the two has been merged since
            held[left], held[right] = piece, -1
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            enter(before[left], left)
            enter(left, after[left])
        return [s for s in held if s >= 0]

    def encode_short(self, symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols after all merges, how many of each segment) of segments of ``size`` symbols, longest first."""
        n = len(symbols)
        if not n:
            return symbols, size
        end = np.cumsum(size)
        start = end - size
        held = np.append(symbols, self.other + 0x110000)  # a last symbol beyond all pairs stands before and after each segment
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[end - 1], before[start] = n, n
        place, piece = np.full(n + 1, NONE), np.zeros(n + 1, dtype=np.int32)  # rank, then position, of the pair that begins here

        def enter(left: np.ndarray, right: np.ndarray) -> None:
            found = self.lookup(held[left], held[right])
            place[left] = np.where(found == NONE, NONE, (found >> 32 << 32) | left)
            piece[left] = found & 0xFFFFFFFF

        enter(np.arange(n), after[:n])
        last = len(start)
        while last:
            best = np.minimum.reduceat(place[: end[last - 1]], start[:last])
            live = np.flatnonzero(best != NONE)
            last = int(live[-1]) + 1 if len(live) else 0  # short segments end first, so the rest shrinks
            at = best[live] & 0xFFFFFFFF
            right = after[at]
            held[at], held[right], place[right] = piece[at], -1, NONE
            after[at] = after[right]
            before[after[right]] = at
            enter(at, after[at])
            enter(before[at], at)
        alive = held[:n] >= 0
        return held[:n][alive], np.add.reduceat(alive, start, dtype=np.int64)

    def to_ids(self, symbols: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids and how many of each segment: characters that are no piece become their bytes."""
        strange = symbols >= self.first
        if not strange.any():
            return symbols.astype(np.int32), count
        code = symbols[strange]
        code = np.where(code < self.other, self.code[np.minimum(code, self.other - 1)], code - self.other)
        size = np.ones(len(symbols), dtype=np.int64)
        size[strange] = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        raw = np.frombuffer(code.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8"), dtype=np.uint8)
        out = np.repeat(symbols, size).astype(np.int32)
        out[np.repeat(strange, size)] = self.bytes[raw]
        upto = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum(count)))]
        return out, np.diff(upto)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids begin (with the end)."""
        marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        length = np.array([len(t) for t in marked], dtype=np.int64)
        starts = np.concatenate(([0], np.cumsum(length)))
        wide = np.frombuffer("".join(marked).encode("utf-32-le"), dtype=np.uint32)
        if not len(wide):
            return np.zeros(0, dtype=np.int32), np.zeros(len(texts) + 1, dtype=np.int64)
        cut = np.ones(len(wide) + 1, dtype=bool)
        kind = self.kind[wide]
        cut[1:-1] = ~self.beside[kind[:-1], kind[1:]]
        cut[starts] = True
        at = np.flatnonzero(cut)
        s, e = at[:-1], at[1:]
        which, first = _distinct(wide, s, e)
        # ids of the distinct segments, longest first
        size = (e - s)[first]
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.arange(len(order))
        n_long = int((size > SHORT).sum())
        long = [self.encode_long(self.char[wide[s[k] : e[k]]].tolist()) for k in first[:n_long].tolist()]
        short, count = self.encode_short(self.char[_slices(wide, s[first[n_long:]], size[n_long:])], size[n_long:])
        symbols = np.concatenate([*(np.array(x, dtype=np.int64) for x in long), short])
        ids, count = self.to_ids(symbols, np.concatenate(([len(x) for x in long], count)).astype(np.int64))
        begin = np.cumsum(count) - count
        # every segment gets the ids of its like
        like = number[which]
        size = count[like]
        upto = np.concatenate(([0], np.cumsum(size)))
        return _slices(ids, begin[like], size), upto[np.searchsorted(s, starts)]


def _slices(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices data[start : start + size] one after the other."""
    end = np.cumsum(size)
    total = int(end[-1]) if len(end) else 0
    kind = np.int32 if max(total, len(data)) < 1 << 31 else np.int64
    at = np.repeat((start - end + size).astype(kind), size)
    at += np.arange(total, dtype=kind)
    return data[at]


def _distinct(wide: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each segment the number of its like among the distinct ones, and the first segment of each distinct one."""
    found = run_hashes(wide, s, e)
    order = np.argsort(found)
    new = np.concatenate(([True], np.diff(found[order].view(np.int64)) != 0))
    which = np.empty(len(s), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    first = order[new]
    like = first[which]
    size = e - s
    if (size[like] != size).any() or (_slices(wide, s[like], size) != wide).any():  # two texts of one hash
        return np.arange(len(s)), np.arange(len(s))
    return which, first
