"""Posting lists of a block of documents with range-maximum tables, searched best interval first.

Every list holds (document, impact) by document.  A sparse table per list gives the place of the largest impact of any range of
it in two look-ups.  A search starts with the interval of all documents; the sum over the terms of weight times
largest impact bounds every score in an interval.  The interval of the highest bound is split at a document of
maximum impact, which is scored, into the intervals left and right of it; intervals of few postings are
scored at once.  The search ends when the best bound left is below the k-th score.
"""

from __future__ import annotations

import heapq
import itertools

import numpy as np

#: Intervals of at most so many postings are scored at once instead of being split.
LEAF = 4096


class Best:
    """The k best (score, document id) of one search: higher scores first, ties by smaller id, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.rows: list[tuple[int, bool, int]] = []  # (-score, id is null, id), in order

    @property
    def least(self) -> int:
        """Scores below this cannot enter; none of 0 does."""
        return max(1, -self.rows[-1][0]) if len(self.rows) == self.k else 1

    def offer(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        some = np.flatnonzero(scores >= self.least)
        if len(some) > self.k:
            some = some[np.lexsort((ids[some], null[some], -scores[some]))[: self.k]]
        if len(some):
            new = zip((-scores[some]).tolist(), null[some].tolist(), ids[some].tolist())
            self.rows = sorted([*self.rows, *new])[: self.k]


class Index:
    """Lists of postings (term, document, impact) of documents 0 .. n - 1, given by ascending document."""

    def __init__(self, n_docs: int, n_terms: int, term: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        order = np.argsort(term, kind="stable")
        self.n_docs = n_docs
        self.doc, self.impact = doc[order].astype(np.int64), impact[order].astype(np.int64)
        self.key = term[order].astype(np.int64) * n_docs + self.doc
        self.begin = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=n_terms))))
        self.top = self._sparse_table(int(np.diff(self.begin).max(initial=0)))

    def _sparse_table(self, longest: int) -> np.ndarray:
        """[level, place] -> place of the largest impact of the 2^level postings from place on (the first of equal ones)."""
        levels = max(1, longest.bit_length())
        top = np.empty((levels, len(self.impact)), dtype=np.int32)
        top[0] = np.arange(len(self.impact))
        for level in range(1, levels):
            half = 1 << (level - 1)
            top[level] = top[level - 1]
            a, b = top[level - 1, :-half], top[level - 1, half:]
            top[level, :-half] = np.where(self.impact[b] > self.impact[a], b, a)
        return top

    def largest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Place of the largest impact of each non-empty range of one list."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        a, b = self.top[level, lo], self.top[level, hi - (1 << level)]
        return np.where(self.impact[b] > self.impact[a], b, a)

    def search(self, terms: np.ndarray, weights: np.ndarray, ids: np.ndarray, null: np.ndarray, best: Best) -> int:
        """Offers the documents that may be among the best of a query; returns how many postings were scored."""
        scored, agenda, entered = 0, [], itertools.count()

        def enter(terms: np.ndarray, weights: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> None:
            some = hi > lo
            if some.any():
                if not some.all():
                    terms, weights, lo, hi = terms[some], weights[some], lo[some], hi[some]
                place = self.largest(lo, hi)
                gain = weights * self.impact[place]
                bound = int(gain.sum())
                if bound >= best.least:
                    heapq.heappush(agenda, (-bound, next(entered), terms, weights, lo, hi, int(place[gain.argmax()])))

        enter(terms, weights, self.begin[terms], self.begin[terms + 1])
        while agenda and -agenda[0][0] >= best.least:
            _, _, terms, weights, lo, hi, place = heapq.heappop(agenda)
            size = hi - lo
            total = int(size.sum())
            if total <= LEAF:
                at = np.arange(total) + np.repeat(hi - np.cumsum(size), size)
                doc = self.doc[at]
                first = int(doc.min())
                score = np.zeros(int(doc.max()) - first + 1, dtype=np.int64)
                np.add.at(score, doc - first, self.impact[at] * np.repeat(weights, size))
                scored += total
                best.offer(score, ids[first : first + len(score)], null[first : first + len(score)])
                continue
            split = int(self.doc[place])
            at = np.searchsorted(self.key, terms * self.n_docs + split)
            held = at < hi
            held[held] = self.doc[at[held]] == split
            score = (weights[held] * self.impact[at[held]]).sum()
            scored += int(held.sum())
            best.offer(np.array([score]), ids[split : split + 1], null[split : split + 1])
            enter(terms, weights, lo, at)
            enter(terms, weights, at + held, hi)
        return scored
