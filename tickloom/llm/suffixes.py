"""Suffix arrays of bounded blocks by two-stage sorting, in numpy.

A suffix is either smaller than its successor (the suffix one place to the right) or greater. Only the
smaller ones are sorted directly. A greater one begins with a symbol and is ordered by its successor
after that, so one scan over the buckets of first symbols, in order, puts all of them in place.

Symbols are 0 for the end of a string and 1 to 256 for its bytes. Order is by the first ``depth`` symbols.
"""

from __future__ import annotations

import numpy as np

_BITS, _HELD = 9, 7
_SYMBOLS = 257


class Block:
    """Strings end to end, each followed by its end symbol."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        sizes = np.diff(starts)
        ends = np.cumsum(sizes + 1) - 1
        self.symbols = np.zeros(len(data) + len(sizes), np.int16)
        inside = np.ones(len(self.symbols), bool)
        inside[ends] = False
        self.symbols[inside] = data.astype(np.int16) + 1
        #: The string of each symbol, its place there, and how many symbols follow before the end.
        self.string = np.repeat(np.arange(len(sizes)), sizes + 1)
        self.place = np.arange(len(self.symbols)) - (ends - sizes)[self.string]
        self.left = ends[self.string] - np.arange(len(self.symbols))
        self._heads = self._packed()

    def _packed(self) -> np.ndarray:
        """The next seven symbols as one number that sorts like them; nothing after an end counts."""
        n = len(self.symbols)
        padded = np.concatenate([self.symbols, np.zeros(_HELD, np.int16)])
        out, live = np.zeros(n, np.uint64), np.ones(n, bool)
        for k in range(_HELD):
            symbol = padded[k : k + n]
            out = out << np.uint64(_BITS) | np.where(live, symbol, 0).astype(np.uint64)
            live &= symbol != 0
        return out

    def head(self, at: np.ndarray, offset: int) -> np.ndarray:
        """The seven symbols from ``offset`` on of the suffixes at ``at``."""
        there = self.left[at] > offset
        out = np.zeros(len(at), np.uint64)
        out[there] = self._heads[at[there] + offset]
        return out

    def smaller(self) -> np.ndarray:
        """Which suffixes are smaller than their successors: a run of one symbol is as its last place is."""
        wide = np.append(self.symbols, np.int16(-1))
        n = len(self.symbols)
        last = np.where(wide[:-1] != wide[1:], np.arange(n), n)
        last = np.minimum.accumulate(last[::-1])[::-1]
        return (wide[:-1] < wide[1:])[last]

    def _directly(self, at: np.ndarray, depth: int) -> np.ndarray:
        """``at`` sorted by seven symbols at a time; only what is still tied is looked at again."""
        head = self._heads[at]
        by = np.argsort(head, kind="stable")
        order, head = at[by], head[by]
        first = np.ones(len(order), bool)
        first[1:] = head[1:] != head[:-1]
        ended = head & np.uint64((1 << _BITS) - 1) == 0
        for offset in range(_HELD, depth, _HELD):
            tied = ~first
            tied[:-1] |= ~first[1:]
            spots = np.flatnonzero(tied & ~ended)
            if not len(spots):
                break
            group, head = np.cumsum(first)[spots], self.head(order[spots], offset)
            by = np.lexsort((head, group))
            order[spots], head = order[spots][by], head[by]
            first[spots[1:]] |= (group[1:] == group[:-1]) & (head[1:] != head[:-1])
            ended[spots] = head & np.uint64((1 << _BITS) - 1) == 0
        return order

    def suffix_array(self, depth: int) -> np.ndarray:
        """Places of all symbols, in the order of the suffixes that begin there."""
        symbols, n = self.symbols, len(self.symbols)
        if not n:
            return np.zeros(0, np.int64)
        direct = self._directly(np.flatnonzero(self.smaller()), depth)
        cuts = np.concatenate([[0], np.cumsum(np.bincount(symbols[direct], minlength=_SYMBOLS))])
        induced: list[list[np.ndarray]] = [[] for _ in range(_SYMBOLS)]
        induced[symbols[-1]].append(np.array([n - 1]))  # its successor is the empty suffix, the smallest
        buckets = []
        for symbol in range(_SYMBOLS):
            fresh = np.concatenate(induced[symbol]) if induced[symbol] else np.zeros(0, np.int64)
            parts = [fresh]
            while len(fresh):  # runs of this symbol: a place is put down after its successor
                before = fresh[fresh > 0] - 1
                fresh = before[symbols[before] == symbol]
                parts.append(fresh)
            bucket = np.concatenate([*parts, direct[cuts[symbol] : cuts[symbol + 1]]])
            buckets.append(bucket)
            before = bucket[bucket > 0] - 1
            before = before[symbols[before] > symbol]
            before = before[np.argsort(symbols[before], kind="stable")]
            kinds, ats = np.unique(symbols[before], return_index=True)
            for kind, part in zip(kinds, np.split(before, ats[1:]), strict=False):
                induced[kind].append(part)
        return np.concatenate(buckets)

    def same_prefix(self, order: np.ndarray, length: int) -> np.ndarray:
        """Whether each suffix but the first has ``length`` symbols in common with the one before it."""
        one, two = order[:-1], order[1:]
        spots = np.flatnonzero((self.left[one] >= length) & (self.left[two] >= length))
        for offset in range(0, length, _HELD):
            drop = np.uint64(_BITS * max(0, _HELD - (length - offset)))
            same = self.head(one[spots], offset) >> drop == self.head(two[spots], offset) >> drop
            spots = spots[same]
        out = np.zeros(len(one), bool)
        out[spots] = True
        return out
