"""Byte pair merges of many words at once.

Words are spelt as symbols one after the other. In each round every word that can still be merged
gives up its pair of least rank, the leftmost of equals, as if it were alone; a word that is through
leaves the arrays. So a round costs a few operations on arrays, and there are as many rounds as the
word with most merges has.
"""

from __future__ import annotations

import numpy as np

NONE = np.iinfo(np.int32).max
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Merges:
    """Ranks of pairs in a table with open addressing, and the symbol each pair becomes."""

    def __init__(self, pairs: np.ndarray, made: np.ndarray):
        """`pairs` holds two symbols a row, in order of rank; `made` what they become."""
        self.made = made.astype(np.int64)
        self.bits = max(int(len(pairs)).bit_length() + 2, 4)
        self.keys = np.full(1 << self.bits, np.iinfo(np.uint64).max)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        keys = self._keys(pairs[:, 0], pairs[:, 1])
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slots(keys).tolist())):
            while self.ranks[slot] != NONE and self.keys[slot] != key:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            if self.ranks[slot] == NONE:
                self.keys[slot], self.ranks[slot] = key, rank

    def _keys(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * FACTOR) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; `NONE` for those that are never merged."""
        keys = self._keys(left, right)
        slots = self._slots(keys)
        found = np.where(self.keys[slots] == keys, self.ranks[slots], NONE)
        open_ = np.flatnonzero((found == NONE) & (self.ranks[slots] != NONE))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            hit = self.keys[slots[open_]] == keys[open_]
            found[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (self.ranks[slots[open_]] != NONE)]
        return found

    def merged(
        self, symbols: np.ndarray, starts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols after all merges, where each word's begin there, and how many it has.

        `starts` says where each word begins in `symbols`; none is empty.
        """
        count = len(starts)
        begin, size = np.zeros(count, np.int64), np.zeros(count, np.int64)
        done, given = [], 0
        symbols, words = symbols.astype(np.int64), np.arange(count)
        rank = np.full(len(symbols), NONE, np.int32)
        if len(symbols) > 1:
            rank[:-1] = self.rank(symbols[:-1], symbols[1:])
        rank[starts[1:] - 1] = NONE
        while len(words):
            sizes = np.diff(np.append(starts, len(symbols)))
            least = np.minimum.reduceat(rank, starts)
            live = least != NONE
            if not live.all():
                # Words without a pair to merge are through.
                over = ~live
                own = np.repeat(over, sizes)
                done.append(symbols[own])
                begin[words[over]] = given + np.cumsum(sizes[over]) - sizes[over]
                size[words[over]] = sizes[over]
                given += len(done[-1])
                symbols, rank = symbols[~own], rank[~own]
                words, sizes, least = words[live], sizes[live], least[live]
                starts = np.cumsum(sizes) - sizes
                if not len(words):
                    break
            hits = np.flatnonzero(rank == np.repeat(least, sizes))
            word = np.searchsorted(starts, hits, side="right") - 1
            at = hits[np.diff(word, prepend=-1) > 0]
            symbols[at] = self.made[least]
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            symbols, rank = symbols[kept], rank[kept]
            # Every word has given up one symbol, so all that follow move up by one more.
            moved = np.arange(len(words))
            at, starts = at - moved, starts - moved
            ends = starts + sizes - 2
            rank[at] = NONE
            inner = at[at < ends]
            rank[inner] = self.rank(symbols[inner], symbols[inner + 1])
            behind = at[at > starts]
            rank[behind - 1] = self.rank(symbols[behind - 1], symbols[behind])
        flat = np.concatenate(done) if done else symbols
        return flat, begin, size
