"""A trie of word phrases in two integer arrays, walked by many positions of a text at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ROOT = 0
FREE = -1
# Slots looked through at a time for a place where all children of a node fit.
WINDOW = 256
MOST_WINDOWS = 4


@dataclass
class DoubleArray:
    """The child of node `s` by digit `c` is slot `base[s] + c` where `check` there is `s`.

    A word is two digits: its number in the order of `words`, from 1, over `radix`. So a node has
    few possible children however many words there are, and families of children pack well.
    `phrase` numbers the phrases that end at a node from 1; 0 stands for none.
    """

    words: pa.Array
    radix: int
    base: np.ndarray
    check: np.ndarray
    phrase: np.ndarray

    def symbols(self, words: pa.Array) -> np.ndarray:
        """The numbers of words, 0 for those in no phrase."""
        found = pc.index_in(words, value_set=self.words)
        return pc.fill_null(found, -1).to_numpy().astype(np.int64) + 1

    def step(self, states: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """The states after one more digit each, -1 where there is none."""
        slot = self.base[states] + digits
        inside = (slot > ROOT) & (slot < len(self.check)) & (digits > 0)
        slot = np.where(inside, slot, ROOT)
        return np.where(inside & (self.check[slot] == states), slot, -1)

    def walk(self, words: list[np.ndarray], states: np.ndarray | None = None) -> np.ndarray:
        """The states after the words with these numbers, -1 where a phrase leaves the trie."""
        if states is None:
            states = np.full(len(words[0]), ROOT)
        for symbols in words:
            for digit in digits_of(symbols, self.radix):
                on = states >= 0
                states = np.where(on, self.step(np.where(on, states, ROOT), digit), -1)
        return states

    def occurrences(self, symbols: np.ndarray, ends: np.ndarray, longest: int) -> np.ndarray:
        """How often each node is reached in a text, from all its words at once, level by level.

        `symbols` are the text's words, `ends` says which of them no phrase may go beyond.
        """
        counts = np.zeros(len(self.base), np.int64)
        digits = digits_of(symbols, self.radix)
        at = np.arange(len(symbols))
        states = np.zeros(len(symbols), np.int64)
        for _ in range(longest):
            for digit in digits:
                states = self.step(states, digit[at])
                alive = states >= 0
                at, states = at[alive], states[alive]
            counts += np.bincount(states, minlength=len(counts))
            on = ~ends[at]
            at, states = at[on] + 1, states[on]
        return counts


def digits_of(symbols: np.ndarray, radix: int) -> list[np.ndarray]:
    """Both digits of each number, from 1; 0 where there is no word."""
    high, low = np.divmod(symbols, radix)
    return [np.where(symbols > 0, high + 1, 0), np.where(symbols > 0, low + 1, 0)]


def build(columns: list[pa.Array], numbers: np.ndarray) -> DoubleArray:
    """The trie of phrases given word by word, the k-th words in `columns[k]`, null beyond the end.

    `numbers` are the phrases' own numbers from 1.
    """
    every = pa.chunked_array(columns).drop_null()
    words = every.unique().sort() if len(every) else pa.array([], columns[0].type)
    radix = max(int(np.ceil(np.sqrt(len(words) + 1))), 2)
    digits = []
    for column in columns:
        found = pc.fill_null(pc.index_in(column, value_set=words), -1)
        digits += digits_of(found.to_numpy().astype(np.int64) + 1, radix)
    # Nodes by level: the parent's number within its level, the digit, and the phrases that end there.
    within = np.zeros(len(numbers), np.int64)  # each phrase's node on the level reached so far
    alive = np.arange(len(numbers))
    levels = []
    for n, own in enumerate(digits):
        going = own[alive] > 0
        alive, within = alive[going], within[going]
        nodes, within = np.unique(within * (radix + 1) + own[alive], return_inverse=True)
        parent, digit = np.divmod(nodes, radix + 1)
        ends = np.zeros(len(nodes), np.int64)
        last = np.ones(len(alive), bool) if n + 1 == len(digits) else digits[n + 1][alive] == 0
        ends[within[last]] = numbers[alive[last]]
        levels.append((parent, digit, ends))
    return _placed(words, radix, levels)


def _placed(words: pa.Array, radix: int, levels) -> DoubleArray:
    """Give every node a slot, parents before children, those with most children first."""
    slots = _Slots(1 + sum(len(level[0]) for level in levels))
    phrase_of: list[tuple[np.ndarray, np.ndarray]] = []
    above = np.array([ROOT])
    for parent, digit, ends in levels:
        own = np.zeros(len(parent), np.int64)
        if len(parent):
            heads = np.flatnonzero(np.diff(parent, prepend=-1))
            sizes = np.diff(np.append(heads, len(parent)))
            for n in np.flatnonzero(sizes > 1)[np.argsort(-sizes[sizes > 1], kind="stable")]:
                family = slice(heads[n], heads[n] + sizes[n])
                own[family] = slots.family(above[parent[heads[n]]], digit[family])
            alone = heads[sizes == 1]
            if len(alone):
                own[alone] = slots.singles(above[parent[alone]], digit[alone])
        phrase_of.append((own, ends))
        above = own
    size = slots.used()
    phrase = np.zeros(size, np.int32)
    for own, ends in phrase_of:
        phrase[own] = ends
    base, check = (x[:size].astype(np.int32) for x in (slots.base, slots.check))
    return DoubleArray(words, radix, base, check, phrase)


class _Slots:
    def __init__(self, size: int):
        self.base = np.zeros(size, np.int64)
        self.check = np.full(size, FREE)
        self.check[ROOT] = ROOT
        self.top = 1  # all slots from here are free
        self.cursor, self.family_size = 1, 1 << 62

    def _reach(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, len(self.check) * 5 // 4) - len(self.check)
            self.base = np.pad(self.base, (0, more))
            self.check = np.pad(self.check, (0, more), constant_values=FREE)

    def family(self, parent: int, digits: np.ndarray) -> np.ndarray:
        """A place where all children of one parent find free slots.

        The search goes on where the last one ended, and from the beginning again once families
        are half as large; after a few windows without a place it goes beyond all slots in use.
        """
        if len(digits) * 2 <= self.family_size:
            self.cursor, self.family_size = 1, len(digits)
        apart = digits - digits[0]
        some = max(1, (1 << 16) // len(digits))
        for at in [*range(self.cursor, self.top, WINDOW)[:MOST_WINDOWS], self.top]:
            self._reach(at + WINDOW + int(apart[-1]) + 1)
            tried = np.flatnonzero(self.check[at : at + WINDOW] == FREE) + at
            for begin in range(0, len(tried), some):
                block = tried[begin : begin + some]
                fits = (self.check[block[:, None] + apart] == FREE).all(axis=1)
                if fits.any():
                    self.cursor = at
                    return self._take(parent, digits, block[fits.argmax()] + apart)
        raise AssertionError("slots beyond the last used one are free")

    def singles(self, parents: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """Any free slots, for nodes without siblings."""
        free = np.flatnonzero(self.check == FREE)
        if len(free) < len(digits):
            self._reach(len(self.check) + len(digits) - len(free))
            free = np.flatnonzero(self.check == FREE)
        return self._take(parents, digits, free[: len(digits)])

    def _take(self, parents, digits: np.ndarray, slots: np.ndarray) -> np.ndarray:
        self.check[slots] = parents
        self.top = max(self.top, int(slots[-1]) + 1)
        self.base[parents] = slots - digits if np.ndim(parents) else slots[0] - digits[0]
        return slots

    def used(self) -> int:
        return self.top
