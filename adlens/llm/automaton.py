"""Generalised suffix automaton over sequences of hashable symbols.

States are classes of substrings with the same end positions; ``length`` is a
class's longest member and ``link`` the class of its longest proper suffix in
another class. Several sequences share one automaton (each starts at the root).
"""

from __future__ import annotations

from collections.abc import Hashable, Iterable

import numpy as np


class SuffixAutomaton:
    def __init__(self) -> None:
        self.next: list[dict[Hashable, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]

    def _state(self, length: int, link: int, edges: dict) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, q: int, c: Hashable) -> int:
        """Separate from ``q`` the suffixes that also end after ``p`` + ``c``."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: Hashable) -> int:
        q = self.next[last].get(c)
        if q is not None:  # the longer string is already there
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
        cur = self._state(self.length[last] + 1, 0, {})
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
        return cur

    def add(self, sequence: Iterable[Hashable]) -> None:
        last = 0
        for c in sequence:
            last = self._extend(last, c)

    def step(self, state: int, matched: int, c: Hashable) -> tuple[int, int]:
        """State and length of the longest suffix of (match + c) that occurs."""
        while state and c not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        to = self.next[state].get(c)
        return (to, matched + 1) if to is not None else (0, 0)

    def suffix_state(self, state: int, n: int) -> int:
        """The class of the length-``n`` suffix of a match of >= n symbols at ``state``."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def jump_table(self, symbols: int, columns: int) -> JumpTable:
        """For cross-parsing over symbols 0..symbols-1, see ``JumpTable``. The
        symbols below ``columns`` have a column each."""
        return JumpTable(self, symbols, min(columns, symbols))


class JumpTable:
    """The entry of a state (as its row offset) and a symbol is
    ``2 * row offset of the next state + 1 if a phrase ended before the symbol``.

    Where a symbol cannot extend the match, the phrase ends and the parse
    restarts at the root with the symbol. A symbol that occurs nowhere leads to
    one extra state, from which every symbol ends a phrase: it is a phrase
    of its own. At the root (a segment's start) no phrase ends.

    Symbols from ``columns`` on (the rarer ones) are no columns of the dense
    table: what they extend is kept as sorted (state, symbol) keys."""

    def __init__(self, auto: SuffixAutomaton, symbols: int, columns: int) -> None:
        n = len(auto.length)
        self.columns, self.rare = columns, symbols - columns
        assert (n + 1) * columns * 2 < 2**31
        go = np.zeros((n + 1, columns), dtype=np.int32)
        keys, ends = [], []
        self.first = np.full(self.rare, n, dtype=np.int64)   # from the root, by rare symbol
        for s, edges in enumerate(auto.next):
            for c, to in edges.items():
                if c < columns:
                    go[s, c] = to
                else:
                    keys.append(s * columns * self.rare + c - columns)
                    ends.append(to)
                    if not s:
                        self.first[c - columns] = to
        dead = go == 0
        np.copyto(go, np.where(dead[0], n, go[0]), where=dead, casting="same_kind")
        dead[0] = False
        go *= columns * 2
        go += dead
        self.dense = go.ravel()
        order = np.argsort(keys, kind="stable") if keys else np.empty(0, np.int64)
        self.keys = np.append(np.array(keys, dtype=np.int64)[order], np.iinfo(np.int64).max)
        self.ends = (np.append(np.array(ends, dtype=np.int64)[order], 0) * columns * 2).astype(np.int32)
        self.first = (self.first * columns * 2).astype(np.int32)

    def step(self, state: np.ndarray, column: np.ndarray, at: np.ndarray, rare: np.ndarray) -> np.ndarray:
        """Entries for states and symbols: ``column`` has the symbols below
        ``columns`` (anything below it at ``at``), ``rare`` those of ``at``, less ``columns``."""
        to = self.dense[state + column]
        if len(at):
            own = state[at]
            key = own.astype(np.int64) * self.rare + rare
            k = np.searchsorted(self.keys, key)
            to[at] = np.where(self.keys[k] == key, self.ends[k], self.first[rare] + (own > 0))
        return to
