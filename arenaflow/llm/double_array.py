"""Double-array tries over sequences of word numbers, for numpy.

A word number is written in digits of ``RADIX``, so a node has at most ``RADIX`` children.
Two arrays hold the transitions: from state ``s`` the digit ``d`` leads to
``t = base[s] + d`` if ``check[t] == s``.  States are places in the arrays, the
root is place 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BITS = 11
RADIX = 1 << BITS


def digits_of(words: np.ndarray, digits: int) -> np.ndarray:
    """``words`` (n x k) as n x (k * digits) digits, the highest first."""
    shifts = np.arange(digits - 1, -1, -1) * BITS
    return np.concatenate([((column[:, None] >> shifts) & (RADIX - 1)).astype(np.int16) for column in words.T], 1)


@dataclass
class DoubleArray:
    words: int  # words of a phrase
    digits: int  # digits of a word
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray  # row of the phrase that ends in a state, else -1

    @classmethod
    def build(cls, phrases: np.ndarray) -> DoubleArray:
        """``phrases``: n x k distinct rows of word numbers of 1 or more; at least one row."""
        n, k = phrases.shape
        digits = max(1, -(-int(phrases.max(initial=1)).bit_length() // BITS))
        path = digits_of(phrases, digits)
        order = np.lexsort(path.T[::-1])
        path = np.ascontiguousarray(path[order].T)
        place = _Places(4 * RADIX)
        state = np.zeros(n, np.int64)
        base, check = {}, {}
        new = np.zeros(n, bool)
        new[:1] = True
        links = []
        for level in range(k * digits):
            # a child begins where the path up to here changes; its parent's state is known
            child = new.copy()
            child[1:] |= path[level, 1:] != path[level, :-1]
            at = np.flatnonzero(child)
            parent, digit = state[at], path[level, at].astype(np.int64)
            first = np.flatnonzero(np.append(True, new[at][1:]))  # the parents' first children
            of_parent = place.fit(digit, first)
            slot = np.repeat(of_parent, np.diff(np.append(first, len(at)))) + digit
            links.append(tuple(x.astype(np.int32) for x in (parent[first], of_parent, slot, parent)))
            state = np.repeat(slot, np.diff(np.append(at, n)))
            new = child
        size = place.size + RADIX
        base, check, accept = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        for node, of_node, slot, parent in links:
            base[node], check[slot] = of_node, parent
        accept[state] = order
        return cls(k, digits, base, check, accept)

    def find(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ``text`` (word numbers, 0 for none) where a phrase begins, and the phrase's row.

        The states of all places advance together, one digit of one word a step.
        """
        k = self.words
        if len(text) < k:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(text[: len(text) - k + 1])
        state = np.zeros(len(at), np.int64)
        for j in range(k):
            word = text[at + j]
            known = word < 1 << (BITS * self.digits)
            state, at, word = state[known], at[known], word[known]
            for d in range(self.digits - 1, -1, -1):
                step = self.base[state] + ((word >> (d * BITS)) & (RADIX - 1))
                go = self.check[step] == state
                state, at, word = step[go], at[go], word[go]
        return at, self.accept[state].astype(np.int64)


class _Places:
    """Free places of the arrays, found for the children of whole levels of nodes."""

    def __init__(self, size: int):
        self.used, self.size = np.zeros(size, bool), RADIX
        self.used[:RADIX] = True  # the root; no base is below 1

    def _reserve(self, size: int) -> None:
        if size > len(self.used):
            self.used = np.append(self.used, np.zeros(max(size - len(self.used), len(self.used)), bool))

    def fit(self, digit: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A base for each node, whose children's digits begin at ``first``: no two children get one place."""
        size = np.diff(np.append(first, len(digit)))
        base = np.zeros(len(first), np.int64)
        self.low = max(RADIX, self.size - RADIX)
        for node in np.argsort(-size, kind="stable")[: int((size > 1).sum())].tolist():
            base[node] = self._fit_one(digit[first[node] : first[node] + size[node]])
        single = np.flatnonzero(size == 1)
        if len(single):
            self._reserve(self.size + len(single))
            free = np.flatnonzero(~self.used[: self.size + len(single)])[: len(single)]
            self.used[free] = True
            self.size = max(self.size, int(free[-1]) + 1)
            base[single] = free - digit[first[single]]
        return base

    def _fit_one(self, digits: np.ndarray, window: int = 512) -> int:
        """First fit, from where the larger nodes of the level found room (single children fill the holes)."""
        from_first = digits - digits[0]
        while True:
            self._reserve(self.low + window + RADIX)
            fits = ~self.used[self.low : self.low + window]
            for d in from_first[1:].tolist():
                fits &= ~self.used[self.low + d : self.low + d + window]
            at = int(fits.argmax())
            if fits[at]:
                break
            self.low += window
        places = self.low + at + from_first
        self.used[places] = True
        self.size = max(self.size, int(places[-1]) + 1)
        return int(places[0] - digits[0])
