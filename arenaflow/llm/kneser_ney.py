"""Interpolated Kneser-Ney character model in sorted hash arrays.

A gram of up to four characters is one 64-bit number, 16 bits a character.  The
model of a language holds, for each order, the sorted grams with their
probability and the sorted histories with their back-off weight.
"""

from __future__ import annotations

import numpy as np

ORDER, BITS, SPACE, BEYOND = 4, 16, 0x20, 0xFFFF
_CLASSES: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """Character code -> its symbol: letters stand for themselves, all else is a space."""
    if not _CLASSES:
        table = np.full(0x10000, SPACE, np.uint64)
        letters = [i for i in range(0x10000) if chr(i).isalpha()]
        table[letters] = letters
        _CLASSES.append(table)
    return _CLASSES[0]


def symbols(text: str) -> np.ndarray:
    """The text's letters in lower case, any other characters between them as one
    space, with a space before and after; letters past U+FFFF are one symbol.
    Empty if the text has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    beyond = codes >= 0x10000
    out = _classes()[np.where(beyond, SPACE, codes)]
    if beyond.any():
        far = [i for i in np.flatnonzero(beyond) if chr(codes[i]).isalpha()]
        out[far] = BEYOND
    space = out == SPACE
    if space.all():
        return out[:0]
    keep = ~space
    keep[1:] |= ~space[:-1]  # the first space after a letter stays
    keep[0] = not space[0]
    out = out[keep]
    tail = [] if out[-1] == SPACE else [SPACE]
    return np.concatenate([[SPACE], out, tail]).astype(np.uint64)


def grams(symbols_: np.ndarray) -> np.ndarray:
    """One gram per symbol after the first: up to ``ORDER`` symbols ending there, padded with spaces in front."""
    padded = np.concatenate([np.full(ORDER - 2, SPACE, np.uint64), symbols_])
    n = len(padded) - ORDER + 1
    out = np.zeros(n, np.uint64)
    for i in range(ORDER):
        out = (out << np.uint64(BITS)) | padded[i : i + n]
    return out


def _suffix(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & np.uint64((1 << (BITS * order)) - 1) if order < 4 else keys


def _lookup(table: np.ndarray, values: np.ndarray, keys: np.ndarray, missing: float) -> np.ndarray:
    if not len(table):
        return np.full(len(keys), missing)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, values[at], missing)


class KneserNey:
    """Model of one language, from its grams of full order and their counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, alphabet: int = 1 << 12):
        order_of = np.argsort(keys)
        keys, counts = keys[order_of].astype(np.uint64), counts[order_of].astype(np.float64)
        levels = {ORDER: (keys, counts)}
        for order in range(ORDER - 1, 0, -1):  # continuation counts: different symbols seen before
            levels[order] = tuple(np.unique(_suffix(levels[order + 1][0], order), return_counts=True))
        self.levels: dict[int, tuple] = {}
        self.floor = 1.0 / alphabet
        for order in range(1, ORDER + 1):
            grams_, n = levels[order]
            n = n.astype(np.float64)
            ones, twos = float((n == 1).sum()), float((n == 2).sum())
            discount = ones / (ones + 2 * twos) if ones and twos else 0.5
            history = grams_ >> np.uint64(BITS)
            heads, at = np.unique(history, return_inverse=True)
            total = np.bincount(at, n)
            kinds = np.bincount(at).astype(np.float64)
            backoff = discount * kinds / total
            lower = self._probability(grams_, order - 1)
            p = np.maximum(n - discount, 0) / total[at] + backoff[at] * lower
            self.levels[order] = (grams_, p, heads, backoff)

    def _probability(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Interpolated probability of each gram's last symbol given the ``order - 1`` before it."""
        if order == 0:
            return np.full(len(keys), self.floor)
        keys = _suffix(keys, order)
        table, p, heads, backoff = self.levels[order]
        out = _lookup(table, p, keys, -1.0)
        unseen = np.flatnonzero(out < 0)
        if len(unseen):
            weight = _lookup(heads, backoff, keys[unseen] >> np.uint64(BITS), 1.0)
            out[unseen] = weight * self._probability(keys[unseen], order - 1)
        return out

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """Cost of each gram's last symbol in bits."""
        return -np.log2(self._probability(keys, ORDER))
