"""BM25 inverted index of a bounded set of items, searched by block-max WAND.

Scores are shares of an item's own score (the item as its own query), so one
threshold suits items of any length.  Postings are ordered by item and cut into
blocks of ``BLOCK`` consecutive items; each term knows its greatest score overall and in
each block, which bounds what a passage can score there.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np

BLOCK = 2
K1, B = 1.2, 0.75
# Terms in more than this share of the items are bounded once for all passages.
COMMON = 0.05


# Room for rounding in the bounds, so that no item right at the threshold is lost.
SLACK = 1e-9
# (window, posting block) pairs that are looked at together: some tens of MB.
PAIRS = 1_000_000


@dataclass(frozen=True)
class Collection:
    """Statistics of all items: their number, mean length in words, and in how many of them a word stands."""

    items: int
    mean: float
    frequency: Mapping[str, int]

    @classmethod
    def of(cls, items: list[list[str]]) -> Collection:
        return cls(len(items), sum(map(len, items)) / max(1, len(items)), Counter(t for words in items for t in set(words)))


class BlockMaxIndex:
    def __init__(self, items: list[list[str]], collection: Collection | None = None):
        """``items``: the words of each item, none empty; ``collection``: all items' statistics, by default these items'."""
        counts = [Counter(words) for words in items]
        collection = collection or Collection.of(items)
        n, mean, df = collection.items, collection.mean, {t: collection.frequency[t] for c in counts for t in c}
        idf = {t: math.log(1 + (n - f + 0.5) / (f + 0.5)) for t, f in df.items()}
        self.items, self.blocks, self.all_items = len(items), (len(items) + BLOCK - 1) // BLOCK, n
        self.terms = {t: i for i, t in enumerate(sorted(df))}
        postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        for item, (words, c) in enumerate(zip(items, counts, strict=True)):
            norm = K1 * (1 - B + B * len(words) / mean)
            parts = {t: idf[t] * f * (K1 + 1) / (f + norm) for t, f in c.items()}
            own = math.fsum(parts.values())
            for t, score in parts.items():
                postings[self.terms[t]].append((item, score / own))
        self.postings = postings
        self.block_max: list[dict[int, float]] = []
        for plist in postings:
            best: dict[int, float] = {}
            for item, score in plist:
                best[item // BLOCK] = max(best.get(item // BLOCK, 0.0), score)
            self.block_max.append(best)
        self.top = [max(best.values()) for best in self.block_max]
        self._bounds(df)

    def _bounds(self, df: Mapping[str, int]) -> None:
        """Arrays for :meth:`may_reach`: the rarer terms' block maxima, and per block the most that
        the common terms can add to one of its items."""
        common = {self.terms[t] for t, f in df.items() if f > max(1, COMMON * self.all_items)}
        rest = np.zeros(max(1, self.items))
        first, block, score = [0], [], []
        for t, plist in enumerate(self.postings):
            if t in common:
                for item, s in plist:
                    rest[item] += s
            else:
                block += self.block_max[t].keys()
                score += self.block_max[t].values()
            first.append(len(block))
        self.first, self.block, self.score = np.array(first), np.array(block, np.int64), np.array(score)
        self.rest = np.array([rest[i * BLOCK : (i + 1) * BLOCK].max() for i in range(self.blocks)])

    def numbers(self, words: list[str]) -> np.ndarray:
        """Term number of each word, -1 for words that no item has."""
        get = self.terms.get
        return np.fromiter((get(w, -1) for w in words), np.int64, len(words))

    def may_reach(self, window: np.ndarray, term: np.ndarray, windows: int, threshold: float) -> np.ndarray:
        """Windows in which some block's bound reaches the threshold, from (window, term) pairs.

        The pairs are taken in runs of whole windows with about ``PAIRS`` posting blocks, so a text of any
        length needs no more memory than its words and one run.
        """
        least = threshold - SLACK
        if (self.rest >= least).any():  # common terms alone might do: bound nothing away
            return np.arange(windows)
        pair = np.unique(window * len(self.postings) + term)
        window, term = np.divmod(pair, len(self.postings))
        size = self.first[term + 1] - self.first[term]
        have = size > 0
        window, term, size = window[have], term[have], size[have]
        if not len(size):
            return np.zeros(0, np.int64)
        run = np.cumsum(size) // PAIRS
        starts = np.flatnonzero(np.append(True, window[1:] != window[:-1]))  # where a window begins
        cuts = starts[np.flatnonzero(np.append(True, run[starts][1:] != run[starts][:-1]))]
        hot = [self._hot(window[i:j], term[i:j], size[i:j], least) for i, j in zip(cuts, np.append(cuts[1:], len(size)), strict=True)]
        return np.concatenate(hot)

    def _hot(self, window: np.ndarray, term: np.ndarray, size: np.ndarray, least: float) -> np.ndarray:
        ends = np.cumsum(size)
        at = np.repeat(self.first[term] - ends + size, size) + np.arange(ends[-1])
        key = np.repeat(window, size) * self.blocks + self.block[at]
        keys, place = np.unique(key, return_inverse=True)
        bound = np.bincount(place, self.score[at]) + self.rest[keys % self.blocks]
        return np.unique(keys[bound >= least] // self.blocks)

    def search(self, terms: set[int], threshold: float) -> list[tuple[int, float]]:
        """All (item, score) with score >= threshold, by block-max WAND."""
        lists = [[self.postings[t], 0, self.top[t], self.block_max[t]] for t in terms if t >= 0]
        found = []
        while lists:
            lists.sort(key=lambda x: x[0][x[1]][0])
            bound, pivot = 0.0, -1
            for k, x in enumerate(lists):
                bound += x[2]
                if bound >= threshold - SLACK:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = lists[pivot][0][lists[pivot][1]][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0][lists[pivot + 1][1]][0] == item:
                pivot += 1
            block = item // BLOCK
            if sum(x[3].get(block, 0.0) for x in lists[: pivot + 1]) < threshold - SLACK:
                # no item of this block before the next list's item can reach it
                target = (block + 1) * BLOCK
                if pivot + 1 < len(lists):
                    target = min(target, lists[pivot + 1][0][lists[pivot + 1][1]][0])
                target = max(target, item + 1)
                moved = lists[: pivot + 1]
            elif lists[0][0][lists[0][1]][0] == item:
                score = math.fsum(x[0][x[1]][1] for x in lists[: pivot + 1])  # the same in whatever order the lists are
                if score >= threshold:
                    found.append((item, score))
                target, moved = item + 1, lists[: pivot + 1]
            else:
                target, moved = item, [x for x in lists[:pivot] if x[0][x[1]][0] < item]
            for x in moved:
                plist, at = x[0], x[1]
                while at < len(plist) and plist[at][0] < target:
                    at += 1
                x[1] = at
            lists = [x for x in lists if x[1] < len(x[0])]
        return sorted(found)
