"""Minimal acyclic transducer: sorted words -> their numbers, sharing prefixes and suffixes.

States that accept the same endings are one state, so words share their
suffixes.  Each arc carries a number; the numbers along a word's path add up to
the word's place in sorted order, and that place gives its output (a slice of
token ids).  The whole lexicon is one flat buffer that can be memory-mapped:

    header   8 x uint32: magic, states, arcs, words, ids, root, 0, 0
    first    uint32[states + 1]   first arc of a state
    target   uint32[arcs]         state an arc leads to, times 2, plus 1 if that state accepts
    skip     uint32[arcs]         number added on an arc
    start    uint32[words + 1]    first id of a word
    ids      uint32[ids]          token ids
    label    uint8[arcs]          byte of an arc, ascending within a state
"""

from __future__ import annotations

import mmap
import struct

MAGIC = 0x4D544C31


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """The buffer for words (non-empty) and their ids."""
    words = sorted(w for w in entries if w)
    register: dict[tuple, int] = {}  # finished states by content
    states: list[tuple] = []  # (accepts, ((label, state), ...))

    def finish(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    # the path of the last word: [accepts, finished arcs]; path[i + 1] hangs below path[i] by last[i]
    path: list[list] = [[False, []]]
    last = b""
    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        for i in range(len(last), common, -1):
            node = path.pop()
            path[i - 1][1].append((last[i - 1], finish(node)))
        path.extend([False, []] for _ in range(len(word) - common))
        path[-1][0] = True
        last = word
    for i in range(len(last), 0, -1):
        node = path.pop()
        path[i - 1][1].append((last[i - 1], finish(node)))
    root = finish(path[0])

    below = []  # words accepted from a state on; targets are finished before their sources
    for accepts, arcs in states:
        below.append(accepts + sum(below[t] for _, t in arcs))
    first, target, skip, label = [0], [], [], bytearray()
    for accepts, arcs in states:
        n = int(accepts)
        for byte, t in arcs:
            label.append(byte)
            target.append(2 * t + states[t][0])
            skip.append(n)
            n += below[t]
        first.append(len(target))
    start, ids = [0], []
    for word in words:
        ids.extend(entries[word])
        start.append(len(ids))
    numbers = [MAGIC, len(states), len(target), len(words), len(ids), root, 0, 0, *first, *target, *skip, *start, *ids]
    return struct.pack(f"<{len(numbers)}I", *numbers) + bytes(label)


class Lexicon:
    """A compiled lexicon, from a buffer or a memory-mapped file."""

    def __init__(self, buffer):
        self.buffer = buffer
        magic, states, arcs, words, ids, self.root, _, _ = struct.unpack_from("<8I", buffer)
        if magic != MAGIC:
            raise ValueError("not a lexicon")
        at, view = 32, memoryview(buffer)
        parts = []
        for n in (states + 1, arcs, arcs, words + 1, ids):
            parts.append(view[at : at + 4 * n].cast("I"))
            at += 4 * n
        self.first, self.target, self.skip, self.start, _ = parts
        self.ids_at, self.label_at, self.size = at - 4 * ids, at, words

    @classmethod
    def mapped(cls, path: str) -> Lexicon:
        with open(path, "rb") as fh:
            return cls(mmap.mmap(fh.fileno(), 0, access=mmap.ACCESS_READ))

    def number(self, word: bytes) -> int:
        """The word's place in sorted order, -1 if the lexicon lacks it."""
        find, first, base = self.buffer.find, self.first, self.label_at
        state, total, accepts = self.root, 0, 0
        for i in range(len(word)):
            arc = find(word[i : i + 1], base + first[state], base + first[state + 1]) - base
            if arc < 0:
                return -1
            total += self.skip[arc]
            state, accepts = divmod(self.target[arc], 2)
        return total if accepts else -1

    def ids(self, word: bytes) -> bytes | None:
        """The word's ids as little-endian unsigned 32-bit integers."""
        n = self.number(word)
        if n < 0:
            return None
        return self.buffer[self.ids_at + 4 * self.start[n] : self.ids_at + 4 * self.start[n + 1]]
