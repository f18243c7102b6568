"""Byte-pair merges of a public tokenizer file (``tokenizers`` JSON), word by word."""

from __future__ import annotations

import json
import re
from itertools import groupby

import regex
from tokenizers import Tokenizer

# Words whose characters all lie below this code point take the word-by-word
# route (the tests compare it with the library over every one of them); words
# with any other character are encoded by the library itself, whose Unicode
# tables may be of another version than Python's.
PLAIN_LIMIT = 0x0250
NOT_PLAIN = re.compile(f"[^\x00-{chr(PLAIN_LIMIT - 1)}]")
# A text may be cut before a space that follows a printable ASCII character: no
# pre-token and no normalization of the known forms reaches across.
CUT = re.compile(r"(?<=[!-~])(?= )")

# The pre-token pattern and the normalizer of the two tokenizer kinds.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LOWER_CASE = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]


def plain_pattern(pattern: str) -> re.Pattern:
    """The pattern for texts of plain characters alone, its classes (``\\p{L}``, ``\\p{N}``, ``\\s``) written out."""
    plain = [chr(c) for c in range(PLAIN_LIMIT)]
    members = {name: "".join(map(re.escape, filter(regex.compile(name).fullmatch, plain))) for name in (r"\p{L}", r"\p{N}", r"\s")}
    out, inside = [], False
    for token in re.findall(r"\\p\{\w\}|\\.|.", pattern):
        if token in members:
            token = members[token] if inside else f"[{members[token]}]"
        elif token == r"\S":
            token = f"[^{members[r'\s']}]"
        elif token in "[]":
            inside = token == "["
        out.append(token)
    return re.compile("".join(out))


def _form(data: dict) -> tuple[bool, str]:
    """Whether the tokenizer file lower-cases, and its pre-token pattern; an error for any form not known here."""
    normalizer, pre = data["normalizer"], data["pre_tokenizer"] or {}
    if data["model"]["type"] == "BPE" and normalizer is None and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
        return False, BYTE_LEVEL_PATTERN
    steps = pre.get("pretokenizers", [])
    if (
        normalizer == {"type": "Sequence", "normalizers": LOWER_CASE}
        and [s["type"] for s in steps] == ["Split", "ByteLevel"]
        and (steps[0]["behavior"], steps[0]["invert"], steps[1]["use_regex"], steps[1]["add_prefix_space"]) == ("Removed", True, False, False)
    ):
        return True, steps[0]["pattern"]["Regex"]
    raise ValueError(f"unknown form of tokenizer: normalizer {normalizer}, pre-tokenizer {pre}")


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    printable Latin-1 bytes stand for themselves, the rest follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table, extra = [""] * 256, 0
    for b in range(256):
        if b in own:
            table[b] = chr(b)
        else:
            table[b] = chr(0x100 + extra)
            extra += 1
    return table


class WordBpe:
    """Exact ids of one pre-token, by the merges of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as fh:
            data = json.load(fh)
        model = data["model"]
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.vocab: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.lower, pattern = _form(data)
        self.pattern = plain_pattern(pattern)
        self.chars = byte_chars()
        self.by_byte = str.maketrans(dict(enumerate(self.chars)))

    def word_ids(self, word: str) -> list[int]:
        """Ids of a pre-token, by the library's merges of that one word."""
        mapped = word.encode().decode("latin-1").translate(self.by_byte)
        return [t.id for t in self.library.model.tokenize(mapped)]

    def parts(self, text: str) -> list[tuple[bool, str]]:
        """The text cut where that is safe; True marks parts that are left to :meth:`library_ids`."""
        if not NOT_PLAIN.search(text):
            return [(False, text)]
        return [(far, "".join(run)) for far, run in groupby(CUT.split(text), lambda x: NOT_PLAIN.search(x) is not None)]

    def segments(self, text: str) -> list[str]:
        """The text cut at special strings; odd places hold the special strings."""
        return self.split_special.split(text) if self.split_special else [text]

    def pretokens(self, segment: str) -> list[str]:
        """Pre-tokens of a plain segment (see ``PLAIN_LIMIT``) without special strings."""
        return self.pattern.findall(segment.lower() if self.lower else segment)

    def library_ids(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def id_bytes(self) -> list[bytes]:
        """The bytes of each id of a byte-level vocabulary; a special token is its own text."""
        back = {c: b for b, c in enumerate(self.chars)}
        table = [b""] * (max(max(self.vocab.values()), *self.special.values(), 0) + 1)
        for token, i in self.vocab.items():
            table[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            table[i] = token.encode()
        return table
