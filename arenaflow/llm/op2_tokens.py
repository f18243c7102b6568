"""Operator 2, token counts by a two-tier map-side lookup.

Tier 1: a compact table ``hash of a frequent pre-token -> its number of tokens``
is broadcast (12 bytes an entry, at most ``table_words`` words' pre-tokens).
Tier 2: a pre-token that the table lacks is merged once and kept in the Python
worker's cache (bounded).  No pre-token is shuffled.

The table comes from the most frequent words over all documents and changes only
the speed; every count is the library's own count for the whole text.  (Table
keys are 64-bit hashes: two pre-tokens with one hash would share a count, at
odds of about 5e-9 per 10^11 different pre-tokens and table entry.)

Defined cases: a NULL text counts as empty (0 bytes, 0 tokens); special strings
inside a text are one token each, as the library's default has it; texts of any
length are counted whole; exactly ``limit`` tokens are not over it; repeated rows each get their row; an empty table gives
an empty result; extra columns, whatever their names, are ignored.  Words with characters from
``PLAIN_LIMIT`` on are counted by the library (see ``bpe.py``).
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaflow.llm.bpe import NOT_PLAIN, WordBpe
from arenaflow.llm.common import WORKER_CACHE, frequent_words, map_rows, once

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
     T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
)


def pretoken_table(bpe: WordBpe, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and token counts of the pre-tokens of ``words``."""
    seen = {p for w in words if not NOT_PLAIN.search(w) for s in bpe.segments(w)[::2] for p in bpe.pretokens(s)}
    rows = sorted((xxhash.xxh3_64_intdigest(p), len(bpe.word_ids(p))) for p in seen)
    return np.array([h for h, _ in rows], np.uint64), np.array([n for _, n in rows], np.uint32)


class Lengths(dict):
    """Number of tokens of a pre-token: worker cache, then broadcast table, then the merges."""

    def __init__(self, bpe: WordBpe, hashes: np.ndarray, counts: np.ndarray):
        super().__init__()
        self.bpe = bpe
        self.table = dict(zip(hashes.tolist(), counts.tolist(), strict=True))

    def __missing__(self, word: str) -> int:
        n = self.table.get(xxhash.xxh3_64_intdigest(word))
        if n is None:
            n = len(self.bpe.word_ids(word))
        if len(self) >= WORKER_CACHE:
            self.clear()
        self[word] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of a whole text."""
        total = 0
        for far, part in self.bpe.parts(text):
            if far:
                total += len(self.bpe.library_ids(part))
            else:
                segments = self.bpe.segments(part)
                total += len(segments) // 2 + sum(sum(map(self.__getitem__, self.bpe.pretokens(s))) for s in segments[::2])
        return total


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, table_words: int = 50_000) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit`` (more than ``limit`` tokens).

    ``tokenizer`` is the path of a ``tokenizers`` JSON file, present on every machine.
    """
    spark = docs.sparkSession
    words = frequent_words(docs, table_words, lower=True)
    entries = pretoken_table(WordBpe(tokenizer), words)
    key = xxhash.xxh3_64_hexdigest(entries[0].tobytes())
    table = spark.sparkContext.broadcast(entries)

    def start():
        lengths = once(("lengths", tokenizer, key), lambda: Lengths(WordBpe(tokenizer), *table.value))

        def one(row):
            text = row[1] or ""
            n = lengths.count(text)
            yield row[0], len(text.encode()), n, n > limit

        return one

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), start, SCHEMA)
