"""Operator 3, benchmark decontamination by BM25 retrieval and overlap checks.

The benchmark items are the index (``blockmax.py``); every passage of every
document is a query.  A passage is a window of words, twice as long as the longest
item, every item length; so each copy of an item lies whole in some passage.  All
items above the threshold are retrieved, first by block bounds for all passages
of a document at once, then by block-max WAND, and a hit counts if the passage
has enough of the item's question and of its answer (three-word shingles).

The index is broadcast.  Its size is bounded: the items are split by hash into
blocks of about ``shard_items`` items and ``shard_bytes`` bytes, and the documents
are searched against one block after the other, each collected, broadcast and given up
before the next.  What a score depends on (document frequencies, number and mean length of the items, longest
item) is taken once over the whole benchmark in Spark, so the blocks change no score and no hit.

Question and answer: an item's answer is its last sentence, the question what
comes before it; an item of one sentence is split in the middle.

Ties: of equally good passages of an item the first one's figures count.  Texts of any length are searched
whole, in memory of a few times their size.

Defined cases: an item that is NULL or has no words is never found; a NULL or empty text
matches nothing; equal items are found each under its own id (NULL if it has none); repeated documents
give repeated rows; an empty table on either side gives no hits; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaflow.llm.blockmax import BlockMaxIndex, Collection
from arenaflow.llm.common import filter_texts, map_rows, materialize, once
from arenaflow.operators.sizing import materialize_at, remove_folder

WORDS = re.compile(r"\w+")
SENTENCES = re.compile(r"(?<=[.!?])\s+|\n+")
SHINGLE = 3
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
     T.StructField("question_overlap", T.DoubleType()), T.StructField("answer_overlap", T.DoubleType())]
)


def text_words(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def shingles(words: list[str]) -> set[tuple]:
    n = min(SHINGLE, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def split_item(text: str) -> tuple[list[str], list[str]]:
    """Words of the question and of the answer."""
    parts = [w for w in map(text_words, SENTENCES.split(text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = parts[0] if parts else []
    return words[: (len(words) + 1) // 2], words[(len(words) + 1) // 2 :]


def overlap(wanted: set[tuple], have: set[tuple], words: list[str]) -> float:
    """Share of the wanted shingles that are there; 1 if nothing is wanted."""
    if not wanted:
        return 1.0
    n = len(next(iter(wanted)))
    if n < SHINGLE:  # a part of one or two words
        have = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
    return len(wanted & have) / len(wanted)


@dataclass(frozen=True)
class Block:
    """A part of the benchmark, and the statistics of the whole that its words need."""

    items: list[tuple[int | None, str]]
    collection: Collection
    longest: int

    def key(self) -> str:
        frequency = sorted(self.collection.frequency.items())
        return xxhash.xxh3_64_hexdigest(repr((self.items, self.collection.items, self.collection.mean, frequency, self.longest)))


class Searcher:
    """Finds the items of one index block in whole documents."""

    def __init__(self, block: Block, threshold: float, least_overlap: float):
        kept = [(i, text, words) for i, text in block.items if (words := text_words(text))]
        self.ids = [i for i, _, _ in kept]
        self.parts = [tuple(map(shingles, split_item(text))) for _, text, _ in kept]
        self.step = block.longest
        self.index = BlockMaxIndex([w for _, _, w in kept], block.collection) if kept else None
        self.threshold, self.least = threshold, least_overlap

    @classmethod
    def of(cls, items: list[tuple[int | None, str]], threshold: float, least_overlap: float) -> Searcher:
        """A searcher for items that are the whole benchmark."""
        words = [w for _, text in items if (w := text_words(text))]
        return cls(Block(items, Collection.of(words), max(map(len, words), default=1)), threshold, least_overlap)

    def __call__(self, text: str | None) -> list[tuple[int, float, float, float]]:
        """(item id, score, question overlap, answer overlap), the best passage of each item."""
        words = text_words(text)
        if not words or self.index is None:
            return []
        numbers = self.index.numbers(words)
        known = np.flatnonzero(numbers >= 0)
        if not len(known):
            return []
        # window k covers the words [k * step, (k + 2) * step); each word lies in two windows
        windows = (len(words) + self.step - 1) // self.step
        block = known // self.step
        window = np.concatenate([block, np.maximum(block - 1, 0)])
        term = np.concatenate([numbers[known], numbers[known]])
        best: dict[int, tuple[int, float, float, float]] = {}
        for k in self.index.may_reach(window, term, windows, self.threshold).tolist():
            start, end = k * self.step, (k + 2) * self.step
            hits = self.index.search(set(numbers[start:end].tolist()), self.threshold)
            if not hits:
                continue
            passage = words[start:end]
            have = shingles(passage)
            for item, score in hits:
                question, answer = (overlap(p, have, passage) for p in self.parts[item])
                row = (self.ids[item], score, question, answer)
                if min(question, answer) >= self.least and (item not in best or row[1:] > best[item][1:]):
                    best[item] = row
        return [best[item] for item in sorted(best)]


ITEMS = T.StructType(
    [T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()),
     T.StructField("words", T.ArrayType(T.StringType()))]
)


def _item_words(row: tuple) -> list[tuple]:
    words = text_words(row[1])
    return [(row[0], row[1], len(words), sorted(set(words)))] if words else []


def benchmark_blocks(benchmark: DataFrame, shard_items: int, shard_bytes: int) -> Iterator[Block]:
    """The benchmark in blocks of bounded size, one collected at a time, each with the whole benchmark's
    statistics of its words."""
    rows = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = materialize(map_rows(rows, lambda: _item_words, ITEMS), "benchmark-items")
    size = items.agg(
        F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.sum("n_words").alias("words"), F.max("n_words").alias("longest")
    ).first()
    if not size["n"]:
        return
    frequency = materialize(items.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")), "benchmark-words")
    blocks = max(-(-size["n"] // shard_items), -(-size["bytes"] // shard_bytes))
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        found = sorted(((r["item_id"], r["text"]) for r in own.select("item_id", "text").collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        known = own.select(F.explode("words").alias("word")).distinct().join(frequency, "word").collect()
        if found:
            yield Block(found, Collection(size["n"], size["words"] / size["n"], {r["word"]: r["n"] for r in known}), size["longest"])


def contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, least_overlap: float = 0.5,
    shard_items: int = 20_000, shard_bytes: int = 16 << 20,
) -> DataFrame:
    """``doc_id``, ``item_id``, ``score`` (share of the item's own BM25 score), ``question_overlap``,
    ``answer_overlap``: one row for each document and item found in it, with its best passage."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    found = []
    for block in benchmark_blocks(benchmark, shard_items, shard_bytes):
        searcher, shared = _searcher(rows, block, threshold, least_overlap)

        def start(searcher=searcher):
            search = searcher()
            return lambda row: [(row[0], *hit) for hit in search(row[1])]

        found.append(materialize(map_rows(rows, start, SCHEMA), "contaminated"))
        shared.unpersist()
    return reduce(DataFrame.unionAll, found) if found else docs.sparkSession.createDataFrame([], SCHEMA)


def _searcher(docs: DataFrame, block: Block, threshold: float, least_overlap: float):
    shared = docs.sparkSession.sparkContext.broadcast(block)
    key = ("benchmark", block.key(), threshold, least_overlap)
    return (lambda: once(key, lambda: Searcher(shared.value, threshold, least_overlap))), shared


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = 0.5, least_overlap: float = 0.5,
    shard_items: int = 20_000, shard_bytes: int = 16 << 20,
) -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns as they are.

    A filter where the rows lie: each index block takes out what it finds.  Between two blocks the rows left are
    written, so that a worker holds one block's index; the rows before them are removed then.
    """
    spark, last, folder, used = docs.sparkSession, None, None, None
    for block in benchmark_blocks(benchmark, shard_items, shard_bytes):
        if last is not None:
            docs, written = materialize_at(last, "decontaminated")
            used.unpersist()
            if folder is not None:
                remove_folder(spark, folder)
            folder = written
        searcher, used = _searcher(docs, block, threshold, least_overlap)

        def start(searcher=searcher):
            search = searcher()
            return lambda text: not search(text)

        last = filter_texts(docs, start)
    return docs if last is None else last
