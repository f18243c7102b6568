"""Operator 13, phrase collocations counted by broadcast double-array tries.

1. Texts become word numbers.  A task gathers documents into *chunks* of about
   ``chunk_words`` words with a dictionary of their own; only the dictionaries are shuffled, to
   count every word of every language and to number those with at least ``least`` occurrences
   (a phrase with as many has no rarer word).  The numbers are broadcast in shards of
   ``shard_words`` words and put into the chunks' dictionaries where these lie.
2. Level by level, k = 2, 3, 4: the Apriori-safe candidates (their first k - 1 words are a frequent
   phrase, their last word is frequent, and the sums of what the chunks hold reach ``least``) are
   cut by hash into *shards* of about ``shard_phrases`` phrases.  Each shard is compiled into a
   double-array trie (``double_array.py``) and broadcast; numpy advances the states of all places of
   a chunk together, word by word, and ``bincount`` over the accepting states counts the phrases.  A pass also
   gathers what may follow the phrases it finds, the candidates of the next level.  The tasks' counts are summed.
3. Cuts, scores, contained phrases and ranks are joins and aggregations over the counted phrases.

A trie of n phrases has at most n states for each digit of its words (two a word up to 4,000,000 frequent words), in
arrays of less than twice as many places, so each broadcast is bounded by ``shard_phrases``; a larger corpus takes more shards, one pass each, by the same plan.

Defined cases: a NULL text counts as empty, a NULL lang as ``und``; pieces and phrases never
reach across documents; equal scores go by count, then by the phrase; repeated rows
count each time; an empty table gives an empty result; extra columns, whatever their
names, are not looked at.  Scores are computed in decimals, so no product overflows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from arenaflow.llm.common import materialize, once, small_batches
from arenaflow.llm.double_array import DoubleArray
from arenaflow.operators.sizing import materialize_at, remove_folder
from arenaflow.session import ship_package

LONGEST = 4
UND = "und"
# The signs that end a piece, and white space within one.
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_FOLD = bytes.maketrans(
    bytes(range(65, 91)) + PIECE_ENDS + BLANKS, bytes(range(97, 123)) + b"\n" * len(PIECE_ENDS) + b" " * len(BLANKS)
)
_TOKEN = re.compile(rb"\n|[^ \n]+")
_SLICE = 1 << 20  # bytes of a long text that are split into words at a time
PART = 250_000  # numbers of a chunk that are searched for phrases at a time

CHUNKS = T.StructType(
    [T.StructField("places", T.BinaryType()), T.StructField("langs", T.ArrayType(T.StringType())),
     T.StructField("words", T.ArrayType(T.StringType())), T.StructField("times", T.ArrayType(T.LongType()))]
)
NUMBERED = T.StructType([T.StructField("width", T.LongType()), T.StructField("numbers", T.BinaryType())])
FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("phrase", "next", "n")])
TRIES = T.StructType([T.StructField("shard", T.LongType()), T.StructField("digits", T.LongType())] + [T.StructField(n, T.BinaryType()) for n in ("base", "check", "accept", "ids")])


def words_of(text: str | None) -> Iterator[bytes]:
    """Words of a text in order, lower-cased, with a line end wherever a piece ends."""
    data = text.encode().translate(_FOLD) if text else b""
    start = 0
    while start < len(data):
        end = data.find(b" ", start + _SLICE)
        end = len(data) if end < 0 else end
        yield from _TOKEN.findall(data, start, end)
        start = end


class _Chunk:
    """The words of some documents as places in a dictionary; 0 is the end of a piece."""

    def __init__(self):
        self.langs: dict[str, dict[bytes, int]] = {}
        self.entry_langs: list[str] = []
        self.entry_words: list[bytes] = []
        self.places: list[np.ndarray] = []
        self.size = self.bytes = 0

    def add(self, lang: str, text: str | None) -> None:
        known = self.langs.setdefault(lang, {b"\n": 0})
        out = []
        for word in words_of(text):
            place = known.get(word)
            if place is None:
                self.entry_langs.append(lang)
                self.entry_words.append(word)
                place = known[word] = len(self.entry_words)
                self.bytes += len(word)
            out.append(place)
        self.places.append(np.array([*out, 0], "<u4"))
        self.size += len(out) + 1

    def row(self) -> tuple[pa.Array, ...]:
        places = np.concatenate(self.places)
        times = np.bincount(places, minlength=len(self.entry_words) + 1)[1:]
        words = pa.array(self.entry_words, pa.binary()).cast(pa.string())
        return _one_binary(places), *(_one_list(x) for x in (pa.array(self.entry_langs, pa.string()), words, pa.array(times, pa.int64())))


def _one_binary(values: np.ndarray) -> pa.Array:
    """One binary value that is the array's memory, not a copy."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, values.nbytes], np.int32)), pa.py_buffer(values)])


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def text_chunks(docs: DataFrame, chunk_words: int) -> tuple[DataFrame, str]:
    """One row a chunk: word places (0 ends a piece) and the chunk's dictionary with its counts; written, with its folder."""
    ship_package(docs.sparkSession)
    schema = to_arrow_schema(CHUNKS)

    def batch_of(chunk: _Chunk) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([v.cast(f.type) for v, f in zip(chunk.row(), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk()
        for batch in batches:
            for k in range(0, batch.num_rows, 200):  # few texts at a time as Python objects
                for lang, text in zip(*(c.to_pylist() for c in batch.slice(k, 200).columns), strict=True):
                    chunk.add(lang, text)
                    if chunk.size >= chunk_words or chunk.bytes >= 8 * chunk_words:
                        yield batch_of(chunk)
                        chunk = _Chunk()
        if chunk.size:
            yield batch_of(chunk)
        pa.default_memory_pool().release_unused()  # the worker serves later stages too

    return materialize_at(docs.select(F.coalesce("lang", F.lit(UND)), "text").mapInArrow(run, CHUNKS), "phrase-chunks", large_rows=True)


def numbered(rows: DataFrame, name: str, purpose: str) -> DataFrame:
    """``rows``, written, with a number from 1 on and without gaps in the column ``name``.

    The numbers follow the written partitions; the driver sees one count of each.
    """
    spark = rows.sparkSession
    written = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("_row", 33)
    sizes = {r["part"]: r["n"] for r in written.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, starts = 0, []
    for p in sorted(sizes):
        starts.append((p, before))
        before += sizes[p]
    # from an Arrow table, since a list goes through Python workers of another kind, which stay beside those in use
    firsts = spark.createDataFrame(pa.table({k: pa.array(v, pa.int64()) for k, v in (("_part", [p for p, _ in starts]), ("_before", [n for _, n in starts]))}))
    return written.join(F.broadcast(firsts), part == F.col("_part")).select(
        *rows.columns, (F.col("_before") + F.col("_row").bitwiseAND((1 << 33) - 1) + 1).alias(name)
    )


def number_texts(chunks: DataFrame, frequent: DataFrame, shard_words: int) -> DataFrame:
    """The chunks' texts in the numbers of the frequent words, of ``width`` bytes each; 0 for others and for ends
    of pieces, runs of 0 once; written.

    The vocabulary goes out in shards of ``shard_words`` words, one after the other.  Each numbers its words in the chunks'
    dictionaries where these lie; nothing is shuffled.  Shards and dictionaries stay Arrow arrays in the tasks, which
    take a few bytes a word beside its letters.
    """
    spark = chunks.sparkSession
    ship_package(spark)
    last = frequent.agg(F.max("number")).first()[0] or 0
    rows, folder = chunks.select("places", "langs", "words", F.lit(b"").alias("known")), None
    for first in range(1, max(last, 1) + 1, shard_words):
        shard = frequent.where(F.col("number").between(first, first + shard_words - 1)).select("lang", "word", "number").toArrow()  # one shard
        shard = shard.sort_by("number")
        entries = _entries(shard["lang"].combine_chunks(), shard["word"].combine_chunks())
        shared, key, final = spark.sparkContext.broadcast(entries), uuid.uuid4().hex, first + shard_words > last
        del shard, entries
        schema = NUMBERED if final else rows.schema
        arrow = to_arrow_schema(schema)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, key=key, first=first, final=final, arrow=arrow) -> Iterator[pa.RecordBatch]:
            vocabulary = once(("vocabulary", key), lambda: shared.value, tables=1)
            for batch in batches:
                for k in range(batch.num_rows):
                    row = batch.slice(k, 1)
                    places, langs, words, known = (c[0] for c in row.columns)
                    at = pc.index_in(_entries(langs.values, words.values), value_set=vocabulary).cast(pa.int64())
                    number = pc.fill_null(pc.add(at, first), 0).to_numpy(zero_copy_only=False)
                    if known.as_py():
                        number = number + np.frombuffer(known.as_buffer(), "<i8")
                    if final:
                        yield from _numbered_rows(np.append(0, number)[np.frombuffer(places.as_buffer(), "<u4")], arrow)
                    else:
                        yield pa.RecordBatch.from_arrays([*row.columns[:3], pa.array([number.tobytes()], pa.binary())], schema=arrow)
            pa.default_memory_pool().release_unused()

        rows, written = materialize_at(rows.mapInArrow(run, schema), "phrase-texts", large_rows=True)
        shared.destroy()  # written, so nothing reads it again; the driver holds its blocks until then
        if folder is not None:
            remove_folder(spark, folder)
        folder = written
    return rows


def _entries(langs: pa.Array, words: pa.Array) -> pa.Array:
    """Language and word as one text each; no word holds a line end, so none stands for two pairs."""
    text = pa.large_string()
    return pc.binary_join_element_wise(langs.cast(text), words.cast(text), pa.scalar("\n", text))


def _numbered_rows(text: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The numbers of a chunk in rows of about ``PART`` of them, cut behind ends of pieces."""
    text = text[np.append(True, (text[1:] != 0) | (text[:-1] != 0))] if len(text) else text
    width = 4 if text.max(initial=0) < 1 << 32 else 8
    ends = np.flatnonzero(text == 0) + 1
    cuts = np.unique(ends[np.searchsorted(ends, np.arange(PART, ends[-1], PART))]) if len(ends) else ends
    for part in np.split(text, cuts):
        yield pa.RecordBatch.from_arrays([pa.array([width]), pa.array([part.astype(f"<u{width}").tobytes()], pa.binary())], schema=schema)


def _pairs(row: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, word) pairs and how often each is there."""
    if len(row) and max(row.max() >> 31, word.max() >> 32) == 0:  # both fit into one sortable number
        key, n = np.unique(row << 32 | word, return_counts=True)
        return key >> 32, key & 0xFFFFFFFF, n
    order = np.lexsort((word, row))
    row, word = row[order], word[order]
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (word[1:] != word[:-1])))
    return row[first], word[first], np.diff(np.append(first, len(row)))


def scan(texts: DataFrame, finder, follow: bool, gather: int = 500_000) -> DataFrame:
    """``phrase``, ``next``, ``n``: how often each phrase that ``finder`` knows stands in the texts (``next`` 0),
    and, if ``follow``, how often each frequent word follows it.

    ``finder()`` gives, once a task, a function from a text's numbers to places, rows and words of
    phrases, and the phrases' ids.  A task hands on sums, about ``gather`` places a time.
    """
    schema = to_arrow_schema(FOUND)

    def batches_of(phrase, nxt, n):
        for k in range(0, len(n), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[k : k + 100_000], pa.int64()) for x in (phrase, nxt, n)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, ids = finder()
        total = np.zeros(len(ids), np.int64) if ids is not None else None
        rows, words, size = [], [], 0

        def followers():
            row, word, n = _pairs(np.concatenate(rows), np.concatenate(words))
            return batches_of(row if ids is None else ids[row], word, n)

        for batch in batches:
            for width, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = np.frombuffer(data.as_buffer(), f"<u{width}").astype(np.int64)
                at, row, length = find(text)
                if total is not None:
                    total += np.bincount(row, minlength=len(ids))
                if follow:
                    nxt = np.append(text, 0)[at + length]
                    rows.append(row[nxt > 0])
                    words.append(nxt[nxt > 0])
                    size += len(rows[-1])
                    if size >= gather:
                        yield from followers()
                        rows, words, size = [], [], 0
        if size:
            yield from followers()
        if total is not None:
            seen = np.flatnonzero(total)
            yield from batches_of(ids[seen], np.zeros(len(seen), np.int64), total[seen])

    return texts.mapInArrow(run, FOUND).groupBy("phrase", "next").agg(F.sum("n").alias("n"))


def tries_of(candidates: DataFrame, shards: int) -> DataFrame:
    """The candidates' tries, one row a shard, each compiled in one task from a bounded number of phrases."""
    schema = to_arrow_schema(TRIES)

    def compile_shard(rows: pa.Table) -> pa.Table:
        phrases = np.array(rows.column("numbers").combine_chunks().flatten()).reshape(rows.num_rows, -1)
        trie = DoubleArray.build(phrases)
        arrays = [_one_binary(x) for x in (trie.base, trie.check, trie.accept, rows.column("phrase").to_numpy().astype("<i8"))]
        return pa.table([pa.array([rows.column("shard")[0].as_py()]), pa.array([trie.digits]), *arrays], schema=schema)

    shard = F.pmod(F.xxhash64("numbers"), F.lit(shards)).alias("shard")
    return candidates.select(shard, "phrase", "numbers").groupBy("shard").applyInArrow(compile_shard, TRIES)


def count_level(texts: DataFrame, candidates: DataFrame, words: int, shard_phrases: int, least: int) -> DataFrame:
    """``phrase``, ``next``, ``n`` of the candidates of one level (see :func:`scan`), written; one pass a shard."""
    spark = texts.sparkSession
    shards = max(1, -(-candidates.count() // shard_phrases))
    tries = materialize_at(tries_of(candidates, shards), f"phrase-tries-{words}", large_rows=True)[0]
    passes = []
    for shard in range(shards):
        found = tries.where(F.col("shard") == shard).collect()  # one trie: bounded by the size of a shard
        if not found:
            continue
        shared, key = spark.sparkContext.broadcast(found[0].asDict()), uuid.uuid4().hex
        del found

        def finder(shared=shared, key=key):
            def load():
                t = shared.value
                arrays = [np.frombuffer(t[n], np.int32) for n in ("base", "check", "accept")]
                return DoubleArray(words, t["digits"], *arrays), np.frombuffer(t["ids"], "<i8")

            trie, ids = once(("phrases", key), load, tables=1)
            return lambda text: (*trie.find(text), words), ids

        passes.append(materialize(scan(texts, finder, words < LONGEST).where(F.col("n") >= least), f"phrases-{words}"))
        shared.destroy()
    return reduce(DataFrame.unionAll, passes) if passes else spark.createDataFrame(to_arrow_schema(FOUND).empty_table())


def phrase_counts(docs: DataFrame, least: int, chunk_words: int, shard_phrases: int, shard_words: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Word totals by language (``lang``, ``n``), frequent words (``lang``, ``word``, ``f``, ``number``), and
    phrases of 2 to ``LONGEST`` words (``numbers``, ``f``) with at least ``least`` occurrences."""
    chunks, folder = text_chunks(docs, chunk_words)
    entry = F.explode(F.arrays_zip("langs", "times")).alias("e")
    totals = materialize(chunks.select(entry).groupBy(F.col("e.langs").alias("lang")).agg(F.sum("e.times").alias("n")), "phrase-totals")
    entry = F.explode(F.arrays_zip("langs", "words", "times")).alias("e")
    counted = chunks.select(entry).groupBy(F.col("e.langs").alias("lang"), F.col("e.words").alias("word")).agg(F.sum("e.times").alias("f"))
    frequent = materialize(numbered(counted.where(F.col("f") >= least), "number", "frequent-words"), "numbered-words")
    texts = number_texts(chunks, frequent, shard_words)
    remove_folder(chunks.sparkSession, folder)  # nothing reads the dictionaries again

    def words():  # level 1: the words themselves, by their numbers
        def find(text):
            at = np.flatnonzero(text)
            return at, text[at], 1

        return find, None

    known = frequent.select(F.col("number").alias("phrase"), F.array("number").alias("numbers"))
    follows = scan(texts, words, True).where(F.col("n") >= least)
    levels = []
    for k in range(2, LONGEST + 1):
        longer = follows.join(known, "phrase").select(F.concat("numbers", F.array("next")).alias("numbers"))
        candidates = materialize(longer.withColumn("phrase", F.monotonically_increasing_id()), f"candidates-{k}")
        found = count_level(texts, candidates, k, shard_phrases, least)
        counted = found.where(F.col("next") == 0).select("phrase", F.col("n").alias("f")).join(candidates, "phrase")
        levels.append(counted.select("numbers", "f"))
        known, follows = candidates, found.where(F.col("next") > 0)
    return totals, frequent, reduce(DataFrame.unionAll, levels)


def score_of(a: Column, both: Column, scale: int = 2_000_000) -> Column:
    """``floor(scale * a / both)`` for positive numbers, exact."""
    return F.call_function("div", F.lit(scale).cast("decimal(10,0)") * a.cast("decimal(20,0)"), both.cast("decimal(20,0)"))


def collocations(
    docs: DataFrame, least: int = 30, top: int = 2_000, chunk_words: int = 1_000_000, shard_phrases: int = 200_000, shard_words: int = 500_000,
    contained_percent: int = 80,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: each language's first ``top`` phrases."""
    with small_batches(docs.sparkSession):
        totals, frequent, counted = phrase_counts(docs, least, chunk_words, shard_phrases, shard_words)
    phrases = materialize(counted, "counted-phrases")
    parts = frequent.select(F.array("number").alias("part"), "f").unionAll(phrases.select(F.col("numbers").alias("part"), "f"))
    size = F.size("numbers")
    cuts = phrases.select("numbers", "f", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    first, rest = F.slice("numbers", F.lit(1), F.col("k")), F.slice("numbers", F.col("k") + 1, size)
    cuts = cuts.select("numbers", "f", "k", first.alias("first"), rest.alias("rest"))
    for side, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(parts.select(F.col("part").alias(side), F.col("f").alias(name)), side)
    scored = cuts.select("numbers", F.col("f").alias("a"), F.struct(score_of(F.col("f"), F.col("l") + F.col("r")).alias("score"), "k", "l", "r").alias("cut"))
    best = materialize(scored.groupBy("numbers").agg(F.max("a").alias("a"), F.min("cut").alias("cut")), "scored-phrases")
    # phrases inside longer ones that are nearly as frequent
    inside = phrases.where(size > 2).select(
        "f", F.explode(F.expr(
            "flatten(transform(sequence(2, size(numbers) - 1), m -> transform(sequence(1, size(numbers) - m + 1), i -> slice(numbers, i, m))))"
        )).alias("numbers")
    )
    covered = inside.groupBy("numbers").agg(F.max("f").alias("longer"))
    kept = best.join(covered, "numbers", "left").where(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * contained_percent)
    )
    kept = materialize(kept, "kept-phrases")
    spelled = kept.select("numbers", F.posexplode("numbers").alias("place", "number")).join(frequent.select("number", "lang", "word"), "number")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ")
    spelled = spelled.groupBy("numbers").agg(F.first("lang").alias("lang"), text.alias("phrase"))
    rows = kept.join(spelled, "numbers").select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    order = f"PARTITION BY %s ORDER BY score DESC, a DESC, phrase"
    # a language's first ones are among the first ones of its slices: no task ranks a whole language
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    rows = rows.withColumn("rank", F.expr(f"row_number() OVER ({order % 'lang, slice'})")).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.expr(f"row_number() OVER ({order % 'lang'})").cast("long")).where(F.col("rank") <= top)
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
