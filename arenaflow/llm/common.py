"""Helpers shared by the training-data operators.

Conventions of every operator:

* it reads ``doc_id`` and ``text`` (other columns, whatever their names, are not looked at);
* a NULL text counts as the empty text;
* repeated rows and repeated ids are kept: one result row per input row;
* an empty table gives an empty result.
"""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from arenaflow.operators.sizing import materialize
from arenaflow.session import scratch_dir, ship_package

__all__ = [
    "WordHashes", "documents", "filter_texts", "fold", "frequent_words", "hash_sample", "map_rows", "materialize", "once", "scratch_dir",
    "shingle_hashes", "small_batches", "write_bytes",
]

# Entries that one Python worker keeps of a word table (tens of MB at most).
WORKER_CACHE = 200_000

BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@contextmanager
def small_batches(spark: SparkSession, size: str = "2m") -> Iterator[None]:
    """Arrow batches of about ``size`` (one row at least) for the Python code that runs meanwhile.

    Spark's own bounds are 10,000 rows and 64 MB.  A batch lies in buffers outside the JVM's heap several times, which
    double as they grow, and in the worker.
    """
    before = spark.conf.get(BATCH_CONF, None)
    spark.conf.set(BATCH_CONF, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_CONF)
        else:
            spark.conf.set(BATCH_CONF, before)


def map_rows(df: DataFrame, start: Callable[[], Callable[[tuple], Iterable[tuple]]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` over rows: ``start()`` runs once a task and returns a function
    from the tuple of an input row to its output tuples.

    Output goes out after every input batch and after every 4,096 rows, so a
    task holds one Arrow batch (64 MB by Spark's default) and its own tables.
    """
    ship_package(df.sparkSession)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = start()
        for batch in batches:
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out.extend(fn(row))
                if len(out) >= 4096:
                    yield _batch(out, arrow)
                    out = []
            if out:
                yield _batch(out, arrow)

    return df.mapInArrow(run, schema)


def filter_texts(docs: DataFrame, start: Callable[[], Callable[[str | None], bool]]) -> DataFrame:
    """The rows of ``docs`` whose text passes, all columns as they are; ``start()`` runs once a task."""
    ship_package(docs.sparkSession)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = start()
        for batch in batches:
            yield batch.filter(pa.array(list(map(passes, batch.column(place).to_pylist())), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered up to ``WORKER_CACHE`` words."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < WORKER_CACHE:
            self[word] = h
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the windows of ``size`` consecutive word hashes, in order;
    the whole sequence as one window when it is shorter, nothing when it is empty."""
    if not len(words):
        return words
    size, n = min(size, len(words)), max(1, len(words) - size + 1)
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n])
    return h


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Writes a small file through the Hadoop file system of its path."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def fold(folds: int):
    """The fold of a document, ``crc32(doc_id as text) mod folds``; fold 0 of a NULL id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(0)) % folds


def hash_sample(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` rows (all, if there are no more), chosen by the hash of ``key``.

    The share follows from a count of all rows, so the sample's size does not
    grow with the input.  Used only to fit classifiers.
    """
    total, steps = rows.count(), 1 << 30
    if total <= bound:
        return rows
    return rows.where(F.pmod(F.xxhash64(key), F.lit(steps)) < int(steps * bound / total))


# --- frequent words -------------------------------------------------------

_SUMMARY = T.StructType(
    [T.StructField("words", T.ArrayType(T.StringType())), T.StructField("counts", T.ArrayType(T.LongType()))]
)


# Summaries that one task of a later round merges.
MERGED = 16


def _summary(counts: Counter, k: int) -> tuple[list[str], list[int]]:
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]
    return [w for w, _ in top], [c for _, c in top]


def _add(counts: Counter, words: list[str] | dict[str, int], capacity: int) -> None:
    counts.update(words)
    if len(counts) > capacity:
        floor = sorted(counts.values())[len(counts) // 2]
        for w in [w for w, c in counts.items() if c <= floor]:
            del counts[w]


def frequent_words(docs: DataFrame, k: int, lower: bool = False, capacity: int = 400_000) -> list[str]:
    """The ``k`` most frequent white-space separated words over all documents.

    Every text is counted where it lies: a task keeps at most ``capacity`` counts
    (the lower half goes when there are more) and hands on one row with its ``k``
    most frequent words.  These rows are merged in rounds, about ``MERGED`` a task, read one after the
    other into as many counts; no word is shuffled by itself.  The counts of rare
    words may be low by the pruning; callers use the list to fill a lookup table
    that changes their speed, never their result.
    """
    spark = docs.sparkSession
    ship_package(spark)
    schema = to_arrow_schema(_SUMMARY)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    _add(counts, (text.lower() if lower else text).split(), capacity)
        yield _batch([_summary(counts, k)], schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for words, ns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _add(counts, dict(zip(words, ns, strict=True)), capacity)
        yield _batch([_summary(counts, k)], schema)

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    merged = docs.select("text").mapInArrow(count, _SUMMARY).repartition(parts).mapInArrow(merge, _SUMMARY)
    while parts > 1:
        parts = max(1, parts // MERGED)
        merged = merged.repartition(parts).mapInArrow(merge, _SUMMARY)
    rows = merged.collect()
    return list(rows[0]["words"]) if rows else []


_ONCE: dict = {}
_LOCK = threading.Lock()
# Tables that one Python worker keeps; a worker that serves many stages must not hold them all.
TABLES = 2


def once(key, make: Callable[[], object], tables: int = TABLES):
    """``make()`` once per Python process (reused workers keep the ``tables`` tables used last)."""
    with _LOCK:
        found = _ONCE.pop(key, None)
        if found is None:
            while len(_ONCE) >= tables:
                _ONCE.pop(next(iter(_ONCE)))
            found = make()
        _ONCE[key] = found
        return found
