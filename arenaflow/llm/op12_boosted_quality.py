"""Operator 12, a quality classifier of histogram gradient-boosted trees over document statistics.

Every text is described by some thirty figures (``STATISTICS``): lengths, shares of
character classes, words, repeats, lines.  Trees of fixed depth are boosted with the
logistic loss; a split is searched in histograms of gradients and curvatures over at most
``bins`` quantile bins of each figure.  The fitted trees are flattened into two
arrays (figure and threshold of each inner node, value of each leaf, in heap order), and
all rows of a batch descend all trees together, one level a step.

Fitted on at most about ``rows`` labelled documents, chosen by the hash of their id (a
parameter; the driver gets their figures, not their texts); scoring is map-side over
all documents.

Defined cases: a NULL text counts as empty, and an empty one has all figures 0 and its score
by the trees; a document labelled more than once counts with its lowest label; without any
label every score is 0.5; equal gains go to the first figure and lowest threshold; repeated
documents each get their row; an empty table gives an empty result; extra columns, whatever
their names, are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from arenaflow.llm.common import hash_sample, once
from arenaflow.session import ship_package

# The classes of characters (as bytes of UTF-8) whose shares are figures.
CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "spaces": b" \t",
    "line_ends": b"\n\r",
    "stops": b".?",
    "commas": b",;:",
    "bangs": b"!",
    "symbols": b"#*$%&|<>",
    "brackets": b"()[]{}",
    "marks": b"@_=+/\\~^`",
    "quotes": b"'\"-",
    "far": bytes(range(0x80, 0x100)),
    "controls": bytes([*range(9), 11, 12, *range(14, 32), 127]),
}
STATISTICS = (
    "log_chars", "log_words", "log_lines", *CLASSES, "entropy", "word_length", "long_words", "short_words", "different_words",
    "top_word", "title_words", "capital_words", "plain_words", "bound_words", "repeated_triples", "repeated_lines", "words_a_line", "short_lines",
    "stops_a_word", "longest_word",
)
RESULT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

_CLASS_OF = np.full(256, len(CLASSES))
for _k, _members in enumerate(CLASSES.values()):
    _CLASS_OF[list(_members)] = _k
_WORD = re.compile(r"\w+")


def _repeated_triples(words: list[str], times: Counter) -> int:
    """How many windows of three words stand in the text more than once."""
    number = {w: i for i, w in enumerate(times)}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    _, pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
    _, found = np.unique(pair[:-1] * len(number) + ids[2:], return_counts=True)
    return int(found[found > 1].sum())


def statistics(text: str | None) -> list[float]:
    """The figures of a whole text, in the order of ``STATISTICS``; all 0 for an empty one."""
    words = text.split() if text else []
    if not words:
        return [0.0] * len(STATISTICS)
    data = np.frombuffer(text.encode(), np.uint8)
    counts = np.bincount(data, minlength=256)
    share = counts[counts > 0] / len(data)
    classes = np.bincount(_CLASS_OF, counts, len(CLASSES) + 1)[:-1] / len(data)
    n, lengths, times = len(words), list(map(len, words)), Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    sizes = [len(line.split()) for line in lines]
    return [
        np.log1p(len(text)), np.log1p(n), np.log1p(len(lines)), *classes, float(-(share * np.log2(share)).sum()),
        sum(lengths) / n, sum(x > 12 for x in lengths) / n, sum(x < 4 for x in lengths) / n, len(times) / n,
        max(times.values()) / n, sum(map(str.istitle, words)) / n, sum(map(str.isupper, words)) / n, sum(map(str.isalpha, words)) / n,
        sum(1 for w in words if _WORD.fullmatch(w.strip(".,;:!?"))) / n,
        _repeated_triples(words, times) / n, 1 - len(set(lines)) / len(lines), n / len(lines), sum(x < 4 for x in sizes) / len(lines),
        sum(w[-1] in ".!?" for w in words) / n, np.log1p(max(lengths)),
    ]


@dataclass
class BoostedTrees:
    """Flattened trees: row t of ``figure`` and ``threshold`` has the inner nodes of tree t in heap
    order (node i has the children 2i + 1 and 2i + 2), row t of ``leaf`` its leaves from left to right."""

    base: float
    figure: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.int64))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    leaf: np.ndarray = field(default_factory=lambda: np.zeros((0, 1)))

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the trees for each row of ``x``: all rows go down all trees, level by level."""
        trees, inner = self.figure.shape
        node = np.zeros((len(x), trees), np.int64)
        row, tree = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        while inner and len(x) and node[0, 0] < inner:
            right = x[row, self.figure[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        return self.base + self.leaf[tree, node - inner].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -50, 50)))

    def key(self) -> str:
        return xxhash.xxh3_64_hexdigest(self.threshold.tobytes() + self.leaf.tobytes() + self.figure.tobytes() + repr(self.base).encode())


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Upper edges of the quantile bins of each figure; values over the last one form a bin more."""
    return [np.unique(np.quantile(column, np.arange(1, bins) / bins, method="lower")) for column in x.T]


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 150, depth: int = 4, rate: float = 0.1, bins: int = 64, ridge: float = 1.0, least_weight: float = 2.0,
) -> BoostedTrees:
    """Boosts ``trees`` trees on the rows ``x`` with labels ``y`` (0 or 1)."""
    n, figures = x.shape
    prior = min(0.999, max(0.001, float(y.mean())))
    model = BoostedTrees(float(np.log(prior / (1 - prior))), np.zeros((trees, 2**depth - 1), np.int64), np.full((trees, 2**depth - 1), np.inf), np.zeros((trees, 2**depth)))
    edges = _edges(x, bins)
    binned = np.stack([np.searchsorted(e, column, "left") for e, column in zip(edges, x.T, strict=True)], 1)
    flat = binned + np.arange(figures) * bins  # a cell for each figure and bin
    usable = np.arange(bins)[None, :] < np.array([len(e) for e in edges])[:, None]
    margin = np.full(n, model.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, curve = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)  # number of a row's node in its level
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            cells = (node[:, None] * (figures * bins) + flat).ravel()
            g, h = (
                np.bincount(cells, np.repeat(v, figures), width * figures * bins).reshape(width, figures, bins).cumsum(2)
                for v in (gradient, curve)
            )
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
            gain[~(usable & (h >= least_weight) & (h_all - h >= least_weight))] = 0
            best = gain.reshape(width, -1).argmax(1)
            split = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            figure, at = np.divmod(best, bins)
            limit = np.where(split, at, bins)  # without a split all rows go left
            model.figure[t, first : first + width] = np.where(split, figure, 0)
            model.threshold[t, first : first + width] = [edges[f][b] if s else np.inf for f, b, s in zip(figure, at, split, strict=True)]
            node = 2 * node + (binned[np.arange(n), np.where(split, figure, 0)[node]] > limit[node])
        value = -np.bincount(node, gradient, 2**depth) / (np.bincount(node, curve, 2**depth) + ridge)
        model.leaf[t] = rate * value
        margin += model.leaf[t][node]
    return model


def _figures(docs: DataFrame, *also: str) -> DataFrame:
    """The columns ``also`` and ``figures``, the statistics of ``text``."""
    ship_package(docs.sparkSession)
    rows = docs.select(*also, "text")
    schema = T.StructType([rows.schema[c] for c in also] + [T.StructField("figures", T.ArrayType(T.DoubleType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            figures = [statistics(t) for t in batch.column(len(also)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(also)], pa.array(figures, arrow.field("figures").type)], schema=arrow)

    return rows.mapInArrow(run, schema)


def train_quality(docs: DataFrame, labels: DataFrame, training: Column, rows: int = 20_000, **how) -> BoostedTrees:
    """``labels``: ``doc_id``, ``quality`` (0 or 1).  ``training``: the condition on ``doc_id`` of the rows to learn from."""
    known = labels.where(training & F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("_labelled")).agg(F.min("quality").alias("_quality"))
    sample = F.broadcast(hash_sample(known, "_labelled", rows))  # about ``rows`` ids at most
    texts = docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("_labelled"))
    found = _figures(texts, "_quality").toArrow()
    if not found.num_rows:
        return BoostedTrees(0.0)
    x = np.array(found.column("figures").to_pylist(), float)
    y = found.column("_quality").to_numpy().astype(float)
    order = np.lexsort((y, *x.T))  # the same sums whatever order the rows came in
    return fit_trees(x[order], y[order], **how)


def score_quality(docs: DataFrame, model: BoostedTrees, batch_rows: int = 1024) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` (1 if the score is 0.5 or more)."""
    spark = docs.sparkSession
    ship_package(spark)
    shared, key, schema = spark.sparkContext.broadcast(model), model.key(), to_arrow_schema(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = once(("boosted", key), lambda: shared.value)
        for batch in batches:
            for k in range(0, batch.num_rows, batch_rows):
                part = batch.slice(k, batch_rows)
                score = trees.score(np.array([statistics(t) for t in part.column(1).to_pylist()], float))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)
