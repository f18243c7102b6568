"""Operator 8, language identification by Kneser-Ney character models.

The grams of all training documents are counted in Spark, language by language
(counted within each batch, then summed); each language's model is built from
all its grams.  The languages are dealt, in alphabetical order, into blocks of
about ``block_grams`` grams; one block is broadcast and scored after the other, the
costs going along with the texts.  So a worker holds the models of one block: a
language is never split, and the largest one bounds a block from below.  A text takes
the language of the lowest length-normalised cross-entropy.

Rejection: of every training document the cross-entropy under its
own language is measured; a text that costs more than their mean plus
``reject_sigmas`` standard deviations is marked ``rejected``.  The score is the
softmax of the negative cross-entropies, with that limit as one more class.

Defined cases: a NULL text or one without letters is ``und`` with score 0; whole
texts are scored; ties go to the first language in alphabetical order; rows
without a language train nothing; without any training row all are ``und``;
repeated rows each get their row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from arenaflow.llm.common import materialize, once
from arenaflow.llm.kneser_ney import KneserNey, grams, symbols
from arenaflow.session import ship_package

UNDETERMINED = "und"
# Symbols whose grams are counted or scored together (some tens of MB of arrays).
BLOCK = 2_000_000
COUNTS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])


def gram_counts(training: DataFrame) -> DataFrame:
    """``lang``, ``gram``, ``n`` over all texts of ``training`` (``text``, ``lang``)."""
    ship_package(training.sparkSession)
    schema = to_arrow_schema(COUNTS)

    def counted(lang: str, parts: list[np.ndarray]) -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = symbols(text)
                if len(s):
                    held.setdefault(lang, []).append(grams(s))
                    size[lang] = size.get(lang, 0) + len(s)
                    if size.get(lang, 0) >= BLOCK:
                        yield counted(lang, held.pop(lang))
                        size[lang] = 0
        for lang, parts in held.items():
            yield counted(lang, parts)

    rows = training.select("text", "lang").mapInArrow(run, COUNTS)
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def language_blocks(counts: DataFrame, block_grams: int) -> list[list[str]]:
    """The languages of ``counts`` (:func:`gram_counts`) in order, in blocks of about ``block_grams`` grams."""
    blocks: list[list[str]] = []
    size = 0
    for lang, n in sorted(map(tuple, counts.groupBy("lang").agg(F.count("*")).collect())):
        if not blocks or size + n > block_grams:
            blocks.append([])
            size = 0
        blocks[-1].append(lang)
        size += n
    return blocks


def language_models(counts: DataFrame, langs: list[str]) -> dict[str, KneserNey]:
    """The models of ``langs``, each from all its grams in ``counts``."""
    table = counts.where(F.col("lang").isin(langs)).select("lang", "gram", "n").toArrow()
    models = {}
    for lang in langs:
        own = table.filter(pc.equal(table["lang"], lang))
        keys, n = (own.column(c).to_numpy() for c in ("gram", "n"))
        models[lang] = KneserNey(keys.view(np.uint64), n)
    return models


class Scorer:
    """Cross-entropies (bits a symbol) of texts under every language, the languages in alphabetical order."""

    def __init__(self, models: dict[str, KneserNey]):
        self.langs = sorted(models)
        self.models = [models[la] for la in self.langs]

    def __call__(self, texts: list[str | None]) -> list[np.ndarray | None]:
        out: list[np.ndarray | None] = [None] * len(texts)
        places, parts, size = [], [], 0
        for i, text in enumerate(texts):
            s = symbols(text) if text else ()
            if len(s):
                places.append(i)
                parts.append(grams(s))
                size += len(s)
            if parts and (size >= BLOCK or i == len(texts) - 1):
                self._block(places, parts, out)
                places, parts, size = [], [], 0
        if parts:
            self._block(places, parts, out)
        return out

    def _block(self, places: list[int], parts: list[np.ndarray], out: list) -> None:
        keys, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        sizes = np.array([len(p) for p in parts])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        costs = np.empty((len(parts), len(self.models)))
        for j, model in enumerate(self.models):
            costs[:, j] = np.add.reduceat(model.bits(keys)[inverse], starts) / sizes
        for i, row in zip(places, costs, strict=True):
            out[i] = row


def _gathered(df: DataFrame, scorer_of, last: bool) -> DataFrame:
    """``df`` with the costs of one more block of languages at the end of ``costs``; the ``last`` one leaves the texts out."""
    schema = T.StructType(df.schema.fields[1:]) if last else df.schema
    arrow = to_arrow_schema(schema)
    place = arrow.get_field_index("costs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of()
        for batch in batches:
            new = scorer(batch.column(0).to_pylist())
            costs = [[] if c is None else old + c.tolist() for old, c in zip(batch.column(1).to_pylist(), new, strict=True)]
            text = [] if last else [batch.column(0)]
            yield pa.RecordBatch.from_arrays([*text, pa.array(costs, arrow.field(place).type), *batch.columns[2:]], schema=arrow)

    return df.mapInArrow(run, schema)


def text_costs(scorers: list, df: DataFrame, keep: list[str]) -> DataFrame:
    """``costs`` of every text of ``df`` under the languages of all blocks in order (empty without a letter) and the
    columns ``keep``; written after each block, so no stage holds the models of two."""
    ship_package(df.sparkSession)
    rows = df.select("text", F.array().cast("array<double>").alias("costs"), *keep)
    for scorer_of in scorers[:-1]:
        rows = materialize(_gathered(rows, scorer_of, False), "language-costs")
    return materialize(_gathered(rows, scorers[-1], True), "language-costs")


def identify_language(
    docs: DataFrame, training: Column, block_grams: int = 4_000_000, reject_sigmas: float = 4.0, temperature: float = 0.15,
) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``cross_entropy``, ``rejected``.

    ``training``: the condition on ``docs`` (with ``lang``) that picks the rows to learn from.
    """
    spark = docs.sparkSession
    learned = training & F.col("lang").isNotNull() & F.col("text").isNotNull()
    counts = materialize(gram_counts(docs.where(learned)), "language-grams")
    blocks = language_blocks(counts, block_grams)
    names = [la for block in blocks for la in block]
    doc_id = T.StructField("doc_id", T.LongType())
    result = T.StructType(
        [doc_id, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
         T.StructField("cross_entropy", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.when(learned, F.col("lang")).alias("own"))
    if not blocks:
        return rows.select(
            "doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("cross_entropy"), F.lit(True).alias("rejected"),
        )

    def scorer_of(block: list[str]):
        shared = spark.sparkContext.broadcast(language_models(counts, block))
        key = f"languages-{spark.sparkContext.applicationId}-{shared._jbroadcast.id()}"
        return lambda: once(key, lambda: Scorer(shared.value))

    scorers = [scorer_of(block) for block in blocks]

    scored = text_costs(scorers, rows, ["doc_id", "own"])
    place = F.array_position(F.array(*map(F.lit, names)), F.col("own")).cast("int")
    cost = F.get("costs", place - 1)
    measured = scored.where(F.col("own").isNotNull()).select(F.col("own").alias("lang"), cost.alias("cost")).where(F.col("cost").isNotNull())
    limits = {
        r["lang"]: r["mean"] + reject_sigmas * (r["deviation"] or 0.0) + 0.5
        for r in measured.groupBy("lang").agg(F.avg("cost").alias("mean"), F.stddev_pop("cost").alias("deviation")).collect()
    }
    widest = max(limits.values(), default=12.0)
    arrow = to_arrow_schema(result)

    def predict(costs):
        if not costs:
            return UNDETERMINED, 0.0, None, True
        costs = np.array(costs)
        best = int(np.argmin(costs))
        limit = limits.get(names[best], widest)
        weights = np.exp((costs[best] - np.append(costs, limit)) / temperature)
        return names[best], float(1 / weights.sum()) if math.isfinite(weights.sum()) else 0.0, float(costs[best]), bool(costs[best] > limit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(zip(*map(predict, batch.column(1).to_pylist()), strict=True))
            if made:
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, f.type) for v, f in zip(made, list(arrow)[1:], strict=True))], schema=arrow)

    return scored.select("doc_id", "costs").mapInArrow(run, result)
