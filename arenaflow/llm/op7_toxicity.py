"""Operator 7, toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples are the positives; texts without regard to any label
are the unlabelled rest.  A linear numpy classifier is trained on

    prior * R_P(+1) + max(0, R_U(-1) - prior * R_P(-1))

the class-prior-corrected risk whose negative part is not let below zero.  Its
inputs are word and word-edge features of the whole text (present or absent), so
a toxic word counts as much in a long text as in a short one.

Fitted on samples of at most about ``positive_rows`` and ``unlabelled_rows``
documents (by id hash); the class prior is the toxic share of all training
labels.  At most ``max_features`` features are broadcast.

Defined cases: a NULL or empty text gets the score of a text without features;
without any positive example all scores are 0; exact copies in a sample count
once; repeated label rows of a document count once; a score of exactly 0.5 is predicted toxic; repeated documents
each get their row; an empty table gives an empty result; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from arenaflow.llm.common import WORKER_CACHE, filter_texts, hash_sample, map_rows, materialize, once
from arenaflow.session import ship_package

LETTERS = re.compile(r"[^\W\d_]+")
EDGES = (4, 5, 6)
FEATURE_COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in ("feature", "p", "u")])


def word_features(word: str) -> list[int]:
    """Hashes of the word, its beginnings and its ends."""
    names = [f"={word}"]
    for n in EDGES:
        if len(word) >= n:
            names += [f"^{word[:n]}", f"{word[-n:]}$"]
    return [xxhash.xxh3_64_intdigest(x) >> 1 for x in names]


def text_words(text: str | None) -> set[str]:
    return set(LETTERS.findall(text.lower())) if text else set()


@dataclass
class ToxicityModel:
    """Weights of the selected features, and the intercept."""

    intercept: float
    features: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))


class Selected(dict):
    """Word -> places of its selected features (most words have none)."""

    def __init__(self, features: np.ndarray):
        super().__init__()
        self.places = {int(f): i for i, f in enumerate(features)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.places[f] for f in word_features(word) if f in self.places)
        if len(self) < WORKER_CACHE:
            self[word] = found
        return found

    def of(self, text: str | None) -> list[int]:
        return sorted(set().union(*filter(None, map(self.__getitem__, text_words(text)))))


class ToxicityScorer:
    def __init__(self, model: ToxicityModel):
        self.selected, self.model = Selected(model.features), model
        self.weights = model.weights.tolist()

    def __call__(self, text: str | None) -> float:
        z = self.model.intercept + sum(self.weights[i] for i in self.selected.of(text))
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def training_sample(docs: DataFrame, labels: DataFrame, training: Column, positive_rows: int, unlabelled_rows: int) -> DataFrame:
    """``text``, ``p`` (a confirmed toxic example), ``u`` (drawn without regard to labels); exact copies once."""
    toxic = labels.where(training & (F.col("toxic") == 1)).select(F.col("doc_id").alias("_toxic_id")).distinct()
    positives = F.broadcast(hash_sample(toxic, "_toxic_id", positive_rows))  # about positive_rows ids at most
    known = docs.where(training & F.col("text").isNotNull()).select("doc_id", "text")
    total, steps = known.select("doc_id").count(), 1 << 30
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("unlabelled")), F.lit(steps)) < int(steps * min(1.0, unlabelled_rows / max(1, total)))
    sample = known.join(positives, known["doc_id"] == positives["_toxic_id"], "left").select(
        "text", F.col("_toxic_id").isNotNull().cast("int").alias("p"), F.coalesce(drawn, F.lit(False)).cast("int").alias("u")
    )
    return sample.where("p + u > 0").groupBy("text").agg(F.max("p").alias("p"), F.max("u").alias("u"))


def feature_counts(sample: DataFrame) -> DataFrame:
    """``feature``, ``p``, ``u``: in how many positive and unlabelled texts it is present."""
    ship_package(sample.sparkSession)
    schema = to_arrow_schema(FEATURE_COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, p, u = [], [], []
            for text, is_p, is_u in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = {f for w in text_words(text) for f in word_features(w)}
                found.append(np.fromiter(own, np.int64, len(own)))
                p.append(np.full(len(own), is_p))
                u.append(np.full(len(own), is_u))
            keys, at = np.unique(np.concatenate(found), return_inverse=True)
            counts = [np.bincount(at, np.concatenate(x), len(keys)).astype(np.int64) for x in (p, u)]
            yield pa.RecordBatch.from_arrays([pa.array(keys), *map(pa.array, counts)], schema=schema)

    rows = sample.select("text", "p", "u").mapInArrow(run, FEATURE_COUNTS)
    return rows.groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def select_features(counts: DataFrame, n_p: int, n_u: int, max_features: int, least_z: float = 5.0) -> np.ndarray:
    """Features present more often in positive than in unlabelled texts, the clearest first."""
    share = n_p / (n_p + n_u)
    both = F.col("p") + F.col("u")
    z = (F.col("p") - both * share) / F.sqrt(both * share * (1 - share))
    enough = F.col("p") >= max(3, round(0.005 * n_p))
    best = counts.where(enough).select("feature", z.alias("z")).where(F.col("z") >= least_z)
    return np.array([r["feature"] for r in best.orderBy(F.col("z").desc(), "feature").limit(max_features).collect()], np.int64)


def fit_nnpu(rows: list[np.ndarray], p: np.ndarray, u: np.ndarray, width: int, prior: float, steps: int = 2_000, rate: float = 0.05, ridge: float = 0.2):
    """Weights and intercept of the linear classifier with the least non-negative risk.

    Logistic loss, Adam over the whole sample, weights shrunk by ``ridge`` over the number of positives;
    the result is the mean of the last quarter of the steps.
    """
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    cols = np.concatenate(rows).astype(np.int64) if len(at) else np.zeros(0, np.int64)
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    wp, wu = p / p.sum(), u / max(1.0, u.sum())
    m, v, mean, decay = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1), ridge / p.sum()
    for step in range(1, steps + 1):
        z = b + np.bincount(at, w[cols], len(rows))
        plus, minus = 1 / (1 + np.exp(z)), 1 / (1 + np.exp(-z))  # -d loss(+1)/dz, d loss(-1)/dz
        cost = np.logaddexp(0, z)  # loss of "-1"
        negative = wu @ cost - prior * (wp @ cost)
        if negative >= 0:
            g = -prior * wp * plus + wu * minus - prior * wp * minus
        else:  # the negative part overfits: step back on it alone
            g = -(wu * minus - prior * wp * minus)
        grad = np.append(np.bincount(cols, g[at], width) + decay * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
        if step > steps - steps // 4:
            mean += np.append(w, b) / (steps // 4)
    return mean[:-1], float(mean[-1])


def train_toxicity(
    docs: DataFrame, labels: DataFrame, training: Column, positive_rows: int = 3_000, unlabelled_rows: int = 8_000, max_features: int = 4_096,
) -> ToxicityModel:
    """``labels``: ``doc_id``, ``toxic``.  ``training``: the condition on ``doc_id`` of the rows to learn from."""
    known = labels.where(training & F.col("toxic").isNotNull()).agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    if not known["toxic"]:
        return ToxicityModel(-50.0)
    prior = min(0.9, max(1e-3, known["toxic"] / known["n"]))
    sample = materialize(training_sample(docs, labels, training, positive_rows, unlabelled_rows), "toxicity-sample")
    n = sample.agg(F.sum("p").alias("p"), F.sum("u").alias("u")).first()
    if not n["p"] or not n["u"]:
        return ToxicityModel(-50.0)
    features = select_features(feature_counts(sample), n["p"], n["u"], max_features)
    schema = T.StructType(
        [T.StructField("p", T.IntegerType()), T.StructField("u", T.IntegerType()), T.StructField("found", T.ArrayType(T.IntegerType()))]
    )

    def start():
        selected = Selected(features)
        return lambda row: ((row[1], row[2], selected.of(row[0])),)

    rows = map_rows(sample.select("text", "p", "u"), start, schema).toPandas()  # the sample's rows, a few numbers each
    found = [np.asarray(x) for x in rows["found"]]
    w, b = fit_nnpu(found, rows["p"].to_numpy(float), rows["u"].to_numpy(float), len(features), prior)
    return ToxicityModel(b, features, w)


def _shared(docs: DataFrame, model: ToxicityModel):
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = ("toxicity", xxhash.xxh3_64_hexdigest(model.features.tobytes() + model.weights.tobytes()), model.intercept)
    return lambda: once(key, lambda: ToxicityScorer(shared.value))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``doc_id``, ``score``, ``predicted`` (1 if the score is 0.5 or more)."""
    scorer = _shared(docs, model)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def start():
        score = scorer()

        def one(row):
            s = score(row[1])
            yield row[0], s, int(s >= 0.5)

        return one

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), start, schema)


def without_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they are."""
    scorer = _shared(docs, model)

    def start():
        score = scorer()
        return lambda text: score(text) < 0.5

    return filter_texts(docs, start)
