"""Boosted trees: the histogram fit against a plain one, the flattened descent against a walk, held-out labels."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from arenaflow.llm import queries as q
from arenaflow.llm.common import fold
from arenaflow.llm.op12_boosted_quality import STATISTICS, BoostedTrees, fit_trees, score_quality, statistics, train_quality

TEXTS = [None, "", " \n\t", "one", "A b c. A b c.\nA b c.", "x" * 100_000, "#$% &&& 12 é漢\x00\x7f", "w " * 50_000, "Same line\n" * 400]


def walk(model, row):
    """One row down one tree after the other."""
    total = model.base
    for figure, threshold, leaf in zip(model.figure, model.threshold, model.leaf, strict=True):
        node = 0
        while node < len(figure):
            node = 2 * node + 1 + int(row[figure[node]] > threshold[node])
        total += leaf[node - len(figure)]
    return total


def plain_tree(x, gradient, curve, depth, ridge, least):
    """The tree of greatest gains by trying every value of every figure as a threshold; values of the rows."""
    out = np.zeros(len(x))

    def grow(rows, level):
        g, h = gradient[rows].sum(), curve[rows].sum()
        best = None
        if level < depth:
            for f in range(x.shape[1]):
                for v in np.unique(x[rows, f])[:-1]:
                    left = rows[x[rows, f] <= v]
                    gl, hl = gradient[left].sum(), curve[left].sum()
                    if hl >= least and h - hl >= least:
                        gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, f, v)
        if best is None:
            out[rows] = -g / (h + ridge)
        else:
            _, f, v = best
            grow(rows[x[rows, f] <= v], level + 1)
            grow(rows[x[rows, f] > v], level + 1)

    grow(np.arange(len(x)), 0)
    return out


def sample(n=300, seed=1):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), rng.integers(0, 4, n), rng.exponential(size=n)], 1).round(1)
    return x, ((x[:, 0] > 0.3) ^ (x[:, 1] == 2) | (rng.random(n) < 0.05)).astype(float)


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_histogram_fit_equals_a_plain_one(depth):
    x, y = sample()
    model = fit_trees(x, y, trees=5, depth=depth, bins=512, rate=0.3)
    margin = np.full(len(x), np.log(y.mean() / (1 - y.mean())))
    for _ in range(5):
        p = 1 / (1 + np.exp(-margin))
        margin += 0.3 * plain_tree(x, p - y, p * (1 - p), depth, 1.0, 2.0)
    assert model.margin(x) == pytest.approx(margin, abs=1e-9)


def test_flattened_descent_equals_a_walk():
    x, y = sample()
    model = fit_trees(x, y, trees=20, depth=4, bins=16)
    probe = np.concatenate([x, x + 0.05, [[np.inf, -np.inf, 0], [1e9, -1e9, 7]]])
    assert model.margin(probe) == pytest.approx([walk(model, row) for row in probe])
    assert ((model.score(x) >= 0.5) == y).mean() > 0.9
    assert model.score(np.zeros((0, 3))).shape == (0,)


def test_one_class_and_no_labels(spark):
    x, _ = sample(40)
    assert fit_trees(x, np.ones(40)).score(x).min() > 0.99
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = train_quality(docs, none, F.lit(True))
    assert model.key() == BoostedTrees(0.0).key()
    assert {(r["score"], r["predicted"]) for r in score_quality(docs, model).collect()} == {(0.5, 1)}


@pytest.mark.parametrize("text", TEXTS)
def test_statistics_of_odd_texts(text):
    found = statistics(text)
    assert len(found) == len(STATISTICS) and np.isfinite(found).all()
    if not (text or "").split():
        assert not any(found)


def test_statistics_by_hand():
    by = dict(zip(STATISTICS, statistics("Ab ab ab ab x1!\n\nab ab ab"), strict=True))
    assert by["repeated_triples"] == pytest.approx(2 / 8)  # "ab ab ab" twice, the line end is white space
    assert by["different_words"] == pytest.approx(3 / 8) and by["top_word"] == pytest.approx(6 / 8)
    assert (by["words_a_line"], by["short_lines"], by["stops_a_word"]) == (4, 0.5, 1 / 8)
    assert by["log_chars"] == pytest.approx(np.log1p(25))


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark, sf_small):
    docs, labels = (spark.read.parquet(f"{sf_small}/{n}.parquet") for n in ("documents", "labels"))
    changed = labels.withColumn("quality", F.when(fold(3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    moved = docs.select("doc_id", "text", F.lit("xx").alias("lang"), F.lit("s").alias("source"), F.lit("y").alias("quality"), F.lit(1).alias("figures")).repartition(7)
    assert train_quality(docs, labels, fold(3) != 1).key() == train_quality(moved, changed.unionAll(changed), fold(3) != 1).key()


def test_sample_is_bounded(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    model = train_quality(docs, labels, F.lit(True), rows=100, trees=2)
    assert model.figure.shape[0] == 2


def test_quality_held_out(spark):
    """On a table large enough to learn from, held-out labels are met."""
    sf = "/root/testdata/sf0.01"
    found = q.op12_boosted_quality(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = found.select("score", "predicted", "quality").collect()
    assert len(rows) > 80 and sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)
    low, high = ([r["score"] for r in rows if r["quality"] == k] for k in (0, 1))
    assert np.mean([a < b for a in low for b in high]) > 0.97
