"""Operator 1, quality rules by weak supervision.

Rules vote "good", "bad" or abstain on each document.  Expectation-maximisation
over the votes of all documents estimates each rule's accuracy and the share of
good documents, without labels; the posterior probability of "good" decides, in
place of the demand that every rule pass.

The EM needs only how many documents cast each vote pattern, at most
``3 ** len(RULES)`` rows whatever the input, so the corpus is aggregated in
Spark and the loop runs over that small table.

Defined cases: a NULL or empty text has no words, fails the base rules and is
not kept; extra columns are ignored; repeated rows each get their row; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenaflow.llm.common import WordHashes, map_rows, materialize, once, shingle_hashes

SYMBOLS = "#*$%&|<>"
SEPARATORS = (b" | ", b" * ", b" # ", b" > ", b" & ", b" - ", b" / ")
WHITE = " \t\n\x0b\x0c\r"
GOOD, ABSTAIN, BAD = 2, 1, 0


def _band(bad_from: float, good_to: float):
    """Votes on a value that is better the smaller it is."""
    return lambda v: BAD if v >= bad_from else GOOD if v <= good_to else ABSTAIN


# name, feature, vote on its value (None: nothing to judge, abstain)
RULES = (
    ("length", "n_words", lambda v: BAD if v < 30 else GOOD if v >= 50 else ABSTAIN),
    ("word_length", "mean_word", lambda v: GOOD if 3 <= v <= 10 else BAD if v < 2 or v > 15 else ABSTAIN),
    ("symbols", "symbols_per_word", _band(0.10, 0.02)),
    ("repeated_lines", "dup_line_share", _band(0.30, 0.05)),
    ("repeated_windows", "repeat_share", _band(0.50, 0.20)),
    ("capitals", "upper_share", _band(0.50, 0.20)),
    ("letters", "no_letter_share", _band(0.30, 0.10)),
    ("shouting", "bangs_per_word", _band(0.30, 0.05)),
    ("separators", "separators_per_word", _band(0.20, 0.03)),
)

FEATURES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField("pattern", T.IntegerType())]
)


def text_features(text: str | None, hashes: WordHashes) -> dict:
    """The base counts and the values that the rules judge."""
    text = text or ""
    data = text.encode()
    words = data.split()  # bytes: exactly the six ASCII white-space characters
    n = len(words)
    word_chars = len(text) - sum(text.count(c) for c in WHITE)
    n_symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in data.split(b"\n") if x.strip()]
    n_dup = len(lines) - len(set(lines))
    n_repeat = 0
    if n > 3:
        windows = shingle_hashes(hashes.of(words), 3)
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
        found = np.flatnonzero(counts[inverse] > 1)
        covered = np.zeros(n, bool)
        for i in range(3):
            covered[found + i] = True
        n_repeat = int(covered.sum())
    codes = np.frombuffer(data, np.uint8)
    upper = int(np.count_nonzero((codes >= 0x41) & (codes <= 0x5A)))
    letters = upper + int(np.count_nonzero((codes >= 0x61) & (codes <= 0x7A)))
    beyond = int(np.count_nonzero(codes >= 0xC0))  # characters past ASCII count as letters
    return {
        "n_words": n, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup, "n_repeat_words": n_repeat,
        "mean_word": word_chars / n if n else None,
        "symbols_per_word": n_symbols / n if n else None,
        "dup_line_share": n_dup / len(lines) if len(lines) > 1 else None,
        "repeat_share": n_repeat / n if n > 3 else None,
        "upper_share": upper / letters if letters else None,
        "no_letter_share": 1 - (letters + beyond) / word_chars if word_chars else None,
        "separators_per_word": sum(map(data.count, SEPARATORS)) / n if n else None,
        "bangs_per_word": text.count("!") / n if n else None,
    }


def vote_pattern(features: dict) -> int:
    """The votes as one number, a base-3 digit per rule."""
    code = 0
    for _, name, vote in RULES:
        value = features[name]
        code = code * 3 + (ABSTAIN if value is None else vote(value))
    return code


def pattern_votes(patterns: np.ndarray) -> np.ndarray:
    """One row per pattern: +1 good, -1 bad, 0 abstain."""
    powers = 3 ** np.arange(len(RULES) - 1, -1, -1)
    return (patterns[:, None] // powers) % 3 - 1


def fit_votes(patterns: np.ndarray, counts: np.ndarray, steps: int = 500) -> tuple[float, np.ndarray, np.ndarray]:
    """EM: share of good documents, accuracies, posterior of "good" per pattern.

    Given the document's class the votes are independent, and a rule has two
    accuracies: how often it is right when it votes on a good document, and on a
    bad one (``accuracy[class, rule]``, class 0 bad, 1 good).  An abstention
    says nothing.  The first guess is that one vote of "bad" makes a document
    doubtful; one pseudo-vote right and one wrong smooth each accuracy.
    """
    votes = pattern_votes(patterns)
    posterior = np.where((votes < 0).any(1), 0.2, 0.95)
    share, accuracy = 0.5, np.full((2, len(RULES)), 0.5)
    for _ in range(steps):
        share = float((counts @ posterior + 1) / (counts.sum() + 2))
        right = np.empty_like(accuracy)
        for y, weight in enumerate((counts * (1 - posterior), counts * posterior)):
            sided = votes == (2 * y - 1)
            right[y] = (weight @ sided + 1) / (weight @ (votes != 0) + 2)
        log_good = np.log(share) + (votes > 0) @ np.log(right[1]) + (votes < 0) @ np.log(1 - right[1])
        log_bad = np.log(1 - share) + (votes < 0) @ np.log(right[0]) + (votes > 0) @ np.log(1 - right[0])
        posterior = 1 / (1 + np.exp(np.clip(log_bad - log_good, -500, 500)))
        done = np.abs(right - accuracy).max() < 1e-9
        accuracy = right
        if done:
            break
    return share, accuracy, posterior


def quality_features(docs: DataFrame) -> DataFrame:
    """Base counts and vote pattern of every document, in one pass over the texts."""

    def start():
        hashes = once("word-hashes", WordHashes)
        names = FEATURES.names[1:-1]

        def one(row):
            f = text_features(row[1], hashes)
            yield (row[0], *(f[n] for n in names), vote_pattern(f))

        return one

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), start, FEATURES)


def quality_rules(docs: DataFrame, keep_from: float = 0.5) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``kept``, ``quality`` (posterior of "good").

    ``kept`` is false for a document that fails the base rules and otherwise
    ``quality >= keep_from``.
    """
    spark = docs.sparkSession
    features = materialize(quality_features(docs), "quality-features")
    rows = features.groupBy("pattern").count().orderBy("pattern").collect()  # at most 3 ** rules rows
    patterns = np.array([r["pattern"] for r in rows], np.int64)
    _, _, posterior = fit_votes(patterns, np.array([r["count"] for r in rows], float))
    verdicts = spark.createDataFrame(
        [(int(p), float(q)) for p, q in zip(patterns, posterior, strict=True)], "pattern int, quality double"
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return features.join(F.broadcast(verdicts), "pattern").select(
        *FEATURES.names[:-1],
        failed.alias("base_failed"),
        (~failed & (F.col("quality") >= keep_from)).alias("kept"),
        "quality",
    )
