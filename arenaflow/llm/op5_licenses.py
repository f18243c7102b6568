"""Operator 5, license scans by a positional index of rare license words.

Each template is a short license notice as a word sequence.  Over all documents
the document frequency of the templates' words is counted; a template's
``RARE`` words of highest inverse document frequency are its lookup words.  In a
text, every place of a lookup word points, through the template postings, to the
start that the template would have there; a start that at least half of the
template's lookup words agree on is a candidate, and it counts if the template's
mandatory phrase stands at its place.

Everything is built-in column functions: per text the words, the lookup hits and
the candidates are arrays of the row, so nothing but the few word frequencies is
shuffled.

Defined cases: a NULL text counts as empty (no words, no labels, score 0); whole
texts are read, in time that grows with their hits; equally rare words are taken in alphabetical order; repeated
rows each get their row; an empty table gives an empty result; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Word pattern, base phrases and their labels.
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
# Label, notice, mandatory phrase (a part of the notice).
TEMPLATES = (
    ("mit", "under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("apache-2", "apache license version 2", "apache license version 2"),
    ("cc-by-nc", "cc by nc", "cc by nc"),
    ("cc-by-nc", "creative commons attribution noncommercial", "creative commons attribution noncommercial"),
    ("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
)
RARE = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_words(text: Column) -> Column:
    """The words of a whole text, A-Z in lower case."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), 0)


def _literal(words) -> Column:
    return F.array(*map(F.lit, words))


def rare_words(docs: DataFrame) -> list[list[str]]:
    """The lookup words of each template, by document frequency over all documents (ties: alphabetical)."""
    vocabulary = sorted({w for _, notice, _ in TEMPLATES for w in notice.split()})
    found = docs.select(F.explode(F.array_intersect(text_words(F.col("text")), _literal(vocabulary))).alias("word"))
    df = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}  # at most the vocabulary
    return [sorted(set(notice.split()), key=lambda w: (df.get(w, 0), w))[:RARE] for _, notice, _ in TEMPLATES]


def _starts(hits: Column, word: str, at: int) -> Column:
    """Where a sequence would start that has ``word`` at place ``at``, for each hit of the word."""
    return F.transform(F.filter(hits, lambda h: h["w"] == F.lit(word)), lambda h: h["i"] - at)


def _places(hits: Column, words: Column, phrase: list[str], anchor: str) -> Column:
    """Starts of a phrase, looked up by one of its words among the hits."""
    at = phrase.index(anchor)
    return F.filter(
        _starts(hits, anchor, at),
        lambda s: (s >= 0) & (F.slice(words, F.greatest(s, F.lit(0)) + 1, F.lit(len(phrase))) == _literal(phrase)),
    )


def _template_score(hits: Column, words: Column, template: tuple[str, str, str], lookup: list[str]) -> Column:
    """Best share of the notice's words that stand in place at a verified start; 0 without one."""
    _, notice, mandatory = template
    notice_words, phrase = notice.split(), mandatory.split()
    offset = next(i for i in range(len(notice_words)) if notice_words[i : i + len(phrase)] == phrase)
    postings = [(w, i) for i, w in enumerate(notice_words) if w in lookup]
    starts = F.sort_array(F.flatten(F.array(*(_starts(hits, w, i) for w, i in postings))))
    need = (len(postings) + 1) // 2
    # of the sorted starts, those that stand there again need - 1 places on: counted in one pass over them
    later = F.slice(starts, F.lit(need), F.greatest(F.size(starts), F.lit(0)))
    often = F.array_distinct(F.array_compact(F.zip_with(starts, later, lambda s, t: F.when(s == t, s))))
    agreed = F.filter(
        often,
        lambda s: (s + offset >= 0)
        & (F.slice(words, F.greatest(s + offset, F.lit(0)) + 1, F.lit(len(phrase))) == _literal(phrase)),
    )
    share = F.transform(
        agreed,
        lambda s: reduce(
            lambda a, b: a + b,
            (F.when(F.get(words, s + i) == F.lit(w), 1).otherwise(0) for i, w in enumerate(notice_words)),
        ) / F.lit(float(len(notice_words))),
    )
    return F.coalesce(F.array_max(share), F.lit(0.0))


def license_scan(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, base counts and places, ``base_labels``, ``labels``, ``score``."""
    lookups = rare_words(docs)
    anchors = {"mit", "apache", "nc"}  # one rare word of each base phrase
    wanted = sorted(anchors.union(*lookups))
    words, hits = F.col("_words"), F.col("_hits")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_words(F.col("text")).alias("_words"))
    none = F.array().cast("array<struct<w:string,i:int>>")
    indexed = F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    rows = rows.select(
        "doc_id", "_words",
        F.when(F.arrays_overlap(words, _literal(wanted)), F.filter(indexed, lambda h: h["w"].isin(wanted))).otherwise(none).alias("_hits"),
    )
    base = [_places(hits, words, phrase.split(), next(a for a in sorted(anchors) if a in phrase.split())) for phrase, _ in BASE]
    scores = [_template_score(hits, words, t, lookup) for t, lookup in zip(TEMPLATES, lookups, strict=True)]
    rows = rows.select(
        "doc_id", F.size(words).cast("long").alias("n_words"),
        F.when(F.size(hits) > 0, F.array(*base)).alias("_base"), F.when(F.size(hits) > 0, F.array(*scores)).alias("_scores"),
    )
    starts = F.flatten("_base")
    base_labels = [F.when(F.size(F.get("_base", F.lit(k))) > 0, F.lit(label)) for k, (_, label) in enumerate(BASE)]
    method = [F.when(F.get("_scores", F.lit(k)) > 0, F.lit(label)) for k, (label, _, _) in enumerate(TEMPLATES)]

    def joined(labels: list[Column]) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))), ",")

    return rows.select(
        "doc_id", "n_words",
        F.coalesce(F.size(starts), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(base_labels + method).alias("labels"),
        F.coalesce(F.array_max("_scores"), F.lit(0.0)).alias("score"),
    )
