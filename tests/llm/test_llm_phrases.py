"""Phrase collocations: tries against dictionaries, the operator against a plain version."""

import glob
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from arenaflow.llm import queries as q
from arenaflow.llm.double_array import DoubleArray
from arenaflow.llm.op13_phrases import collocations, score_of, words_of
from arenaflow.operators.sizing import materialize_at
from pyspark.sql import functions as F


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("top", [3, 50, 3_000, 5_000_000])
def test_trie_finds_its_phrases(seed, top):
    rng = np.random.default_rng(seed)
    words = 2 + seed % 3
    phrases = np.unique(rng.integers(1, top, (rng.integers(1, 3_000), words)) ** 2 // top + 1, axis=0)
    rng.shuffle(phrases)
    trie = DoubleArray.build(phrases)
    known = {tuple(p): i for i, p in enumerate(phrases.tolist())}
    text = np.concatenate([*(phrases[rng.integers(0, len(phrases), 300)]), rng.integers(0, top, 500), [1 << 40, 0, 1]]).astype(np.int64)
    want = [(i, known[tuple(text[i : i + words].tolist())]) for i in range(len(text) - words + 1) if tuple(text[i : i + words].tolist()) in known]
    at, row = trie.find(text)
    assert list(zip(at.tolist(), row.tolist(), strict=True)) == want and len(want) >= 300
    assert trie.find(text[: words - 1])[0].tolist() == []


def test_large_trie_is_compact():
    rng = np.random.default_rng(1)
    phrases = np.unique((rng.pareto(0.7, (60_000, 3)) * 50).astype(np.int64) % 100_000 + 1, axis=0)
    trie = DoubleArray.build(phrases)
    states = int((trie.check >= 0).sum())
    assert len(trie.base) < 2 * states and (trie.accept >= 0).sum() == len(phrases)


def plain_words(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[\x20\x09]+", piece) if w] for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded)]


@pytest.mark.parametrize("text", [None, "", " \t", "A b.C,,d e É f\r\ng\x0bh\x85i \x1c", "x" * 10, "no end", ".", "a\tB  c!"])
def test_words_of_a_text(text):
    pieces, now = [], []
    for w in words_of(text):
        if w == b"\n":
            pieces.append(now)
            now = []
        else:
            now.append(w.decode())
    assert [*pieces, now] == plain_words(text)


def test_long_texts_are_split_whole(monkeypatch):
    from arenaflow.llm import op13_phrases

    text = " ".join(f"W{i}.x" for i in range(500))
    whole = list(words_of(text))
    for size in (1, 7, 100):
        monkeypatch.setattr(op13_phrases, "_SLICE", size)
        assert list(words_of(text)) == whole


def brute(rows, least=30, top=2_000):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in plain_words(text):
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longest[p[i : i + m]] = max(longest[p[i : i + m]], a)
        scored = []
        for p, a in found.items():
            if 100 * longest[p] < 80 * a:
                score, _, left, right = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found_rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("how", [{}, {"chunk_words": 50, "shard_phrases": 40, "shard_words": 6}, {"top": 5}])
def test_collocations_equal_brute_force(spark, how):
    rng = random.Random(5)
    common = ["of the", "New York City", "in the middle of", "É tude", "a", "b", "a a a a", "the", "of", "in", "x y", " z z"]
    rows = []
    for i in range(300):
        parts = [rng.choice(common) if rng.random() < 0.7 else f"rare{rng.randrange(5000)}" for _ in range(rng.randint(0, 40))]
        text = "".join(p + rng.choice([" ", " ", " ", ". ", ",", "\t", "\n"]) for p in parts)
        rows.append((rng.choice(["en", "en", "fr", None]), rng.choice([text, text.upper(), text])))
    rows += [(None, None), ("fr", ""), ("de", " "), ("en", "a " * 500), ("en", "a " * 500)]
    docs = spark.createDataFrame([(i, t, la, "x") for i, (la, t) in enumerate(rows)], "doc_id long, text string, lang string, chunk string").repartition(6)
    want = brute(rows, top=how.get("top", 2_000))
    assert len(want) > 10 and found_rows(collocations(docs, **how)) == want


def test_scores_are_exact(spark):
    rng = random.Random(6)
    pairs = [(a, b) for a in (1, 30, 10**12 + 7, 2**62, 9_007_199_254_740_993) for b in (2 * a, 2 * a + 1, 3 * a - 1, 2_000_000 * a, 2_000_000 * a + 1) if b < 2**63]
    pairs += [(a := rng.randrange(1, 2**40), a * 2 + rng.randrange(2**41)) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a long, b long")
    found = df.select("a", "b", score_of(F.col("a"), F.col("b")).alias("s")).collect()
    assert all(r["s"] == 2_000_000 * r["a"] // r["b"] for r in found)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations(none).collect() == []


def test_query_equals_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    assert found_rows(q.op13_phrases(spark, sf_small)) == brute([(r["lang"], r["text"]) for r in docs.collect()])


def test_python_gets_small_batches(spark, tmp_path, monkeypatch):
    """Spark's own bound, 64 MB of rows at once, took much of an executor's memory on several GB."""
    from arenaflow.llm.common import BATCH_CONF

    kind = type(spark.range(1))
    plain = kind.mapInArrow

    def watched(self, func, schema, *args, **kwargs):
        def run(batches):
            def seen():
                for batch in batches:
                    with open(f"{tmp_path}/sizes", "a") as out:
                        out.write(f"{batch.num_rows} {batch.nbytes}\n")
                    yield batch

            yield from func(seen())

        return plain(self, run, schema, *args, **kwargs)

    monkeypatch.setattr(kind, "mapInArrow", watched)
    text = "one two three. " * 4_000
    docs = spark.range(100).select(F.lit(text).alias("text"), F.lit("en").alias("lang")).coalesce(1)
    before = spark.conf.get(BATCH_CONF, None)
    assert found_rows(collocations(docs, chunk_words=100_000_000)) == brute([("en", text)] * 100)
    sizes = [tuple(map(int, line.split())) for line in open(f"{tmp_path}/sizes")]
    assert len(sizes) > 4 and all(n == 1 or size < 4_000_000 for n, size in sizes)
    assert spark.conf.get(BATCH_CONF, None) == before


def test_small_batches_restore_a_setting(spark):
    from arenaflow.llm.common import BATCH_CONF, small_batches

    before = spark.conf.get(BATCH_CONF, None)
    spark.conf.set(BATCH_CONF, "5m")
    try:
        with pytest.raises(ZeroDivisionError), small_batches(spark):
            assert spark.conf.get(BATCH_CONF) == "2m"
            1 / 0
        assert spark.conf.get(BATCH_CONF) == "5m"
    finally:
        spark.conf.unset(BATCH_CONF) if before is None else spark.conf.set(BATCH_CONF, before)


def first_page(path):
    """Uncompressed bytes of the first page of the first column: the second number of its header."""
    import pyarrow.parquet as pq

    at = pq.ParquetFile(path).metadata.row_group(0).column(0).data_page_offset
    data, numbers = open(path, "rb").read()[at : at + 24], []
    while len(numbers) < 2:  # each field: its kind, then a zigzag number of seven bits a byte
        value, shift, data = 0, 0, data[1:]
        while True:
            value |= (data[0] & 127) << shift
            more, shift, data = data[0] & 128, shift + 7, data[1:]
            if not more:
                break
        numbers.append(value >> 1)
    return numbers[1]


def test_large_rows_get_small_pages(spark):
    """A page of 100 rows of a MB is compressed in buffers of its size outside the heap."""
    rows = spark.range(0, 60, 1, 1).select(F.expr("cast(repeat(uuid(), 8000) as binary)").alias("numbers"))
    pages = []
    for large in (False, True):
        read, folder = materialize_at(rows, "large-rows", large_rows=large)
        (path,) = glob.glob(folder.removeprefix("file:") + "/part-*")
        pages.append(first_page(path))
        assert read.count() == 60 and read.select(F.sum(F.length("numbers"))).first()[0] == 60 * 8000 * 36
    assert pages[0] > 8_000_000 and pages[1] < 2_500_000


def test_a_worker_keeps_as_many_tables_as_asked(monkeypatch):
    from arenaflow.llm import common

    monkeypatch.setattr(common, "_ONCE", {})
    for key in "abc":
        common.once(key, lambda: key)
    assert list(common._ONCE) == ["b", "c"]
    assert common.once("d", lambda: list(common._ONCE), tables=1) == [] and list(common._ONCE) == ["d"]
