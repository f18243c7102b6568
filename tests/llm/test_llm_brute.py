"""Plain versions of operators that SQL can't express, written from their definitions."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from arenaflow.llm import queries as q
from arenaflow.llm.common import fold
from arenaflow.llm.kneser_ney import KneserNey, grams, symbols
from arenaflow.llm.op1_quality import quality_rules
from arenaflow.llm.op7_toxicity import score_toxicity, train_toxicity
from arenaflow.llm.op8_language import identify_language
from arenaflow.llm.op9_secrets import secret_scan


# --- language models -----------------------------------------------------------------

class PlainKneserNey:
    """Interpolated Kneser-Ney over strings, by dictionaries and recursion."""

    def __init__(self, texts, alphabet):
        self.count, self.floor = {4: Counter()}, 1 / alphabet
        for text in texts:
            s = "  " + plain_symbols(text)
            self.count[4].update(s[i : i + 4] for i in range(len(s) - 3))
        for n in (3, 2, 1):
            self.count[n] = Counter(g[1:] for g in self.count[n + 1])
        self.total, self.kinds, self.discount = {}, {}, {}
        for n, grams_ in self.count.items():
            ones, twos = (sum(c == k for c in grams_.values()) for k in (1, 2))
            self.discount[n] = ones / (ones + 2 * twos) if ones and twos else 0.5
            self.total[n], self.kinds[n] = defaultdict(int), defaultdict(int)
            for g, c in grams_.items():
                self.total[n][g[:-1]] += c
                self.kinds[n][g[:-1]] += 1

    def p(self, gram):
        n = len(gram)
        if n == 0:
            return self.floor
        head, lower = gram[:-1], self.p(gram[1:])
        if head not in self.total[n]:
            return lower
        d, total = self.discount[n], self.total[n][head]
        return max(self.count[n].get(gram, 0) - d, 0) * (gram in self.count[n]) / total + d * self.kinds[n][head] / total * lower


def plain_symbols(text):
    out = " "
    for c in text.lower():
        c = c if c.isalpha() else " "
        out += "" if c == " " and out[-1] == " " else c
    return out if out.endswith(" ") else out + " "


@pytest.mark.parametrize("seed", range(4))
def test_models_equal_a_plain_kneser_ney(seed):
    rng = random.Random(seed)
    letters = "abcdeéß"[: 3 + seed]
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 30))) for _ in range(20)]
    keys, counts = np.unique(np.concatenate([grams(symbols(t)) for t in texts]), return_counts=True)
    model, plain = KneserNey(keys, counts, alphabet=50), PlainKneserNey(texts, 50)
    for text in [*texts[:5], "abc, xyz!", "ééß a", "q"]:
        s = "  " + plain_symbols(text)
        want = [-math.log2(plain.p(s[i : i + 4])) for i in range(len(s) - 3)]
        assert model.bits(grams(symbols(text))) == pytest.approx(want)


def test_predictions_follow_the_plain_models(spark):
    rng = random.Random(8)
    docs = []
    for i in range(60):
        lang, letters = rng.choice([("aa", "abcd"), ("bb", "bcde"), ("cc", "defg")])
        docs.append((i, " ".join("".join(rng.choice(letters) for _ in range(4)) for _ in range(rng.randint(3, 30))), lang))
    docs += [(100, None, "aa"), (101, "12 ?!", None), (102, "bcd bcd", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    plain = {la: PlainKneserNey([t for i, t, x in docs if x == la and t and i < 40], 1 << 12) for la in ("aa", "bb", "cc")}
    for how in ({}, {"block_grams": 1}):
        found = {r["doc_id"]: r for r in identify_language(df, F.col("doc_id") < 40, **how).collect()}
        for i, text, _ in docs:
            s = "  " + plain_symbols(text or "")
            if not s.strip():
                assert found[i]["lang_pred"] == "und" and found[i]["cross_entropy"] is None
                continue
            costs = {la: np.mean([-math.log2(m.p(s[k : k + 4])) for k in range(len(s) - 3)]) for la, m in plain.items()}
            assert found[i]["lang_pred"] == min(costs, key=costs.get)
            assert found[i]["cross_entropy"] == pytest.approx(min(costs.values()))


def test_limits_come_from_every_training_text(spark):
    rng = random.Random(9)
    texts = [" ".join("".join(rng.choice("abcd") for _ in range(4)) for _ in range(rng.randint(1, 12))) for _ in range(4_300)]
    df = spark.createDataFrame([(i, t, "aa") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    found = identify_language(df, F.lit(True)).collect()
    costs = np.array([r["cross_entropy"] for r in found])
    limit = costs.mean() + 4.0 * costs.std() + 0.5
    want = [1 / (1 + math.exp((c - limit) / 0.15)) for c in costs]
    assert [r["score"] for r in found] == pytest.approx(want, rel=1e-9)


# --- secrets --------------------------------------------------------------------------

VALUE = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")


def run_of(text, at, members):
    end = at
    while end < len(text) and text[end] in members:
        end += 1
    return end


def base_spans(text):
    spans = []
    at = 0
    while at < len(text):  # assignments
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text[at : at + 8])
        name = next((n for n in ("password", "passwd", "secret", "token", "api_key", "apikey") if low.startswith(n)), None)
        end = None
        if name:
            k = at + len(name)
            for quote in ((k + 1, k) if text[k : k + 1] in ('"', "'") and text[k : k + 1] else (k,)):
                j = run_of(text, quote, " ")
                if text[j : j + 1] in (":", "=") and text[j : j + 1]:
                    j = run_of(text, j + 1, " ")
                    start = j + 1 if text[j : j + 1] in ('"', "'") and text[j : j + 1] else j
                    stop = run_of(text, start, VALUE)
                    if stop > start:
                        end = stop
                        if stop - start >= 12:
                            spans.append(("assign", at, stop))
                        break
        at = end if end else at + 1
    at = 0
    while (at := text.find("AKIA", at)) >= 0:
        end = run_of(text, at + 4, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
        if end - at >= 18:
            spans.append(("access", at, end))
        at = end if end > at + 4 else at + 1
    at = 0
    while at < len(text):
        end = run_of(text, at, "0123456789abcdef")
        if end - at >= 16:
            spans.append(("hex", at, end))
        at = max(end, at + 1)
    return sorted(spans, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_base_secrets_equal_a_hand_written_scanner(spark):
    rng = random.Random(4)
    parts = ["password", "Passwd", "SECRET", "token", "api_key", "ApiKey", "api-key", " ", "  ", ":", "=", '"', "'", "AKIA", "AKIAAKIA", "Z9" * 8, "deadbeef" * 2, "0a", "hunter2",
             "longenoughvalue", "é", "\n", ".", "xyz", "A" * 15, "tokentoken", "K", "ſecret", "\t"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1500)] + [None, "", "0" * 100_000, "AKIA" * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for r in secret_scan(df).collect():
        spans = base_spans(texts[r["doc_id"]] or "")
        kinds = Counter(k for k, _, _ in spans)
        named = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (kinds["assign"], kinds["access"], kinds["hex"]), texts[r["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(",".join(named).encode()).hexdigest()
        assert set(named) <= set(r["spans"].split(",")) | ({""} if not named else set())


# --- quality rules and toxicity scores ------------------------------------------------------

def plain_quality(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, repeated = set(), 0
    for line in lines:
        repeated += line in seen
        seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(inside), failed


def test_quality_rows_equal_their_definition(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = quality_rules(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
        assert got == plain_quality(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_toxicity_scores_equal_a_sum_by_hand(spark, sf_small):
    docs, labels = (spark.read.parquet(f"{sf_small}/{n}.parquet") for n in ("documents", "labels"))
    from arenaflow.llm.op7_toxicity import LETTERS, word_features

    model = train_toxicity(docs, labels, fold(5) != 0)
    weight = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in score_toxicity(docs, model).collect():
        present = {f for w in LETTERS.findall((texts[r["doc_id"]] or "").lower()) for f in word_features(w)}
        z = model.intercept + sum(weight[f] for f in present if f in weight)
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-max(-50, min(50, z))))) and r["predicted"] == int(r["score"] >= 0.5)
    assert {r["doc_id"] for r in q.op7_toxicity(spark, sf_small).where("held_out").collect()} == {r["doc_id"] for r in docs.where(fold(5) == 0).collect()}
