"""Cross-tokenizer alignment against a plain version that follows the definition token by token."""

import bisect
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from arenaflow.llm import queries as q
from arenaflow.llm.bpe import WordBpe
from arenaflow.llm.op11_alignment import Aligner, token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "a", " ", "  x", "x  ", "\n", "a\nb  c \n\n d \n", "\t\n y ’quoted’ — 字 漢 字\nНу да, конечно", "<|endoftext|> x", "<s> <0x41> </s>",
    "a ▁ b", "▁", "a" * 3000, "\x00 é é \x85", "😀 hi 😀😀", "’", " ’ x ’", "naïve café Ω ﬁ", "x\r\ny",
]


def mixed(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab c'\n\t Zé1\xa0\x1c\x85.,’字😀▁") for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def aligner():
    return Aligner(A, B)


def test_ids_are_the_libraries(aligner):
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    assert aligner.b.cuts
    for text in [*ODD, *mixed(400)]:
        if text:
            assert aligner.a.ids(text)[0].tolist() == library.encode(" " + text, add_special_tokens=False).ids
            assert aligner.b.ids(text)[0].tolist() == model.encode(text)


def test_far_characters_leave_only_their_words_to_the_library():
    bpe = WordBpe(A)
    words = [f"word{i}" for i in range(1000)]
    parts = bpe.parts(" ".join([*words, "‘far’", *words]))
    assert [far for far, _ in parts] == [False, True, False] and parts[1][1] == " ‘far’ word0"


def brute(texts):
    """Rows by the definition, with the libraries' own ids."""
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = {c: b for b, c in enumerate(WordBpe(A).chars)}
    docs = []
    for text in texts:
        tokens = [[], []]
        if text:
            a = [(i, bytes(plain[c] for c in library.id_to_token(i))) for i in library.encode(" " + text, add_special_tokens=False).ids]
            b = []
            for i in model.encode(text):
                piece = model.id_to_piece(i)
                b.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
            if all(b"".join(x for _, x in side) == (" " + text).encode() for side in (a, b)):
                for side, out in zip((a, b), tokens, strict=True):
                    at = 0
                    for i, spelled in side:
                        out.append((i, at, at + len(spelled)))
                        at += len(spelled)
        docs.append(tokens)
    links = []
    for a, b in docs:  # tokens overlap where they share a byte
        owner = [[k for k, (_, s, e) in enumerate(side) for _ in range(s, e)] for side in (a, b)]
        links.append([(a[x][0], b[y][0]) for x, y in sorted(set(zip(*owner, strict=True)))])
    count = Counter(x for d in links for x in d)
    highest = Counter()
    for (_, j), n in count.items():
        highest[j] = max(highest[j], n)
    rows = []
    for (a, b), own in zip(docs, links, strict=True):
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        inside = [defaultdict(list), defaultdict(list)]
        for side, found in zip((a, b), inside, strict=True):
            for i, _, e in side:
                found[bisect.bisect_left(ends, e)].append(str(i))
        groups = ["|".join(",".join(found[k]) for found in inside) for k in range(len(ends))]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        rows.append((len(a), len(b), len(ends), len(own), sum(count[x] == highest[x[1]] for x in own), sum(count[x] for x in own), digest))
    return rows


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("chunk_links", [1, 300, 1_000_000])
def test_alignment_equals_brute_force(spark, chunk_links):
    texts = [*ODD, *mixed(150), None, "", "the same text twice", "the same text twice"]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, chunk long").repartition(5)
    found = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in token_alignment(docs, A, B, chunk_links).collect()}
    assert found == dict(enumerate(brute(texts)))


def test_alignment_of_the_test_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").orderBy("doc_id").collect()
    found = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in q.op11_alignment(spark, sf_small).collect()}
    assert found == {r["doc_id"]: row for r, row in zip(docs, brute([r["text"] for r in docs]), strict=True)}


def test_long_text_and_many_chunks(spark):
    long = " ".join(f"w{i % 997}’s" for i in range(60_000))
    docs = spark.createDataFrame([(1, long), (2, long), (3, "w1 w2")], "doc_id long, text string")
    one, many = ({r["doc_id"]: r for r in token_alignment(docs, A, B, n).collect()} for n in (10**9, 1))
    assert one == many and one[1]["n_links"] == one[2]["n_links"] > 100_000


def test_empty_table(spark):
    assert token_alignment(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
