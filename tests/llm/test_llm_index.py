"""The decontamination index against exhaustive scoring."""

import random
import tracemalloc

import numpy as np
import pytest

from arenaflow.llm import blockmax
from arenaflow.llm.blockmax import BlockMaxIndex, Collection
from arenaflow.llm.op3_decontamination import Searcher, split_item, text_words


def vocabulary(n, rng):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n)]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.6])
def test_block_max_wand_finds_all_above_the_threshold(seed, threshold):
    rng = random.Random(seed)
    words = vocabulary(150, rng)
    items = [[rng.choice(words) for _ in range(rng.randint(3, 30))] for _ in range(120)]
    index = BlockMaxIndex(items)
    queries = [items[7], items[3] + items[90], *([rng.choice(words) for _ in range(40)] for _ in range(30))]
    for query in queries:
        terms = {index.terms[w] for w in query if w in index.terms}
        scores = np.zeros(len(items))
        for t in terms:
            for item, s in index.postings[t]:
                scores[item] += s
        want = set(np.flatnonzero(scores >= threshold).tolist())
        found = index.search(terms, threshold)
        assert {i for i, _ in found} == want
        assert all(abs(s - scores[i]) < 1e-9 for i, s in found)
        if want:  # the bound of the whole passage must let it through
            assert index.may_reach(np.zeros(len(terms), np.int64), np.array(sorted(terms)), 1, threshold).tolist() == [0]


def test_items_are_found_wherever_they_stand():
    rng = random.Random(5)
    words = vocabulary(4000, rng)
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(8, 60))) + ". " + " ".join(rng.choice(words) for _ in range(6)) + ".") for i in range(100)]
    search = Searcher.of(items, 0.5, 0.5)
    for item, text in items:
        before, after = ([rng.choice(words) for _ in range(rng.randint(0, 300))] for _ in range(2))
        found = search(" ".join(before) + "\n" + text.upper() + "\n" + " ".join(after))
        assert item in [f[0] for f in found]
    clean = " ".join(rng.choice(words) for _ in range(3000))
    assert search(clean) == [] == search(None) == search("") == search("?!")


def test_question_alone_is_no_hit():
    item = "one two three four five six seven eight nine ten. eleven twelve thirteen fourteen fifteen."
    search = Searcher.of([(1, item), (2, "other words here. not the same at all.")], 0.5, 0.5)
    assert [f[0] for f in search(item)] == [1]
    assert search("one two three four five six seven eight nine ten.") == []
    assert split_item("a b. c d") == (["a", "b"], ["c", "d"]) and split_item("a b c") == (["a", "b"], ["c"])


def test_few_and_equal_items():
    search = Searcher.of([(1, "alpha beta"), (2, "alpha beta"), (3, ""), (None, "gamma")], 0.5, 0.5)
    assert [f[0] for f in search("x alpha beta gamma")] == [1, 2, None]
    assert Searcher.of([], 0.5, 0.5)("alpha") == [] and text_words(None) == []


def test_a_part_of_the_items_scores_like_the_whole():
    rng = random.Random(9)
    words = vocabulary(150, rng)
    items = [[rng.choice(words) for _ in range(rng.randint(3, 30))] for _ in range(90)]
    whole, collection = BlockMaxIndex(items), Collection.of(items)
    parts = [(k, BlockMaxIndex(items[k : k + 9], collection)) for k in range(0, 90, 9)]
    for _ in range(30):
        query = [rng.choice(words) for _ in range(40)]
        want = whole.search({whole.terms[w] for w in query if w in whole.terms}, 0.3)
        found = [(k + i, s) for k, part in parts for i, s in part.search({part.terms[w] for w in query if w in part.terms}, 0.3)]
        assert found == want  # to the last bit


def test_runs_of_windows_bound_the_same(monkeypatch):
    rng = random.Random(10)
    words = vocabulary(3_000, rng)
    items = [[rng.choice(words) for _ in range(rng.randint(3, 20))] for _ in range(200)]
    index = BlockMaxIndex(items)
    pairs = [(k, index.terms[w]) for k in range(0, 50, 2) for w in items[3 * k]] + [(rng.randrange(50), rng.randrange(len(index.postings))) for _ in range(400)]
    window, term = (np.array(x) for x in zip(*pairs, strict=True))
    whole = index.may_reach(window, term, 50, 0.7).tolist()
    assert 0 < len(whole) < 50
    for size in (1, 100, 5_000):
        monkeypatch.setattr(blockmax, "PAIRS", size)
        assert index.may_reach(window, term, 50, 0.7).tolist() == whole


def test_long_text_against_many_items_in_bounded_memory():
    rng = random.Random(11)
    words = vocabulary(6_000, rng)
    items = [(i, " ".join(rng.choice(words) for _ in range(25)) + ". " + " ".join(rng.choice(words) for _ in range(6))) for i in range(20_000)]
    search = Searcher.of(items, 0.5, 0.5)
    text = " ".join(rng.choice(words) for _ in range(70_000)) + " " + items[123][1]
    tracemalloc.start()
    found = search(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [f[0] for f in found] == [123] and peak < 250e6
