import random
from collections import Counter

import numpy as np
import pytest

from tillmarts.llm import spelling as S


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(counts, ratio=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), form[w] and counts[form[w]]))
    return out


def vocabulary(seed, n, letters, lengths):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.choice(lengths))) for _ in range(n)}
    return {w: rng.choice([1, 2, 7, 7, 40, 300]) for w in words}


CASES = {
    "short and dense": vocabulary(1, 250, "ab", range(1, 8)),
    "usual": vocabulary(2, 400, "abcé", range(5, 8)),
    "wide code points": vocabulary(3, 150, "a漢\U0001f600", range(3, 6)),
    "same beginning": {"prefix" + w: n for w, n in vocabulary(4, 200, "xyz", range(1, 6)).items()},
    "runs": {"a" * k + "b" * j: 5 ** (k % 4) for k in range(6) for j in range(6)},
    "long": {"q" * 3000: 1, "q" * 2999: 9, "q" * 1500 + "x" + "q" * 1499: 70, "r" + "q" * 2999: 8},
}


@pytest.mark.parametrize("name", CASES)
def test_against_all_pairs(spark, rows, name):
    counts = CASES[name]
    got = S.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert rows(got) == rows(spark.createDataFrame(brute(counts), got.schema))


def test_a_large_set_is_compared_in_tiles_and_each_pair_once(spark, rows, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 40)
    counts = {"common" + w: n for w, n in vocabulary(5, 500, "abcd", range(1, 6)).items()}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    cut = S.tiles(words)
    largest = cut.groupBy(*S._TILE).count().agg({"count": "max"}).first()[0]
    assert largest < 4 * 40 and cut.select("low", "high").distinct().count() > 10
    assert rows(S.variants(words)) == rows(spark.createDataFrame(brute(counts), S.variants(words).schema))


def test_prefix_and_suffix_lengths():
    words = ["abcdef", "abXdef", "abcdeX", "Xbcdef", "abcde", "bcdef", "abccdef"]
    width = max(map(len, words))
    ahead, back = S.code_points(words, width), S.code_points(words, width, from_right=True)
    assert S.common_lengths(ahead[:1], ahead, 5).tolist() == [[5, 2, 5, 0, 5, 0, 3]]
    assert S.common_lengths(back[:1], back, 5).tolist() == [[5, 3, 0, 5, 0, 5, 4]]
    assert S.common_lengths(ahead, ahead[:0], 5).shape == (7, 0)


def test_chain_of_forms(spark):
    counts = {"abcdefg" + "hij"[:k]: 10**k for k in range(4)}
    got = {r.word: r for r in S.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got["abcdefg"].form == "abcdefgh" and {r.root for r in got.values()} == {"abcdefghij"}


def test_words_of_documents(spark, documents, awkward_rows):
    text = "Straße straße, STRASSE Ünïcode don't élèves x" * 3 + " élèves"
    docs = documents([*awkward_rows, (50, text, "fr", "a"), (51, text, None, None)], extra=True)
    import re

    want = Counter()
    for _, t, *_ in [*awkward_rows, (50, text), (51, text)]:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            lowered = "".join(c.lower() if c.isascii() else c for c in run)
            want[lowered] += len(lowered) >= 6
    got = {r.word: r.n for r in S.word_counts(docs, least_count=2).collect()}
    assert got == {w: n for w, n in want.items() if n >= 2}


def test_awkward_counts(spark, rows):
    data = [("abcdef", 3), ("abcdef", 4), (None, 9), ("abcdex", None), ("", 1), ("a", 5), ("zzzzzz", 1)]
    got = S.variants(spark.createDataFrame(data, "word string, n long").selectExpr("*", "'x' AS form", "1 AS block"))
    want = [("", "a", "a", 1, 1, 5), ("a", None, "a", 5, 1, None), ("abcdef", None, "abcdef", 7, 0, None), ("zzzzzz", None, "zzzzzz", 1, 0, None)]
    assert rows(got) == rows(spark.createDataFrame(want, got.schema))
    assert S.variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_cycles_are_an_error(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "a")], "word string, form string")
    with pytest.raises(RuntimeError):
        S.roots(links, most_rounds=3)
    assert np.array_equal(S.code_points(["é"], 2), [[0xE9, 0]])
