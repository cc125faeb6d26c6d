import random
from collections import defaultdict

import numpy as np
import pytest

from tillmarts.llm import jaccard_join as J
from tillmarts.llm.common import LOWERED, WORDS
from tillmarts.llm.graph import components


def brute(rows, words, percent):
    sets = []
    for _, text, *_ in rows:
        w = WORDS.findall((text or "").translate(LOWERED))
        k = min(words, len(w))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    different = list(dict.fromkeys(sets))
    first = {}
    for i, s in enumerate(sets):
        if s and s in first:
            parent[find(i)] = find(first[s])
        first.setdefault(s, i)
    for a in range(len(different)):
        for b in range(a):
            x, y = different[a], different[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(first[x])] = find(first[y])
    names = defaultdict(list)
    for i, (key, *_) in enumerate(rows):
        names[find(i)].append(key)
    out = []
    for i, (key, *_) in enumerate(rows):
        known = [k for k in names[find(i)] if k is not None]
        out.append((key, len(sets[i]), (min(known) if known else None) if sets[i] else key))
    return sorted(out, key=str)


def families(seed, words, sizes, edits, length=60):
    """Families of near copies of one text each, and a passage that many other texts share."""
    rng = random.Random(seed)
    rows = []
    for size in sizes:
        base = [rng.choice(words) for _ in range(length)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(text))
                text[at : at + 1] = rng.choice([[], [rng.choice(words)], [text[at], rng.choice(words)]])
            rows.append(" ".join(text))
    passage = " ".join(rng.choice(words) for _ in range(40))
    rows += [f"{passage} {' '.join(rng.choice(words) for _ in range(rng.randint(2, 50)))}" for _ in range(60)]
    rng.shuffle(rows)
    return [(i + 1, text, "en", "a") for i, text in enumerate(rows)]


@pytest.fixture(params=[(5, 80), (4, 85)])
def rule(request):
    return request.param


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_families(documents, words, rule, seed):
    rows = families(seed, words, [2] * 20 + [5] * 8 + [40, 90], 4)
    assert got(J.join(documents(rows), *rule)) == brute(rows, *rule)


def test_small_blocks_and_chunks(documents, words, rule, monkeypatch):
    """Large groups as pairs of blocks, documents in many chunks."""
    monkeypatch.setattr(J, "BLOCK_SETS", 7)
    monkeypatch.setattr(J, "CHUNK_TOKENS", 500)
    monkeypatch.setattr(J, "UNIT_SETS", 20)
    rows = families(3, words, [2] * 10 + [30, 60, 120], 5)
    assert got(J.join(documents(rows), *rule)) == brute(rows, *rule)


def test_awkward_rows(documents, awkward_rows, rule):
    docs = documents(awkward_rows, extra=True)
    assert got(J.join(docs, *rule)) == brute(awkward_rows, *rule)


def test_small_sets_by_all_pairs(documents):
    """Every text of up to six words over three words: sets of one to a few shingles."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(1, 9))), "en", "a") for i in range(250)]
    assert got(J.join(documents(rows), words=2, percent=60)) == brute(rows, 2, 60)


def test_keep_one(documents, words):
    rows = families(6, words, [2] * 10 + [6] * 5, 2) + [(None, "a b c d e f", "", ""), (None, None, "", "")]
    docs = documents(rows, extra=True)
    kept = J.keep_one(docs)
    assert kept.columns == docs.columns
    want = sorted(str(k) for k, n, c in brute(rows, 5, 80) if k is None or k == c)
    assert sorted(str(r.doc_id) for r in kept.collect()) == want


def test_empty_table(documents):
    assert J.join(documents([])).count() == 0 and J.keep_one(documents([])).count() == 0


def test_longer_prefixes_meet():
    """least_shared never asks for more than two linked sets of any sizes must have in common."""
    for percent in (60, 80, 85, 95):
        for n in range(1, 400):
            smallest = -(-n * percent // 100)
            for tenths in (J.LONGER, J.LONGEST):
                least = J.longer_prefix(smallest, percent, tenths) - J.own_tokens(smallest, percent)
                for m in range(smallest, n + 1):
                    assert J.longer_prefix(m, percent, tenths) - J.own_tokens(m, percent) >= least >= 1


def test_intersections(words):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40))) for _ in range(30)] + [np.empty(0, np.int64)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    shared = J._common(sets, width=8)
    for i in range(len(sets)):
        for j in range(len(sets)):
            assert i == j or shared[i, j] == want[i][j]


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(-500, 500), rng.randrange(-500, 500)) for _ in range(400)]
    edges += [(i, i + 1) for i in range(1000, 1200)] + [(5000, i) for i in range(5001, 5200)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in list(parent)}
    df = spark.createDataFrame(edges * 2, "a long, b long")
    found = [tuple(r) for r in components(df).collect()]
    assert len(found) == len(set(found)) == len(dict(found))
    assert all(want[n] == label for n, label in found)
    assert {n for n, _ in found} == {n for n in want if any(n in e and e[0] != e[1] for e in edges)}
    assert components(df.limit(0)).count() == 0
