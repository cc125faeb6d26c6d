from collections import Counter

import pytest

from tillmarts.llm import mixing as M
from tillmarts.llm.common import WORDS


def targets(sizes, weights=(5, 2, 1), percent=150, most=2):
    """Share, cut, share the excess again, until nothing is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full, out = percent * sum(sizes.values()) / 100, set(), {}
    while True:
        open_ = [s for s in names if s not in full]
        total = sum(weight[s] for s in open_)
        out |= {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if out[s] >= most * sizes[s]]
        if not over:
            return out
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            full.add(s)
        if len(full) == len(names):
            return out


def check(plan, given):
    size = Counter()
    for _, text, _, source in given:
        size[source] += len(WORDS.findall(text or ""))
    want = targets(dict(size))
    taken = Counter()
    for r in plan:
        assert r.source_size == size[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    return taken, want


def test_awkward_rows(documents, awkward_rows):
    plan = M.plan(documents(awkward_rows, extra=True)).collect()
    assert len(plan) == len(awkward_rows)
    check(plan, awkward_rows)


def test_taken_words_come_near_the_targets(documents):
    given = [(i, "w " * (1 + i * 7 % 40), "en", None if i % 10 == 0 else f"s{i % 3}") for i in range(6000)]
    taken, want = check(M.plan(documents(given)).collect(), given)
    for source, target in want.items():
        assert taken[source] == pytest.approx(target, rel=0.05)


def test_mix_repeats_rows_as_planned(documents, awkward_rows):
    docs = documents(awkward_rows, extra=True)
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    planned = Counter()
    for r in M.plan(docs).collect():
        planned[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed.collect()) == +planned


def test_reruns_agree_and_seeds_differ(documents):
    given = [(i, "a b c", "en", f"s{i % 4}") for i in range(400)]
    one = {(r.doc_id, r.copies) for r in M.plan(documents(given)).collect()}
    assert one == {(r.doc_id, r.copies) for r in M.plan(documents(given).repartition(7)).collect()}
    assert one != {(r.doc_id, r.copies) for r in M.plan(documents(given), seed="other").collect()}


def test_nothing_to_mix(documents):
    assert M.plan(documents([])).count() == 0 and M.mix(documents([])).count() == 0
    wordless = M.plan(documents([(1, None, "", "a"), (2, " ", "", "b")])).collect()
    assert [(r.size, r.target, r.taken) for r in wordless] == [(0, 0.0, 0)] * 2
