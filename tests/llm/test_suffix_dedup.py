import hashlib
import random

import numpy as np
import pytest

from tillmarts.llm import suffix_dedup as S


def brute(rows):
    """Rows begin with (doc_id, text)."""
    least = {}
    bodies = [(i, (t or "").encode()) for i, t, *_ in rows]
    for i, b in bodies:
        for p in range(len(b) - 49 if i is not None else 0):
            w = b[p : p + 50]
            least[w] = min(least.get(w, i), i)
    out = []
    for i, b in bodies:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 49 if i is not None else 0):
            if least[b[p : p + 50]] < i:
                gone[p : p + 50] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n, alphabet):
    """Documents that share passages of about the deciding length, shifted and overlapping."""
    rng = random.Random(seed)
    make = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    shared = [make(rng.randint(45, 160)) for _ in range(12)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(1, 6)):
            passage = rng.choice(shared)
            a = rng.randint(0, 20)
            parts += [make(rng.randint(0, 60)), passage[a : len(passage) - rng.randint(0, 20)]]
        out.append((i, "".join(parts), "en", "a"))
    return out


CASES = {
    "letters": corpus(1, 60, "abcdefgh "),
    "two letters": corpus(2, 40, "ab"),
    "several bytes a letter": corpus(3, 40, "aé漢\U0001f600"),
    "periodic": [(1, "ab" * 60, "", ""), (2, "x" + "ab" * 40 + "y", "", ""), (3, "a" * 300, "", ""), (4, "b" + "a" * 55, "", "")],
    "exact length": [(5, "q" * 50, "", ""), (4, "q" * 49, "", ""), (6, "zz" + "q" * 50, "", ""), (7, "q" * 51, "", "")],
}


@pytest.mark.parametrize("name", CASES)
def test_against_all_windows(spark, rows, documents, name):
    got = S.report(documents(CASES[name]))
    assert rows(got) == rows(spark.createDataFrame(brute(CASES[name]), got.schema))


def test_awkward_rows(spark, rows, documents, awkward_rows):
    got = S.report(documents(awkward_rows, extra=True))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert rows(got) == rows(spark.createDataFrame(brute(awkward_rows), got.schema))


def test_empty_table(documents):
    assert S.report(documents([])).count() == 0


def test_kept_texts_and_spans(documents, words):
    passage = " ".join(words[:30])
    docs = documents([(1, passage, "en", "a"), (2, "before " + passage + " after", "en", "a"), (3, None, "", "")])
    got = {r.doc_id: r for r in S.remove(docs).collect()}
    assert bytes(got[1].kept).decode() == passage and not got[1].spans and bytes(got[3].kept) == b""
    assert bytes(got[2].kept) == b"before  after"
    assert [(s.begin, s.end) for s in got[2].spans] == [(7, 7 + len(passage))]


def test_equal_windows_share_a_bucket():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(50, 120))).encode() for _ in range(150)]
    texts += [t[3:] for t in texts if len(t) > 60]
    places, heads = S.equal_windows(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts]))
    whole, begins = b"".join(texts), np.cumsum([0, *map(len, texts)])
    groups = [{whole[p : p + 50] for p in part.tolist()} for part in np.split(places, heads[1:])]
    assert all(len(g) == 1 for g in groups) and len({next(iter(g)) for g in groups}) == len(groups)
    seen: dict[bytes, int] = {}
    for a, t in zip(begins.tolist(), texts):
        for p in range(len(t) - 49):
            seen[t[p : p + 50]] = seen.get(t[p : p + 50], 0) + 1
    assert sum(n for n in seen.values() if n > 1) == len(places)


def test_runs_cover_every_window_once_and_anchors_depend_on_the_window_alone(monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abc") for _ in range(n)).encode() for n in (700, 49, 50, 51, 0, 3000)] + [b"z" * 400]
    whole = list(S.window_runs(texts))
    monkeypatch.setattr(S, "PART", 256)
    parts = list(S.window_runs(texts))
    assert len(parts) > len(whole)
    for runs in (whole, parts):
        anchor_of, count = {}, 0
        for part in runs:
            for d, a, i, n, h in zip(*(x.tolist() for x in (part.doc, part.start, part.at, part.count, part.anchor))):
                assert part.data[i : i + n + 49] == texts[d][a : a + n + 49]
                for p in range(a, a + n):
                    assert anchor_of.setdefault(texts[d][p : p + 50], h) == h
                    assert n <= S.SPAN
                    count += 1
        assert count == sum(max(len(t) - 49, 0) for t in texts)


def pieces_of(keys, texts, ranges, extra=0):
    anchors = np.unique(np.concatenate([runs.anchor for runs in S.window_runs(texts)]))
    return S.Pieces(keys, texts, anchors | np.uint64(S._SEVERAL | extra), ranges)


def test_hot_anchors_are_dealt_by_window():
    """The same spans, whether anchors go to one range or their windows to many."""
    import pandas as pd

    docs = CASES["letters"]
    keys, texts = [i for i, *_ in docs], [t.encode() for _, t, *_ in docs]
    found = []
    for note in (1, 20):
        pieces = pieces_of(keys, texts, 16, note)
        replies = {}
        for number, own in pieces.dealt():
            rows = pd.DataFrame(
                [(number, 0, b"".join(pieces.texts[i] for i in own), pieces.pieces[own].tobytes())],
                columns=["range", "chunk", "text", "pieces"],
            )
            for row in S._sort_suffixes(rows).itertuples():
                replies[row.range] = np.frombuffer(row.replies, S._REPLY)
        spans = S.chunk_spans(keys, pieces, replies)
        found.append([(i, *map(np.ndarray.tolist, spans[i])) for i in sorted(spans)])
        sizes = {len(t) for t in pieces.texts}
        assert (sizes == {50}) == (note == 20)
    assert found[0] == found[1]
    want = [(i, gone, n) for i, _, gone, n, _ in brute(docs) if gone]
    assert [(i, sum(b) - sum(a), len(a)) for i, a, b in found[0]] == want


def test_texts_are_not_shuffled(spark):
    """The table of chunks is grouped where it lies; only the other side is exchanged."""
    name = "suffix_plan"
    rows = spark.createDataFrame([(1, 1, 1, b"x")], "chunk long, row long, doc_id long, text binary")
    rows.write.mode("overwrite").bucketBy(4, "chunk").saveAsTable(name)
    shared = spark.createDataFrame([(1, b"")], S._SHARED)
    sent = spark.table(name).groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInPandas(S._send_pieces(4), S._PIECES)
    plan = sent._jdf.queryExecution().executedPlan().toString()
    spark.sql(f"DROP TABLE {name}")
    assert plan.count("Exchange") == 1, plan
