import hashlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tillmarts.llm import merkle as M
from tillmarts.llm import sha_states as S


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def climb(tree, at, folded, proof):
    for nodes in tree[:-1]:
        run = range(at - at % 3, min(at - at % 3 + 3, len(nodes)))
        proof += [nodes[i] for i in run if i != at]
        folded = h(*[folded if i == at else nodes[i] for i in run])
        at //= 3
    return folded


def brute(rows, change):
    """Rows are (doc_id, text, lang, source)."""
    groups = defaultdict(list)
    for i, t, lang, source in rows:
        n = None if t is None else len(t)
        groups[source].append((i, leaf((i, source, lang, n, t)), leaf((i, source, lang, n, change(i, t)))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = levels([x[1] for x in groups[s]])
    top = levels([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for at, (i, own, changed) in enumerate(groups[s]):
            proof = []
            folded = climb(top, k, climb(trees[s], at, changed, proof), proof)
            out.append((i, own, trees[s][-1][0], top[-1][0], h(*proof), folded, folded == top[-1][0]))
    return out


def test_states_are_those_of_sha256():
    digests = np.random.default_rng(1).integers(0, 2**32, (50, 8), dtype=np.uint32)
    state = S.started(50)
    for taken in range(4):
        want = [h(*[S.to_bytes(np.roll(digests, -k, 0))[i].hex() for k in range(taken)]) for i in range(50)]
        assert [d.hex() for d in S.to_bytes(S.finish(state, np.full(50, taken)))] == want
        state = S.absorb(state, np.roll(digests, -taken, 0))


def test_against_plain_trees(spark, rows, documents, awkward_rows):
    got = M.manifest(documents(awkward_rows, extra=True), F.translate("text", "\n ", ""))
    want = brute(awkward_rows, lambda i, t: t and t.replace("\n", "").replace(" ", ""))
    assert rows(got) == rows(spark.createDataFrame(want, got.schema))


def test_tree_sizes(spark, rows, documents):
    """Trees of one to three storeys, all in one manifest."""
    sizes = [1, 2, 3, 4, 9, 10, 28, 243, 244, 730, 59_050]
    data = [(1000 * k + i, f"{i}\n" * (i % 3), "en", f"s{n}") for k, n in enumerate(sizes) for i in range(n)]
    even = F.col("doc_id") % 2 == 0
    got = M.manifest(documents(data), F.when(even, F.translate("text", "\n", "")).otherwise(F.col("text")))
    want = brute(data, lambda i, t: t.replace("\n", "") if i % 2 == 0 else t)
    assert rows(got) == sorted(want)


def test_repeated_rows_are_leaves_of_their_own(spark, documents):
    data = [(7, "same", "en", "a")] * 500 + [(8, "other", "en", "a")]
    got = M.manifest(documents(data)).collect()
    assert len(got) == 501 and all(r.verified and r.folded_root == r.root for r in got)
    assert len({r.proof_sha256 for r in got}) > 1


def test_any_change_is_noticed(documents):
    data = [(i, f"text {i}", "en", f"s{i % 3}") for i in range(50)]
    got = M.manifest(documents(data), F.when(F.col("doc_id") == 11, F.lit("text 12")).otherwise(F.col("text")))
    assert [r.doc_id for r in got.filter("not verified").collect()] == [11]


def test_empty_table(documents):
    got = M.manifest(documents([]))
    assert got.count() == 0 and got.columns[-1] == "verified"
