"""The pipeline stage by stage against plain Python over the same rows."""

from __future__ import annotations

import os
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from tillmarts.llm import mixing, packing
from tillmarts.llm.common import LOWERED
from tillmarts.storage import materialize

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def test_every_stage(spark):
    from test_jaccard_join import brute

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "jaccard_join", "mixing", "packing"]

    def step(name, docs):
        out = materialize(stages[name](spark, docs, FOLDER), f"test-{name}")
        assert name == "packing" or out.columns == columns
        return out

    clean = step("toxicity", docs)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in clean.collect()}
    assert sum(i in kept for i, y in labels.items() if y == 0) >= 0.95 * sum(y == 0 for y in labels.values())
    assert sum(i in kept for i, y in labels.items() if y == 1) < sum(labels.values())

    single = step("exact_dedup", clean)
    largest = {}
    for r in clean.collect():
        text = (r.text or "").translate(LOWERED)
        largest[text] = max(largest.get(text, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in single.collect()) == sorted(largest.values())

    apart = step("jaccard_join", single)
    rows = [(r.doc_id, r.text) for r in single.collect()]
    assert sorted(r.doc_id for r in apart.collect()) == sorted(k for k, _, c in brute(rows, 5, 80) if k == c)

    mixed = step("mixing", apart)
    copies = {r.doc_id: r.copies for r in mixing.plan(apart).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == +Counter(copies)

    packed = step("packing", mixed).collect()
    pieces = defaultdict(int)
    filled = defaultdict(int)
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert filled[r.sequence_id] == r.offset
        filled[r.sequence_id] += r.length
        pieces[r.doc_id] += r.length
    assert max(filled.values()) <= packing.CAPACITY
    tokens = {r.doc_id: r.doc_tokens for r in packed}
    assert all(n == tokens[i] * copies[i] for i, n in pieces.items()) and set(pieces) == {i for i, c in copies.items() if c}


def test_no_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.count() == 0
