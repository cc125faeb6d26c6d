"""The registered queries on the smallest test tables, against SQL or a plain version."""

from __future__ import annotations

import os
import sys
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    from check_expected import connect

    return connect(FOLDER)


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op3_topk_search", "op10_mixing", "op11_merkle_manifest", "op12_suffix_dedup", "op13_spelling_variants"])
def test_against_sql(spark, con, name):
    from check_expected import compare

    assert compare(spark, con, FOLDER, name) is None


@pytest.mark.parametrize(
    "name", ["op1_toxicity", "op4_html_text", "op5_sharding", "op6_token_output", "op7_disclosure", "op8_packing", "op9_jaccard_join"]
)
def test_every_row_has_its_result(spark, name):
    table = "pages" if name.startswith("op4") else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    want = Counter(r[0] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select(key).collect())
    found = Counter(r[0] for r in entry.queries()[name](spark, FOLDER).select(key).collect())
    assert found == want if name != "op8_packing" else set(found) == set(want)


def test_toxicity_never_learns_from_the_held_out_fold(spark, monkeypatch):
    from tillmarts.llm import queries, toxicity

    seen = []
    monkeypatch.setattr(toxicity, "train", lambda docs, labels: seen.append(labels) or toxicity.Model(0.0, {}))
    rows = queries.op1_toxicity(spark, FOLDER).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 for r in seen[0].collect())
    assert {r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows} == {True}


def test_near_copies_against_all_pairs(spark):
    from test_jaccard_join import brute

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in entry.queries()["op9_jaccard_join"](spark, FOLDER).collect()), key=str)
    assert found == brute(rows, 4, 85)
