"""Every registered query against its expected-result SQL, whole results compared."""

from __future__ import annotations

import os
import sys

import pytest

import __spark_entry__ as entry
from tillmarts.catalog import registered

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    from check_expected import connect

    return connect(FOLDER)


def test_every_query_states_its_result():
    assert all(q.sql for q in registered().values())
    assert registered().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(registered()))
def test_query(spark, con, name):
    from check_expected import compare

    assert compare(spark, con, FOLDER, name) is None


def test_a_wrong_result_is_noticed(spark, con, monkeypatch):
    """The comparison itself: a changed value, a missing row and a changed type all show."""
    from check_expected import compare

    sql = entry.oracle_sql()["max_by_group"]
    for wrong in (
        sql.replace("max(l_extendedprice)", "min(l_extendedprice)"),
        sql.replace("GROUP BY", "WHERE l_suppkey > 1 GROUP BY"),
        sql.replace("max(l_extendedprice)", "CAST(max(l_extendedprice) AS DECIMAL(18,2))"),
    ):
        monkeypatch.setattr(entry, "oracle_sql", lambda wrong=wrong: {"max_by_group": wrong})
        assert compare(spark, con, FOLDER, "max_by_group")


def test_entry(spark):
    daily = entry.entry(spark)
    assert daily.columns[:3] == ["fecha", "variant_description", "orden_tallas"] and daily.count() > 0
