"""Load steps into folders, keyed and versioned tables; dead letters."""

from __future__ import annotations

import re
import uuid

import pytest
from pyspark.sql import functions as F

from tillmarts.operators import joins, loads
from tillmarts.sources.targets import Folder, Keyed, Versions, target
from tillmarts.storage import fresh_path

DOCS = "id bigint, body string"


@pytest.fixture(params=["folder", "keyed", "versions", "versions by layout"])
def place(request, spark):
    path = fresh_path(spark, "target")
    if request.param == "folder":
        return Folder(path)
    if request.param == "keyed":
        return Keyed(f"t_{uuid.uuid4().hex}", "id", path, 4)
    return Versions(path, "id", "id div 100" if "layout" in request.param else None)


def test_a_load_appends_what_is_new_and_nothing_twice(spark, rows, place):
    assert not place.exists(spark)
    first = spark.createDataFrame([(1, "a"), (250, "b"), (None, "n")], DOCS)
    loads.append_new(first, place, lambda df: df, "id", ["body"])
    assert place.exists(spark)
    batch = spark.createDataFrame([(250, "other"), (3, "z"), (3, "c"), (900, "d")], DOCS)
    for _ in range(3):
        loads.append_new(batch, place, lambda df: df, "id", ["body"])
    everything = place.holding(spark.range(1000).select("id"))
    want = [(1, "a"), (3, "c"), (250, "b"), (900, "d")]
    assert rows(everything.filter("id IS NOT NULL")) == want


def test_keys_as_text(spark, rows, place):
    loads.append_new(spark.createDataFrame([(5, "a")], DOCS), place, lambda df: df, "id")
    batch = spark.createDataFrame([("5", "x"), ("6", "y")], "id string, body string")
    loads.append_new(batch, place, lambda df: df.withColumn("id", F.col("id").cast("bigint")), "id", as_text=True)
    assert rows(place.holding(batch.select("id")).filter("body <> 'x'"))[-1] == (6, "y")


@pytest.fixture
def no_broadcast(spark):
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(name, "-1")
    yield
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.unset(name)


def test_a_keyed_target_stays_where_it_is_however_large_the_batch(spark, no_broadcast):
    place = Keyed(f"t_{uuid.uuid4().hex}", "id", fresh_path(spark, "keyed"), 8)
    place.append(spark.range(5000).select("id", F.lit("x").alias("body")))
    assert len(place.holding(spark.range(1)).inputFiles()) == 8
    batch = spark.range(4000, 6000).select("id", F.lit("y").alias("body"))
    out = joins.anti_join_existing(batch, place.holding(batch.select("id")), "id")
    assert out.count() == 1000
    text = out._jdf.queryExecution().executedPlan().toString()
    # What lies between the scan of the table and the next join above it holds no exchange.
    lines = text[: text.index("Bucketed: true")].splitlines()
    above = lines[max(i for i, line in enumerate(lines) if "SortMergeJoin" in line) :]
    depth = lambda line: len(re.match(r"[ :+-]*", line)[0])
    scan = above[-1]
    parents = []
    for line in reversed(above):
        if not parents or depth(line) < depth(parents[-1]):
            parents.append(line)
    assert "FileScan" in scan and not any("Exchange" in line for line in parents), text
    assert "Broadcast" not in text


def test_a_versioned_target_is_scanned_near_the_batch_only(spark, monkeypatch):
    place = Versions(fresh_path(spark, "versioned"), "id")
    for start in range(0, 1000, 100):
        place.append(spark.range(start, start + 100).select("id", F.lit("x").alias("body")))
    near = place.holding(spark.createDataFrame([(310,), (420,), (5000,)], "id bigint"))
    assert near.agg(F.min("id"), F.max("id")).first() is not None
    held = {r.id // 100 for r in near.select("id").collect()}
    assert held <= {3, 4} and {3, 4} <= held
    assert place.holding(spark.createDataFrame([(5000,), (None,)], "id bigint")).count() == 0


def test_paths_are_folders():
    assert target("x") == Folder("x") and target(Folder("y")) == Folder("y")


def test_dead_letters_are_kept_once_for_each_content(spark, rows):
    path, rejects = fresh_path(spark, "casts"), fresh_path(spark, "rejects")
    source = spark.createDataFrame([(1, "5"), (2, "x"), (3, None), (2, "x"), (4, "w"), (None, "v")], DOCS)

    def run(df):
        loads.append_new(df, path, lambda d: d, "id", ["body"], casts={"body": "bigint"}, rejects=rejects)

    for _ in range(3):
        run(source)
    assert rows(spark.read.parquet(rejects)) == [(None, "v"), (2, "x"), (4, "w")]
    run(spark.createDataFrame([(2, "other"), (4, "7")], DOCS))  # other content; and one that is mended
    assert rows(spark.read.parquet(rejects)) == [(None, "v"), (2, "other"), (2, "x"), (4, "w")]
    assert rows(spark.read.parquet(path), "id", "body") == [(1, 5), (3, None), (4, 7)]


def test_dead_letters_with_nested_columns(spark):
    rejects = fresh_path(spark, "rejects")
    bad = spark.sql("SELECT 1 AS id, array(named_struct('a', 1, 'b', CAST(NULL AS STRING))) AS items, map('k', 1) AS m, CAST(NULL AS INT) AS n")
    for _ in range(2):
        loads.keep_rejects(bad, rejects, "id")
    assert spark.read.parquet(rejects).count() == 1
    loads.keep_rejects(bad.withColumn("n", F.lit(0)), rejects, "id")
    assert spark.read.parquet(rejects).count() == 2
