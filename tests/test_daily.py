"""Document, bulk and stock loads, and a daily run that is lost on the way and started again."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tillmarts import standin as S
from tillmarts.catalog import models
from tillmarts.plans import daily, loads, marts
from tillmarts.plans.ads import CREATIVE_FIELDS
from tillmarts.sources import versioned as V
from tillmarts.sources.targets import Folder, Versions
from tillmarts.storage import fresh_path

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
NOW = int(dt.datetime(2024, 1, 15, 15, tzinfo=dt.timezone.utc).timestamp())  # noon in Santiago

ITEM = "id bigint, emissionDate bigint, number bigint, details string, office struct<id:bigint>"


def test_documents_of_the_window_are_stored_once_as_18_columns(spark, rows):
    place = Versions(fresh_path(spark, "documents"), "id")
    items = spark.createDataFrame(
        [(1, NOW, 9, '[{"id":1}]', (4,)), (1, NOW, 8, None, None), (2, NOW - 90 * 86_400, 1, None, None), (3, NOW - 86_400, 3, None, None)],
        ITEM,
    )
    for _ in range(2):
        loads.documents_load(items, place, "2024-01-15 12:00:00")
    stored = V.read(spark, place.path)
    assert len(stored.columns) == 18
    assert rows(stored, "id", "number", "details", "office", "client") == [(1, 8, "[]", "{}", "{}"), (3, 3, "[]", "{}", "{}")]


def test_documents_without_a_whole_id_are_dead_letters(spark, rows):
    place, rejects = Folder(fresh_path(spark, "documents")), fresh_path(spark, "rejects")
    data = [("01", str(NOW), 9), ("x", str(NOW), 8), ("3", "soon", 7), ("4", "1", 6), ("5", None, 5)]
    items = spark.createDataFrame(data, "id string, emissionDate string, number bigint")
    for _ in range(2):
        loads.documents_load(items, place, "2024-01-15 12:00:00", rejects=rejects)
    assert rows(spark.read.parquet(place.path), "id", "emissionDate", "number") == [(1, NOW, 9)]
    assert rows(spark.read.parquet(rejects)) == [("3", "soon", 7), ("x", str(NOW), 8)]


def test_bulk_load_fills_gaps_from_the_second_source(spark, rows):
    place = Versions(fresh_path(spark, "documents"), "id")
    every = spark.range(1, 101).select("id", F.lit(NOW).alias("emissionDate"), F.col("id").alias("number"))
    listed = every.filter("id % 7 <> 0")
    cursors = spark.createDataFrame([(1,), (40,), (90,)], "id bigint")  # 90 only closes
    for _ in range(2):
        loads.documents_bulk_load(listed, every, cursors, place)
    assert rows(V.read(spark, place.path), "id") == [(i,) for i in range(1, 90)]


def test_stock_is_replaced_as_a_whole(spark, rows):
    path = fresh_path(spark, "stock")
    loads.stock_load(spark.createDataFrame([(1, 5.0), (2, 6.0), (2, 7.0)], "id bigint, quantity double"), path)
    before = V.read(spark, path)
    loads.stock_load(spark.createDataFrame([(3, 1.0)], "id bigint, quantity double"), path)
    assert rows(V.read(spark, path), "id", "quantity") == [(3, 1.0)]
    assert rows(before, "id", "quantity") == [(1, 5.0), (2, 6.0)]


def test_creatives_are_merged_with_their_posts(spark, rows):
    path = fresh_path(spark, "creatives")
    ads = spark.createDataFrame([("1", ("c1",)), ("2", ("c1",)), ("3", ("c2",)), ("4", None)], "id string, creative struct<id:string>")
    fields = ", ".join(f"CAST(NULL AS STRING) AS {c}" for c in CREATIVE_FIELDS if c != "body")
    details = spark.sql(f"SELECT id, 'own ' || id AS body, IF(id = 'c1', 'p1', NULL) AS effective_object_story_id, {fields}, "
                        "CAST(NULL AS STRUCT<a:INT>) AS object_story_spec FROM VALUES ('c1'), ('c2') t(id)")  # fmt: skip
    posts = spark.sql(
        "SELECT 'p1' AS id, 'text' AS message, '/p1' AS permalink_url, '2024' AS created_time, "
        "named_struct('data', array(named_struct('type', 'photo', 'target', named_struct('id', 'v')))) AS attachments"
    )
    loads.creatives_load(ads.filter("id < 3"), details, path, posts)
    loads.creatives_load(ads, details, path, posts)
    assert rows(V.read(spark, path), "ad_creative_id", "ad_id", "body", "post_link") == [
        ("c1", "1", "text", "/p1"), ("c2", "3", "own c2", None),
    ]


@needs_data
def test_a_daily_run_that_is_lost_can_be_started_again(spark, monkeypatch):
    """Lost in each of its steps in turn; the run that ends has the marts of one that was never lost."""
    lookups = S.ad_statuses(spark, FOLDER), S.adset_budgets(spark, FOLDER), S.campaign_budgets(spark, FOLDER)
    landed = daily.Landed(S.documents(spark, FOLDER), S.stock_raw(spark, FOLDER), S.insights_raw(spark, FOLDER), *lookups)
    sources = models._sources(spark, FOLDER)

    def run(warehouse):
        return daily.daily_run(spark, landed, sources, warehouse, dt.datetime(2003, 1, 1), 4000, 10_000)

    def totals(built):
        return {k: (df.count(), sorted(df.columns)) for k, df in built.items()}

    want = totals(run(fresh_path(spark, "undisturbed")))
    assert want["stock_ledger"][0] > 0 and set(models._MARTS) <= set(want)
    warehouse = fresh_path(spark, "disturbed")

    def lost(*args, **kwargs):
        raise OSError("lost")

    for module, name in ((daily, "stock_load"), (daily, "ads_load"), (marts.sales, "sales_core")):
        with monkeypatch.context() as m:
            m.setattr(module, name, lost)
            with pytest.raises(OSError):
                run(warehouse)
        if module is daily:  # marts of a lost run lie under the same second; the next one has another
            assert V.read(spark, f"{warehouse}/documents").count() == 1500
    monkeypatch.setattr(daily, "build_marts", lambda s, sources, folder, as_of: marts.build_marts(s, sources, folder + "-again", as_of))
    assert totals(run(warehouse)) == want
    assert V.read(spark, f"{warehouse}/documents").count() == 1500
