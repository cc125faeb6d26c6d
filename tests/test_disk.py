"""What jobs of many steps hold on disk and send through the driver."""

from __future__ import annotations

import glob
import time

from pyspark.sql import functions as F
from test_plans import made, no_broadcast, spark_optimized  # noqa: F401  (one of them is a fixture)

from tillmarts import standin, storage
from tillmarts.operators import joins, loads
from tillmarts.plans import ads, sales, stock
from tillmarts.sources import versioned, writers
from tillmarts.sources.targets import Versions
from tillmarts.storage import materialize


def shuffle_files(spark):
    store = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.getAllFiles()) if f.getName().endswith(".data")}


def left_over(spark, before):
    """Shuffle files that are still there after a while."""
    for _ in range(100):
        if not (found := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return found


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    df = spark.range(1000).groupBy((F.col("id") % 50).alias("id")).agg(F.count("id").alias("n"))
    before = shuffle_files(spark)
    table = materialize(df, "summed")
    writers.sink_overwrite(df, f"{tmp_path}/mart")
    assert not left_over(spark, before)
    versioned.append(f"{tmp_path}/versions", df, "id")
    assert table.count() == spark.read.parquet(f"{tmp_path}/mart").count() == versioned.read(spark, f"{tmp_path}/versions").count() == 50
    assert spark.conf.get(storage.CLEANUP) == "false"


def test_staging_of_a_load_is_deleted(spark, tmp_path):
    staging = f"{storage.shared_folder(spark)}/tillmarts/{spark.sparkContext.applicationId}".removeprefix("file:")
    there = {p for n in ("merge", "replace") for p in glob.glob(f"{staging}/{n}-staging-*")}
    rows = spark.range(10).select("id", F.lit("x").alias("body"))
    path = f"{tmp_path}/t"
    for write in (lambda: versioned.merge(path, rows, "id", ["body"]), lambda: versioned.replace(path, rows, "id")):
        write()
        assert not {p for n in ("merge", "replace") for p in glob.glob(f"{staging}/{n}-staging-*")} - there
        assert versioned.read(spark, f"{tmp_path}/t").count() == 10


def test_rows_that_are_stored_already_are_not_shuffled_again(spark, no_broadcast, monkeypatch, tmp_path):
    place = Versions(f"{tmp_path}/documents", "id")
    batch = materialize(spark.range(1000).select("id", F.lit("x").alias("body")), "batch")
    plans = []
    shape = lambda df: plans.append(spark_optimized(df)) or df
    for some in (batch.filter("id < 990"), batch.unionByName(batch)):
        loads.append_new(some, place, shape, "id")
    assert "LeftSemi" in plans[1] and "LeftAnti" not in plans[1]
    assert versioned.read(spark, place.path).count() == versioned.read(spark, place.path).distinct().count() == 1000


def test_rows_without_a_key_count_as_new(spark, rows):
    batch = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b'), (3, 'c'), (NULL, 'd'), (NULL, 'd') t(id, body)")
    for stored in ([1, 2, 3], [1, 2], [1], [9]):
        held = spark.createDataFrame([(i,) for i in stored], "id int")
        for as_text in (False, True):
            held_as = held.select(F.col("id").cast("string")) if as_text else held
            out, want = (f(batch, held_as, "id", as_text) for f in (joins.not_stored, joins.anti_join_existing))
            assert rows(out) == rows(want) and out.columns == batch.columns


def test_a_repair_shuffles_ids_and_not_rows(spark, no_broadcast):
    second = spark.range(100).select("id", F.lit("long text").alias("body"))
    loaded = second.filter("id % 10 <> 3")
    cursors = spark.createDataFrame([(0,), (100,)], "id bigint")
    out = loads.gap_repair(loaded, second, cursors)
    assert out.count() == out.distinct().count() == 100
    # Each row was there once for every size of block before.
    assert "_size" not in spark_optimized(out)


def test_many_products_are_not_broadcast(spark, monkeypatch, tmp_path):
    """A small file may hold many products; above a number of rows they do not go through the driver."""
    folder = made(spark, tmp_path)
    stocked = stock.stg_stock(standin.stock_raw(spark, folder))
    master, groups = standin.product_master(spark, folder), standin.product_groups(spark, folder).limit(0)
    core = sales.signed_lines(standin.build_document_lines(spark, folder))

    def frames():
        lines = core.select("variant_code", "variant_id")
        return {
            "pages": standin.detail_pages(spark, folder), "stock": standin.stock_raw(spark, folder),
            "receptions": standin.receptions(spark, folder),
            "variants": sales.variant_attributes(lines, master, groups, stocked),
            "stock_vs_sales": stock.stock_vs_sales(stocked, master, groups, core),
        }

    insights = standin.insights(spark, folder)
    daily = ads.ads_daily(insights, "2024-01-20").count()
    few = {name: df.count() for name, df in frames().items()}
    monkeypatch.setattr(joins, "BUILD_ROWS", 5)
    for name, df in frames().items():
        assert "strategy=merge" in spark_optimized(df) and df.count() == few[name], name
    attached = sales.sales_core(standin.build_document_lines(spark, folder), spark.sql("SELECT DATE'1997-01-05' AS date_start, 1.0D AS spend"),
                                master, groups, stocked, standin.sales_calendar(spark, folder), stage=materialize)
    assert "strategy=merge" in spark_optimized(attached)
    assert spark_optimized(ads.ads_daily(insights, "2024-01-20")).count("strategy=merge") == 2
    assert ads.ads_daily(insights, "2024-01-20").count() == daily > 5
