"""Physical plans of the registered queries, and behaviour under hot keys."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillmarts import standin
from tillmarts.catalog import registered
from tillmarts.operators import joins, loads
from tillmarts.plans import sales
from tillmarts.storage import fresh_path, materialize

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# One row in all: a global total, the bounds of a calendar or an id range, the first row by a sort.
# ``interval_pairs`` and its users also order one row per shuffle partition.
ONE_TASK_AT_THE_END = {
    "build_marts", "daily_run", "date_table", "filter_id_range", "first_row", "gap_repair", "generate_series", "interval_pairs",
    "left_join_date_dim", "missing_ids", "missing_ranges", "sales_core", "sink_model", "sorted_list",
    "trailing_visit_totals", "visit_totals_since", "ads_platform_calendar",
}

ORDERS_BLOCK_STARTS = {"filter_id_range", "gap_repair", "interval_pairs", "missing_ids", "missing_ranges", "sorted_list"}


@needs_data
@pytest.mark.parametrize("name", sorted(registered()))
def test_no_cross_join_no_python_and_no_single_task(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert operator not in text
    single = "SinglePartition" in text
    assert not single or name in ONE_TASK_AT_THE_END
    # A window specification that starts with a sort order has no partition keys.
    bare = re.findall(r"windowspecdefinition\(\w+#\d+L? (?:ASC|DESC)", text)
    assert not bare or name in ORDERS_BLOCK_STARTS


def test_the_window_check_sees_a_missing_partition(spark):
    text = plan(spark.range(5).selectExpr("lead(id) OVER (ORDER BY id) AS n"))
    assert re.search(r"windowspecdefinition\(\w+#\d+L? (?:ASC|DESC)", text)


@needs_data
def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["sales_daily"](spark, FOLDER))
    assert "In(document_name" in text.split("PushedFilters:")[1][:200]
    read = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "detail_quantity" in read and "total_amount" not in read and "stock_actual" not in read


@needs_data
def test_json_is_parsed_once_per_column(spark):
    text = spark_optimized(standin.stock_plan.stg_stock(spark.read.parquet(write(standin.stock_raw(spark, FOLDER)))))
    assert text.count("from_json(") == 2
    document = sales.raw_document(standin.documents(spark, FOLDER))
    assert spark_optimized(document).count("from_json(") == 3  # two shapes of details, references


def write(df) -> str:
    path = fresh_path(df.sparkSession, "plan")
    df.write.parquet(path)
    return path


def spark_optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@needs_data
def test_small_written_tables_are_broadcast_by_their_size(spark):
    text = plan(entry.queries()["sales_core"](spark, FOLDER))
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "1")
    try:
        frame = entry.queries()["sales_core"](spark, FOLDER)
        assert "Broadcast" not in plan(frame)
        expected = entry.queries()["sales_daily"](spark, FOLDER)
        shuffled = sales.sales_daily(frame)
        assert sorted(map(str, shuffled.collect())) == sorted(map(str, expected.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.fixture
def tight(spark):
    """Thresholds small enough for test data to count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def hot_fact(spark, rows=60_000, hot=None):
    """A third of the rows share one key (NULL unless given)."""
    n = F.col("id")
    key = F.when(n % 3 > 0, (n % 5_000).cast("string")).otherwise(F.lit(hot).cast("string"))
    return spark.range(0, rows, 1, 4).select(key.alias("k"), n.alias("v"), F.hash("id").alias("w"))


@pytest.mark.parametrize("hot", ["7", None])
def test_a_hot_key_is_split_in_a_left_join(spark, tight, hot):
    fact = materialize(hot_fact(spark, hot=hot), "fact")
    dim = spark.range(0, 5_000, 1, 4).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("d"))
    joined = joins.left_join(fact, dim, ["k"])
    assert joined.count() == 60_000
    joined.collect()
    assert "skew=true" in plan(joined)


def test_colour_join_keeps_hot_and_null_codes(spark, tight):
    codes = hot_fact(spark, hot="2249AREN00S").select("k").unionByName(hot_fact(spark, hot=None).select("k"))
    out = {r.color: r["count"] for r in joins.attach_colour(codes, "k").groupBy("color").count().collect()}
    assert out == {"Arena": 20_000, "Otro": 100_000}


@needs_data
def test_a_long_document_is_packed_in_pages(spark, monkeypatch, tmp_path):
    """One order with a third of all lines: no page exceeds the run, no line is lost."""
    source = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    hot = F.when(F.col("l_partkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_orderkey"))
    source.withColumn("l_orderkey", hot.cast("bigint")).write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("orders", "part"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(standin, "PAGE_RUN", 100)
    pages = standin.detail_pages(spark, str(tmp_path))
    assert pages.agg(F.max(F.size("items"))).collect()[0][0] <= 100
    docs = standin.documents(spark, str(tmp_path))
    assert docs.filter("id = 1").count() > 10
    lines = sales.raw_document(docs.withColumn("references", F.lit("[]")))
    assert lines.count() == source.count()
    without = docs.filter("details = '{}'").count()
    assert docs.select("id").distinct().count() == 1_500 and without > 0


@pytest.fixture
def kept(spark, monkeypatch):
    """The labels of the tables that are written for a query to read back."""
    labels = []

    def record(spark, folder, label, build):
        labels.append(label)
        return build()

    monkeypatch.setattr(standin, "staged", record)
    return labels


@needs_data
@pytest.mark.parametrize(
    "name", ["raw_document", "stg_document_lines", "filter_not_in_null", "count_nonnull", "stock_mart"]
)
def test_what_is_read_once_is_not_written_first(spark, kept, name):
    entry.queries()[name](spark, FOLDER)
    assert kept == []


@needs_data
@pytest.mark.parametrize("name", ["sales_daily", "stock_vs_sales", "union_all_movements", "stock_ledger"])
def test_lines_are_kept_but_neither_documents_nor_the_wide_mart(spark, kept, name):
    entry.queries()[name](spark, FOLDER)
    assert "document-lines" in kept and not {"documents", "sales-core"} & {*kept}


@needs_data
@pytest.mark.parametrize("name", ["sales_core", "sales_daily", "union_all_movements"])
def test_stock_that_only_the_mart_reads_is_not_written(spark, kept, name):
    entry.queries()[name](spark, FOLDER)
    assert "stock" not in kept


@needs_data
def test_lines_meet_the_variants_before_the_days(spark):
    """The calendar's columns are not shuffled to the variants."""
    text = spark_optimized(entry.queries()["sales_core"](spark, FOLDER))
    assert "fecha_documento" in text.split("Join LeftOuter")[1] and "<=>" in text.split("Join LeftOuter")[2]


@needs_data
def test_marts_read_documents_that_are_not_written_first(spark, kept):
    entry.queries()["build_marts"](spark, FOLDER)
    assert "documents" not in kept


@needs_data
def test_documents_are_shuffled_as_plain_columns(spark):
    """No JSON text, and no amount that the lines' own columns give, is in a page before the join."""
    pages = standin.detail_pages(spark, FOLDER)
    item = pages.schema["items"].dataType.elementType.fieldNames()
    assert item == standin.LINE_COLUMNS + standin.VARIANT_COLUMNS
    joins_of = spark_optimized(standin.build_documents(spark, FOLDER)).split("Join Inner", 1)[1]
    assert "to_json" not in joins_of


@needs_data
def test_last_values_group_their_rows_once(spark):
    text = plan(entry.queries()["last_value_ignore_nulls"](spark, FOLDER))
    assert text.count("HashAggregate(") == 2  # partial and final


def test_many_keys_and_dead_letters_are_not_broadcast(spark, monkeypatch, tmp_path):
    """Small files may hold many keys; above a number of rows they do not go through the driver."""
    monkeypatch.setattr(joins, "BUILD_ROWS", 50)
    batch = spark.range(100).select("id", F.lit("n/a").alias("n"))
    new = joins.anti_join_existing(batch, spark.range(40), "id")
    assert new.count() == 60 and "Broadcast" not in plan(new)
    few = joins.anti_join_existing(batch.filter("id < 50"), spark.range(40), "id")
    assert few.count() == 10 and "Broadcast" in plan(few)
    plans = []
    monkeypatch.setattr(loads, "sink_append", lambda df, path: plans.append(plan(df)) or df.write.mode("append").parquet(path))
    for _ in range(2):
        loads.keep_rejects(batch, f"{tmp_path}/rejects", "id")
    assert spark.read.parquet(f"{tmp_path}/rejects").count() == 100
    assert "LeftAnti" in plans[1] and "Broadcast" not in plans[1]


def made(spark, folder, orders=200, lines=3_000, twice=None):
    """Small test tables; the lines of an order are far apart, order ``twice`` is there two times."""
    def keep(name, rows, **columns):
        frame = spark.range(0, rows, 1, 1).select(*[F.expr(e).alias(c) for c, e in columns.items()])
        if name == "orders" and twice is not None:
            frame = frame.unionByName(frame.filter(F.col("o_orderkey") == twice)).coalesce(1)
        frame.write.parquet(f"{folder}/{name}.parquet")

    day = "date_add(DATE'1997-01-05', CAST(id % 50 AS INT))"
    keep(
        "orders", orders, o_orderkey="id", o_custkey="id % 7", o_totalprice="CAST(id AS DOUBLE)",
        o_orderstatus="element_at(array('F', 'O', 'P'), CAST(id % 3 + 1 AS INT))",
        o_orderdate=f"CAST({day} AS TIMESTAMP)",
        o_orderpriority="element_at(array('1-URGENT', '5-LOW', '2-HIGH', '3-MEDIUM'), CAST(id % 4 + 1 AS INT))",
    )
    keep(
        "lineitem", lines, l_orderkey=f"id % {orders - 10}", l_partkey="id % 9", l_suppkey="id % 4",
        l_linenumber="CAST(id % 5 AS INT)", l_quantity="CAST(id % 8 + 1 AS DOUBLE)",
        l_extendedprice="CAST(id + 1 AS DOUBLE)", l_discount="0.1D", l_tax="0.2D",
        l_returnflag="element_at(array('A', 'N', 'R'), CAST(id % 3 + 1 AS INT))", l_linestatus="'O'",
        l_shipdate=f"CAST({day} AS TIMESTAMP)",
    )
    keep(
        "part", 9, p_partkey="id", p_name="concat(element_at(array('red', 'blue'), CAST(id % 2 + 1 AS INT)), ' ring')",
        p_brand="concat('Brand#', id + 11)", p_type="'LARGE'", p_size="CAST(id AS INT)", p_retailprice="9.5D",
    )
    keep(
        "events", 400, event_id="id", ts="CAST(date_add(DATE'2024-01-05', CAST(id % 20 AS INT)) AS TIMESTAMP)",
        user_id="id % 12", event_type="element_at(array('view', 'click', 'purchase'), CAST(id % 3 + 1 AS INT))",
        value="CAST(id AS DOUBLE)", props="concat('{\"k\": ', id % 5, '}')",
    )
    return str(folder)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scattered_lines_of_an_order_are_one_document(spark, no_broadcast, monkeypatch, tmp_path):
    """Pages are cut where lines of an order are neighbours, so their number grows with the orders."""
    folder = made(spark, tmp_path, twice=3)
    monkeypatch.setattr(standin, "PAGE_RUN", 300)
    docs = standin.build_documents(spark, folder)
    # Besides the 201 orders a page more for each run that ends inside an order.
    assert 201 <= docs.count() <= 201 + 3_000 // 300 + 4
    lines = sales.raw_document(docs.withColumn("references", F.lit("[]")))
    assert lines.count() == 3_000 + lines.filter("doc_id = 3").count() // 2
    assert docs.filter("details = '{}'").count() == 10


def test_lines_are_shuffled_once_to_their_orders(spark, no_broadcast, tmp_path):
    text = plan(standin.detail_pages(spark, made(spark, tmp_path)))
    # Parts, lines to parts, lines to orders, orders; none for the pages.
    assert text.count("Exchange hashpartitioning(") == 4


def test_a_hot_order_is_split_on_its_way_into_pages(spark, tight, tmp_path):
    folder = made(spark, tmp_path / "a", lines=60_000)
    hot = F.when(F.col("l_partkey") < 3, F.lit(1)).otherwise(F.col("l_orderkey")).cast("bigint")
    source = spark.read.parquet(f"{folder}/lineitem.parquet").withColumn("l_orderkey", hot)
    source.write.parquet(f"{tmp_path}/b/lineitem.parquet")
    for name in ("orders", "part"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/b/{name}.parquet")
    pages = standin.detail_pages(spark, f"{tmp_path}/b")
    assert sum(len(r["items"]) for r in pages.collect()) == 60_000
    assert "skew=true" in plan(pages)


@pytest.mark.parametrize(
    "name", ["union_all_movements", "stock_ledger", "stock_ledger_carried", "stock_vs_sales", "sales_daily"]
)
def test_only_columns_that_are_read_are_kept(spark, monkeypatch, tmp_path, name):
    """Lines and stock are written with what the query reads of them, and the ads mart is not written."""
    folder, kept = made(spark, tmp_path), {}

    def record(spark, folder, label, build):
        kept[label] = build()
        return kept[label]

    monkeypatch.setattr(standin, "staged", record)
    entry.queries()[name](spark, folder)
    of_lines = standin.DAILY_COLUMNS if name == "sales_daily" else standin.SOLD_COLUMNS
    assert {*kept["document-lines"].columns} == {*sales.LINE_KEYS, *of_lines}
    assert "ads-budget" not in kept and len(kept["stock"].columns if "stock" in kept else []) in (0, 3)
    parsed = spark_optimized(kept["document-lines"])
    assert "netDiscount,StringType" not in parsed.split("from_json(")[1]


def test_a_mart_of_some_columns_has_the_rows_of_the_whole(spark, tmp_path):
    folder = made(spark, tmp_path)
    some = standin.build_core(spark, folder, columns=standin.SOLD_COLUMNS)
    whole = standin.build_core(spark, folder)
    assert {"doc_id", "total_amount"} <= {*whole.columns} - {*some.columns}
    assert sorted(map(str, some.collect())) == sorted(map(str, whole.select(*some.columns).collect()))


def test_stock_json_is_made_once_per_variant(spark, tmp_path):
    raw = standin.stock_raw(spark, made(spark, tmp_path))._jdf.queryExecution().analyzed().toString()
    assert "to_json" not in raw.split("Join Inner")[0] and raw.count("to_json") == 2
