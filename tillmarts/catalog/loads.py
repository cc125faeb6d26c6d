"""Sinks and load steps. Each writes to a fresh path and returns what is stored there."""

from __future__ import annotations

import datetime as dt
import uuid
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmarts import standin as S
from tillmarts.catalog.expected import expect, text
from tillmarts.catalog.models import SHOP_SELECT
from tillmarts.catalog.registry import query
from tillmarts.functions.dates import timestamp_to_epoch
from tillmarts.functions.lookups import LOCAL_ZONE
from tillmarts.functions.jsons import stringify_all
from tillmarts.operators import loads
from tillmarts.plans import loads as plans
from tillmarts.plans.sales import document_rows
from tillmarts.plans.shop import order_rows
from tillmarts.schemas import SHOP_ORDER_COLUMNS
from tillmarts.sources import versioned as V
from tillmarts.sources import writers as W
from tillmarts.sources.readers import scan_table
from tillmarts.sources.targets import Keyed, Versions
from tillmarts.storage import fresh_path


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return scan_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return scan_table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def sink_append(spark: SparkSession, folder: str) -> DataFrame:
    path, orders = fresh_path(spark, "append"), _orders(spark, folder)
    for status in ("O", "F", "P"):
        W.sink_append(orders.filter(F.col("o_orderstatus") == status), path)
    return spark.read.parquet(path)


@query("""
  SELECT o_orderkey, o_orderstatus, o_totalprice, CASE WHEN o_orderstatus = 'P' THEN o_clerk_key END AS clerk
  FROM (SELECT *, o_custkey % 100 AS o_clerk_key FROM orders)""")
def sink_append_widened(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches, the last of which brings a column and lists its columns in another order."""
    path, orders = fresh_path(spark, "append-widened"), _orders(spark, folder)
    for status in ("O", "F"):
        W.sink_append(orders.filter(F.col("o_orderstatus") == status), path)
    clerk = (F.col("o_custkey") % 100).alias("clerk")
    last = scan_table(spark, folder, "orders").filter("o_orderstatus = 'P'")
    W.sink_append(last.select(clerk, "o_totalprice", "o_orderkey", "o_orderstatus"), path, columns="widen")
    return W.read_appended(spark, path)


@query(expect("SELECT * FROM creative_rows"))
def creatives_load(spark: SparkSession, folder: str) -> DataFrame:
    """Creatives loaded in two overlapping parts, the second one twice."""
    path = fresh_path(spark, "creatives")
    ads, details = S.ad_links(spark, folder), S.creative_details(spark, folder)
    half = F.crc32("creative.id") % 2 == 0
    plans.creatives_load(ads.filter(half), details, path)
    for _ in range(2):
        plans.creatives_load(ads, details, path)
    return V.read(spark, path)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def sink_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    path, orders = fresh_path(spark, "overwrite"), _orders(spark, folder)
    W.sink_overwrite(orders.filter("o_orderstatus = 'P'"), path)
    W.sink_overwrite(orders.filter("o_orderstatus <> 'P'"), path)
    return spark.read.parquet(path)


@query(
    expect("""
      SELECT * REPLACE (CASE WHEN date_start >= '2024-01-11' THEN ad_name || ', 1' ELSE ad_name END AS ad_name)
      FROM insight_rows""")
)
def sink_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Insights to the 20th, then twice a batch from the 11th on with other names and duplicates."""
    path = fresh_path(spark, "upsert-target")
    rows = S.insights(spark, folder)
    V.merge(path, rows.filter("date_start <= '2024-01-20'"), "id", ["ad_name"], plans.DAY_OF_AD)
    late = rows.filter("date_start >= '2024-01-11'")

    def named(n: int) -> DataFrame:
        return late.withColumn("ad_name", F.concat("ad_name", F.lit(f", {n}")))

    for _ in range(2):
        V.merge(path, named(2).unionByName(named(1)), "id", ["ad_name"], plans.DAY_OF_AD)
    return V.read(spark, path)


@query(
    expect("""
      SELECT * REPLACE (CASE WHEN date_start >= '2024-01-11' THEN ad_name || ', 1' ELSE ad_name END AS ad_name)
      FROM insight_rows""")
)
def sink_upsert_folders(spark: SparkSession, folder: str) -> DataFrame:
    """The same into plain folders of days, which Spark swaps one after the other."""
    path = fresh_path(spark, "upsert-folders")
    rows = S.insights(spark, folder)
    W.sink_upsert(path, rows.filter("date_start <= '2024-01-20'"), "id", ["ad_name"], "date_start")
    late = rows.filter("date_start >= '2024-01-11'")

    def named(n: int) -> DataFrame:
        return late.withColumn("ad_name", F.concat("ad_name", F.lit(f", {n}")))

    W.sink_upsert(path, named(2).unionByName(named(1)), "id", ["ad_name"], "date_start")
    return spark.read.schema(rows.schema).parquet(path)


@query("""
  SELECT 1 AS version, o_orderkey, o_orderstatus, o_totalprice, CAST(NULL AS VARCHAR) AS o_clerk
  FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT 3, o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_orderkey % 7 = 0 THEN 'late' ELSE o_orderstatus END,
    o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 'clerk ' || o_custkey END
  FROM orders WHERE o_orderstatus IN ('O', 'F')""")
def sink_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The first and the last of three versions: loaded, widened by a column, merged."""
    path = fresh_path(spark, "versions")
    all_orders = scan_table(spark, folder, "orders")
    orders = all_orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    clerk = F.concat(F.lit("clerk "), F.col("o_custkey").cast("string"))
    first = orders.filter("o_orderstatus = 'O'").drop("o_custkey")
    V.append(path, first, "o_orderkey")
    second = orders.filter("o_orderstatus = 'F'").withColumn("o_clerk", clerk).drop("o_custkey")
    V.append(path, second, "o_orderkey", columns="widen")
    late = first.filter("o_orderkey % 7 = 0").withColumn("o_orderstatus", F.lit("late"))
    V.merge(path, late, "o_orderkey", ["o_orderstatus"], columns="widen")
    before = V.read(spark, path, 1).withColumn("o_clerk", F.lit(None).cast("string"))
    return before.withColumn("version", F.lit(1)).unionByName(V.read(spark, path).withColumn("version", F.lit(3)))


@query(expect("SELECT * FROM insight_rows"))
def ads_load(spark: SparkSession, folder: str) -> DataFrame:
    """Landed insights, loaded day windows that overlap, with lookups that repeat their keys."""
    path = fresh_path(spark, "ads-load")

    def repeated(df: DataFrame) -> DataFrame:
        """More entries of the same keys, without values, so that they come first."""
        empty = [F.lit(None).cast("string").alias(c) for c in df.columns if c != "id"]
        return df.unionByName(df.select("id", *empty))

    ads = repeated(S.ad_statuses(spark, folder))
    raw = S.insights_raw(spark, folder)
    budgets = S.adset_budgets(spark, folder), S.campaign_budgets(spark, folder)
    for today, days in ((dt.date(2024, 1, 20), 400), (dt.date(2024, 2, 1), 20), (dt.date(2024, 12, 31), 360)):
        plans.ads_load(raw, ads, *budgets, path, today, days)
    return V.read(spark, path)


@query(f"""
  SELECT {", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in SHOP_ORDER_COLUMNS)}
  FROM (SELECT {SHOP_SELECT}, CAST(o_orderdate AS DATE) AS "the day"
        FROM orders JOIN customer ON o_custkey = c_custkey)
  WHERE "the day" < DATE '1997-06-01' OR "the day" >= DATE '1997-12-22'""")
def orders_load(spark: SparkSession, folder: str) -> DataFrame:
    """Orders to May 1997, then twice those created since thirty days before the time given."""
    path = fresh_path(spark, "orders-load")
    orders = S.shop_orders(spark, folder).filter(F.col("user_id").isNotNull())
    W.sink_append(stringify_all(order_rows(orders.filter("created_at < '1997-06-01'"))), path)
    for _ in range(2):
        plans.orders_load(orders.unionByName(orders), path, "1998-01-20T09:30:00Z", 30)
    return spark.read.parquet(path)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def sink_empty_like(spark: SparkSession, folder: str) -> DataFrame:
    path, customers = fresh_path(spark, "empty"), _customers(spark, folder)
    W.sink_empty_like(customers, path)
    W.sink_append(customers, path)
    return spark.read.parquet(path)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def sink_json(spark: SparkSession, folder: str) -> DataFrame:
    path, customers = fresh_path(spark, "json"), _customers(spark, folder)
    W.sink_json(customers, path)
    return spark.read.schema(customers.schema).json(path)


@query("""
  SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus
  UNION ALL SELECT 'all', count(*) FROM orders""")
def sink_model(spark: SparkSession, folder: str) -> DataFrame:
    """A table model and a view model that reads it."""
    orders = _orders(spark, folder)
    W.sink_model(orders, "mart_orders", "table", fresh_path(spark, "model"))
    by_status = spark.table("mart_orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    view = W.sink_model(by_status, "mart_status", "view")
    inline = W.sink_model(orders.agg(F.count("*").alias("n")), "mart_all", "inline")
    return view.unionByName(inline.withColumn("o_orderstatus", F.lit("all")))


_NOW, _DAYS_BACK = "1998-01-20 09:30:00", 30
_END = dt.datetime.fromisoformat(_NOW).replace(tzinfo=ZoneInfo(LOCAL_ZONE))
_LAST = int(_END.timestamp())
_FIRST = _LAST - (_DAYS_BACK + 1) * 86_400


def _landed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with nested parts, as pages are flattened to; most parts are absent."""
    orders = scan_table(spark, folder, "orders")

    def ref(value: Column) -> Column:
        return F.struct(value.cast("bigint").alias("id"))

    return orders.select(
        F.col("o_orderkey").alias("id"),
        timestamp_to_epoch(F.col("o_orderdate")).alias("emissionDate"),
        F.col("o_orderkey").alias("number"),
        F.col("o_totalprice").alias("totalAmount"),
        ref(S.order_type_id()).alias("document_type"),
        ref(F.col("o_custkey")).alias("client"),
        F.when(F.col("o_orderstatus") == "F", F.array(ref(F.col("o_orderkey")))).alias("payments"),
    )


_ABSENT = ", ".join(
    f"{text(v) if v else 'CAST(NULL AS VARCHAR)'} AS {c}"
    for c, v in (
        ("expirationDate", None), ("generationDate", None), ("netAmount", None),
        ("taxAmount", None), ("state", None), ("office", "{}"), ('"user"', "{}"),
        ('"references"', "[]"), ("document_taxes", "[]"), ("details", "[]"), ("sellers", "[]"),
    )
)


@query(
    expect(f"""
      SELECT doc_id AS id, emissionDate, document_number AS number, totalAmount,
        '{{"id":' || document_type_id || '}}' AS document_type,
        '{{"id":' || client_id || '}}' AS client,
        CASE WHEN o_orderstatus = 'F' THEN '[{{"id":' || doc_id || '}}]' ELSE '[]' END AS payments,
        {_ABSENT}
      FROM docs
      WHERE day < DATE '1998-01-01' OR emissionDate BETWEEN {_FIRST} AND {_LAST}""")
)
def incremental_load(spark: SparkSession, folder: str) -> DataFrame:
    """A table loaded to the end of 1997, then twice the trailing window of a doubled source."""
    path = fresh_path(spark, "incremental")
    source = _landed_documents(spark, folder)
    W.sink_append(document_rows(source.filter(F.col("emissionDate") < 883_612_800)), path)
    doubled = source.unionByName(source)
    for _ in range(2):
        loads.incremental_load(doubled, path, _NOW, _DAYS_BACK, shape=document_rows)
    return spark.read.schema(document_rows(source).schema).parquet(path)


@query(
    expect("""
      SELECT doc_id AS id, document_number AS number, document_type_id AS type FROM docs
      WHERE day < DATE '1998-01-01' OR doc_id % 3 = 0""")
)
def incremental_load_keyed(spark: SparkSession, folder: str) -> DataFrame:
    """A table in buckets by id, loaded in part, then twice a batch that overlaps it and repeats itself."""
    place = Keyed(f"load_{uuid.uuid4().hex}", "id", fresh_path(spark, "keyed"), 8)
    return _twice(spark, folder, place)


@query(
    expect("""
      SELECT doc_id AS id, document_number AS number, document_type_id AS type FROM docs
      WHERE day < DATE '1998-01-01' OR doc_id % 3 = 0""")
)
def incremental_load_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The same into a versioned table."""
    return _twice(spark, folder, Versions(fresh_path(spark, "versioned"), "id"))


def _twice(spark: SparkSession, folder: str, place) -> DataFrame:
    source = _landed_documents(spark, folder).select(
        "id", "emissionDate", F.col("number").cast("bigint").alias("number"), F.col("document_type.id").alias("type")
    )

    def shape(df: DataFrame) -> DataFrame:
        return df.drop("emissionDate")

    place.append(shape(source.filter(F.col("emissionDate") < 883_612_800)))
    batch = source.filter("id % 3 = 0")
    for _ in range(2):
        loads.append_new(batch.unionByName(batch), place, shape, "id")
    return place.holding(source.select("id"))


@query("""
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS n, 'stored' AS state FROM events WHERE event_type <> 'error'
  UNION ALL SELECT event_id, NULL, 'n/a' FROM events WHERE event_type = 'error'
  UNION ALL SELECT event_id, NULL, 'n/a again' FROM events WHERE event_type = 'error' AND event_id % 2 = 0""")
def incremental_load_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Loads of records some of which are no numbers: three equal runs, then one in which half of the bad
    records come with other text. Dead letters are kept once for each content."""
    path, rejects = fresh_path(spark, "casts"), fresh_path(spark, "dead-letters")
    events = scan_table(spark, folder, "events")
    bad = F.col("event_type") == "error"
    records = events.select("event_id", F.when(bad, F.lit("n/a")).otherwise(F.get_json_object("props", "$.k")).alias("n"))
    again = records.filter("n = 'n/a' AND event_id % 2 = 0").withColumn("n", F.lit("n/a again"))
    for batch in (records, records.unionByName(records), records, again):
        loads.append_new(batch, path, lambda df: df, "event_id", ["n"], casts={"n": "bigint"}, rejects=rejects)
    stored = spark.read.parquet(path).withColumn("state", F.lit("stored"))
    letters = spark.read.parquet(rejects).select("event_id", F.lit(None).cast("bigint").alias("n"), F.col("n").alias("state"))
    return stored.unionByName(letters)


@query("SELECT o_orderkey AS id, o_custkey AS client FROM orders")
def gap_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Orders that have lines, completed with the missing ones from a second source."""
    orders = scan_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("client")
    )
    fetched = scan_table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"))
    fetched = fetched.distinct()
    loaded = orders.join(fetched, "id", "left_semi")
    starts = orders.groupBy(F.floor(F.col("id") / 500).alias("block")).agg(F.min("id").alias("id"))
    cursors = starts.select("id").unionByName(orders.agg((F.max("id") + 1).alias("id")))
    return loads.gap_repair(loaded, orders.unionByName(orders), cursors)


@query("""
  SELECT l_orderkey AS id, CASE l_returnflag WHEN 'N' THEN CAST(0 AS BIGINT) WHEN 'A' THEN 1 ELSE 2
    END AS page, CAST(p AS BIGINT) AS position, CAST(l_linenumber AS BIGINT) AS line,
    CASE p WHEN 0 THEN l_quantity ELSE l_tax END AS quantity
  FROM lineitem, (VALUES (0), (1)) t(p)""")
def merge_paged_details(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with flag N as first pages, those with A and R as second and third ones."""
    line = F.col("l_linenumber").cast("bigint").alias("line")
    pages = scan_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.when(F.col("l_returnflag") == "N", 0)
        .when(F.col("l_returnflag") == "A", 1)
        .otherwise(2)
        .alias("page"),
        F.array(
            F.struct(line, F.col("l_quantity").alias("quantity")),
            F.struct(line, F.col("l_tax").alias("quantity")),
        ).alias("items"),
    )
    return loads.merge_paged_details(
        pages.filter("page = 0"), pages.filter("page > 0"), "id", "items"
    )
