"""Scans, filters, joins, aggregates, windows and set operations over the whole test tables."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmarts import standin as S
from tillmarts.catalog.expected import between_days, colour_of, expect, money, text
from tillmarts.catalog.registry import query
from tillmarts.functions import arrays as A
from tillmarts.functions import jsons as J
from tillmarts.functions import labels as B
from tillmarts.functions import lookups as L
from tillmarts.functions.dates import epoch_to_date
from tillmarts.functions.numbers import money_sum
from tillmarts.operators import aggregates as G
from tillmarts.operators import filters, joins, sets, windows
from tillmarts.plans import ads, stock
from tillmarts.schemas import ACTION_ITEM, REFERENCE_ITEM
from tillmarts.sources.readers import (
    read_json_pages as read_pages,
    read_seed_csv as read_seed,
    scan_rename as rename,
    scan_table as scan,
    series_between,
    split_json_pages as split_pages,
)
from tillmarts.storage import fresh_path

_SALE_NAMES = ", ".join(text(n) for n in L.SALE_DOCUMENT_NAMES)


# --- scans -----------------------------------------------------------------------------------


@query("""
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
    CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
  FROM orders""")
def scan_table(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("""
  SELECT CAST(p_partkey AS VARCHAR) AS sku, p_name AS nombre_producto, p_type AS tipo_producto
  FROM part""")
def scan_rename(spark: SparkSession, folder: str) -> DataFrame:
    names = {"p_partkey": "sku", "p_name": "nombre_producto", "p_type": "tipo_producto"}
    return rename(scan(spark, folder, "part"), names, sku="string")


@query(expect(f"SELECT {colour_of('variant_code')} AS color, variant_code AS sku FROM variants"))
def read_seed_csv(spark: SparkSession, folder: str) -> DataFrame:
    """The colour-by-SKU list written as a CSV whose header has a stray blank, and read back."""
    path = fresh_path(spark, "seed")
    code = F.col("variant_code")
    S.variants(spark, folder).select(B.colour(code).alias("color "), code.alias("sku")).write.option(
        "header", True
    ).csv(path)
    return read_seed(spark, path)


@query("SELECT c_custkey AS id, c_custkey % 10 = 0 AS rejected FROM customer")
def split_json_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Customers landed as pages of one item, every tenth of them cut off."""
    path = fresh_path(spark, "broken-pages")
    page = F.to_json(F.struct(F.array(F.struct(F.col("c_custkey").alias("id"))).alias("items")))
    cut = F.when(F.col("c_custkey") % 10 == 0, F.regexp_replace(page, r"\]\}$", "")).otherwise(page)
    scan(spark, folder, "customer").select(cut.alias("value")).write.text(path)
    good, bad = split_pages(spark, path, T.StructType.fromDDL("id bigint"))
    broken = F.regexp_extract("record", r'"id":(\d+)', 1).cast("bigint")
    return good.withColumn("rejected", F.lit(False)).unionByName(
        bad.select(broken.alias("id"), F.lit(True).alias("rejected"))
    )


@query("""
  SELECT o_orderkey AS id, o_custkey AS client, o_orderstatus AS state, o_totalprice AS total
  FROM orders""")
def read_json_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Orders landed as pages of at most 50 items, and flattened again."""
    path = fresh_path(spark, "pages")
    item = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("client"),
        F.col("o_orderstatus").alias("state"),
        F.col("o_totalprice").alias("total"),
    )
    # A run of 50 input rows makes a page, whatever the ids are.
    page = F.floor(F.monotonically_increasing_id() / 50)
    scan(spark, folder, "orders").select(page.alias("page"), item.alias("item")).groupBy(
        "page"
    ).agg(F.collect_list("item").alias("items")).drop("page").write.json(path)
    schema = "id bigint, client bigint, state string, total double"
    return read_pages(spark, path, T.StructType.fromDDL(schema))


@query(
    f"""
  SELECT d AS fecha FROM {between_days(
      "(SELECT min(CAST(o_orderdate AS DATE)) FROM orders)",
      "(SELECT max(CAST(o_orderdate AS DATE)) FROM orders)",
  )}"""
)
def generate_series(spark: SparkSession, folder: str) -> DataFrame:
    bounds = scan(spark, folder, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b")
    )
    return series_between(bounds, F.col("a"), F.col("b"))


# --- filters ---------------------------------------------------------------------------------


@query("""
  SELECT o_orderkey, o_orderpriority FROM orders
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def filter_in(spark: SparkSession, folder: str) -> DataFrame:
    orders = scan(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return filters.filter_in(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query(
    expect(f"""
      SELECT document_name, CASE WHEN document_name NOT IN ({_SALE_NAMES}) THEN 'other'
        WHEN document_name IS NULL THEN 'unknown' ELSE 'sale' END AS kind, count(*) AS n
      FROM doc_lines GROUP BY ALL""")
)
def filter_not_in_null(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("document_name")
    kind = (
        F.when(filters.outside(name, L.SALE_DOCUMENT_NAMES), "other")
        .when(name.isNull(), "unknown")
        .otherwise("sale")
    )
    lines = S.build_document_lines(spark, folder)
    return lines.groupBy("document_name", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, user_id, value FROM events WHERE value > 50")
def filter_gt(spark: SparkSession, folder: str) -> DataFrame:
    events = scan(spark, folder, "events").select("event_id", "user_id", "value")
    return filters.filter_gt(events, "value", 50)


@query("""
  SELECT event_id, CAST(ts AS DATE) AS day FROM events
  WHERE CAST(ts AS DATE) >= DATE '2024-01-30' - INTERVAL 1 DAY""")
def filter_recent(spark: SparkSession, folder: str) -> DataFrame:
    events = scan(spark, folder, "events").select("event_id", F.to_date("ts").alias("day"))
    return filters.filter_recent(events, "day", "2024-01-30")


@query("""
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders
  WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-02-01' AND DATE '1996-03-15'""")
def filter_between_dates(spark: SparkSession, folder: str) -> DataFrame:
    orders = scan(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return filters.filter_between_dates(orders, "day", "1995-02-01", "1996-03-15")


@query("""
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '-03:00' AS created_at FROM orders
  WHERE o_orderdate + INTERVAL 3 HOUR >= TIMESTAMP '1998-01-01 12:00:00' - INTERVAL 90 DAY""")
def filter_since(spark: SparkSession, folder: str) -> DataFrame:
    """Times as text three hours behind UTC, some of them no times at all."""
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-03:00"))
    orders = scan(spark, folder, "orders").select("o_orderkey", text.alias("created_at"))
    junk = orders.withColumn("created_at", F.lit("not yet"))
    return filters.filter_since(orders.unionByName(junk), "created_at", "1998-01-01T12:00:00Z", 90)


_NOW, _DAYS_BACK = "1998-03-20 09:30:00", 30
_LOCAL_NOW = dt.datetime.fromisoformat(_NOW)


def _utc_epoch(local: dt.datetime) -> int:
    return int(local.replace(tzinfo=ZoneInfo(L.LOCAL_ZONE)).timestamp())


@query(
    expect(f"""
      SELECT doc_id AS id, emissionDate FROM docs
      WHERE emissionDate BETWEEN {_utc_epoch(_LOCAL_NOW - dt.timedelta(days=_DAYS_BACK + 1))}
        AND {_utc_epoch(_LOCAL_NOW)}""")
)
def filter_date_window(spark: SparkSession, folder: str) -> DataFrame:
    docs = S.document_headers(spark, folder).select("id", "emissionDate")
    return filters.filter_date_window(docs, "emissionDate", _NOW, _DAYS_BACK)


def _cursors(spark: SparkSession, folder: str) -> DataFrame:
    """First id of every block of 500, and the id after the last one."""
    orders = scan(spark, folder, "orders")
    starts = orders.groupBy(F.floor(F.col("o_orderkey") / 500).alias("block")).agg(
        F.min("o_orderkey").alias("id")
    )
    end = orders.agg((F.max("o_orderkey") + 1).alias("id"))
    return starts.select("id").unionByName(end)


@query(
    expect("""
      SELECT first_id, last_id, o_orderkey AS id FROM orders
      JOIN id_intervals ON o_orderkey BETWEEN first_id AND last_id""")
)
def filter_id_range(spark: SparkSession, folder: str) -> DataFrame:
    """Every order with the load interval that covers its id."""
    ids = scan(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))
    intervals = sets.interval_pairs(_cursors(spark, folder))
    return filters.filter_id_intervals(ids, intervals, "id", width=500)


@query("""
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS n,
    CAST(NULL AS VARCHAR) AS reject
  FROM events WHERE event_type <> 'error'
  UNION ALL SELECT event_id, NULL, 'n/a' FROM events WHERE event_type = 'error'""")
def filter_bad_rows(spark: SparkSession, folder: str) -> DataFrame:
    events = scan(spark, folder, "events")
    number = F.when(F.col("event_type") == "error", "n/a").otherwise(
        F.get_json_object("props", "$.k")
    )
    rows = events.select("event_id", number.alias("n"))
    good, bad = filters.split_bad_rows(rows, {"n": "bigint"})
    return good.withColumn("reject", F.lit(None).cast("string")).unionByName(
        bad.select("event_id", F.lit(None).cast("bigint").alias("n"), F.col("n").alias("reject"))
    )


@query(
    expect("""
      SELECT CAST(user_id AS VARCHAR) AS ad_id, 'c' || (user_id % 40) AS ad_creative_id
      FROM users WHERE top >= 150""")
)
def filter_required(spark: SparkSession, folder: str) -> DataFrame:
    links = S.ad_links(spark, folder).select(
        F.col("id").alias("ad_id"), F.col("creative.id").alias("ad_creative_id")
    )
    return filters.filter_required(links, ["ad_id", "ad_creative_id"])


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_by_code(spark: SparkSession, folder: str) -> DataFrame:
    customers = scan(spark, folder, "customer")
    return filters.filter_by_code(customers, "c_mktsegment", "BUILDING").select(
        "c_custkey", "c_name"
    )


# --- joins -----------------------------------------------------------------------------------


@query("""
  SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders
  LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""")
def left_join(spark: SparkSession, folder: str) -> DataFrame:
    customers = (
        scan(spark, folder, "customer")
        .filter("c_acctbal > 0")
        .select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    )
    orders = scan(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return joins.left_join(orders, customers, ["o_custkey"])


@query(
    expect("""
      SELECT l_orderkey, l_partkey, s.variant_id, s.stock_actual
      FROM lineitem LEFT JOIN (
        SELECT CAST(variant_id AS VARCHAR) AS variant_id, stock_actual FROM variant_stock
        WHERE stock_actual > 700) s ON CAST(l_partkey AS VARCHAR) = s.variant_id""")
)
def left_join_cast_key(spark: SparkSession, folder: str) -> DataFrame:
    levels = G.sum_by_key(S.stock(spark, folder), ["variant_id"], {"stock_actual": "quantity"})
    items = scan(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    return joins.left_join_cast_key(
        items, levels.filter("stock_actual > 700"), "l_partkey", "variant_id"
    )


@query(
    expect("""
      SELECT v.variant_code, g.* FROM variants v
      LEFT JOIN product_groups g ON g.variante_code_desc = substr(v.variant_code, 1, 4)""")
)
def left_join_prefix(spark: SparkSession, folder: str) -> DataFrame:
    codes = S.variants(spark, folder).select("variant_code")
    groups = S.product_groups(spark, folder)
    return joins.left_join_prefix(codes, groups, "variant_code", "variante_code_desc")


@query(
    expect("""
      SELECT a.id, n.cantidad_ads
      FROM (SELECT ad_id || '_' || strftime(date_start, '%Y-%m-%d') AS id, adset_id, date_start
            FROM daily_ads) a
      LEFT JOIN spending_ads n ON n.adset_id = a.adset_id AND n.date_start = a.date_start""")
)
def left_join_multi_key(spark: SparkSession, folder: str) -> DataFrame:
    rows = S.insights(spark, folder).select(
        "id", "adset_id", "date_start", "ad_id", F.col("spend").cast("double").alias("spend")
    )
    keys = ["adset_id", "date_start"]
    counted = G.count_distinct(filters.filter_gt(rows, "spend", 0), keys, "ad_id", "cantidad_ads")
    return joins.left_join(rows.select("id", *keys), counted, keys).select("id", "cantidad_ads")


def _daily_moves(frame: DataFrame, day: str, name: str) -> DataFrame:
    return frame.groupBy(F.col(day).alias("fecha"), "variant_id", "office_id").agg(
        money_sum(F.col("quantity")).alias(name)
    )


@query(
    expect(f"""
      SELECT n.*, a.salida
      FROM (SELECT day AS fecha, variant_id, office_id, {money("quantity")} AS ingreso
            FROM movement_details WHERE l_returnflag = 'N' GROUP BY ALL) n
      LEFT JOIN (SELECT day AS fecha, variant_id, office_id, {money("quantity")} AS salida
            FROM movement_details WHERE l_returnflag = 'A' GROUP BY ALL) a
        ON a.fecha = n.fecha AND a.variant_id = n.variant_id AND a.office_id = n.office_id""")
)
def left_join_three_key(spark: SparkSession, folder: str) -> DataFrame:
    received = _daily_moves(
        stock.stg_receptions(S.receptions(spark, folder)), "fecha_recibo", "ingreso"
    )
    consumed = _daily_moves(
        stock.stg_consumptions(S.consumptions(spark, folder)), "fecha_consumo", "salida"
    )
    return joins.left_join(received, consumed, ["fecha", "variant_id", "office_id"])


@query(
    expect("""
      SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day_of_order, c.*
      FROM orders LEFT JOIN order_calendar c ON c.date_raw = CAST(o_orderdate AS DATE)""")
)
def left_join_date_dim(spark: SparkSession, folder: str) -> DataFrame:
    orders = scan(spark, folder, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("day_of_order")
    )
    return joins.left_join_date_dim(orders, S.sales_calendar(spark, folder), "day_of_order")


@query(
    expect("""
      SELECT l_orderkey AS doc_id, l_linenumber AS line, reference_id, reference_reason
      FROM (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem)
      LEFT JOIN doc_refs r ON r.doc_id = l_orderkey""")
)
def left_join_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """Lines by references: a document of n lines and m references gives n x m rows."""
    lines = scan(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").cast("bigint").alias("line")
    )
    exploded = S.document_headers(spark, folder).select(
        F.col("id").alias("doc_id"),
        F.explode(J.json_list(F.col("references"), REFERENCE_ITEM)).alias("r"),
    )
    references = exploded.select(
        "doc_id", F.col("r.id").alias("reference_id"), F.col("r.reason").alias("reference_reason")
    )
    return joins.left_join(lines, references, ["doc_id"])


@query(
    expect(f"""
      SELECT d AS fecha, variant_id, office_id
      FROM {between_days("DATE '1997-01-01'", "DATE '1997-12-31'")},
        (SELECT DISTINCT variant_id, office_id FROM stock_rows)""")
)
def cross_join_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Every stocked variant and branch on every day of a year."""
    pairs = S.stock(spark, folder).select("variant_id", "office_id").distinct()
    days = [F.lit(d).cast("date") for d in ("1997-01-01", "1997-12-31")]
    return joins.date_grid(pairs, *days)


@query(expect("SELECT doc_id AS id, reference_id, reference_reason AS reason FROM doc_refs"))
def unnest_cross_join(spark: SparkSession, folder: str) -> DataFrame:
    docs = S.document_headers(spark, folder).select("id", "references")
    rows = joins.unnest(docs, J.json_list(F.col("references"), REFERENCE_ITEM), "item")
    return rows.select(
        "id", F.col("item.id").alias("reference_id"), F.col("item.reason").alias("reason")
    )


@query("""
  SELECT o_orderkey AS id, o_custkey FROM orders
  WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def anti_join_existing(spark: SparkSession, folder: str) -> DataFrame:
    batch = scan(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    existing = scan(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("id")
    )
    return joins.anti_join_existing(batch, existing, "id", as_text=True)


@query(
    expect("""
      SELECT id, status, effective_status, daily_budget_adset, lifetime_budget_adset,
        budget_remaining_adset, daily_budget_campaign, lifetime_budget_campaign,
        budget_remaining_campaign
      FROM insight_rows""")
)
def lookup_default(spark: SparkSession, folder: str) -> DataFrame:
    rows = S.insights_raw(spark, folder).select(
        F.concat_ws("_", "ad_id", "date_start").alias("id"), "ad_id", "adset_id", "campaign_id"
    )
    rows = joins.status_lookup(rows, S.ad_statuses(spark, folder))
    rows = joins.budget_lookup(rows, S.adset_budgets(spark, folder), "adset_id", "adset")
    rows = joins.budget_lookup(rows, S.campaign_budgets(spark, folder), "campaign_id", "campaign")
    return rows.drop("ad_id", "adset_id", "campaign_id")


@query("SELECT o_orderkey AS order_id, o_orderkey AS id, o_orderpriority AS title FROM orders")
def join_parent_id(spark: SparkSession, folder: str) -> DataFrame:
    return joins.explode_children(S.shop_orders(spark, folder), "id", "line_items", "order_id")


@query("""
  WITH late AS (SELECT o_custkey, max(o_orderpriority) FILTER (o_orderstatus = 'F') AS top,
                  count(*) AS n FROM orders GROUP BY o_custkey)
  SELECT c_custkey AS id, CASE WHEN o_custkey IS NULL THEN c_mktsegment ELSE top END AS body,
    n AS orders
  FROM customer LEFT JOIN late ON o_custkey = c_custkey""")
def coalesce_update(spark: SparkSession, folder: str) -> DataFrame:
    """Customers whose text is replaced by that of their orders, even where it is NULL."""
    left = scan(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("body")
    )
    finished = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    right = (
        scan(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("id"))
        .agg(F.max(finished).alias("body"), F.count(F.lit(1)).alias("orders"))
    )
    return joins.coalesce_update(left, right, "id", ["body", "orders"])


# --- aggregates ------------------------------------------------------------------------------


@query(f"""
  SELECT l_partkey, {money("l_quantity")} AS units, {money("l_extendedprice")} AS net
  FROM lineitem GROUP BY l_partkey""")
def sum_by_key(spark: SparkSession, folder: str) -> DataFrame:
    items = scan(spark, folder, "lineitem")
    return G.sum_by_key(items, ["l_partkey"], {"units": "l_quantity", "net": "l_extendedprice"})


@query(
    expect("""
      SELECT strftime(day, '%Y-%m-%d') AS date_start, CAST(sum(spent) AS DOUBLE) AS spend
      FROM user_days GROUP BY day""")
)
def sum_cast_by_date(spark: SparkSession, folder: str) -> DataFrame:
    return G.sum_by_key(S.insights(spark, folder), ["date_start"], {"spend": "spend"})


@query(expect("SELECT fecha_documento, compras_mismo_dia FROM sale_days"))
def count_nonnull(spark: SparkSession, folder: str) -> DataFrame:
    lines = S.build_document_lines(spark, folder).withColumn(
        "fecha_documento", epoch_to_date(F.col("emissionDate"))
    )
    sales_only = filters.filter_in(lines, "document_name", L.SALE_DOCUMENT_NAMES)
    return G.count_nonnull(
        sales_only, ["fecha_documento"], "document_number", "compras_mismo_dia"
    )


@query("""
  SELECT o_custkey, count(DISTINCT l_partkey) AS parts FROM orders
  JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey""")
def count_distinct(spark: SparkSession, folder: str) -> DataFrame:
    orders = scan(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    items = scan(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    return G.count_distinct(items.join(orders, "l_orderkey"), ["o_custkey"], "l_partkey", "parts")


@query(f"""
  SELECT l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS day, {money("l_quantity")} AS units,
    max(l_extendedprice) AS top, count(*) AS n
  FROM lineitem GROUP BY ALL""")
def group_by_all(spark: SparkSession, folder: str) -> DataFrame:
    return G.group_by_all(
        scan(spark, folder, "lineitem"),
        ["l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("day")],
        [
            money_sum(F.col("l_quantity")).alias("units"),
            F.max("l_extendedprice").alias("top"),
            F.count(F.lit(1)).alias("n"),
        ],
    )


def _action_rows(spark: SparkSession, folder: str, column: str) -> DataFrame:
    rows = joins.unnest(
        S.insights(spark, folder).select("ad_id", "date_start", column),
        J.json_list(F.col(column), ACTION_ITEM),
        "item",
    )
    return rows.select("ad_id", "date_start", "item.*")


@query(
    expect(f"""
      SELECT ad_id, strftime(date_start, '%Y-%m-%d') AS date_start,
        {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in L.ACTION_COLUMNS)}
      FROM daily_ads WHERE actions <> '[]'""")
)
def conditional_sum_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return G.conditional_sums(
        _action_rows(spark, folder, "actions"),
        ["ad_id", "date_start"],
        "action_type",
        F.nullif(F.col("value"), F.lit("")),
        {c: c for c in L.ACTION_COLUMNS},
        "bigint",
    )


@query(
    expect("""
      SELECT ad_id, strftime(date_start, '%Y-%m-%d') AS date_start, purchase_amount
      FROM daily_ads WHERE action_values <> '[]'""")
)
def conditional_sum_float(spark: SparkSession, folder: str) -> DataFrame:
    return G.conditional_sums(
        _action_rows(spark, folder, "action_values"),
        ["ad_id", "date_start"],
        "action_type",
        F.nullif(F.col("value"), F.lit("")),
        {"purchase_amount": "purchase"},
        "double",
    )


@query("SELECT l_suppkey, max(l_extendedprice) AS top FROM lineitem GROUP BY l_suppkey")
def max_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return G.max_by_group(scan(spark, folder, "lineitem"), ["l_suppkey"], "l_extendedprice", "top")


@query(expect("SELECT id, purchases, purchase_value FROM insight_rows"))
def sum_in_set(spark: SparkSession, folder: str) -> DataFrame:
    return S.insights_raw(spark, folder).select(
        F.concat_ws("_", "ad_id", "date_start").alias("id"),
        A.sum_in_set(F.col("actions"), "bigint").alias("purchases"),
        A.sum_in_set(F.col("action_values"), "double").alias("purchase_value"),
    )


@query("""
  SELECT DISTINCT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_returnflag
  FROM lineitem""")
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    return G.distinct_rows(
        scan(spark, folder, "lineitem").select(
            "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_returnflag"
        )
    )


@query("""
  SELECT l_orderkey, l_linenumber, day, l_partkey, l_suppkey, l_quantity, l_extendedprice
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY day, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn
        FROM (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
                CAST(l_shipdate AS DATE) AS day, l_partkey, l_suppkey, l_quantity, l_extendedprice
              FROM lineitem))
  WHERE rn = 1""")
def distinct_by_key(spark: SparkSession, folder: str) -> DataFrame:
    items = scan(spark, folder, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
        F.to_date("l_shipdate").alias("day"),
        "l_partkey",
        "l_suppkey",
        "l_quantity",
        "l_extendedprice",
    )
    return G.distinct_by_key(items, ["l_orderkey", "l_linenumber"], ["day"])


@query("SELECT DISTINCT l_orderkey AS id FROM lineitem")
def distinct_ids(spark: SparkSession, folder: str) -> DataFrame:
    items = scan(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"))
    return G.distinct_ids(items, "id")


@query(
    expect("""
      SELECT 'p' || u.user_id AS id, views % 8 IN (0, 2) AS is_video,
        CASE views % 8 WHEN 0 THEN 'v2-' || u.user_id WHEN 2 THEN 'v1-' || u.user_id END AS video_id
      FROM users u WHERE views % 2 = 0""")
)
def last_match_in_array(spark: SparkSession, folder: str) -> DataFrame:
    attached = F.col("attachments.data")
    return S.posts(spark, folder).select(
        "id", A.any_video(attached).alias("is_video"), A.last_video_id(attached).alias("video_id")
    )


# --- windows ---------------------------------------------------------------------------------


def _order_weeks(spark: SparkSession, folder: str) -> DataFrame:
    days = scan(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.withColumn("week_start", F.trunc("day", "week"))


@query("""
  SELECT d AS day, CAST(dense_rank() OVER (PARTITION BY year(w) ORDER BY w) AS BIGINT) AS week
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, date_trunc('week', o_orderdate) AS w
        FROM orders)""")
def dense_rank_week_of_year(spark: SparkSession, folder: str) -> DataFrame:
    return _order_weeks(spark, folder).select(
        "day", windows.week_of_year(F.col("week_start")).alias("week")
    )


@query("""
  SELECT d AS day, CAST(dense_rank() OVER (PARTITION BY year(d), month(d) ORDER BY w) AS BIGINT)
    AS week
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, date_trunc('week', o_orderdate) AS w
        FROM orders)""")
def dense_rank_week_of_month(spark: SparkSession, folder: str) -> DataFrame:
    week = windows.week_of_month(F.year("day"), F.month("day"), F.col("week_start"))
    return _order_weeks(spark, folder).select("day", week.alias("week"))


@query("""
  SELECT l_partkey, day, CAST(sum(change) OVER (PARTITION BY l_partkey ORDER BY day
    ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS stock
  FROM (SELECT l_partkey, CAST(l_shipdate AS DATE) AS day,
          sum(CAST(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE -l_quantity END
            AS DECIMAL(18,2))) AS change
        FROM lineitem GROUP BY ALL)""")
def running_sum(spark: SparkSession, folder: str) -> DataFrame:
    quantity = F.col("l_quantity")
    change = F.when(F.col("l_returnflag") == "N", quantity).otherwise(-quantity)
    items = scan(spark, folder, "lineitem").withColumn("day", F.to_date("l_shipdate"))
    return windows.running_sum(items, ["l_partkey"], "day", change, "stock")


@query("""
  SELECT l_partkey, day, counted, coalesce(last_value(counted IGNORE NULLS) OVER (
      PARTITION BY l_partkey ORDER BY day ROWS UNBOUNDED PRECEDING), 0) AS filled
  FROM (SELECT l_partkey, CAST(l_shipdate AS DATE) AS day,
          max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS counted
        FROM lineitem GROUP BY ALL)""")
def last_value_ignore_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Last counted quantity of a part, 0 before the first count."""
    counted = F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))
    days = scan(spark, folder, "lineitem").select(
        "l_partkey", F.to_date("l_shipdate").alias("day"), counted.alias("counted")
    )
    return windows.forward_fill(days, ["l_partkey"], "day", "counted", "filled", 0.0)


# --- sorts and set operations ----------------------------------------------------------------


@query("SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey FROM orders ORDER BY day DESC, o_orderkey")
def order_by_desc(spark: SparkSession, folder: str) -> DataFrame:
    orders = scan(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"), "o_orderkey")
    return sets.order_by_desc(orders, "day", "o_orderkey")


@query(expect("SELECT id FROM gaps ORDER BY id"))
def sorted_list(spark: SparkSession, folder: str) -> DataFrame:
    return sets.sorted_list(missing_ids(spark, folder), "id")


@query("""
  SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1""")
def first_row(spark: SparkSession, folder: str) -> DataFrame:
    orders = scan(spark, folder, "orders")
    return filters.first_row(orders, F.desc("o_totalprice"), "o_orderkey").select(
        "o_orderkey", "o_orderstatus"
    )


@query(expect("SELECT * FROM all_movements"))
def union_all_movements(spark: SparkSession, folder: str) -> DataFrame:
    return stock.movements(
        S.receptions(spark, folder),
        S.consumptions(spark, folder),
        S.build_core(spark, folder, columns=S.SOLD_COLUMNS),
    )


@query(expect("SELECT * FROM gaps"))
def missing_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Order ids without any line, by load interval."""
    fetched = scan(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"))
    return sets.missing_ids(sets.interval_pairs(_cursors(spark, folder)), fetched)


@query(
    expect("""
      SELECT first_id, last_id, CAST(min(id) AS BIGINT) AS gap_first, CAST(max(id) AS BIGINT) AS gap_last
      FROM (SELECT *, id - row_number() OVER (PARTITION BY first_id ORDER BY id) AS run FROM gaps)
      GROUP BY first_id, last_id, run""")
)
def missing_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The runs of order ids without any line, by load interval."""
    fetched = scan(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"))
    return sets.missing_ranges(sets.interval_pairs(_cursors(spark, folder)), fetched)


@query("""
  SELECT o_orderkey AS id, c_custkey AS interval FROM orders JOIN customer
  ON o_orderkey BETWEEN c_custkey * 37 - c_nationkey * c_nationkey AND c_custkey * 37 + c_nationkey - 10""")
def filter_id_intervals(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in intervals of very different lengths that overlap, begin below zero or are empty."""
    middle, nation = F.col("c_custkey") * 37, F.col("c_nationkey")
    intervals = scan(spark, folder, "customer").select(
        F.col("c_custkey").alias("interval"),
        (middle - nation * nation).cast("bigint").alias("first_id"),
        (middle + nation - 10).cast("bigint").alias("last_id"),
    )
    ids = scan(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))
    return filters.filter_id_intervals(ids, intervals, "id").select("id", "interval")


@query(expect("SELECT * FROM id_intervals"))
def interval_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return sets.interval_pairs(_cursors(spark, folder))
