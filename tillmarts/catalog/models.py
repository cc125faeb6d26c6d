"""The composed models over the whole test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmarts import standin as S
from tillmarts.catalog.expected import (
    calendar,
    between_days,
    case_of,
    colour_of,
    expect,
    money,
    size_order,
    text,
)
from tillmarts.catalog.registry import query, registered
from tillmarts.functions import lookups as L
from tillmarts.functions.numbers import money_sum
from tillmarts.operators.sets import union_all
from tillmarts.plans import ads, daily, marts, sales, shop, stock
from tillmarts.plans import loads as load_plans
from tillmarts.plans.calendar import calendar_of
from tillmarts.schemas import SHOP_ORDER_COLUMNS
from tillmarts.sources.readers import scan_table, series_between
from tillmarts.storage import fresh_path, materialize

_SALE_NAMES = ", ".join(text(n) for n in L.SALE_DOCUMENT_NAMES)

_ALL_ORDER_DAYS = between_days(
    "(SELECT min(CAST(o_orderdate AS DATE)) FROM orders)",
    "(SELECT max(CAST(o_orderdate AS DATE)) FROM orders)",
)


@query(expect(calendar(_ALL_ORDER_DAYS)))
def date_table(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar from the first to the last order."""
    bounds = scan_table(spark, folder, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last")
    )
    return calendar_of(series_between(bounds, F.col("first"), F.col("last")))


@query(expect("SELECT * FROM raw_lines"))
def raw_document(spark: SparkSession, folder: str) -> DataFrame:
    return sales.raw_document(S.build_documents(spark, folder))


@query(expect("SELECT * FROM doc_lines"))
def stg_document_lines(spark: SparkSession, folder: str) -> DataFrame:
    return S.build_document_lines(spark, folder)


@query(expect("SELECT * FROM core"))
def sales_core(spark: SparkSession, folder: str) -> DataFrame:
    return S.build_core(spark, folder)


@query(
    expect(f"""
      SELECT fecha_documento AS fecha, {money("detail_quantity")} AS unidades_vendidas,
        {money("detail_net_amount")} AS venta_neta, max(precio_unitario) AS precio_unitario,
        variant_description, orden_tallas, tipo_producto, nombre_producto, grupo_producto,
        variant_id, categoria, color, office AS sucursal, year, month, day, week_range
      FROM core WHERE document_name IN ({_SALE_NAMES}) GROUP BY ALL""")
)
def sales_daily(spark: SparkSession, folder: str) -> DataFrame:
    return sales.sales_daily(S.build_core(spark, folder, columns=S.DAILY_COLUMNS))


@query(expect("SELECT * FROM daily_ads"))
def ads_daily(spark: SparkSession, folder: str) -> DataFrame:
    return ads.ads_daily(S.insights(spark, folder), S.ADS_AS_OF)


@query(
    expect("""
      SELECT m.*, c.ad_id AS ad_id_c, c.ad_creative_id, c.body, c.title, c.video_id,
        c.thumbnail_url, c.call_to_action_type, c.status AS status_creative, n.cantidad_ads,
        CASE WHEN CAST(m.adset_daily_budget AS DOUBLE) > 1 THEN CAST(m.adset_daily_budget AS DOUBLE)
          ELSE CAST(m.campaign_daily_budget AS DOUBLE) END / n.cantidad_ads AS distributed_budget
      FROM daily_ads m
      LEFT JOIN creative_rows c ON c.ad_id = m.ad_id
      LEFT JOIN spending_ads n ON n.adset_id = m.adset_id AND n.date_start = m.date_start""")
)
def ads_budget(spark: SparkSession, folder: str) -> DataFrame:
    return S.build_ads_budget(spark, folder)


_DEVICE = (
    "CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 "
    "THEN 'mobile' ELSE 'desktop' END"
)


@query(
    expect(f"""
      SELECT CAST(user_id AS VARCHAR) AS ad_id, 'ad ' || user_id AS ad_name,
        CAST(user_id % 20 AS VARCHAR) AS adset_id, 'adset ' || (user_id % 20) AS adset_name,
        CAST(user_id % 5 AS VARCHAR) AS campaign_id, 'campaign ' || (user_id % 5) AS campaign_name,
        g.d AS campaign_date, g.d AS date_stop, spend, n AS impressions, clicks, n AS reach,
        spend * 1000 / n AS cpm, CAST(clicks AS DOUBLE) / n AS ctr,
        CASE WHEN clicks > 0 THEN spend / clicks END AS cpc, spend / n AS cpp,
        event_type AS publisher_platform, 'feed' AS platform_position,
        device AS impression_device, 'act' AS account_id, 'account' AS account_name,
        CAST(1 AS DOUBLE) AS frequency, c.*
      FROM (SELECT user_id, CAST(ts AS DATE) AS d, event_type, {_DEVICE} AS device,
              {money("value")} AS spend, count(*) AS n,
              count(*) FILTER (value > 50) AS clicks
            FROM events GROUP BY ALL) g
      LEFT JOIN event_calendar c ON c.date_raw = g.d""")
)
def ads_platform_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return ads.ads_platform_calendar(
        S.platform_insights(spark, folder), S.ads_calendar(spark, folder)
    )


@query(
    expect(f"""
      SELECT s.*, g.*,
        coalesce({case_of("variant_description", {k: str(v) for k, v in L.SIZE_ORDER.items()})},
          variant_description) AS orden_tallas,
        {colour_of("variant_code")} AS color
      FROM (SELECT variant_id, variant_code, variant_description, office_name AS sucursal,
              {money("quantity")} AS stock_actual FROM stock_rows GROUP BY ALL) s
      LEFT JOIN product_groups g ON g.variante_code_desc = substr(s.variant_code, 1, 4)""")
)
def stock_mart(spark: SparkSession, folder: str) -> DataFrame:
    return stock.stock_mart(S.build_stock(spark, folder), S.product_groups(spark, folder))


@query(
    expect(f"""
      SELECT s.variant_id, m.*, {size_order("m.variante")} AS orden_tallas,
        g.variante_code_desc, g.grupo_producto, g.categoria, v.unidades_vendidas, s.stock_actual
      FROM (SELECT variant_code, variant_id, {money("quantity")} AS stock_actual
            FROM stock_rows GROUP BY ALL) s
      LEFT JOIN master m ON m.sku = s.variant_code
      LEFT JOIN product_groups g ON g.variante_code_desc = substr(s.variant_code, 1, 4)
      LEFT JOIN (SELECT variant_id, fecha_documento, {money("detail_quantity")} AS unidades_vendidas
                 FROM core GROUP BY ALL) v ON CAST(v.variant_id AS VARCHAR) = s.variant_id""")
)
def stock_vs_sales(spark: SparkSession, folder: str) -> DataFrame:
    held = S.stock(spark, folder, "variant_code", "variant_id", "quantity")
    return stock.stock_vs_sales(
        held,
        S.product_master(spark, folder),
        S.product_groups(spark, folder),
        S.build_core(spark, folder, held, S.SOLD_COLUMNS),
    )


_LEDGER_DAYS = between_days(*[f"DATE '{d}'" for d in S.LEDGER_DAYS])


@query(
    expect(f"""
      SELECT fecha, variant_id, office_id, stock_final, stock_final AS stock_final_lleno
      FROM (
        SELECT g.d AS fecha, g.variant_id, g.office_id,
          CAST(sum(coalesce(m.change, 0)) OVER (PARTITION BY g.variant_id, g.office_id
            ORDER BY g.d ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS stock_final
        FROM (SELECT d, variant_id, office_id FROM {_LEDGER_DAYS},
                (SELECT DISTINCT variant_id, office_id FROM stock_rows)) g
        LEFT JOIN (SELECT fecha, variant_id, office_id,
                     sum(CAST(ingreso - salida AS DECIMAL(18,2))) AS change
                   FROM all_movements GROUP BY ALL) m
          ON m.fecha = g.d AND m.variant_id = g.variant_id AND m.office_id = g.office_id)""")
)
def stock_ledger(spark: SparkSession, folder: str) -> DataFrame:
    held = S.stock(spark, folder, "variant_id", "office_id", "quantity")
    moves = stock.movements(
        S.receptions(spark, folder),
        S.consumptions(spark, folder),
        S.build_core(spark, folder, held, S.SOLD_COLUMNS),
    )
    return stock.stock_ledger(held, moves, *S.LEDGER_DAYS)


@query(expect("SELECT * FROM stock_rows"))
def stg_stock(spark: SparkSession, folder: str) -> DataFrame:
    return stock.stg_stock(S.stock_raw(spark, folder))


@query(
    expect("""
      SELECT id AS consumption_id, day AS fecha_consumo, note, office_id, office_name, variant_id,
        quantity, cost
      FROM movement_details WHERE l_returnflag = 'A'""")
)
def stg_consumptions(spark: SparkSession, folder: str) -> DataFrame:
    return stock.stg_consumptions(S.consumptions(spark, folder))


@query(
    expect("""
      SELECT id AS recepcion_id, day AS fecha_recibo, CAST(id AS VARCHAR) AS document_number, note,
        office_id, office_name, variant_id, quantity, cost
      FROM movement_details WHERE l_returnflag = 'N'""")
)
def stg_receptions(spark: SparkSession, folder: str) -> DataFrame:
    return stock.stg_receptions(S.receptions(spark, folder))


@query(
    expect("""
      SELECT id AS consumption_id, moved AS consumption_date, note, office_id, office_name,
        variant_id, quantity, cost
      FROM movement_details WHERE l_returnflag = 'A'""")
)
def movement_lines(spark: SparkSession, folder: str) -> DataFrame:
    return stock.consumption_lines(S.consumption_headers(spark, folder))


@query(
    expect("""
      SELECT id AS recepcion_id, moved AS admission_date, 'Guía' AS document,
        CAST(id AS VARCHAR) AS document_number, note, office_id, office_name,
        variant_id, quantity, cost
      FROM movement_details WHERE l_returnflag = 'N'""")
)
def movement_lines_receptions(spark: SparkSession, folder: str) -> DataFrame:
    return stock.reception_lines(S.reception_headers(spark, folder))


@query(expect("SELECT * FROM insight_rows"))
def ad_insight_rows(spark: SparkSession, folder: str) -> DataFrame:
    return ads.ad_insight_rows(
        S.insights_raw(spark, folder),
        S.ad_statuses(spark, folder),
        S.adset_budgets(spark, folder),
        S.campaign_budgets(spark, folder),
    )


_INTEGER_BUDGETS = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ads.CAMPAIGN_BUDGETS)


@query(expect(f"SELECT * REPLACE ({_INTEGER_BUDGETS}) FROM insight_rows"))
def ad_insight_rows_integer_budgets(spark: SparkSession, folder: str) -> DataFrame:
    return ads.ad_insight_rows(
        S.insights_raw(spark, folder),
        S.ad_statuses(spark, folder),
        S.adset_budgets(spark, folder),
        S.campaign_budgets(spark, folder),
        integer_budgets=True,
    )


@query(expect("SELECT * FROM creative_rows"))
def creative_dim(spark: SparkSession, folder: str) -> DataFrame:
    return S.creatives(spark, folder)


@query(
    expect("""
      SELECT 'c' || u.user_id AS id,
        CASE WHEN top >= 250 THEN 'p' || u.user_id END AS object_story_id,
        CASE WHEN top >= 200 THEN 'p' || u.user_id END AS effective_object_story_id,
        CASE WHEN top < 200 THEN 'own body ' || u.user_id
          WHEN views % 4 = 0 THEN 'message ' || u.user_id END AS body,
        CASE WHEN top >= 200 AND views % 2 = 0 THEN '/post/' || u.user_id END AS post_link,
        CASE WHEN top >= 200 THEN views % 8 IN (0, 2) END AS is_video,
        CASE WHEN top < 200 THEN 'own video ' || u.user_id
          WHEN views % 8 = 0 THEN 'v2-' || u.user_id
          WHEN views % 8 = 2 THEN 'v1-' || u.user_id END AS video_id,
        CASE WHEN top >= 200 AND views % 2 = 0 THEN '2024-01-31' END AS post_created_time
      FROM users u""")
)
def post_content(spark: SparkSession, folder: str) -> DataFrame:
    return ads.post_content(S.post_creatives(spark, folder), S.posts(spark, folder))


_DAY = "strftime(o_orderdate, '%Y-%m-%d')"
_PRICE = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"
_SHOP_VALUES = {
    "id": "o_orderkey",
    "created_at": _DAY,
    "closed_at": f"CASE WHEN o_orderstatus = 'F' THEN {_DAY} END",
    "currency": "'CLP'",
    "current_total_price": _PRICE,
    "discount_codes": """'[{"code":"' || o_orderpriority || '"}]'""",
    "financial_status": "o_orderstatus",
    "name": "'#' || o_orderkey",
    "number": "o_orderkey",
    "order_number": "o_orderkey + 1000",
    "payment_gateway_names": "'[]'",
    "taxes_included": "o_orderstatus = 'F'",
    "total_price": _PRICE,
    "total_shipping_price_set": "'{}'",
    "user_id": "c_custkey",
    "billing_address": """'{"nation":' || c_nationkey || '}'""",
    "customer": """'{"id":' || c_custkey || ',"name":"' || c_name || '"}'""",
    "shipping_address": "'{}'",
    "line_items": """'[{"id":' || o_orderkey || ',"title":"' || o_orderpriority || '"}]'""",
}
SHOP_SELECT = ", ".join(
    f"{_SHOP_VALUES.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in SHOP_ORDER_COLUMNS
)


@query(f"SELECT {SHOP_SELECT} FROM orders JOIN customer ON o_custkey = c_custkey")
def order_rows(spark: SparkSession, folder: str) -> DataFrame:
    return shop.order_rows(S.shop_orders(spark, folder))


@query("""
  WITH visits AS (SELECT user_id, CAST(ts AS DATE) AS d FROM events),
  inside AS (SELECT * FROM visits WHERE d BETWEEN DATE '2024-01-16' AND DATE '2024-02-15'),
  seen AS (SELECT user_id, min(d) >= DATE '2024-01-16' AS fresh FROM visits
           WHERE d <= DATE '2024-02-15' GROUP BY user_id)
  SELECT (SELECT count(*) FROM inside) AS total_visits,
    (SELECT count(*) FROM (SELECT DISTINCT user_id, d FROM inside)) AS total_sessions,
    (SELECT count(*) FROM seen WHERE fresh AND user_id IN (SELECT user_id FROM inside))
      AS new_visitors,
    (SELECT count(*) FROM seen WHERE NOT fresh AND user_id IN (SELECT user_id FROM inside))
      AS returning_visitors""")
def trailing_visit_totals(spark: SparkSession, folder: str) -> DataFrame:
    return shop.trailing_visit_totals(scan_table(spark, folder, "events"), "2024-02-15")


@query(registered()["trailing_visit_totals"].sql)
def visit_totals_since(spark: SparkSession, folder: str) -> DataFrame:
    """The same from the window's events alone and a table of first days, built from windows that overlap."""
    events = scan_table(spark, folder, "events")
    seen = None
    for first, last in (("2023-01-01", "2024-01-20"), ("2024-01-10", "2024-02-10"), ("2024-02-01", "2024-02-16")):
        window = events.filter(F.col("ts").between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")))
        seen = materialize(shop.first_seen(window, seen), "first-seen")
    return shop.visit_totals_since(events, seen, "2024-02-15")


@query(registered()["stock_ledger"].sql)
def stock_ledger_carried(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger in three pieces, each from the closing balances of the one before."""
    held = S.stock(spark, folder, "variant_id", "office_id", "quantity")
    moves = stock.movements(
        S.receptions(spark, folder),
        S.consumptions(spark, folder),
        S.build_core(spark, folder, held, S.SOLD_COLUMNS),
    )
    moves = materialize(moves, "movements")  # read by every piece
    first, last = (dt.date.fromisoformat(d) for d in S.LEDGER_DAYS)
    third = (last - first) // 3
    day = dt.timedelta(days=1)
    cuts = [first, first + third, first + 2 * third, last + day]
    pieces, opening = [], None
    for start, stop in zip(cuts, cuts[1:]):
        days = str(start), str(stop - day)
        pieces.append(stock.stock_ledger(held, moves, *days, opening))
        opening = materialize(stock.closing_balances(moves, *days, opening), "balances")
    return union_all(*pieces)


# A column to add up of each mart, and the block or the query that states its rows.
_MARTS = {
    "date_table": ("order_calendar", "1.0"),
    "stg_document_lines": ("doc_lines", "detail_quantity"),
    "stg_stock": ("stock_rows", "quantity"),
    "ads_budget": ("ads_budget()", "spend"),
    "ads_platform_calendar": (None, "spend"),  # over another calendar than its query
    "stock_mart": ("stock_mart()", "stock_actual"),
    "sales_core": ("core", "detail_net_amount"),
    "sales_daily": ("sales_daily()", "venta_neta"),
    "stock_vs_sales": ("stock_vs_sales()", "stock_actual"),
    "stg_receptions": ("stg_receptions()", "quantity"),
    "stg_consumptions": ("stg_consumptions()", "quantity"),
    "stock_ledger": ("stock_ledger()", "stock_final"),
}


def _stated(block: str) -> str:
    """A block of the expected results, or the whole result of another query."""
    return f"({registered()[block.removesuffix('()')].sql})" if block.endswith("()") else block


def _mart_totals(marts_sql: dict[str, tuple[str | None, str]]) -> str:
    return expect(
        " UNION ALL ".join(
            f"SELECT '{mart}' AS mart, count(*) AS n, {money(column)} AS total FROM {_stated(block)} q"
            for mart, (block, column) in marts_sql.items()
            if block
        )
    )


def _totals(built: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        *[
            built[mart]
            .agg(F.count(F.lit(1)).alias("n"), money_sum(F.expr(column)).alias("total"))
            .select(F.lit(mart).alias("mart"), "n", "total")
            for mart, (block, column) in _MARTS.items()
            if block
        ]
    )


def _sources(spark: SparkSession, folder: str, documents: DataFrame | None = None) -> marts.Sources:
    return marts.Sources(
        documents=S.documents(spark, folder) if documents is None else documents,
        document_types=S.document_types(spark),
        stock=S.stock_raw(spark, folder),
        product_master=S.product_master(spark, folder),
        product_master_2=S.product_groups_raw(spark, folder),
        ad_insights=S.insights(spark, folder),
        creatives=S.creatives(spark, folder),
        platform_insights=S.platform_insights(spark, folder),
        calendar=S.sales_calendar(spark, folder),
        receptions=S.receptions(spark, folder),
        consumptions=S.consumptions(spark, folder),
        ledger_days=S.LEDGER_DAYS,
    )


@query(_mart_totals(_MARTS))
def build_marts(spark: SparkSession, folder: str) -> DataFrame:
    """All marts written from their sources; rows and totals of each."""
    sources = _sources(spark, folder, S.build_documents(spark, folder))
    built = marts.build_marts(spark, sources, fresh_path(spark, "marts"), S.ADS_AS_OF)
    return _totals(built)


@query(_mart_totals(_MARTS))
def daily_run(spark: SparkSession, folder: str) -> DataFrame:
    """A warehouse filled by a bulk load with gaps, then two equal daily runs; rows and totals of the marts."""
    warehouse = fresh_path(spark, "warehouse")
    documents, insights = S.documents(spark, folder), S.insights_raw(spark, folder)
    old = documents.filter(F.col("emissionDate") < 883_612_800)  # to the end of 1997
    starts = old.groupBy(F.floor(F.col("id") / 500)).agg(F.min("id").alias("id")).select("id")
    cursors = starts.unionByName(old.agg((F.max("id") + 1).alias("id")))
    load_plans.documents_bulk_load(old.filter("id % 11 <> 3"), old, cursors, daily.documents_table(warehouse))
    lookups = S.ad_statuses(spark, folder), S.adset_budgets(spark, folder), S.campaign_budgets(spark, folder)
    load_plans.ads_load(insights, *lookups, f"{warehouse}/insights", dt.date(2024, 12, 31), 800)
    landed = daily.Landed(documents.unionByName(documents), S.stock_raw(spark, folder), insights, *lookups)
    for _ in range(2):
        built = daily.daily_run(
            spark, landed, _sources(spark, folder, documents), warehouse, dt.datetime(2003, 1, 1, 12), 2000, 30, S.ADS_AS_OF
        )
    return _totals(built)
