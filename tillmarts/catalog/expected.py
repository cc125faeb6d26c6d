"""Building blocks of the expected-result SQL.

Each block restates a source or model over the flat test tables, without the JSON packing and the
staged tables of the Spark side. ``expect`` puts the blocks a query needs in front of it.
"""

from __future__ import annotations

import re

from tillmarts import standin as S
from tillmarts.functions import lookups as L


def text(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def case_of(expr: str, mapping: dict, default: str | None = None) -> str:
    def lit(v: object) -> str:
        return str(v) if isinstance(v, int) else text(v)

    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    tail = "" if default is None else f" ELSE {default}"
    return f"CASE {expr} {whens}{tail} END"


def colour_of(expr: str) -> str:
    whens = " ".join(f"WHEN {expr} LIKE '%{c}%' THEN {text(n)}" for c, n in L.COLOUR_RULES)
    return f"CASE {whens} ELSE {text(L.COLOUR_OTHER)} END"


def money(expr: str) -> str:
    return f"CAST(sum(CAST({expr} AS DECIMAL(18,2))) AS DOUBLE)"


def flipped(expr: str) -> str:
    return f"CASE WHEN document_type_id = {L.CREDIT_NOTE_ID} THEN -{expr} ELSE {expr} END"


def size_order(expr: str) -> str:
    return f"CAST({case_of(expr, L.SIZE_ORDER)} AS BIGINT)"


def calendar(days: str) -> str:
    """Calendar columns over a relation with a DATE column ``d``."""
    week = "date_trunc('week', d)"
    return f"""
      SELECT d AS date_raw,
        CAST(year(d) AS BIGINT) AS year,
        CAST(month(d) AS BIGINT) AS month,
        {case_of("month(d)", L.MONTHS)} AS month_name,
        CAST(year(d) AS VARCHAR) || '/' || CAST(month(d) AS VARCHAR) AS year_month,
        CAST(day(d) AS BIGINT) AS day,
        CAST(dense_rank() OVER (PARTITION BY year({week}) ORDER BY {week}) AS BIGINT) AS week_of_year,
        CAST(dayofweek(d) + 1 AS BIGINT) AS weekday,
        {case_of("dayofweek(d) + 1", L.WEEKDAYS)} AS weekday_name,
        CAST(dense_rank() OVER (PARTITION BY year(d), month(d) ORDER BY {week}) AS BIGINT)
          AS week_of_month,
        strftime({week}, '%Y-%m-%d') || ' / ' ||
          strftime({week} + INTERVAL 6 DAY, '%Y-%m-%d') AS week_range,
        CASE WHEN month(d) <= 6 THEN 'S1' ELSE 'S2' END AS semester,
        'Q' || CAST((month(d) + 2) // 3 AS VARCHAR) AS quarter
      FROM {days}"""


def between_days(first: str, last: str) -> str:
    return (
        "(SELECT CAST(unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), "
        f"INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT {first} AS a, {last} AS b))"
    )


_ORDER_DAY = "CAST(o_orderdate AS DATE)"
_K = "CAST(json_extract_string(props, '$.k') AS BIGINT) % 2"
_SALE_NAMES = ", ".join(text(n) for n in L.SALE_DOCUMENT_NAMES)
_SALE_IDS = ", ".join(str(i) for i in L.SALE_DOCUMENT_IDS)
_DETAIL_MEASURES = {
    "detail_quantity": "detail_quantity",
    "detail_unit_value": "detail_netUnitValue",
    "detail_total_unit_value": "detail_totalUnitValue",
    "detail_net_amount": "detail_netAmount",
    "detail_tax_amount": "detail_taxAmount",
    "detail_total_amount": "detail_totalAmount",
    "detail_net_discount": "detail_netDiscount",
    "detail_total_discount": "detail_totalDiscount",
}


def _count_if(name: str) -> str:
    event, parity = S.ACTION_SOURCES[name]
    return f"count(*) FILTER (event_type = '{event}' AND {_K} = {parity})"


def _amount_if(name: str) -> str:
    event, parity = S.ACTION_SOURCES[name]
    return (
        f"sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = '{event}' AND {_K} = {parity})"
    )


def _json_item(name: str, value: str, when: str) -> str:
    body = f"""'{{"action_type":"{name}","value":"' || {value} || '"}}'"""
    return f"CASE WHEN {when} THEN {body} END"


_ACTION_TEXT = ", ".join(
    [_json_item(n, f"CAST(n_{n} AS VARCHAR)", f"n_{n} > 0") for n in S.ACTION_SOURCES]
    + [_json_item("landing_page_view", "''", "n_video_view > 0")]
)
_AMOUNT_TEXT = ", ".join(
    _json_item(n, f"CAST(CAST(v_{n} AS DECIMAL(18,2)) AS VARCHAR)", f"v_{n} IS NOT NULL")
    for n in ("purchase", "omni_purchase")
)


def _budget(level: str, size: int, hidden: str) -> str:
    n = f"(user_id % {size})"
    listed = f"CAST({n} AS VARCHAR) <> '{hidden}'"
    return f"""
        CASE WHEN {listed} THEN CASE WHEN {n} % 4 = 1 THEN '1'
          WHEN {n} % 4 > 1 THEN CAST({n} * 100 AS VARCHAR) END END AS daily_budget_{level},
        CASE WHEN {listed} AND {n} % 4 = 0 THEN CAST({n} + 7 AS VARCHAR) END
          AS lifetime_budget_{level},
        CASE WHEN {listed} THEN CAST({n} * 10 AS VARCHAR) END AS budget_remaining_{level}"""


# An action column is NULL for ads without any action that day; types that never occur are 0.
def _action_column(name: str) -> str:
    value = f"n_{name}" if name in S.ACTION_SOURCES else "0"
    return f"CASE WHEN n_actions > 0 THEN CAST({value} AS BIGINT) END"


BLOCKS: dict[str, str] = {
    "variants": f"""
      SELECT p_partkey AS variant_id,
        CAST(2000 + CAST(substr(p_brand, 7) AS BIGINT) AS VARCHAR)
          || {case_of("split_part(p_name, ' ', 1)", S.WORD_CODES)}
          || {case_of("p_size % 8", dict(enumerate(S.SIZE_SUFFIXES)))}
          || '-' || CAST(p_partkey AS VARCHAR) AS variant_code,
        {case_of("p_size % 8", dict(enumerate(S.SIZES)))} AS variant_description,
        'B' || CAST(p_partkey AS VARCHAR) AS barcode,
        CAST(p_size % 5 + 1 AS BIGINT) AS home_office,
        p_name, p_type, p_brand, p_retailprice
      FROM part""",
    "master": """
      SELECT variant_code AS sku, p_type AS tipo_producto, p_name AS nombre_producto,
        variant_description AS variante, p_retailprice * CAST(0.6 AS DOUBLE) AS costo_neto,
        p_retailprice AS precio_unitario
      FROM variants WHERE p_type <> 'PROMO'""",
    "product_groups": """
      SELECT CAST(2000 + n AS VARCHAR) AS variante_code_desc,
        'GRUPO ' || p_brand AS grupo_producto,
        'CATEGORIA ' || CAST(n % 7 AS VARCHAR) AS categoria
      FROM (SELECT DISTINCT p_brand, CAST(substr(p_brand, 7) AS BIGINT) AS n FROM part)
      WHERE p_brand <> 'Brand#25'""",
    "docs": f"""
      SELECT o_orderkey AS doc_id, o_orderkey AS document_number,
        CAST(epoch(o_orderdate) AS BIGINT) AS emissionDate,
        CAST(epoch(o_orderdate) AS BIGINT) + 2592000 AS expirationDate,
        CAST(epoch(o_orderdate) AS BIGINT) AS generationDate,
        {_ORDER_DAY} AS day,
        o_totalprice AS totalAmount,
        o_totalprice * CAST(0.81 AS DOUBLE) AS netAmount,
        o_totalprice * CAST(0.19 AS DOUBLE) AS taxAmount,
        CAST(CASE o_orderstatus WHEN 'P' THEN 9 WHEN 'O' THEN 1
          ELSE {case_of("o_orderpriority", S.PRIORITY_TYPES)} END AS BIGINT) AS document_type_id,
        o_custkey AS client_id, o_custkey % 6 + 1 AS office_id, o_custkey % 10 AS user_id,
        o_orderstatus, o_orderpriority
      FROM orders""",
    "doc_refs": """
      SELECT o_orderkey AS doc_id, o_orderkey * 10 + 1 AS reference_id,
        'devolucion' AS reference_reason
      FROM orders WHERE o_orderpriority IN ('1-URGENT', '4-NOT SPECIFIED')
      UNION ALL
      SELECT o_orderkey, o_orderkey * 10 + 2, 'cambio'
      FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "raw_lines": """
      SELECT d.doc_id, d.document_number, d.emissionDate, d.expirationDate, d.generationDate,
        d.totalAmount, d.netAmount, d.taxAmount,
        l_orderkey * 10 + l_linenumber AS detail_id,
        CAST(l_linenumber AS BIGINT) AS detail_lineNumber,
        l_quantity AS detail_quantity,
        l_extendedprice / l_quantity AS detail_netUnitValue,
        l_extendedprice * (1 + l_tax) / l_quantity AS detail_totalUnitValue,
        l_extendedprice AS detail_netAmount,
        l_extendedprice * l_tax AS detail_taxAmount,
        l_extendedprice * (1 + l_tax) AS detail_totalAmount,
        l_extendedprice * l_discount AS detail_netDiscount,
        l_extendedprice * l_discount * (1 + l_tax) AS detail_totalDiscount,
        l_returnflag AS detail_note,
        CAST(0 AS BIGINT) AS detail_relatedDetailId,
        v.variant_id, v.variant_description, v.variant_code,
        d.document_type_id, d.client_id, d.office_id, d.user_id,
        r.reference_id, r.reference_reason
      FROM docs d
      JOIN lineitem ON l_orderkey = d.doc_id
      JOIN variants v ON v.variant_id = l_partkey
      LEFT JOIN doc_refs r ON r.doc_id = d.doc_id""",
    "doc_lines": f"""
      SELECT doc_id, document_number, emissionDate, expirationDate, generationDate,
        document_type_id, {case_of("document_type_id", S.DOCUMENT_TYPES)} AS document_name,
        totalAmount AS total_amount, netAmount AS net_amount, taxAmount AS tax_amount,
        {", ".join(f"{old} AS {new}" for new, old in _DETAIL_MEASURES.items())},
        office_id,
        {case_of("office_id", L.OFFICES, text(L.OFFICE_OTHER))} AS office,
        variant_description,
        {size_order("variant_description")} AS orden_tallas,
        variant_code, variant_id
      FROM raw_lines""",
    "sale_days": f"""
      SELECT d AS fecha_documento, count(*) AS compras_mismo_dia
      FROM (SELECT make_date(1970, 1, 1) + CAST(emissionDate // 86400 AS INTEGER) AS d,
              document_name FROM doc_lines)
      WHERE document_name IN ({_SALE_NAMES}) GROUP BY d""",
    "user_days": f"""
      SELECT user_id, CAST(ts AS DATE) AS day,
        {", ".join(f"{_count_if(n)} AS n_{n}" for n in S.ACTION_SOURCES)},
        {", ".join(f"{_amount_if(n)} AS v_{n}" for n in ("purchase", "omni_purchase"))},
        count(*) FILTER (event_type <> 'signup') AS n_actions,
        count(*) FILTER (event_type = 'view') AS views,
        count(*) FILTER (event_type = 'click') AS clicks,
        CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (event_type = 'click'), 0)
          AS DECIMAL(18,2)) AS spent
      FROM events GROUP BY ALL""",
    "users": """
      SELECT user_id, max(value) AS top, count(*) FILTER (event_type = 'view') AS views
      FROM events GROUP BY user_id""",
    "insight_rows": f"""
      SELECT CAST(u.user_id AS VARCHAR) || '_' || strftime(day, '%Y-%m-%d') AS id,
        CAST(u.user_id AS VARCHAR) AS ad_id, 'ad ' || u.user_id AS ad_name,
        CAST(u.user_id % 20 AS VARCHAR) AS adset_id, 'adset ' || (u.user_id % 20) AS adset_name,
        CAST(u.user_id % 5 AS VARCHAR) AS campaign_id,
        'campaign ' || (u.user_id % 5) AS campaign_name,
        CAST(d.views AS VARCHAR) AS impressions, CAST(clicks AS VARCHAR) AS clicks,
        CAST(clicks AS VARCHAR) || '.0' AS ctr, CAST(spent AS VARCHAR) AS spend,
        strftime(day, '%Y-%m-%d') AS date_start, strftime(day, '%Y-%m-%d') AS date_stop,
        '[' || concat_ws(',', {_ACTION_TEXT}) || ']' AS actions,
        '[' || concat_ws(',', {_AMOUNT_TEXT}) || ']' AS action_values,
        CAST(n_purchase + n_omni_purchase AS BIGINT) AS purchases,
        CAST(coalesce(v_purchase, 0) AS DOUBLE) + CAST(coalesce(v_omni_purchase, 0) AS DOUBLE)
          AS purchase_value,
        CASE WHEN top >= 250 THEN 'ACTIVE' WHEN top >= 200 THEN 'PAUSED' ELSE 'unknown' END
          AS status,
        CASE WHEN top >= 200 THEN 'DELIVERING' WHEN top >= 150 THEN 'ARCHIVED'
          ELSE 'unknown' END AS effective_status,
        {_budget("adset", 20, "19").replace("user_id", "u.user_id")},
        {_budget("campaign", 5, "4").replace("user_id", "u.user_id")}
      FROM user_days d JOIN users u ON u.user_id = d.user_id""",
    "recent_ads": f"""
      SELECT CAST(user_id AS VARCHAR) AS ad_id, sum(views) AS seen FROM user_days
      WHERE day >= DATE '{S.ADS_AS_OF}' - INTERVAL 1 DAY GROUP BY user_id""",
    "daily_ads": f"""
      SELECT i.ad_id, i.ad_name, i.adset_name, i.adset_id, i.campaign_id, i.campaign_name,
        i.impressions, i.clicks, i.ctr, CAST(i.spend AS DOUBLE) AS spend,
        CAST({_action_column("purchase")} AS DOUBLE) AS purchase,
        CASE WHEN v_purchase IS NOT NULL OR v_omni_purchase IS NOT NULL
          THEN CAST(coalesce(v_purchase, 0) AS DOUBLE) END AS purchase_amount,
        d.day AS date_start, d.day AS date_stop, i.status,
        i.daily_budget_adset AS adset_daily_budget,
        i.daily_budget_campaign AS campaign_daily_budget,
        i.effective_status, i.action_values, i.actions,
        {", ".join(f"{_action_column(c)} AS {c}" for c in L.ACTION_COLUMNS if c != "purchase")},
        CASE WHEN seen > 0 THEN 'Active' ELSE 'Inactive' END AS ad_is_active
      FROM insight_rows i
      JOIN user_days d ON CAST(d.user_id AS VARCHAR) = i.ad_id
        AND strftime(d.day, '%Y-%m-%d') = i.date_start
      LEFT JOIN recent_ads r ON r.ad_id = i.ad_id""",
    "creative_rows": """
      SELECT 'c' || n AS ad_creative_id, 'creative ' || n AS name, 'body ' || n AS body,
        CASE WHEN shown % 2 = 0 THEN 'title ' || n END AS title,
        '/image/' || n AS image_url, '/thumb/' || n AS thumbnail_url,
        CASE WHEN shown % 3 = 0 THEN 'v' || n END AS video_id,
        'p' || n AS object_story_id, 'ACTIVE' AS status, 'SHOP_NOW' AS call_to_action_type,
        'SHARE' AS object_type, CAST(NULL AS VARCHAR) AS template_url,
        CASE WHEN shown % 2 = 0 THEN '{"page_id":"page ' || n || '"}' ELSE '{}' END
          AS object_story_spec,
        ad_id
      FROM (SELECT CAST(user_id % 40 AS VARCHAR) AS n, sum(views) AS shown,
              min(CAST(user_id AS VARCHAR)) FILTER (top >= 150) AS ad_id
            FROM users GROUP BY user_id % 40)
      WHERE ad_id IS NOT NULL""",
    "spending_ads": """
      SELECT adset_id, date_start, count(DISTINCT ad_id) AS cantidad_ads
      FROM daily_ads WHERE spend > 0 GROUP BY adset_id, date_start""",
    "stock_lots": """
      SELECT l_partkey * 1000000 + l_suppkey AS id, l_partkey,
        CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
        CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (l_returnflag = 'R'), 0)
          AS DOUBLE) AS quantity_reserved
      FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "stock_rows": f"""
      SELECT id, quantity, quantity_reserved, quantity - quantity_reserved AS quantity_available,
        CAST(variant_id AS VARCHAR) AS variant_id, variant_description,
        barcode AS variant_barcode, variant_code, p_brand AS product_id,
        CAST(home_office AS VARCHAR) AS office_id,
        {case_of("home_office", L.OFFICES, text(L.OFFICE_OTHER))} AS office_name,
        'AV ' || home_office AS office_address, 'SANTIAGO' AS office_city,
        'CHILE' AS office_country
      FROM stock_lots JOIN variants ON l_partkey = variant_id""",
    "order_calendar": calendar(
        "(SELECT d FROM "
        + between_days("DATE '1900-01-01'", "DATE '2100-12-31'")
        + " WHERE year(d) > (SELECT min(year(o_orderdate)) FROM orders)"
        " AND year(d) < (SELECT max(year(o_orderdate)) FROM orders))"
    ),
    "event_calendar": calendar(
        between_days(
            "(SELECT min(CAST(ts AS DATE)) FROM events)",
            "(SELECT max(CAST(ts AS DATE)) - 1 FROM events)",
        )
    ),
    "spend_days": f"""
      SELECT day - {S.SPEND_SHIFT_DAYS} AS date_fb, CAST(sum(spent) AS DOUBLE) AS costo
      FROM user_days GROUP BY day""",
    "variant_stock": f"""
      SELECT l_partkey AS variant_id, {money("l_quantity")} AS stock_actual
      FROM lineitem GROUP BY l_partkey""",
    "core": f"""
      SELECT doc_id, document_number, fecha_documento, expiration_date, generation_date,
        document_type_id, document_name, office, office_id,
        {", ".join(f"{flipped(c)} AS {c}" for c in ["total_amount", "net_amount", "tax_amount", *_DETAIL_MEASURES])},
        variant_description, orden_tallas, variant_code, variant_id,
        CASE WHEN document_name NOT IN ({_SALE_NAMES}) THEN 0.0
          WHEN compras_mismo_dia < 2 OR compras_mismo_dia IS NULL THEN costo
          ELSE costo / compras_mismo_dia END AS inversion_desglosada_fbads,
        tipo_producto, nombre_producto,
        {flipped("costo_neto")} AS costo_neto, {flipped("precio_unitario")} AS precio_unitario,
        grupo_producto, categoria, variante_code_desc, stock_actual,
        date_raw, year, month, month_name, year_month, day, week_of_year, weekday, weekday_name,
        week_of_month, week_range, semester, quarter,
        {colour_of("variant_code")} AS color
      FROM (SELECT *,
          make_date(1970, 1, 1) + CAST(emissionDate // 86400 AS INTEGER) AS fecha_documento,
          make_date(1970, 1, 1) + CAST(expirationDate // 86400 AS INTEGER) AS expiration_date,
          make_date(1970, 1, 1) + CAST(generationDate // 86400 AS INTEGER) AS generation_date
        FROM doc_lines) x
      LEFT JOIN sale_days USING (fecha_documento)
      LEFT JOIN spend_days ON date_fb = fecha_documento
      LEFT JOIN master ON sku = variant_code
      LEFT JOIN product_groups ON variante_code_desc = substr(variant_code, 1, 4)
      LEFT JOIN variant_stock USING (variant_id)
      LEFT JOIN order_calendar ON date_raw = fecha_documento""",
    "movement_details": f"""
      SELECT l_returnflag, l_orderkey * 10 + l_linenumber AS id,
        CAST(epoch(l_shipdate) AS BIGINT) AS moved, CAST(l_shipdate AS DATE) AS day,
        CASE WHEN l_linestatus = 'O' THEN 'abierto' ELSE '' END AS note,
        home_office AS office_id,
        {case_of("home_office", L.OFFICES, text(L.OFFICE_OTHER))} AS office_name,
        variant_id, q AS quantity, l_extendedprice / l_quantity AS cost
      FROM (SELECT *, l_quantity - 1 AS q FROM lineitem
            UNION ALL SELECT *, CAST(1 AS DOUBLE) FROM lineitem)
      JOIN variants ON variant_id = l_partkey""",
    "all_movements": f"""
      SELECT day AS fecha, CAST(variant_id AS VARCHAR) AS variant_id,
        CAST(office_id AS VARCHAR) AS office_id,
        CASE WHEN l_returnflag = 'N' THEN quantity ELSE 0.0 END AS ingreso,
        CASE WHEN l_returnflag = 'A' THEN quantity ELSE 0.0 END AS salida
      FROM movement_details WHERE l_returnflag IN ('N', 'A')
      UNION ALL
      SELECT make_date(1970, 1, 1) + CAST(emissionDate // 86400 AS INTEGER),
        CAST(variant_id AS VARCHAR), CAST(office_id AS VARCHAR), 0.0,
        {money(flipped("detail_quantity"))}
      FROM doc_lines WHERE document_type_id IN ({_SALE_IDS}) GROUP BY ALL""",
    "id_cursors": """
      SELECT min(o_orderkey) AS id FROM orders GROUP BY o_orderkey // 500
      UNION SELECT max(o_orderkey) + 1 FROM orders""",
    "id_intervals": """
      SELECT id AS first_id, next_id - 1 AS last_id
      FROM (SELECT id, lead(id) OVER (ORDER BY id) AS next_id FROM id_cursors)
      WHERE next_id IS NOT NULL""",
    "gaps": """
      SELECT first_id, last_id, id
      FROM (SELECT first_id, last_id, unnest(generate_series(first_id, last_id)) AS id
            FROM id_intervals)
      WHERE id NOT IN (SELECT l_orderkey FROM lineitem)""",
}


def expect(sql: str) -> str:
    """``sql`` with the blocks it refers to, and those they refer to, as CTEs in front."""
    needed: list[str] = []

    def visit(body: str) -> None:
        for name in BLOCKS:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", body):
                visit(BLOCKS[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{name} AS ({BLOCKS[name]})" for name in needed)
    return f"WITH {ctes}\n{sql}"
