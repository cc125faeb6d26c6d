"""Projections and scalar functions over the whole test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmarts import standin as S
from tillmarts.catalog.expected import case_of, colour_of, expect, size_order, text
from tillmarts.catalog.registry import query
from tillmarts.functions import dates as D
from tillmarts.functions import jsons as J
from tillmarts.functions import labels as B
from tillmarts.functions import lookups as L
from tillmarts.functions import numbers as N
from tillmarts.functions import texts as X
from tillmarts.operators import joins
from tillmarts.sources.readers import scan_table


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return scan_table(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate"))


# --- projections -----------------------------------------------------------------------------


@query("""
  SELECT c_custkey AS client_id, c_name AS client, c_mktsegment AS segment, c_acctbal AS balance
  FROM customer""")
def project_alias(spark: SparkSession, folder: str) -> DataFrame:
    return scan_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("client_id"),
        F.col("c_name").alias("client"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


@query("""
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderpriority,
    c.c_custkey, c.c_name, CAST(c.c_nationkey AS BIGINT) AS c_nationkey, c.c_acctbal,
    c.c_mktsegment
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def project_star_join(spark: SparkSession, folder: str) -> DataFrame:
    o = scan_table(spark, folder, "orders").drop("o_orderdate").alias("o")
    c = scan_table(spark, folder, "customer")
    c = c.withColumn("c_nationkey", F.col("c_nationkey").cast("bigint")).alias("c")
    return o.join(c, F.col("o.o_custkey") == F.col("c.c_custkey"), "left").select("o.*", "c.*")


@query(f"""
  SELECT o_orderkey, {case_of("o_custkey % 6 + 1", L.OFFICES, text(L.OFFICE_OTHER))} AS office,
    {case_of("month(o_orderdate)", L.MONTHS)} AS month_name,
    {case_of("dayofweek(o_orderdate) + 1", L.WEEKDAYS)} AS weekday_name
  FROM orders""")
def case_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder).select(
        "o_orderkey",
        B.office_name(F.col("o_custkey") % 6 + 1).alias("office"),
        B.month_name(F.month("day")).alias("month_name"),
        B.weekday_name(F.dayofweek("day")).alias("weekday_name"),
    )


@query(
    expect(f"""
      SELECT variant_id, variant_description, {size_order("variant_description")} AS orden_tallas
      FROM variants""")
)
def case_size_order(spark: SparkSession, folder: str) -> DataFrame:
    return S.variants(spark, folder).select(
        "variant_id",
        "variant_description",
        B.size_order(F.col("variant_description")).alias("orden_tallas"),
    )


@query(
    expect(f"""
      SELECT variant_id,
        coalesce({case_of("variant_description", {k: str(v) for k, v in L.SIZE_ORDER.items()})},
          variant_description) AS orden_tallas
      FROM variants""")
)
def case_size_order_str(spark: SparkSession, folder: str) -> DataFrame:
    return S.variants(spark, folder).select(
        "variant_id", B.size_order_text(F.col("variant_description")).alias("orden_tallas")
    )


@query(expect(f"SELECT variant_id, variant_code, {colour_of('variant_code')} AS color FROM variants"))
def case_like_first_match(spark: SparkSession, folder: str) -> DataFrame:
    codes = S.variants(spark, folder).select("variant_id", "variant_code")
    return joins.attach_colour(codes, "variant_code")


@query("""
  SELECT o_orderkey, CASE WHEN month(o_orderdate) <= 6 THEN 'S1' ELSE 'S2' END AS semester,
    'Q' || CAST((month(o_orderdate) + 2) // 3 AS VARCHAR) AS quarter
  FROM orders""")
def case_range_bucket(spark: SparkSession, folder: str) -> DataFrame:
    month = F.month("day")
    return _orders(spark, folder).select(
        "o_orderkey", B.semester(month).alias("semester"), B.quarter(month).alias("quarter")
    )


@query("""
  SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS total_amount
  FROM orders""")
def sign_flip(spark: SparkSession, folder: str) -> DataFrame:
    credit = S.order_type_id() == L.CREDIT_NOTE_ID
    return _orders(spark, folder).select(
        "o_orderkey", N.sign_flip(F.col("o_totalprice"), credit).alias("total_amount")
    )


@query(
    expect("""
      SELECT id, CASE WHEN CAST(clicks AS BIGINT) = 0 THEN NULL
        WHEN CAST(daily_budget_adset AS DOUBLE) > 1
          THEN CAST(daily_budget_adset AS DOUBLE) / CAST(clicks AS DOUBLE)
        ELSE CAST(daily_budget_campaign AS DOUBLE) / CAST(clicks AS DOUBLE) END AS budget
      FROM insight_rows""")
)
def case_fallback_budget(spark: SparkSession, folder: str) -> DataFrame:
    budget = N.fallback_budget(
        F.col("daily_budget_adset"), F.col("daily_budget_campaign"), F.col("clicks")
    )
    return S.insights(spark, folder).select("id", budget.alias("budget"))


@query("""
  SELECT l_orderkey, l_partkey, l_quantity AS ingreso, CAST(0 AS BIGINT) AS salida
  FROM lineitem WHERE l_returnflag = 'N'""")
def constant_column(spark: SparkSession, folder: str) -> DataFrame:
    items = scan_table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "N")
    return items.select(
        "l_orderkey",
        "l_partkey",
        F.col("l_quantity").alias("ingreso"),
        F.lit(0).cast("bigint").alias("salida"),
    )


@query("""
  SELECT event_id, CAST(user_id AS VARCHAR) || '_' ||
    CASE WHEN event_type = 'error' THEN 'unknown' ELSE event_type END AS id
  FROM events""")
def concat_key(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return scan_table(spark, folder, "events").select(
        "event_id", X.concat_key(F.col("user_id"), kind).alias("id")
    )


@query("""
  SELECT o_orderkey AS id, '{"id":' || c_custkey || ',"name":"' || c_name || '"}' AS customer,
    '[{"code":"' || o_orderpriority || '"}]' AS discount_codes, o_orderstatus AS financial_status
  FROM orders JOIN customer ON o_custkey = c_custkey""")
def nested_to_json(spark: SparkSession, folder: str) -> DataFrame:
    orders = S.shop_orders(spark, folder)
    return J.nested_to_json(orders.select("id", "customer", "discount_codes", "financial_status"))


@query("""
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
    CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS priority
  FROM orders""")
def stringify_all(spark: SparkSession, folder: str) -> DataFrame:
    typed = _orders(spark, folder).select(
        "o_orderkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        "day",
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).alias("priority"),
    )
    return J.stringify_all(typed)


# --- scalar functions ------------------------------------------------------------------------


@query(
    expect("""
      SELECT doc_id AS id, document_type_id, client_id,
        CASE WHEN o_orderpriority = '3-MEDIUM' THEN '/references' END AS href,
        CAST(NULL AS VARCHAR) AS whole
      FROM docs""")
)
def json_scalar(spark: SparkSession, folder: str) -> DataFrame:
    return S.document_headers(spark, folder).select(
        "id",
        N.safe_cast(J.json_scalar(F.col("document_type"), "$.id"), "bigint").alias(
            "document_type_id"
        ),
        N.safe_cast(J.json_scalar(F.col("client"), "$.id"), "bigint").alias("client_id"),
        J.json_scalar(F.col("references"), "$.href").alias("href"),
        # An object is not a scalar.
        J.json_scalar(F.col("client"), "$").alias("whole"),
    )


@query(
    expect("""
      SELECT doc_id AS id, '{"id":' || reference_id || ',"reason":"' || reference_reason || '"}'
        AS reference
      FROM doc_refs""")
)
def json_array(spark: SparkSession, folder: str) -> DataFrame:
    return S.document_headers(spark, folder).select(
        "id", F.explode(J.json_texts(F.col("references"))).alias("reference")
    )


_EVENT_TEXT = (
    "CASE WHEN event_type = 'error' THEN 'abc' "
    "WHEN event_type = 'signup' THEN '' "
    "WHEN event_type = 'click' THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) "
    "WHEN event_type = 'purchase' THEN '-' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) "
    "ELSE ' ' || json_extract_string(props, '$.k') || ' ' END"
)


def _event_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Text that is a whole number with blanks, a decimal, empty, or no number at all."""
    kind = F.col("event_type")
    amount = F.col("value").cast("decimal(18,2)").cast("string")
    number = (
        F.when(kind == "error", F.lit("abc"))
        .when(kind == "signup", F.lit(""))
        .when(kind == "click", amount)
        .when(kind == "purchase", F.concat(F.lit("-"), amount))
        .otherwise(F.concat(F.lit(" "), F.get_json_object("props", "$.k"), F.lit(" ")))
    )
    return scan_table(spark, folder, "events").select("event_id", number.alias("number"))


@query(f"""
  SELECT event_id, TRY_CAST(number AS DOUBLE) AS as_double,
    CASE WHEN number NOT LIKE '%.%' THEN TRY_CAST(number AS BIGINT) END AS as_bigint
  FROM (SELECT event_id, {_EVENT_TEXT} AS number FROM events)""")
def safe_cast(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("number")
    return _event_texts(spark, folder).select(
        "event_id",
        N.safe_cast(number, "double").alias("as_double"),
        N.safe_cast(number, "bigint").alias("as_bigint"),
    )


@query("""
  SELECT event_id, CASE WHEN event_type <> 'error'
    THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS n
  FROM events""")
def cast_nullif(spark: SparkSession, folder: str) -> DataFrame:
    events = scan_table(spark, folder, "events")
    number = F.when(F.col("event_type") == "error", F.lit("")).otherwise(
        F.get_json_object("props", "$.k")
    )
    return events.select("event_id", N.cast_nullif(number, "bigint").alias("n"))


@query(f"""
  SELECT event_id, CAST(trunc(TRY_CAST(trim(number) AS DOUBLE)) AS BIGINT) AS n
  FROM (SELECT event_id, {_EVENT_TEXT} AS number FROM events)""")
def coerce_int(spark: SparkSession, folder: str) -> DataFrame:
    return _event_texts(spark, folder).select("event_id", N.coerce_int(F.col("number")).alias("n"))


@query(
    expect("SELECT doc_id AS id, day AS fecha, day + 30 AS vence FROM docs"),
)
def epoch_to_date(spark: SparkSession, folder: str) -> DataFrame:
    return S.document_headers(spark, folder).select(
        "id",
        D.epoch_to_date(F.col("emissionDate")).alias("fecha"),
        D.epoch_to_date(F.col("expirationDate")).alias("vence"),
    )


@query("""
  SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m,
    CAST(day(o_orderdate) AS BIGINT) AS d, CAST(dayofweek(o_orderdate) + 1 AS BIGINT) AS wd
  FROM orders""")
def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder).select(
        "o_orderkey",
        F.year("day").cast("bigint").alias("y"),
        F.month("day").cast("bigint").alias("m"),
        F.dayofmonth("day").cast("bigint").alias("d"),
        F.dayofweek("day").cast("bigint").alias("wd"),
    )


@query("""
  SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
    CAST(date_trunc('week', o_orderdate) + INTERVAL 6 DAY AS DATE) AS week_end
  FROM orders""")
def week_bounds(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("day")
    return _orders(spark, folder).select(
        "o_orderkey", D.week_start(day).alias("week_start"), D.week_end(day).alias("week_end")
    )


@query("""
  SELECT o_orderkey, CAST(o_orderdate + INTERVAL 30 DAY AS DATE) AS later,
    CAST(o_orderdate - INTERVAL 1 DAY AS DATE) AS earlier
  FROM orders""")
def date_arith(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder).select(
        "o_orderkey", F.date_add("day", 30).alias("later"), F.date_sub("day", 1).alias("earlier")
    )


@query("SELECT event_id, CAST(date_trunc('day', ts) AS DATE) AS day FROM events")
def date_trunc_day(spark: SparkSession, folder: str) -> DataFrame:
    return scan_table(spark, folder, "events").select("event_id", D.day_of(F.col("ts")).alias("day"))


@query("""
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso,
    strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') || ' / ' ||
    strftime(date_trunc('week', o_orderdate) + INTERVAL 6 DAY, '%Y-%m-%d') AS week_range
  FROM orders""")
def date_format(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("day")
    return _orders(spark, folder).select(
        "o_orderkey", D.iso_date(day).alias("iso"), D.week_range(day).alias("week_range")
    )


@query("""
  SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '/' ||
    CAST(month(o_orderdate) AS VARCHAR) AS year_month
  FROM orders""")
def year_month_label(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder).select(
        "o_orderkey", D.year_month_label(F.year("day"), F.month("day")).alias("year_month")
    )


@query(expect("SELECT variant_id, substr(variant_code, 1, 4) AS group_code FROM variants"))
def left_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return S.variants(spark, folder).select(
        "variant_id", X.left_prefix(F.col("variant_code"), 4).alias("group_code")
    )


@query("""
  SELECT event_id, CASE WHEN event_type = 'click' THEN value ELSE 0.0 END AS spend,
    CASE WHEN event_type = 'error' THEN 'ninguno' ELSE event_type END AS kind
  FROM events""")
def null_default(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return scan_table(spark, folder, "events").select(
        "event_id",
        X.null_default(F.when(kind == "click", F.col("value")), F.lit(0.0)).alias("spend"),
        X.null_default(F.when(kind != "error", kind), F.lit("ninguno")).alias("kind"),
    )


@query("""
  SELECT l_orderkey, l_partkey, CASE WHEN l_tax = 0 THEN NULL ELSE l_extendedprice / l_tax END
    AS ratio
  FROM lineitem""")
def safe_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return scan_table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        N.safe_ratio(F.col("l_extendedprice"), F.col("l_tax")).alias("ratio"),
    )


@query("""
  SELECT o_orderkey,
    CAST(epoch(timezone('America/Santiago', CAST(o_orderdate AS TIMESTAMP) + INTERVAL 12 HOUR))
      AS BIGINT) AS noon_utc
  FROM orders""")
def tz_convert(spark: SparkSession, folder: str) -> DataFrame:
    noon = F.col("o_orderdate") + F.expr("interval 12 hours")
    return scan_table(spark, folder, "orders").select(
        "o_orderkey", D.local_to_epoch(noon).alias("noon_utc")
    )


@query(expect("SELECT variant_id, variant_code LIKE '%BLA%' AS hit FROM variants"))
def like_contains(spark: SparkSession, folder: str) -> DataFrame:
    return S.variants(spark, folder).select(
        "variant_id", X.like_contains(F.col("variant_code"), "BLA").alias("hit")
    )
