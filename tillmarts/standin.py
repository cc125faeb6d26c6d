"""Source-shaped frames made from the given test tables.

The tables the models read in production (documents with JSON inside, stock snapshots, ad
insights, shop orders) are derived here from ``orders``, ``lineitem``, ``part``, ``customer`` and
``events``. Nothing is sampled and no unbounded group is gathered: arrays are packed from a bounded
run of input rows or from a fixed list of columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmarts.functions import dates as D
from tillmarts.functions import labels as B
from tillmarts.functions import lookups as L
from tillmarts.functions.numbers import money_sum
from tillmarts.operators.joins import build_side
from tillmarts.plans import ads as ads_plan
from tillmarts.plans import sales, stock as stock_plan
from tillmarts.plans.calendar import calendar_of
from tillmarts.storage import materialize, read_parquet, staged

# First word of a part name -> colour code. "large" matches two rules, "new" none.
WORD_CODES = {
    "small": "AREN",
    "hot": "ROJO",
    "red": "BLAM",
    "blue": "AZUL",
    "large": "BLANBLAM",
    "old": "CEDE",
    "cold": "RGME",
    "new": "ZZZZ",
}
# Part size modulo 8 -> size label and its suffix in a code. The last one is outside the chart.
SIZES = ["S", "M", "L", "XL", "XXL", "3XL", "4XL", "U"]
SIZE_SUFFIXES = ["00S", "00M", "00L", "0XL", "XXL", "3XL", "4XL", "00U"]

# Document type of orders in status F, by priority; P is the credit note, O the receipt.
PRIORITY_TYPES = {
    "1-URGENT": 6,
    "2-HIGH": 18,
    "3-MEDIUM": 19,
    "4-NOT SPECIFIED": 22,
    "5-LOW": 30,
}
# Type 30 is missing on purpose, 22 is not a sale.
DOCUMENT_TYPES = {
    1: "BOLETA ELECTRÓNICA T",
    6: "FACTURA ELECTRÓNICA T",
    9: "NOTA DE CRÉDITO ELECTRÓNICA T",
    18: "FACTURA DE COMPRA ELECTRÓNICA",
    19: "NOTA DE DÉBITO ELECTRÓNICA T",
    22: "GUÍA DE DESPACHO ELECTRÓNICA T",
}

# Rows of one scan run that may share a page of a document's details: bounds the packed array.
PAGE_RUN = 65_536

# Events fall in 2024 and orders in 1995-2001: days to move the ad spend back for the sales mart.
SPEND_SHIFT_DAYS = 9_861
# What stock movements and stock against sales read of the lines, beside what the mart itself needs.
SOLD_COLUMNS = ["office_id", "detail_quantity"]
DAILY_COLUMNS = [
    "detail_quantity", "detail_net_amount", "office", "variant_description", "orden_tallas"
]
LEDGER_DAYS = ("1997-01-01", "1997-12-31")
ADS_AS_OF = "2024-01-30"

# Ad action -> (event type, parity of the event's "k" property). Sign-ups are no action.
ACTION_SOURCES = {
    "view_content": ("view", 0),
    "onsite_web_view_content": ("view", 1),
    "page_engagement": ("click", 0),
    "post_engagement": ("click", 1),
    "purchase": ("purchase", 0),
    "omni_purchase": ("purchase", 1),
    "video_view": ("error", 0),
    "add_payment_info": ("error", 1),
}


ATTACHMENTS = "array<struct<type:string,target:struct<id:string>>>"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; these never change, so their schemas are looked up once."""
    return read_parquet(spark, f"{folder}/{name}.parquet")


def _pick(index: Column, values: list[str]) -> Column:
    return B.case_lookup(index, dict(enumerate(values)))


def _variant_code(stem: Column, variant_id: Column) -> Column:
    return F.concat(stem, F.lit("-"), variant_id.cast("string"))


def variants(spark: SparkSession, folder: str) -> DataFrame:
    part = _table(spark, folder, "part")
    group = (F.substring("p_brand", 7, 9).cast("bigint") + 2000).cast("string")
    word = F.substring_index("p_name", " ", 1)
    size = F.col("p_size") % 8
    stem = F.concat(group, B.case_lookup(word, WORD_CODES), _pick(size, SIZE_SUFFIXES))
    return part.select(
        F.col("p_partkey").alias("variant_id"),
        stem.alias("variant_stem"),
        _variant_code(stem, F.col("p_partkey")).alias("variant_code"),
        _pick(size, SIZES).alias("variant_description"),
        F.concat(F.lit("B"), F.col("p_partkey").cast("string")).alias("barcode"),
        # Branch that keeps the variant.
        (F.col("p_size") % 5 + 1).cast("bigint").alias("office_id"),
        "p_name",
        "p_type",
        "p_brand",
        "p_retailprice",
    )


def _joined(spark: SparkSession, folder: str, variants: DataFrame) -> DataFrame:
    """Variants as the right side of a join, one for each part."""
    return build_side(variants, _table(spark, folder, "part").count())


def product_master(spark: SparkSession, folder: str) -> DataFrame:
    """Promotional parts are not in the master."""
    v = variants(spark, folder).filter(F.col("p_type") != "PROMO")
    return v.select(
        F.col("variant_code").alias("sku"),
        F.col("p_type").alias("tipo_producto"),
        F.col("p_name").alias("nombre_producto"),
        F.col("variant_description").alias("variante"),
        (F.col("p_retailprice") * F.lit(0.6)).alias("costo_neto"),
        F.col("p_retailprice").alias("precio_unitario"),
    )


def product_groups_raw(spark: SparkSession, folder: str) -> DataFrame:
    """One row per brand but the last, under machine-made column names."""
    brands = _table(spark, folder, "part").select("p_brand").distinct()
    number = F.substring("p_brand", 7, 9).cast("bigint")
    return brands.filter(F.col("p_brand") != "Brand#25").select(
        (number + 2000).alias("int64_field_0"),
        F.concat(F.lit("GRUPO "), F.col("p_brand")).alias("string_field_1"),
        F.concat(F.lit("CATEGORIA "), (number % 7).cast("string")).alias("string_field_2"),
    )


def product_groups(spark: SparkSession, folder: str) -> DataFrame:
    return sales.product_groups(product_groups_raw(spark, folder))


def document_types(spark: SparkSession) -> DataFrame:
    """A table of known small size, so that the planner can broadcast it."""
    rows = F.array(
        *[
            F.struct(
                F.lit(k).cast("bigint").alias("id"),
                F.lit(name).alias("name"),
                F.lit(str(k)).alias("codeSii"),
            )
            for k, name in DOCUMENT_TYPES.items()
        ]
    )
    return spark.range(1).select(F.inline(rows))


def order_type_id() -> Column:
    return (
        F.when(F.col("o_orderstatus") == "P", 9)
        .when(F.col("o_orderstatus") == "O", 1)
        .otherwise(B.case_lookup(F.col("o_orderpriority"), PRIORITY_TYPES))
        .cast("bigint")
    )


def _id_object(value: Column) -> Column:
    return F.to_json(F.struct(value.cast("bigint").alias("id")))


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders").select(*HEADER_COLUMNS)


def document_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without their lines."""
    return _headers(_table(spark, folder, "orders"))


def _headers(orders: DataFrame, *more: str) -> DataFrame:
    """Header columns of orders, beside ``more`` columns they have."""
    emitted = D.timestamp_to_epoch(F.col("o_orderdate"))
    key = F.col("o_orderkey")

    def reference(offset: int, reason: str) -> Column:
        return F.struct((key * 10 + offset).alias("id"), F.lit(reason).alias("reason"))

    priority = F.col("o_orderpriority")
    references = (
        F.when(
            priority == "1-URGENT",
            F.to_json(F.array(reference(1, "devolucion"), reference(2, "cambio"))),
        )
        .when(priority == "4-NOT SPECIFIED", F.to_json(F.array(reference(1, "devolucion"))))
        .when(priority == "3-MEDIUM", F.to_json(F.struct(F.lit("/references").alias("href"))))
        .when(priority == "5-LOW", F.lit("[]"))
    )
    return orders.select(
        key.alias("id"),
        emitted.alias("emissionDate"),
        (emitted + 30 * D.DAY_SECONDS).alias("expirationDate"),
        emitted.alias("generationDate"),
        key.alias("number"),
        F.col("o_totalprice").alias("totalAmount"),
        (F.col("o_totalprice") * F.lit(0.81)).alias("netAmount"),
        (F.col("o_totalprice") * F.lit(0.19)).alias("taxAmount"),
        F.lit(0).cast("bigint").alias("state"),
        _id_object(order_type_id()).alias("document_type"),
        _id_object(F.col("o_custkey")).alias("client"),
        _id_object(F.col("o_custkey") % 6 + 1).alias("office"),
        _id_object(F.col("o_custkey") % 10).alias("user"),
        references.alias("references"),
        F.lit("[]").alias("document_taxes"),
        F.lit("[]").alias("sellers"),
        F.lit("[]").alias("payments"),
        "o_orderstatus",
        *more,
    )


LINE_COLUMNS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]
VARIANT_COLUMNS = ["variant_id", "variant_stem", "variant_description"]
HEADER_COLUMNS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
]


def detail_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Line items of each document in pages, with the columns that ``_detail`` makes a line of, beside the
    columns of the order.

    Lines are shuffled to their orders once, as the side that a skewed join can split (the pages then cost
    another shuffle, so it is split where ``forceOptimizeSkewedJoin`` is set). Where that is a merge, lines of a document are neighbours, so nearly every document is one page and the pages need
    no shuffle of their own. A page holds the lines of a document that lie in one run of ``PAGE_RUN``
    joined rows, so even a document with a third of all lines is packed into bounded arrays.
    """
    v = _joined(spark, folder, variants(spark, folder).select(*VARIANT_COLUMNS))
    items = _table(spark, folder, "lineitem").join(v, F.col("l_partkey") == F.col("variant_id"))
    # An order that is there twice is two documents.
    orders = _orders(spark, folder).withColumn("_order", F.monotonically_increasing_id())
    lines = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.withColumn("page", F.floor(F.monotonically_increasing_id() / PAGE_RUN))
    header = [c for c in HEADER_COLUMNS if c != "o_orderkey"]
    pages = lines.groupBy("o_orderkey", "_order", "page").agg(
        F.first(F.struct(*header)).alias("_header"),
        F.collect_list(F.struct(*LINE_COLUMNS, *VARIANT_COLUMNS)).alias("items"),
    )
    return pages.select("o_orderkey", "_header.*", "items")


def _detail(document: Column, item: Column) -> Column:
    """The line of a document as it is landed."""
    price, tax, off, quantity = (item[f"l_{c}"] for c in ("extendedprice", "tax", "discount", "quantity"))
    return F.struct(
        (document * 10 + item["l_linenumber"]).alias("id"),
        item["l_linenumber"].cast("bigint").alias("lineNumber"),
        quantity.alias("quantity"),
        (price / quantity).alias("netUnitValue"),
        (price * (1 + tax) / quantity).alias("totalUnitValue"),
        price.alias("netAmount"),
        (price * tax).alias("taxAmount"),
        (price * (1 + tax)).alias("totalAmount"),
        (price * off).alias("netDiscount"),
        (price * off * (1 + tax)).alias("totalDiscount"),
        item["l_returnflag"].alias("note"),
        F.lit(0).cast("bigint").alias("relatedDetailId"),
        F.struct(
            item["variant_id"].alias("id"),
            item["variant_description"].alias("description"),
            _variant_code(item["variant_stem"], item["variant_id"]).alias("code"),
        ).alias("variant"),
    )


def build_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with JSON details: an object for most, a bare array for receipts, ``{}`` without lines.

    Lines and orders are shuffled with the columns of their tables; what is computed from them,
    JSON text above all, is several times as wide and comes last.
    """
    # Documents without lines are added from an anti join.
    ids = _table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    without = _orders(spark, folder).join(ids.distinct(), "o_orderkey", "left_anti")
    pages = detail_pages(spark, folder)
    joined = _headers(pages.unionByName(without, allowMissingColumns=True), "items")
    joined = joined.withColumn("items", F.transform("items", lambda x: _detail(F.col("id"), x)))
    details = (
        F.when(F.col("items").isNull(), F.lit("{}"))
        .when(F.col("o_orderstatus") == "O", F.to_json("items"))
        .otherwise(F.to_json(F.struct(F.lit("/details").alias("href"), F.col("items"))))
    )
    return joined.withColumn("details", details).drop("items", "o_orderstatus")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents kept as a table, for what reads them more than once."""
    return staged(spark, folder, "documents", lambda: build_documents(spark, folder))


def build_document_lines(
    spark: SparkSession, folder: str, columns: Sequence[str] = sales.LINE_COLUMNS
) -> DataFrame:
    details = [field for c, field in sales.LINE_DETAILS.items() if c in columns]
    lines = sales.raw_document(build_documents(spark, folder), details=details)
    return sales.stg_document_lines(lines, document_types(spark), columns)


def document_lines(
    spark: SparkSession, folder: str, columns: Sequence[str] = sales.LINE_COLUMNS
) -> DataFrame:
    """These columns of the document lines, parsed once and kept as a table, for what reads them more than once."""
    return staged(
        spark, " ".join([folder, *columns]), "document-lines",
        lambda: build_document_lines(spark, folder, columns),
    )


def sales_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar over the years 1996 to 2000 of the orders: earlier and later days have none."""
    bounds = _table(spark, folder, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last")
    )
    first = F.trunc(F.add_months("first", 12), "year")
    last = F.date_sub(F.trunc("last", "year"), 1)
    days = bounds.select(F.explode(F.sequence(first, last)).alias("fecha"))
    return calendar_of(days)


def _stocked_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Variants with themselves and their branch as JSON, which is made once per variant and not per lot."""
    office = F.col("office_id")
    variant = F.struct(
        F.col("variant_id").alias("id"),
        F.col("variant_description").alias("description"),
        F.col("barcode").alias("barCode"),
        F.col("variant_code").alias("code"),
        F.struct(F.col("p_brand").alias("id")).alias("product"),
    )
    branch = F.struct(
        office.alias("id"),
        B.office_name(office).alias("name"),
        F.concat(F.lit("AV "), office.cast("string")).alias("address"),
        F.lit("SANTIAGO").alias("city"),
        F.lit("CHILE").alias("country"),
    )
    return variants(spark, folder).select(
        "variant_id", F.to_json(variant).alias("variant"), F.to_json(branch).alias("office")
    )


def stock_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Stock lots by part and supplier, variant and branch as JSON."""
    items = _table(spark, folder, "lineitem")
    lots = items.groupBy("l_partkey", "l_suppkey").agg(
        money_sum(F.col("l_quantity")).alias("quantity"),
        money_sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0)).alias(
            "quantityReserved"
        ),
    )
    v = _joined(spark, folder, _stocked_variants(spark, folder))
    joined = lots.join(v, F.col("l_partkey") == F.col("variant_id"))
    return stock_plan.stock_rows(
        joined.select(
            (F.col("l_partkey") * 1_000_000 + F.col("l_suppkey")).alias("id"),
            "quantity",
            "quantityReserved",
            (F.col("quantity") - F.col("quantityReserved")).alias("quantityAvailable"),
            "variant",
            "office",
        )
    )


def build_stock(spark: SparkSession, folder: str) -> DataFrame:
    return stock_plan.stg_stock(stock_raw(spark, folder))


def stock(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Stock rows with JSON unpacked, or these columns of them, kept as a table, for what reads them more than once."""
    return staged(
        spark, " ".join([folder, *columns]), "stock",
        lambda: build_stock(spark, folder).select(*columns or ["*"]),
    )


def _movement_headers(spark: SparkSession, folder: str, flag: str) -> DataFrame:
    """Each line with the flag as a movement of two detail lines: all units but one, and one."""
    items = _table(spark, folder, "lineitem").filter(F.col("l_returnflag") == flag)
    v = _joined(spark, folder, variants(spark, folder).select("variant_id", "office_id"))
    joined = items.join(v, F.col("l_partkey") == F.col("variant_id"))
    cost = F.col("l_extendedprice") / F.col("l_quantity")

    def detail(quantity: Column) -> Column:
        return F.struct(
            F.struct(F.col("variant_id").alias("id")).alias("variant"),
            quantity.alias("quantity"),
            cost.alias("cost"),
        )

    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        D.timestamp_to_epoch(F.col("l_shipdate")).alias("moved"),
        F.when(F.col("l_linestatus") == "O", F.lit("abierto")).alias("note"),
        F.struct(
            F.col("office_id").alias("id"), B.office_name(F.col("office_id")).alias("name")
        ).alias("office"),
        F.struct(F.array(detail(F.col("l_quantity") - 1), detail(F.lit(1.0))).alias("items")).alias(
            "details"
        ),
    )


def consumption_headers(spark: SparkSession, folder: str) -> DataFrame:
    return _movement_headers(spark, folder, "A").withColumnRenamed("moved", "consumptionDate")


def reception_headers(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _movement_headers(spark, folder, "N")
        .withColumnRenamed("moved", "admissionDate")
        .withColumn("document", F.lit("Guía"))
        .withColumn("documentNumber", F.col("id").cast("string"))
    )


def consumptions(spark: SparkSession, folder: str) -> DataFrame:
    return stock_plan.consumption_lines(consumption_headers(spark, folder))


def receptions(spark: SparkSession, folder: str) -> DataFrame:
    return stock_plan.reception_lines(reception_headers(spark, folder))


def insights_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Ad insights per user and day, actions and action values as arrays.

    Each array is made of a fixed list of counts, so the events are only aggregated, never listed.
    """
    events = _table(spark, folder, "events")
    parity = F.get_json_object("props", "$.k").cast("bigint") % 2
    kind, value = F.col("event_type"), F.col("value")
    source = {n: (kind == e) & (parity == p) for n, (e, p) in ACTION_SOURCES.items()}
    counts = {n: F.count(F.when(hit, 1)).alias(f"n_{n}") for n, hit in source.items()}
    paid = {
        n: F.sum(F.when(source[n], value.cast("decimal(18,2)"))).alias(f"v_{n}")
        for n in ("purchase", "omni_purchase")
    }
    days = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        *counts.values(),
        *paid.values(),
        F.count(F.when(kind == "view", 1)).alias("views"),
        F.count(F.when(kind == "click", 1)).alias("clicks"),
        F.coalesce(
            F.sum(F.when(kind == "click", value.cast("decimal(18,2)"))),
            F.lit(0).cast("decimal(18,2)"),
        ).alias("spent"),
    )

    def item(name: str, text: Column) -> Column:
        return F.struct(F.lit(name).alias("action_type"), text.alias("value"))

    def present(items: list[Column]) -> Column:
        return F.filter(F.array(*items), lambda x: x.isNotNull())

    actions = [
        F.when(F.col(f"n_{n}") > 0, item(n, F.col(f"n_{n}").cast("string"))) for n in ACTION_SOURCES
    ]
    # An action reported without a number.
    actions.append(F.when(F.col("n_video_view") > 0, item("landing_page_view", F.lit(""))))
    amounts = [
        F.when(F.col(f"v_{n}").isNotNull(), item(n, F.col(f"v_{n}").cast("string")))
        for n in ("purchase", "omni_purchase")
    ]
    ad = F.col("user_id").cast("string")
    adset, campaign = (F.col("user_id") % 20).cast("string"), (F.col("user_id") % 5).cast("string")
    return days.select(
        ad.alias("ad_id"),
        F.concat(F.lit("ad "), ad).alias("ad_name"),
        adset.alias("adset_id"),
        F.concat(F.lit("adset "), adset).alias("adset_name"),
        campaign.alias("campaign_id"),
        F.concat(F.lit("campaign "), campaign).alias("campaign_name"),
        F.col("views").cast("string").alias("impressions"),
        F.col("clicks").cast("string").alias("clicks"),
        F.concat(F.col("clicks").cast("string"), F.lit(".0")).alias("ctr"),
        F.col("spent").cast("string").alias("spend"),
        F.date_format("day", "yyyy-MM-dd").alias("date_start"),
        F.date_format("day", "yyyy-MM-dd").alias("date_stop"),
        present(actions).alias("actions"),
        present(amounts).alias("action_values"),
    )


def _users(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "events").groupBy("user_id").agg(
        F.max("value").alias("top"), F.count(F.when(F.col("event_type") == "view", 1)).alias("views")
    )


def ad_statuses(spark: SparkSession, folder: str) -> DataFrame:
    """Ads whose largest event value stays below 150 are not listed; some have no status."""
    top = F.col("top")
    return _users(spark, folder).filter(top >= 150).select(
        F.col("user_id").cast("string").alias("id"),
        F.when(top >= 250, "ACTIVE").when(top >= 200, "PAUSED").alias("status"),
        F.when(top >= 200, "DELIVERING").otherwise("ARCHIVED").alias("effective_status"),
    )


def _budgets(spark: SparkSession, folder: str, size: int, hidden: str) -> DataFrame:
    """Budgets of ad sets or campaigns: none, 1 or a real amount; one member is not listed."""
    number = F.col("user_id") % size
    groups = _table(spark, folder, "events").select(number.alias("n")).distinct()
    n = F.col("n")
    daily = F.when(n % 4 == 1, F.lit("1")).when(n % 4 > 1, (n * 100).cast("string"))
    return groups.filter(n.cast("string") != hidden).select(
        n.cast("string").alias("id"),
        F.concat(F.lit("name "), n.cast("string")).alias("name"),
        daily.alias("daily_budget"),
        F.when(n % 4 == 0, (n + 7).cast("string")).alias("lifetime_budget"),
        (n * 10).cast("string").alias("budget_remaining"),
    )


def adset_budgets(spark: SparkSession, folder: str) -> DataFrame:
    return _budgets(spark, folder, 20, "19")


def campaign_budgets(spark: SparkSession, folder: str) -> DataFrame:
    return _budgets(spark, folder, 5, "4")


def insights(spark: SparkSession, folder: str) -> DataFrame:
    """Stored ad insights, kept as a table."""

    def build() -> DataFrame:
        return ads_plan.ad_insight_rows(
            insights_raw(spark, folder),
            ad_statuses(spark, folder),
            adset_budgets(spark, folder),
            campaign_budgets(spark, folder),
        )

    return staged(spark, folder, "insights", build)


def ad_links(spark: SparkSession, folder: str) -> DataFrame:
    """Ads with their creative; forty creatives are shared, small ads have none."""
    creative = F.concat(F.lit("c"), (F.col("user_id") % 40).cast("string"))
    return _users(spark, folder).select(
        F.col("user_id").cast("string").alias("id"),
        F.struct(F.when(F.col("top") >= 150, creative).alias("id")).alias("creative"),
    )


def creative_details(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("user_id") % 40
    groups = (
        _table(spark, folder, "events")
        .groupBy(number.alias("n"))
        .agg(F.count(F.when(F.col("event_type") == "view", 1)).alias("views"))
    )
    text = F.col("n").cast("string")

    def named(prefix: str) -> Column:
        return F.concat(F.lit(prefix), text)

    return groups.select(
        named("c").alias("id"),
        named("creative ").alias("name"),
        named("body ").alias("body"),
        F.when(F.col("views") % 2 == 0, named("title ")).alias("title"),
        named("/image/").alias("image_url"),
        named("/thumb/").alias("thumbnail_url"),
        F.when(F.col("views") % 3 == 0, named("v")).alias("video_id"),
        named("p").alias("object_story_id"),
        F.lit("ACTIVE").alias("status"),
        F.lit("SHOP_NOW").alias("call_to_action_type"),
        F.lit("SHARE").alias("object_type"),
        F.lit(None).cast("string").alias("template_url"),
        F.when(F.col("views") % 2 == 0, F.struct(named("page ").alias("page_id"))).alias(
            "object_story_spec"
        ),
    )


def creatives(spark: SparkSession, folder: str) -> DataFrame:
    return ads_plan.creative_dim(ad_links(spark, folder), creative_details(spark, folder))


def post_creatives(spark: SparkSession, folder: str) -> DataFrame:
    """One creative per user, naming its post directly, as the effective one, or not at all."""
    user = F.col("user_id").cast("string")
    post = F.concat(F.lit("p"), user)
    top = F.col("top")
    return _users(spark, folder).select(
        F.concat(F.lit("c"), user).alias("id"),
        F.concat(F.lit("own body "), user).alias("body"),
        F.concat(F.lit("own video "), user).alias("video_id"),
        F.when(top >= 250, post).alias("object_story_id"),
        F.when(top >= 200, post).alias("effective_object_story_id"),
    )


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """Posts of users with an even number of views, with none, one or two videos attached."""
    user = F.col("user_id").cast("string")
    views = F.col("views")

    def attachment(kind: str, prefix: str) -> Column:
        return F.struct(
            F.lit(kind).alias("type"),
            F.struct(F.concat(F.lit(prefix), user).alias("id")).alias("target"),
        )

    photo = attachment("photo", "f")
    first, second = attachment("video_autoplay", "v1-"), attachment("video_autoplay", "v2-")
    data = (
        F.when(views % 8 == 0, F.array(first, photo, second))
        .when(views % 8 == 2, F.array(photo, first))
        .when(views % 8 == 4, F.array(photo))
        .otherwise(F.array().cast(ATTACHMENTS))
    )
    return _users(spark, folder).filter(views % 2 == 0).select(
        F.concat(F.lit("p"), user).alias("id"),
        F.when(views % 4 == 0, F.concat(F.lit("message "), user)).alias("message"),
        F.concat(F.lit("/post/"), user).alias("permalink_url"),
        F.lit("2024-01-31").alias("created_time"),
        F.struct(data.alias("data")).alias("attachments"),
    )


def platform_insights(spark: SparkSession, folder: str) -> DataFrame:
    """Insights by ad, day, platform (event type) and device (parity of ``k``)."""
    events = _table(spark, folder, "events")
    parity = F.get_json_object("props", "$.k").cast("bigint") % 2
    device = F.when(parity == 0, "mobile").otherwise("desktop")
    groups = events.groupBy(
        "user_id",
        F.to_date("ts").alias("day"),
        F.col("event_type").alias("publisher_platform"),
        device.alias("impression_device"),
    ).agg(
        money_sum(F.col("value")).alias("spend"),
        F.count(F.lit(1)).alias("impressions"),
        F.count(F.when(F.col("value") > 50, 1)).alias("clicks"),
    )
    ad = F.col("user_id").cast("string")
    adset, campaign = (F.col("user_id") % 20).cast("string"), (F.col("user_id") % 5).cast("string")
    n = F.col("impressions")
    return groups.select(
        ad.alias("ad_id"),
        F.concat(F.lit("ad "), ad).alias("ad_name"),
        adset.alias("adset_id"),
        F.concat(F.lit("adset "), adset).alias("adset_name"),
        campaign.alias("campaign_id"),
        F.concat(F.lit("campaign "), campaign).alias("campaign_name"),
        F.col("day").alias("date_start"),
        F.col("day").alias("date_stop"),
        "spend",
        "impressions",
        "clicks",
        n.alias("reach"),
        (F.col("spend") * 1000 / n).alias("cpm"),
        (F.col("clicks").cast("double") / n).alias("ctr"),
        F.try_divide(F.col("spend"), F.col("clicks").cast("double")).alias("cpc"),
        (F.col("spend") / n).alias("cpp"),
        "publisher_platform",
        F.lit("feed").alias("platform_position"),
        "impression_device",
        F.lit("act").alias("account_id"),
        F.lit("account").alias("account_name"),
        F.lit(1.0).alias("frequency"),
    )


def ads_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar from the first event to the day before the last."""
    bounds = _table(spark, folder, "events").agg(
        F.min(F.to_date("ts")).alias("first"), F.max(F.to_date("ts")).alias("last")
    )
    days = bounds.select(F.explode(F.sequence(F.col("first"), F.date_sub("last", 1))).alias("fecha"))
    return calendar_of(days)


def build_ads_budget(spark: SparkSession, folder: str) -> DataFrame:
    daily = ads_plan.ads_daily(insights(spark, folder), ADS_AS_OF)
    return ads_plan.ads_budget(daily, creatives(spark, folder))


def ads_budget(spark: SparkSession, folder: str) -> DataFrame:
    """The ads mart, kept as a table."""
    return staged(spark, folder, "ads-budget", lambda: build_ads_budget(spark, folder))


def shifted_ads(spark: SparkSession, folder: str) -> DataFrame:
    """The ads mart with its days moved into the period of the orders."""
    return build_ads_budget(spark, folder).withColumn(
        "date_start", F.date_sub("date_start", SPEND_SHIFT_DAYS)
    )


def build_core(
    spark: SparkSession,
    folder: str,
    held: DataFrame | None = None,
    columns: Sequence[str] = sales.LINE_COLUMNS,
) -> DataFrame:
    """The line-level sales mart; ``held`` is the stock, if the caller reads it too, ``columns`` what it reads of
    the lines: others are neither kept nor shuffled."""
    kept = [c for c in sales.LINE_COLUMNS if c in {*sales.LINE_KEYS, *columns}]
    return sales.sales_core(
        document_lines(spark, folder, kept),
        shifted_ads(spark, folder),
        product_master(spark, folder),
        product_groups(spark, folder),
        build_stock(spark, folder) if held is None else held,
        sales_calendar(spark, folder),
        stage=materialize,
        columns=kept,
    )


def core(spark: SparkSession, folder: str) -> DataFrame:
    """The line-level sales mart, kept as a table."""
    return staged(spark, folder, "sales-core", lambda: build_core(spark, folder))


def shop_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Web-shop orders with nested customer, address and lines."""
    orders = _table(spark, folder, "orders")
    customers = _table(spark, folder, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return joined.select(
        F.col("o_orderkey").alias("id"),
        day.alias("created_at"),
        F.when(F.col("o_orderstatus") == "F", day).alias("closed_at"),
        F.lit("CLP").alias("currency"),
        price.alias("current_total_price"),
        F.array(F.struct(F.col("o_orderpriority").alias("code"))).alias("discount_codes"),
        F.col("o_orderstatus").alias("financial_status"),
        F.concat(F.lit("#"), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_orderkey").alias("number"),
        (F.col("o_orderkey") + 1000).alias("order_number"),
        (F.col("o_orderstatus") == "F").alias("taxes_included"),
        price.alias("total_price"),
        F.col("c_custkey").alias("user_id"),
        F.struct(F.col("c_nationkey").alias("nation")).alias("billing_address"),
        F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).alias("customer"),
        F.array(
            F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"))
        ).alias("line_items"),
    )
