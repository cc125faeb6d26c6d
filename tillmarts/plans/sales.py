"""Sales documents to line-level and daily sales."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmarts.functions import dates as D
from tillmarts.functions import labels as B
from tillmarts.functions import lookups as L
from tillmarts.functions.jsons import json_items, json_list, shaped
from tillmarts.functions.numbers import money_sum, safe_cast, safe_ratio, sign_flip
from tillmarts.operators.filters import filter_in, outside
from tillmarts.operators.joins import (
    by_rows,
    left_join,
    left_join_cast_key,
    left_join_on,
    left_join_prefix,
)
from tillmarts.schemas import (
    DETAIL_ITEM,
    DOCUMENT_COLUMNS,
    DOCUMENT_NESTED,
    REFERENCE_ITEM,
    as_text,
)

Stage = Callable[[DataFrame, str], DataFrame]

HEADER = {
    "id": "doc_id",
    "number": "document_number",
    "emissionDate": "emissionDate",
    "expirationDate": "expirationDate",
    "generationDate": "generationDate",
    "totalAmount": "totalAmount",
    "netAmount": "netAmount",
    "taxAmount": "taxAmount",
}
OBJECT_IDS = {
    "document_type": "document_type_id",
    "client": "client_id",
    "office": "office_id",
    "user": "user_id",
}


def as_is(df: DataFrame, label: str) -> DataFrame:
    return df


def document_rows(items: DataFrame) -> DataFrame:
    """Documents as they come from landed pages, as 18 stored columns with nested parts as JSON text."""
    return shaped(items, DOCUMENT_COLUMNS, DOCUMENT_NESTED)


def raw_document(
    documents: DataFrame, unique_ids: bool = True, details: Sequence[str] | None = None
) -> DataFrame:
    """One row per document line, repeated for each reference of the document.

    With unique documents the references sit in the row of the details, so the LEFT JOIN on the
    document id is a second explode and nothing is shuffled. ``unique_ids=False`` keeps the join,
    whose result differs where a document was loaded more than once (every copy of a line meets
    every copy of a reference). ``details`` names the fields of a line to be read beside its variant;
    others are skipped by the parser and have no column.
    """
    items = DETAIL_ITEM
    if details is not None:
        items = T.StructType([f for f in DETAIL_ITEM.fields if f.name in {*details, "variant"}])
    header = [F.col(c).alias(n) for c, n in HEADER.items()]
    ids = [
        safe_cast(F.get_json_object(c, "$.id"), "bigint").alias(n) for c, n in OBJECT_IDS.items()
    ]
    references = json_list(F.col("references"), as_text(REFERENCE_ITEM))
    lines = documents.select(
        *header,
        *ids,
        *([references.alias("_references")] if unique_ids else []),
        F.explode(json_items(F.col("details"), as_text(items))).alias("_line"),
    )
    if unique_ids:
        joined = lines.select(
            *[c for c in lines.columns if c != "_references"],
            F.explode_outer("_references").alias("_reference"),
        )
    else:
        exploded = documents.select(
            F.col("id").alias("doc_id"), F.explode(references).alias("_reference")
        )
        joined = left_join(lines, exploded, ["doc_id"])

    values = [
        safe_cast(F.col("_line")[f.name], f.dataType.simpleString()).alias(f"detail_{f.name}")
        if f.dataType.simpleString() != "string"
        else F.col("_line")[f.name].alias(f"detail_{f.name}")
        for f in items.fields
        if f.name != "variant"
    ]
    variant = F.col("_line")["variant"]
    return joined.select(
        *HEADER.values(),
        *values,
        safe_cast(variant["id"], "bigint").alias("variant_id"),
        variant["description"].alias("variant_description"),
        variant["code"].alias("variant_code"),
        *OBJECT_IDS.values(),
        safe_cast(F.col("_reference")["id"], "bigint").alias("reference_id"),
        F.col("_reference")["reason"].alias("reference_reason"),
    )


#: Measures of a line and the fields they are read from.
LINE_DETAILS = {
    "detail_quantity": "quantity",
    "detail_unit_value": "netUnitValue",
    "detail_total_unit_value": "totalUnitValue",
    "detail_net_amount": "netAmount",
    "detail_tax_amount": "taxAmount",
    "detail_total_amount": "totalAmount",
    "detail_net_discount": "netDiscount",
    "detail_total_discount": "totalDiscount",
}
DOCUMENT_MEASURES = ["total_amount", "net_amount", "tax_amount", *LINE_DETAILS]
LINE_DATES = {
    "emissionDate": "fecha_documento",
    "expirationDate": "expiration_date",
    "generationDate": "generation_date",
}
#: The columns of document lines that the mart holds, and those that it cannot be made without.
LINE_COLUMNS = [
    "doc_id",
    "document_number",
    *LINE_DATES,
    "document_type_id",
    "document_name",
    "office",
    "office_id",
    *DOCUMENT_MEASURES,
    "variant_description",
    "orden_tallas",
    "variant_code",
    "variant_id",
]
LINE_KEYS = [
    "document_number", "emissionDate", "document_type_id", "document_name", "variant_code", "variant_id"
]


def stg_document_lines(
    lines: DataFrame, document_types: DataFrame, columns: Sequence[str] = LINE_COLUMNS
) -> DataFrame:
    """Document lines with type name, branch name and size position; only these ``columns``."""
    types = document_types.select(
        F.col("id").alias("document_type_id"), F.col("name").alias("document_name")
    )
    named = {
        **{c: F.col(c) for c in ("doc_id", "document_number", *LINE_DATES, "document_type_id", "document_name")},
        "total_amount": F.col("totalAmount"),
        "net_amount": F.col("netAmount"),
        "tax_amount": F.col("taxAmount"),
        **{c: F.col(f"detail_{f}") for c, f in LINE_DETAILS.items() if c in columns},
        "office_id": F.col("office_id"),
        "office": B.office_name(F.col("office_id")),
        "variant_description": F.col("variant_description"),
        "orden_tallas": B.size_order(F.col("variant_description")),
        "variant_code": F.col("variant_code"),
        "variant_id": F.col("variant_id"),
    }
    joined = left_join(lines, types, ["document_type_id"])
    return joined.select(*[v.alias(c) for c, v in named.items() if c in columns])


def signed_lines(lines: DataFrame, columns: Sequence[str] = LINE_COLUMNS) -> DataFrame:
    """Lines with dates from their epochs, and the measures of credit notes negated."""
    credit = F.col("document_type_id") == L.CREDIT_NOTE_ID

    def signed(name: str) -> Column:
        if name in LINE_DATES:
            return D.epoch_to_date(F.col(name)).alias(LINE_DATES[name])
        return sign_flip(F.col(name), credit).alias(name) if name in DOCUMENT_MEASURES else F.col(name)

    return lines.select(*[signed(c) for c in columns])


def spend_by_day(ads: DataFrame) -> DataFrame:
    """Spend of all ads per day."""
    return ads.groupBy(F.col("date_start").cast("date").alias("date_fb")).agg(
        money_sum(F.col("spend")).alias("costo_clp_fbads")
    )


def sale_lines_by_day(lines: DataFrame) -> DataFrame:
    """Number of sale lines per day, for every day with lines of any type."""
    sale = F.col("document_name").isin(*L.SALE_DOCUMENT_NAMES)
    return lines.groupBy("fecha_documento").agg(
        F.count(F.when(sale, F.col("document_number"))).alias("compras_mismo_dia")
    )


def day_attributes(lines: DataFrame, ads: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per day with lines: sale lines, ad spend and calendar columns."""
    days = sale_lines_by_day(lines)
    days = left_join_on(days, spend_by_day(ads), F.col("fecha_documento"), "date_fb")
    return left_join_on(days, calendar, F.col("fecha_documento"), "date_raw").drop("date_fb")


def variant_attributes(
    lines: DataFrame, master: DataFrame, groups: DataFrame, stock: DataFrame
) -> DataFrame:
    """Master, group, stock and colour of every (code, id) of a variant that occurs in the lines.

    The prefix join, the casts of the key and the colour rules then run once per variant instead of
    once per line. A code with several entries in a master gets several rows, as joining the
    master to the lines would give.
    """
    variants = lines.select("variant_code", "variant_id").distinct()
    variants = variants.withColumn("color", B.colour(F.col("variant_code")))
    products = master.select(
        "sku", "tipo_producto", "nombre_producto", "costo_neto", "precio_unitario"
    )
    variants = left_join_on(variants, by_rows(products), F.col("variant_code"), "sku").drop("sku")
    variants = left_join_prefix(variants, groups, "variant_code", "variante_code_desc")
    levels = stock_by_variant(stock).withColumnRenamed("variant_id", "_stocked")
    return left_join_cast_key(variants, levels, "variant_id", "_stocked").drop("_stocked")


def product_groups(raw: DataFrame) -> DataFrame:
    """Second product master under its business names, the group code as text."""
    return raw.select(
        F.col("int64_field_0").cast("string").alias("variante_code_desc"),
        F.col("string_field_1").alias("grupo_producto"),
        F.col("string_field_2").alias("categoria"),
    )


def stock_by_variant(stock: DataFrame) -> DataFrame:
    return stock.groupBy("variant_id").agg(money_sum(F.col("quantity")).alias("stock_actual"))


def sales_core(
    lines: DataFrame,
    ads: DataFrame,
    master: DataFrame,
    groups: DataFrame,
    stock: DataFrame,
    calendar: DataFrame,
    stage: Stage = as_is,
    columns: Sequence[str] = LINE_COLUMNS,
) -> DataFrame:
    """Line-level sales with each line's share of the day's ad spend and all attributes.

    Everything keyed by day is first brought into one small table, and so is everything keyed by
    the variant; the lines then take part in two joins only. ``stage`` may write those tables out,
    which lets the planner see their real size before it places the joins. ``columns`` are the columns
    of the lines that the mart shall have, ``LINE_KEYS`` among them; the lines need no others.
    """
    signed = signed_lines(lines, columns)
    days = stage(day_attributes(signed, ads, calendar), "days")
    variants = stage(variant_attributes(lines, master, groups, stock), "variants")
    # Null-safe: a line without a code still has the stock of its id.
    variants = variants.withColumnsRenamed({"variant_code": "_code", "variant_id": "_id"})
    if stage is not as_is:  # else counting them would make them twice
        variants = by_rows(variants)
    same = F.col("variant_code").eqNullSafe(F.col("_code"))
    joined = signed.join(variants, same & F.col("variant_id").eqNullSafe(F.col("_id")), "left")
    # Variants may be many, so that the lines are shuffled to them; the days, which are few, come after.
    joined = left_join(joined, days, ["fecha_documento"])

    spend, count = F.col("costo_clp_fbads"), F.col("compras_mismo_dia")
    share = (
        F.when(outside(F.col("document_name"), L.SALE_DOCUMENT_NAMES), F.lit(0.0))
        .when((count < 2) | count.isNull(), spend)
        .otherwise(safe_ratio(spend, count))
    )
    credit = F.col("document_type_id") == L.CREDIT_NOTE_ID
    return joined.select(
        *signed.columns,
        share.alias("inversion_desglosada_fbads"),
        "tipo_producto",
        "nombre_producto",
        sign_flip(F.col("costo_neto"), credit).alias("costo_neto"),
        sign_flip(F.col("precio_unitario"), credit).alias("precio_unitario"),
        "grupo_producto",
        "categoria",
        "variante_code_desc",
        "stock_actual",
        *calendar.columns,
        "color",
    )


def sales_daily(core: DataFrame) -> DataFrame:
    """Units, net sales and top price by day, product and branch."""
    return (
        filter_in(core, "document_name", L.SALE_DOCUMENT_NAMES)
        .groupBy(
            D.day_of(F.col("fecha_documento")).alias("fecha"),
            "variant_description",
            "orden_tallas",
            "tipo_producto",
            "nombre_producto",
            "grupo_producto",
            "variant_id",
            "categoria",
            "color",
            F.col("office").alias("sucursal"),
            "year",
            "month",
            "day",
            "week_range",
        )
        .agg(
            money_sum(F.col("detail_quantity")).alias("unidades_vendidas"),
            money_sum(F.col("detail_net_amount")).alias("venta_neta"),
            F.max("precio_unitario").alias("precio_unitario"),
        )
    )
