"""Types of the source tables and of the JSON inside them."""

from __future__ import annotations

from pyspark.sql import types as T

_T = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
}


def struct_of(ddl: str) -> T.StructType:
    """``"id bigint, name string"`` as a StructType."""
    fields = [part.split() for part in ddl.split(",")]
    return T.StructType([T.StructField(name, _T[kind]) for name, kind in fields])


def as_text(schema: T.StructType) -> T.StructType:
    """The same shape with every leaf read as text, so that one bad value spoils only itself."""
    return T.StructType(
        [
            T.StructField(
                f.name, as_text(f.dataType) if isinstance(f.dataType, T.StructType) else T.StringType()
            )
            for f in schema.fields
        ]
    )


VARIANT_REF = struct_of("id bigint, description string, code string")

DETAIL_ITEM = T.StructType(
    struct_of(
        "id bigint, lineNumber bigint, quantity double, netUnitValue double,"
        "totalUnitValue double, netAmount double, taxAmount double, totalAmount double,"
        "netDiscount double, totalDiscount double, note string, relatedDetailId bigint"
    ).fields
    + [T.StructField("variant", VARIANT_REF)]
)

REFERENCE_ITEM = struct_of("id bigint, reason string")

ID_OBJECT = struct_of("id bigint")

STOCK_VARIANT = T.StructType(
    struct_of("id string, description string, barCode string, code string").fields
    + [T.StructField("product", struct_of("id string"))]
)
STOCK_OFFICE = struct_of("id string, name string, address string, city string, country string")

ACTION_ITEM = struct_of("action_type string, value string")

ATTACHMENT = T.StructType(
    [T.StructField("type", T.StringType()), T.StructField("target", struct_of("id string"))]
)

COLOUR_SEED = struct_of("color string, sku string")

PRODUCT_MASTER = struct_of(
    "sku string, tipo_producto string, nombre_producto string, variante string,"
    "costo_neto double, precio_unitario double"
)

MOVEMENT_DETAIL = T.StructType(
    [
        T.StructField("variant", struct_of("id bigint")),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("cost", T.DoubleType()),
    ]
)
MOVEMENT_DETAILS = T.StructType([T.StructField("items", T.ArrayType(MOVEMENT_DETAIL))])
OFFICE_REF = struct_of("id bigint, name string")

CONSUMPTION = T.StructType(
    struct_of("id bigint, consumptionDate bigint, note string").fields
    + [T.StructField("office", OFFICE_REF), T.StructField("details", MOVEMENT_DETAILS)]
)
RECEPTION = T.StructType(
    struct_of(
        "id bigint, admissionDate bigint, document string, documentNumber string, note string"
    ).fields
    + [T.StructField("office", OFFICE_REF), T.StructField("details", MOVEMENT_DETAILS)]
)

# Columns of one stored ad insight, in order; the upsert writes exactly these.
INSIGHT_COLUMNS = [
    "id", "ad_id", "ad_name", "adset_id", "adset_name", "campaign_id", "campaign_name",
    "impressions", "clicks", "ctr", "spend", "date_start", "date_stop", "actions",
    "action_values", "purchases", "purchase_value", "status", "effective_status",
    "daily_budget_adset", "lifetime_budget_adset", "budget_remaining_adset",
    "daily_budget_campaign", "lifetime_budget_campaign", "budget_remaining_campaign",
]

# Columns of one stored web-shop order, in order, with the empty JSON value of nested ones.
SHOP_ORDER_COLUMNS = [
    "id", "admin_graphql_api_id", "app_id", "browser_ip", "cancel_reason", "cancelled_at",
    "cart_token", "checkout_id", "closed_at", "created_at", "currency", "current_total_price",
    "customer_locale", "device_id", "discount_codes", "email", "financial_status",
    "fulfillment_status", "gateway", "landing_site", "name", "note", "number", "order_number",
    "payment_gateway_names", "phone", "processed_at", "referring_site", "subtotal_price", "tags",
    "taxes_included", "total_discounts", "total_line_items_price", "total_price",
    "total_shipping_price_set", "total_tax", "total_weight", "updated_at", "user_id",
    "billing_address", "customer", "shipping_address", "line_items",
]
SHOP_ORDER_NESTED = {
    "discount_codes": "[]",
    "payment_gateway_names": "[]",
    "total_shipping_price_set": "{}",
    "billing_address": "{}",
    "customer": "{}",
    "shipping_address": "{}",
    "line_items": "[]",
}

# Columns of one stored sales document and of one stored stock row, in the same way.
DOCUMENT_COLUMNS = [
    "id", "emissionDate", "expirationDate", "generationDate", "number", "totalAmount", "netAmount",
    "taxAmount", "state", "document_type", "client", "office", "user", "references",
    "document_taxes", "details", "sellers", "payments",
]
DOCUMENT_NESTED = {
    "document_type": "{}",
    "client": "{}",
    "office": "{}",
    "user": "{}",
    "references": "[]",
    "document_taxes": "[]",
    "details": "[]",
    "sellers": "[]",
    "payments": "[]",
}
STOCK_COLUMNS = ["id", "quantity", "quantityReserved", "quantityAvailable", "variant", "office"]
STOCK_NESTED = {"variant": "{}", "office": "{}"}
