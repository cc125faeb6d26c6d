"""Stock snapshots, stock movements and the running stock ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmarts.functions import dates as D
from tillmarts.functions import labels as B
from tillmarts.functions import lookups as L
from tillmarts.functions.jsons import shaped
from tillmarts.functions.numbers import MONEY, money_sum
from tillmarts.operators.filters import filter_in
from tillmarts.operators.joins import attach_colour, by_rows, left_join_on, left_join_prefix
from tillmarts.operators.sets import union_all
from tillmarts.schemas import STOCK_COLUMNS, STOCK_NESTED, STOCK_OFFICE, STOCK_VARIANT


def stock_rows(items: DataFrame) -> DataFrame:
    """Stock as it comes from landed pages, as stored rows with variant and branch as JSON text."""
    rows = shaped(items, STOCK_COLUMNS, STOCK_NESTED)
    doubles = ["quantity", "quantityReserved", "quantityAvailable"]
    return rows.withColumns({c: F.col(c).cast("double") for c in doubles})


def stg_stock(stock: DataFrame) -> DataFrame:
    """Stock rows with variant and branch unpacked, each JSON column parsed once."""
    parsed = stock.withColumns(
        {
            "_variant": F.from_json("variant", STOCK_VARIANT),
            "_office": F.from_json("office", STOCK_OFFICE),
        }
    )
    return parsed.select(
        "id",
        F.col("quantity").cast("double").alias("quantity"),
        F.col("quantityReserved").cast("double").alias("quantity_reserved"),
        F.col("quantityAvailable").cast("double").alias("quantity_available"),
        F.col("_variant.id").alias("variant_id"),
        F.col("_variant.description").alias("variant_description"),
        F.col("_variant.barCode").alias("variant_barcode"),
        F.col("_variant.code").alias("variant_code"),
        F.col("_variant.product.id").alias("product_id"),
        F.col("_office.id").alias("office_id"),
        F.col("_office.name").alias("office_name"),
        F.col("_office.address").alias("office_address"),
        F.col("_office.city").alias("office_city"),
        F.col("_office.country").alias("office_country"),
    )


def stock_mart(stock: DataFrame, groups: DataFrame) -> DataFrame:
    """Stock by variant and branch with group, size position and colour."""
    levels = stock.groupBy(
        "variant_id", "variant_code", "variant_description", F.col("office_name").alias("sucursal")
    ).agg(money_sum(F.col("quantity")).alias("stock_actual"))
    levels = left_join_prefix(levels, groups, "variant_code", "variante_code_desc")
    # One row per variant and branch already, so the colour rules run on these rows.
    return levels.withColumns(
        {
            "orden_tallas": B.size_order_text(F.col("variant_description")),
            "color": B.colour(F.col("variant_code")),
        }
    )


def stock_vs_sales(
    stock: DataFrame, master: DataFrame, groups: DataFrame, core: DataFrame
) -> DataFrame:
    """Stock per variant with master data, once per day on which the variant was sold."""
    levels = stock.groupBy("variant_code", "variant_id").agg(
        money_sum(F.col("quantity")).alias("stock_actual")
    )
    sold = (
        core.groupBy("variant_code", "variant_id", "fecha_documento")
        .agg(money_sum(F.col("detail_quantity")).alias("unidades_vendidas"))
        .select(F.col("variant_id").cast("string").alias("_variant"), "unidades_vendidas")
    )
    out = left_join_on(levels, by_rows(master), F.col("variant_code"), "sku")
    out = left_join_prefix(out, groups, "variant_code", "variante_code_desc")
    out = left_join_on(out, sold, F.col("variant_id"), "_variant")
    return out.select(
        "variant_id",
        *master.columns,
        B.size_order(F.col("variante")).alias("orden_tallas"),
        "variante_code_desc",
        "grupo_producto",
        "categoria",
        "unidades_vendidas",
        "stock_actual",
    )


def stg_consumptions(consumptions: DataFrame) -> DataFrame:
    return consumptions.select(
        "consumption_id",
        D.epoch_to_date(F.col("consumption_date")).alias("fecha_consumo"),
        "note",
        "office_id",
        "office_name",
        "variant_id",
        "quantity",
        "cost",
    )


def stg_receptions(receptions: DataFrame) -> DataFrame:
    return receptions.select(
        "recepcion_id",
        D.epoch_to_date(F.col("admission_date")).alias("fecha_recibo"),
        "document_number",
        "note",
        "office_id",
        "office_name",
        "variant_id",
        "quantity",
        "cost",
    )


def _movement_lines(movements: DataFrame, header: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Header fields (missing text as given) and branch, once per detail line."""
    fields = [
        (F.col(c) if default is None else F.coalesce(c, F.lit(default))).alias(name)
        for name, (c, default) in header.items()
    ]
    return movements.select(
        *fields,
        F.col("office.id").alias("office_id"),
        F.col("office.name").alias("office_name"),
        F.explode("details.items").alias("_line"),
    ).select(
        *header,
        "office_id",
        "office_name",
        F.col("_line.variant.id").alias("variant_id"),
        F.col("_line.quantity").alias("quantity"),
        F.col("_line.cost").alias("cost"),
    )


def consumption_lines(consumptions: DataFrame) -> DataFrame:
    return _movement_lines(
        consumptions,
        {
            "consumption_id": ("id", None),
            "consumption_date": ("consumptionDate", None),
            "note": ("note", ""),
        },
    )


def reception_lines(receptions: DataFrame) -> DataFrame:
    return _movement_lines(
        receptions,
        {
            "recepcion_id": ("id", None),
            "admission_date": ("admissionDate", None),
            "document": ("document", None),
            "document_number": ("documentNumber", ""),
            "note": ("note", ""),
        },
    )


def movements(receptions: DataFrame, consumptions: DataFrame, core: DataFrame) -> DataFrame:
    """Receptions, consumptions and sales as one ledger of incoming and outgoing units."""
    key = [F.col("variant_id").cast("string").alias("variant_id")]
    key.append(F.col("office_id").cast("string").alias("office_id"))
    none = F.lit(0.0)
    sold = (
        filter_in(core, "document_type_id", L.SALE_DOCUMENT_IDS)
        .groupBy("variant_id", "office_id", "fecha_documento")
        .agg(money_sum(F.col("detail_quantity")).alias("quantity"))
    )
    return union_all(
        stg_receptions(receptions).select(
            F.col("fecha_recibo").alias("fecha"),
            *key,
            F.col("quantity").alias("ingreso"),
            none.alias("salida"),
        ),
        stg_consumptions(consumptions).select(
            F.col("fecha_consumo").alias("fecha"),
            *key,
            none.alias("ingreso"),
            F.col("quantity").alias("salida"),
        ),
        sold.select(
            F.col("fecha_documento").alias("fecha"),
            *key,
            none.alias("ingreso"),
            F.col("quantity").alias("salida"),
        ),
    )


_PAIR = ["variant_id", "office_id"]


def _changes(moves: DataFrame, first: str, last: str) -> DataFrame:
    """Signed movements of the days from ``first`` to ``last``, exact; pairs with a NULL do not count."""
    start, end = F.lit(first).cast("date"), F.lit(last).cast("date")
    change = F.coalesce("ingreso", F.lit(0.0)) - F.coalesce("salida", F.lit(0.0))
    inside = moves.filter(F.col("fecha").between(start, end)).dropna(subset=_PAIR)
    return inside.select(*_PAIR, "fecha", change.cast(MONEY).alias("change"))


def closing_balances(
    moves: DataFrame, first: str, last: str, opening: DataFrame | None = None
) -> DataFrame:
    """variant_id, office_id and balance after ``last``: the movements from ``first`` on and the
    ``opening`` balances, which a call for the days before ``first`` has given.

    Balances are kept for all pairs that ever moved, in stock or not, so a pair that comes into stock later
    begins with what it has. They are exact, so it does not matter where the days are cut.
    """
    parts = _changes(moves, first, last).select(*_PAIR, "change")
    if opening is not None:
        parts = parts.unionByName(opening.select(*_PAIR, F.col("balance").alias("change")))
    return parts.groupBy(*_PAIR).agg(F.sum("change").cast(MONEY).alias("balance"))


def stock_ledger(
    stock: DataFrame, moves: DataFrame, first: str, last: str, opening: DataFrame | None = None
) -> DataFrame:
    """Running stock of every stocked variant and branch on every day from ``first`` to ``last``.

    It starts from the ``opening`` balances (see ``closing_balances``), or from zero; with them a new day
    takes that day's movements only.

    Totals are formed over the days that have movements; each total is then spread over the days
    up to the next movement. The full day grid is therefore never shuffled, joined or sorted: it
    appears in the last, row-local step. Movements of pairs that are not in stock, or outside
    the days, do not count.
    """
    start, end = F.lit(first).cast("date"), F.lit(last).cast("date")
    pair = _PAIR
    stocked = stock.select(
        *[F.col(c).cast("string").alias(c) for c in pair],
        start.alias("fecha"),
        F.lit(0).cast(MONEY).alias("change"),
        F.lit(True).alias("stocked"),
    )
    moved = _changes(moves, first, last).withColumn("stocked", F.lit(False))
    if opening is not None:
        carried = opening.select(
            *pair, start.alias("fecha"), F.col("balance").cast(MONEY).alias("change"), F.lit(False).alias("stocked")
        )
        moved = moved.unionByName(carried)
    days = (
        stocked.unionByName(moved)
        .groupBy(*pair, "fecha")
        .agg(F.sum("change").alias("change"), F.max("stocked").alias("stocked"))
    )
    # At most one row per day and pair from here on.
    by_day = Window.partitionBy(*pair).orderBy("fecha")
    to_here = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = days.select(
        *pair,
        "fecha",
        F.sum("change").over(to_here).cast("double").alias("stock_final"),
        # The opening row is the first of its pair, so later rows inherit its mark.
        F.max("stocked").over(to_here).alias("stocked"),
        F.lead("fecha").over(by_day).alias("_next"),
    ).filter("stocked")
    until = F.coalesce(F.date_sub("_next", 1), end)
    return totals.select(
        F.explode(F.sequence("fecha", until, F.expr("interval 1 day"))).alias("fecha"),
        *pair,
        "stock_final",
        F.coalesce("stock_final", F.lit(0.0)).alias("stock_final_lleno"),
    )
