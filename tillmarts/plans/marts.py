"""All marts from their sources, each written once and read back by those that build on it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillmarts.plans import ads, sales, stock
from tillmarts.sources.writers import sink_model


@dataclass(frozen=True)
class Sources:
    """The warehouse tables the marts read (columns as in FIXTURES.md)."""

    documents: DataFrame
    document_types: DataFrame
    stock: DataFrame
    product_master: DataFrame
    product_master_2: DataFrame
    ad_insights: DataFrame
    creatives: DataFrame
    platform_insights: DataFrame
    calendar: DataFrame
    #: Stock movements and the days of the ledger; without them there is none.
    receptions: DataFrame | None = None
    consumptions: DataFrame | None = None
    ledger_days: tuple[str, str] | None = None


def build_marts(spark: SparkSession, sources: Sources, folder: str, as_of: str) -> dict[str, DataFrame]:
    """Write every mart under ``folder`` and register it as a view of its name.

    Document lines are written too: their JSON is then parsed once, though three steps read them.
    """
    built: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        built[name] = sink_model(df, name, "table", f"{folder}/{name}")
        return built[name]

    calendar = keep("date_table", sources.calendar)
    groups = sales.product_groups(sources.product_master_2)
    raw = sales.raw_document(sources.documents)
    lines = keep("stg_document_lines", sales.stg_document_lines(raw, sources.document_types))
    rows = keep("stg_stock", stock.stg_stock(sources.stock))
    daily = ads.ads_daily(sources.ad_insights, as_of)
    budget = keep("ads_budget", ads.ads_budget(daily, sources.creatives))
    keep("ads_platform_calendar", ads.ads_platform_calendar(sources.platform_insights, calendar))
    keep("stock_mart", stock.stock_mart(rows, groups))
    core = keep(
        "sales_core",
        sales.sales_core(
            lines, budget, sources.product_master, groups, rows, calendar,
            stage=lambda df, name: keep(f"sales_core_{name}", df),
        ),
    )
    keep("sales_daily", sales.sales_daily(core))
    keep("stock_vs_sales", stock.stock_vs_sales(rows, sources.product_master, groups, core))
    if sources.receptions is not None and sources.consumptions is not None:
        keep("stg_receptions", stock.stg_receptions(sources.receptions))
        keep("stg_consumptions", stock.stg_consumptions(sources.consumptions))
        if sources.ledger_days:
            moves = stock.movements(sources.receptions, sources.consumptions, core)
            keep("stock_ledger", stock.stock_ledger(rows, moves, *sources.ledger_days))
    return built
