"""The daily loads, each from landed rows to the stored table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmarts.functions.jsons import stringify_all
from tillmarts.operators.aggregates import distinct_by_key
from tillmarts.operators.filters import filter_between_dates, filter_id_intervals, filter_since
from tillmarts.operators.loads import append_new, gap_repair, incremental_load
from tillmarts.operators.sets import interval_pairs
from tillmarts.plans.ads import ad_insight_rows, creative_dim, post_content
from tillmarts.plans.sales import document_rows
from tillmarts.plans.shop import order_rows
from tillmarts.plans.stock import stock_rows
from tillmarts.sources import versioned
from tillmarts.sources.targets import Target


#: The day in the key of an ad's day.
DAY_OF_AD = "substring_index(id, '_', -1)"


def ads_load(
    insights: DataFrame,
    ads: DataFrame,
    adsets: DataFrame,
    campaigns: DataFrame,
    path: str,
    today: dt.date,
    days_back: int,
    integer_budgets: bool = False,
) -> None:
    """Merge the insights of the last ``days_back`` days, today included, with all their columns into the
    versioned table at ``path``.

    The key ends in the day and the table is laid out by it, so only files of those days are read
    and replaced.
    """
    recent = filter_between_dates(insights, "date_start", today - dt.timedelta(days=days_back), today)
    rows = ad_insight_rows(recent, ads, adsets, campaigns, integer_budgets)
    versioned.merge(path, rows, "id", [c for c in rows.columns if c != "id"], DAY_OF_AD)


def orders_load(orders: DataFrame, place: str | Target, now: str, days_back: int) -> None:
    """Append the web-shop orders created in the last ``days_back`` days that are not stored yet, as text."""
    recent = filter_since(orders, "created_at", now, days_back)
    append_new(recent, place, lambda df: stringify_all(order_rows(df)), "id", as_text=True)


def documents_load(
    items: DataFrame, place: str | Target, now: str, days_back: int = 3, rejects: str | None = None
) -> None:
    """Append the sales documents of the trailing window that are not stored yet, as 18 columns.

    Documents whose id or time of emission is not a whole number are dead letters.
    """
    casts = {c: "bigint" for c in ("id", "emissionDate") if items.schema[c].dataType.simpleString() == "string"}
    incremental_load(items, place, now, days_back, document_rows, order_by=["number"], casts=casts or None, rejects=rejects)


def documents_bulk_load(
    items: DataFrame, second_source: DataFrame, cursors: DataFrame, place: str | Target
) -> None:
    """All documents of the id intervals between ``cursors``, appended where they are not stored yet.

    What the interval pages lack is taken from the second source, which is asked by single ids.
    """
    intervals = interval_pairs(cursors, "id")
    listed = filter_id_intervals(items, intervals, "id").select(*items.columns)
    whole = gap_repair(listed, second_source.select(*items.columns), cursors, "id", ["number"])
    append_new(whole, place, document_rows, "id", ["number"])


def stock_load(items: DataFrame, path: str) -> None:
    """Truncate and reload the stock, one row of each id. Readers see the old stock or the new one."""
    rows = stock_rows(items)
    versioned.replace(path, distinct_by_key(rows, ["id"], ["quantity"]), "id")


def creatives_load(ads: DataFrame, details: DataFrame, path: str, posts: DataFrame | None = None) -> None:
    """Merge the creatives of ``ads``, one row each, with their details and, where ``posts`` are given,
    their post's text, link and video. Creatives that were stored before and come no more stay."""
    rows = creative_dim(ads, details)
    if posts is not None:
        story = "effective_object_story_id"
        shown = F.col(story) if story in details.columns else F.lit(None).cast("string")
        shown = details.groupBy(F.col("id").alias("ad_creative_id")).agg(F.min(shown).alias(story))
        rows = post_content(rows.join(shown, "ad_creative_id", "left"), posts)
    versioned.merge(path, rows, "ad_creative_id", ["ad_id"])
