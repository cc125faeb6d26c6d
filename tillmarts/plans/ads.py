"""Ad insights, creatives and budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmarts.functions import arrays as A
from tillmarts.functions import dates as D
from tillmarts.functions import lookups as L
from tillmarts.functions.jsons import json_list, json_or_empty
from tillmarts.functions.numbers import MONEY, cast_nullif, fallback_budget, safe_cast
from tillmarts.functions.texts import concat_key
from tillmarts.operators.aggregates import count_distinct, distinct_by_key
from tillmarts.operators.filters import filter_gt, filter_recent, filter_required
from tillmarts.operators.joins import (
    budget_lookup,
    build_side,
    left_join,
    left_join_date_dim,
    left_join_on,
    status_lookup,
)
from tillmarts.schemas import ACTION_ITEM, INSIGHT_COLUMNS

CAMPAIGN_BUDGETS = [
    "daily_budget_campaign",
    "lifetime_budget_campaign",
    "budget_remaining_campaign",
]


def _purchase_values_fit() -> Column:
    return A.castable_in_set(F.col("actions"), "bigint") & A.castable_in_set(
        F.col("action_values"), "double"
    )


def ad_insight_rows(
    insights: DataFrame,
    ads: DataFrame,
    adsets: DataFrame,
    campaigns: DataFrame,
    integer_budgets: bool = False,
) -> DataFrame:
    """Raw insights as stored rows: key, status, budgets, purchases and actions as JSON text.

    Rows whose purchase values are not numbers are left out (``ad_insight_rejects`` holds them).
    ``integer_budgets`` gives campaign budgets as integers, NULL where the text is not one.
    """
    rows = insights.filter(_purchase_values_fit())
    ids = ["ad_id", "adset_id", "campaign_id", "date_start", "date_stop"]
    rows = rows.fillna(L.UNKNOWN, subset=ids)
    rows = status_lookup(rows, ads)
    rows = budget_lookup(rows, adsets, "adset_id", "adset")
    rows = budget_lookup(rows, campaigns, "campaign_id", "campaign")
    rows = rows.withColumns(
        {
            "id": concat_key(F.col("ad_id"), F.col("date_start")),
            "purchases": A.sum_in_set(F.col("actions"), "bigint"),
            "purchase_value": A.sum_in_set(F.col("action_values"), "double"),
            "actions": json_or_empty(F.col("actions"), "[]"),
            "action_values": json_or_empty(F.col("action_values"), "[]"),
        }
    )
    if integer_budgets:
        rows = rows.withColumns({c: safe_cast(F.trim(c), "bigint") for c in CAMPAIGN_BUDGETS})
    return rows.select(*INSIGHT_COLUMNS)


def ad_insight_rejects(insights: DataFrame) -> DataFrame:
    return insights.filter(~_purchase_values_fit())


def action_totals(insights: DataFrame) -> DataFrame:
    """Per ad and day: ten action counts and the purchase amount.

    Counts and amounts come out of one explode and one aggregate. A count is NULL where the ad
    had no actions that day, 0 where it had some but none of the type.
    """
    actions = json_list(F.col("actions"), ACTION_ITEM)
    values = json_list(F.col("action_values"), ACTION_ITEM)

    def tagged(items: Column, tag: str) -> Column:
        return F.coalesce(
            F.transform(
                items,
                lambda x: F.struct(
                    F.lit(tag).alias("tag"), x["action_type"].alias("type"), x["value"].alias("value")
                ),
            ),
            F.array().cast("array<struct<tag:string,type:string,value:string>>"),
        )

    items = insights.select(
        "ad_id",
        F.col("date_start").cast("date").alias("date_start"),
        F.explode(F.concat(tagged(actions, "count"), tagged(values, "amount"))).alias("item"),
    )
    tag, kind, value = F.col("item.tag"), F.col("item.type"), F.col("item.value")

    def total(which: str, name: str, to: str) -> Column:
        picked = F.when(kind == name, cast_nullif(value, to)).otherwise(F.lit(0).cast(to))
        exact = picked.cast(MONEY) if to == "double" else picked
        return F.sum(F.when(tag == which, exact))

    return items.groupBy("ad_id", "date_start").agg(
        *[total("count", c, "bigint").alias(c) for c in L.ACTION_COLUMNS],
        total("amount", "purchase", "double").cast("double").alias("purchase_amount"),
    )


def ads_daily(insights: DataFrame, as_of: str) -> DataFrame:
    """Stored insights with typed spend and dates, action columns and recent activity.

    An ad is active when it had impressions since the day before ``as_of``.
    """
    base = insights.select(
        "ad_id",
        "ad_name",
        "adset_name",
        "adset_id",
        "campaign_id",
        "campaign_name",
        "impressions",
        "clicks",
        "ctr",
        F.col("spend").cast("double").alias("spend"),
        F.col("date_start").cast("date").alias("date_start"),
        F.col("date_stop").cast("date").alias("date_stop"),
        "status",
        F.col("daily_budget_adset").alias("adset_daily_budget"),
        F.col("daily_budget_campaign").alias("campaign_daily_budget"),
        "effective_status",
        "action_values",
        "actions",
    )
    totals = action_totals(insights)
    recent = (
        filter_recent(base, "date_start", as_of)
        .groupBy("ad_id")
        .agg(F.sum(F.col("impressions").cast("double")).alias("_recent"))
    )
    # Their sizes are guessed from the files, which have a few MB for very many rows.
    rows = insights.count()
    totals, recent = build_side(totals, rows), build_side(recent, rows)
    joined = left_join(left_join(base, totals, ["ad_id", "date_start"]), recent, ["ad_id"])
    return joined.select(
        *base.columns[:10],
        F.col("purchase").cast("double").alias("purchase"),
        "purchase_amount",
        *base.columns[10:],
        *[c for c in L.ACTION_COLUMNS if c != "purchase"],
        F.when(F.col("_recent") > 0, "Active").otherwise("Inactive").alias("ad_is_active"),
    )


def stg_creatives(creatives: DataFrame) -> DataFrame:
    return creatives.select(
        F.col("ad_id").alias("ad_id_c"),
        "ad_creative_id",
        "body",
        "title",
        "video_id",
        "thumbnail_url",
        "call_to_action_type",
        F.col("status").alias("status_creative"),
    )


def ads_budget(daily: DataFrame, creatives: DataFrame) -> DataFrame:
    """Ads per day with creative, number of spending ads in the ad set and their budget share."""
    counted = count_distinct(
        filter_gt(daily, "spend", 0), ["adset_id", "date_start"], "ad_id", "cantidad_ads"
    )
    joined = left_join_on(daily, stg_creatives(creatives), F.col("ad_id"), "ad_id_c")
    joined = left_join(joined, counted, ["adset_id", "date_start"])
    budget = fallback_budget(
        F.col("adset_daily_budget"), F.col("campaign_daily_budget"), F.col("cantidad_ads")
    )
    creative_columns = stg_creatives(creatives).columns
    return joined.select(
        *daily.columns, *creative_columns, "cantidad_ads", budget.alias("distributed_budget")
    )


PLATFORM_COLUMNS = [
    "ad_id", "ad_name", "adset_id", "adset_name", "campaign_id", "campaign_name", "date_stop",
    "spend", "impressions", "clicks", "reach", "cpm", "ctr", "cpc", "cpp", "publisher_platform",
    "platform_position", "impression_device", "account_id", "account_name", "frequency",
]


def ads_platform_calendar(insights: DataFrame, calendar: DataFrame) -> DataFrame:
    """Insights by platform and device with the attributes of their day."""
    staged = insights.select(
        *PLATFORM_COLUMNS, D.day_of(F.col("date_start")).alias("campaign_date")
    )
    return left_join_date_dim(staged, calendar, "campaign_date")


# Fields of a creative.
CREATIVE_FIELDS = [
    "name", "body", "title", "image_url", "thumbnail_url", "video_id", "object_story_id", "status",
    "call_to_action_type", "object_type", "template_url",
]


def creative_dim(ads: DataFrame, details: DataFrame) -> DataFrame:
    """One row per creative: its details and the first ad that uses it."""
    mapping = filter_required(
        ads.select(F.col("id").alias("ad_id"), F.col("creative.id").alias("ad_creative_id")),
        ["ad_id", "ad_creative_id"],
    )
    shaped = details.select(
        F.col("id").alias("ad_creative_id"),
        *CREATIVE_FIELDS,
        json_or_empty(F.col("object_story_spec"), "{}").alias("object_story_spec"),
    )
    # Reduced to one ad per creative before the details are joined.
    first = distinct_by_key(mapping, ["ad_creative_id"], ["ad_id"])
    joined = first.join(shaped, "ad_creative_id")
    rows = distinct_by_key(joined, ["ad_creative_id"], ["ad_id"])
    return rows.select("ad_creative_id", *CREATIVE_FIELDS, "object_story_spec", "ad_id")


def post_content(creatives: DataFrame, posts: DataFrame) -> DataFrame:
    """Creatives with the text, link and video of their post.

    A creative that names a post takes all post values, NULL where the post is gone; one that
    names none keeps its own body and video.
    """
    shaped = posts.select(
        F.col("id").alias("_post"),
        F.col("message").alias("_message"),
        F.col("permalink_url").alias("_link"),
        F.col("created_time").alias("_created"),
        A.any_video(F.col("attachments.data")).alias("_is_video"),
        A.last_video_id(F.col("attachments.data")).alias("_video"),
    )
    # A post that landed twice counts once, by its latest time.
    shaped = distinct_by_key(shaped, ["_post"], ["_created"], last=True)
    story = F.coalesce("object_story_id", "effective_object_story_id")
    joined = creatives.withColumn("_story", story).join(
        shaped, F.col("_story") == F.col("_post"), "left"
    )
    named = F.col("_story").isNotNull()
    kept = [c for c in creatives.columns if c not in ("body", "video_id")]
    return joined.select(
        *kept,
        F.when(named, F.col("_message")).otherwise(F.col("body")).alias("body"),
        F.col("_link").alias("post_link"),
        F.when(named, F.coalesce("_is_video", F.lit(False))).alias("is_video"),
        F.when(named, F.col("_video")).otherwise(F.col("video_id")).alias("video_id"),
        F.col("_created").alias("post_created_time"),
    )
