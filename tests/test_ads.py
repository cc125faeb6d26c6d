"""Ad insights, creatives and budgets on hand-made rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tillmarts.functions import lookups as L
from tillmarts.plans import ads
from tillmarts.schemas import INSIGHT_COLUMNS

RAW = (
    "ad_id string, ad_name string, adset_id string, adset_name string, campaign_id string,"
    "campaign_name string, impressions string, clicks string, ctr string, spend string,"
    "date_start string, date_stop string, actions array<struct<action_type:string,value:string>>,"
    "action_values array<struct<action_type:string,value:string>>"
)


def raw(ad, actions, values, adset="s1", campaign="k1", day="2024-01-01", spend="5"):
    return (ad, "n", adset, "sn", campaign, "kn", "10", "1", "0.1", spend, day, day, actions, values)


def lookups(spark):
    status = spark.createDataFrame([("a1", "ACTIVE", None)], "id string, status string, effective_status string")
    kind = "id string, daily_budget string, lifetime_budget string, budget_remaining string"
    adsets = spark.createDataFrame([("s1", "700", None, "5")], kind)
    campaigns = spark.createDataFrame([("k1", " 7 ", "", "12.9"), ("k2", "abc", None, "3")], kind)
    return status, adsets, campaigns


def test_insight_rows(spark):
    insights = spark.createDataFrame(
        [
            raw("a1", [("purchase", "2"), ("omni_purchase", "1"), ("view", "9")], [("purchase", "1.5")]),
            raw("a2", None, None, adset="s9", campaign="k2"),
            raw(None, [], [], campaign=None, day=None),
            raw("a3", [("purchase", "two")], []),
            raw("a4", [("view", "two")], [("view", "x")]),
        ],
        RAW,
    )
    out = {r.ad_id: r for r in ads.ad_insight_rows(insights, *lookups(spark), integer_budgets=True).collect()}
    assert list(out["a1"].asDict()) == INSIGHT_COLUMNS
    assert set(out) == {"a1", "a2", "a4", "unknown"}
    one = out["a1"]
    assert (one.id, one.purchases, one.purchase_value) == ("a1_2024-01-01", 3, 1.5)
    assert (one.status, one.effective_status) == ("ACTIVE", "unknown")
    assert one.actions.startswith('[{"action_type":"purchase","value":"2"}')
    assert (one.daily_budget_adset, one.daily_budget_campaign) == ("700", 7)
    assert (one.lifetime_budget_campaign, one.budget_remaining_campaign) == (None, None)
    two = out["a2"]
    assert (two.status, two.daily_budget_adset, two.daily_budget_campaign) == ("unknown", None, None)
    assert (two.budget_remaining_campaign, two.actions, two.purchases) == (3, "[]", 0)
    assert out["unknown"].id == "unknown_unknown" and out["unknown"].campaign_id == "unknown"
    assert [r.ad_id for r in ads.ad_insight_rejects(insights).collect()] == ["a3"]


STORED = ", ".join(f"{c} string" for c in INSIGHT_COLUMNS if c not in ("purchases", "purchase_value"))


def stored(ad, day, actions, values, impressions="10", spend="5", adset="s1", budget=("700", "80")):
    row = dict.fromkeys(c for c in INSIGHT_COLUMNS if c not in ("purchases", "purchase_value"))
    row |= {
        "id": f"{ad}_{day}", "ad_id": ad, "adset_id": adset, "impressions": impressions,
        "spend": spend, "date_start": day, "date_stop": day, "actions": actions,
        "action_values": values, "daily_budget_adset": budget[0], "daily_budget_campaign": budget[1],
    }
    return tuple(row.values())


def insights(spark):
    item = '{{"action_type":"{}","value":"{}"}}'.format
    return spark.createDataFrame(
        [
            stored("a1", "2024-01-09", f"[{item('purchase', 2)},{item('video_view', '')}]", f"[{item('purchase', 3.5)}]"),
            stored("a1", "2024-01-01", f"[{item('purchase', 1)},{item('purchase', 4)},{item('other', 9)}]", "[]"),
            stored("a2", "2024-01-09", "[]", None, impressions="0"),
            stored("a3", "2024-01-01", None, f"[{item('view', 7)}]", spend="0", budget=("1", "80")),
            stored("a4", "2024-01-01", '{"action_type":"purchase","value":"1"}', "", adset="s2"),
        ],
        STORED,
    )


def test_ads_daily(spark):
    out = {(r.ad_id, str(r.date_start)): r for r in ads.ads_daily(insights(spark), "2024-01-10").collect()}
    late, early = out["a1", "2024-01-09"], out["a1", "2024-01-01"]
    assert (late.purchase, late.purchase_amount, late.video_view, late.add_to_cart) == (2.0, 3.5, 0, 0)
    assert (early.purchase, early.purchase_amount, early.page_engagement) == (5.0, None, 0)
    # Impressions since the day before make the ad active on all its days.
    assert (late.ad_is_active, early.ad_is_active) == ("Active", "Active")
    none = out["a2", "2024-01-09"]
    assert (none.purchase, none.view_content, none.ad_is_active) == (None, None, "Inactive")
    values_only = out["a3", "2024-01-01"]
    assert (values_only.purchase, values_only.purchase_amount) == (None, 0.0)
    shape = out["a4", "2024-01-01"]
    assert all(shape[c] is None for c in L.ACTION_COLUMNS)
    assert late.spend == 5.0 and late.date_stop == dt.date(2024, 1, 9)


def test_rows_of_one_ad_and_day_share_their_totals(spark):
    item = '[{"action_type":"purchase","value":"2"}]'
    df = spark.createDataFrame(
        [stored("a1", "2024-01-01", item, None), stored("a1", "2024-01-01", item, None)], STORED
    )
    assert [r.purchase for r in ads.ads_daily(df, "2024-01-10").collect()] == [4.0, 4.0]


def test_budget_is_shared_by_spending_ads(spark):
    daily = ads.ads_daily(insights(spark), "2024-01-10")
    creatives = spark.createDataFrame(
        [("a1", "c1", "b", "t", None, "th", "SHOP", "ACTIVE")],
        "ad_id string, ad_creative_id string, body string, title string, video_id string,"
        "thumbnail_url string, call_to_action_type string, status string",
    )
    out = {(r.ad_id, str(r.date_start)): r for r in ads.ads_budget(daily, creatives).collect()}
    # Two ads of s1 on the 9th, one spending ad of s1 on the 1st.
    assert out["a1", "2024-01-09"].cantidad_ads == 2 and out["a1", "2024-01-09"].distributed_budget == 350.0
    assert out["a3", "2024-01-01"].cantidad_ads == 1 and out["a3", "2024-01-01"].distributed_budget == 80.0
    assert out["a1", "2024-01-01"].ad_id_c == "a1" and out["a2", "2024-01-09"].ad_id_c is None


def test_one_row_per_creative(spark):
    links = spark.createDataFrame(
        [("a2", ("c1",)), ("a1", ("c1",)), ("a3", ("c2",)), ("a4", None), (None, ("c3",))],
        "id string, creative struct<id:string>",
    )
    fields = ["id", *ads.CREATIVE_FIELDS]
    details = spark.createDataFrame(
        [("c1", *["x"] * len(ads.CREATIVE_FIELDS), ("p",)), ("c9", *["y"] * len(ads.CREATIVE_FIELDS), None)],
        ", ".join(f"{f} string" for f in fields) + ", object_story_spec struct<page_id:string>",
    )
    out = ads.creative_dim(links, details).collect()
    assert [(r.ad_creative_id, r.ad_id, r.object_story_spec) for r in out] == [("c1", "a1", '{"page_id":"p"}')]


def test_post_values_replace_the_creatives_own(spark):
    creatives = spark.createDataFrame(
        [("c1", "own", "v0", "p1", None), ("c2", "own", "v0", None, "p9"), ("c3", "own", "v0", None, None)],
        "id string, body string, video_id string, object_story_id string, effective_object_story_id string",
    )
    posts = spark.createDataFrame(
        [("p1", None, "/p1", "now", ([("video_autoplay", ("v1",)), ("photo", ("f",))],))],
        "id string, message string, permalink_url string, created_time string,"
        "attachments struct<data:array<struct<type:string,target:struct<id:string>>>>",
    )
    out = {r.id: r for r in ads.post_content(creatives, posts).collect()}
    assert (out["c1"].body, out["c1"].video_id, out["c1"].is_video, out["c1"].post_link) == (None, "v1", True, "/p1")
    assert (out["c2"].body, out["c2"].video_id, out["c2"].is_video, out["c2"].post_link) == (None, None, False, None)
    assert (out["c3"].body, out["c3"].video_id, out["c3"].is_video) == ("own", "v0", None)


def test_platform_rows_outside_the_calendar_have_no_attributes(spark):
    from tillmarts.plans.calendar import date_table

    values = {c: None for c in ads.PLATFORM_COLUMNS}
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2019-01-01")], "n int, day string").select(
        *[F.lit(v).cast("string").alias(c) for c, v in values.items() if c != "ad_id"],
        F.col("n").cast("string").alias("ad_id"),
        F.to_date("day").alias("date_start"),
    )
    out = {r.ad_id: r for r in ads.ads_platform_calendar(df, date_table(spark)).collect()}
    assert (out["1"].year, out["2"].year) == (2024, None)
    assert out["1"].campaign_date == dt.date(2024, 1, 1)
