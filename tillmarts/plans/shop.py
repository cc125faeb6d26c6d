"""Web-shop orders and visits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmarts.functions.jsons import shaped
from tillmarts.schemas import SHOP_ORDER_COLUMNS, SHOP_ORDER_NESTED


def order_rows(orders: DataFrame) -> DataFrame:
    """Orders as 43 columns, nested parts as JSON text; absent fields are NULL or empty JSON."""
    return shaped(orders, SHOP_ORDER_COLUMNS, SHOP_ORDER_NESTED)


def trailing_visit_totals(
    events: DataFrame, as_of: str, days: int = 30, user: str = "user_id", ts: str = "ts"
) -> DataFrame:
    """Visits, sessions, new and returning visitors from ``days`` before ``as_of`` to ``as_of``.

    A session is one user on one day; a visitor is new when the first event ever lies inside the
    days. Events are reduced per user and day, then per user, so no distinct set is gathered.
    """
    end = F.lit(as_of).cast("date")
    start = F.date_sub(end, days)
    day = F.col("_day")
    per_day = (
        events.select(F.col(user).alias("_user"), F.to_date(ts).alias("_day"))
        .filter(day <= end)
        .groupBy("_user", "_day")
        .agg(F.count(F.lit(1)).alias("_visits"))
    )
    inside = day >= start
    per_user = per_day.groupBy("_user").agg(
        F.sum(F.when(inside, F.col("_visits"))).alias("_visits"),
        F.count(F.when(inside, F.lit(1))).alias("_sessions"),
        (F.min("_day") >= start).alias("_new"),
    )
    seen = F.col("_sessions") > 0
    return per_user.agg(
        F.coalesce(F.sum("_visits"), F.lit(0)).cast("bigint").alias("total_visits"),
        F.coalesce(F.sum("_sessions"), F.lit(0)).cast("bigint").alias("total_sessions"),
        F.count(F.when(seen & F.col("_new"), F.lit(1))).alias("new_visitors"),
        F.count(F.when(seen & ~F.col("_new"), F.lit(1))).alias("returning_visitors"),
    )


def first_seen(events: DataFrame, known: DataFrame | None = None, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """user and the day of the first event, from ``events`` and from what is ``known`` from earlier ones.

    Days may come in any order and repeatedly, as re-read windows do.
    """
    days = events.select(F.col(user).alias("user"), F.to_date(ts).alias("first_day"))
    if known is not None:
        days = days.unionByName(known.select("user", "first_day"))
    return days.groupBy("user").agg(F.min("first_day").alias("first_day"))


def visit_totals_since(
    events: DataFrame, seen: DataFrame, as_of: str, days: int = 30, user: str = "user_id", ts: str = "ts"
) -> DataFrame:
    """``trailing_visit_totals`` from the window's events and the table of first days (``first_seen``).

    The window is a range of times, which reaches the scan; no earlier event is read. Visitors that
    ``seen`` does not have yet count by the window alone.
    """
    end = F.lit(as_of).cast("date")
    start = F.date_sub(end, days)
    stamp = F.col(ts)
    window = events.filter((stamp >= start.cast("timestamp_ntz")) & (stamp < F.date_add(end, 1).cast("timestamp_ntz")))
    per_day = (
        window.select(F.col(user).alias("user"), F.to_date(ts).alias("_day"))
        .groupBy("user", "_day")
        .agg(F.count(F.lit(1)).alias("_visits"))
    )
    per_user = per_day.groupBy("user").agg(
        F.sum("_visits").alias("_visits"), F.count(F.lit(1)).alias("_sessions"), F.min("_day").alias("_first")
    )
    # NULL is a visitor too.
    known = seen.withColumnRenamed("user", "_user")
    joined = per_user.join(known, F.col("user").eqNullSafe(F.col("_user")), "left")
    new = F.least("_first", "first_day") >= start
    return joined.agg(
        F.coalesce(F.sum("_visits"), F.lit(0)).cast("bigint").alias("total_visits"),
        F.coalesce(F.sum("_sessions"), F.lit(0)).cast("bigint").alias("total_sessions"),
        F.count(F.when(new, F.lit(1))).alias("new_visitors"),
        F.count(F.when(~new, F.lit(1))).alias("returning_visitors"),
    )
