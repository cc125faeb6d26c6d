"""Lookups, enrichment, grids and existence checks.

No join here carries a broadcast hint (``build_side`` may rule one out): whether a side is broadcast is decided against
``spark.sql.autoBroadcastJoinThreshold`` on its real size (file sizes at planning time, shuffle
sizes at run time). Sides above it are joined by a shuffle, where a hot key is split by the
adaptive skew join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmarts.functions.labels import colour
from tillmarts.functions.lookups import COLOUR_OTHER, UNKNOWN
from tillmarts.functions.texts import left_prefix
from tillmarts.operators.aggregates import distinct_by_key
from tillmarts.storage import materialize

#: Rows of keys or digests up to which a join may broadcast them (some 10 MB).
BUILD_ROWS = 100_000


def left_join(fact: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """LEFT OUTER on equal column names; repeated keys in ``dim`` repeat the fact rows."""
    return fact.join(dim, list(keys), "left")


def left_join_on(fact: DataFrame, dim: DataFrame, fact_key: Column, dim_key: str) -> DataFrame:
    """LEFT OUTER of ``dim`` on an expression over ``fact``; the dimension key is kept."""
    keyed = dim.withColumn("_key", F.col(dim_key))
    return fact.withColumn("_key", fact_key).join(keyed, "_key", "left").drop("_key")


def left_join_cast_key(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, to: str = "string"
) -> DataFrame:
    """Keys of different types: the fact side is cast, so the join stays an equi join."""
    return left_join_on(fact, dim, F.col(fact_key).cast(to), dim_key)


def left_join_prefix(
    fact: DataFrame, dim: DataFrame, fact_code: str, dim_key: str, length: int = 4
) -> DataFrame:
    return left_join_on(fact, dim, left_prefix(F.col(fact_code), length), dim_key)


def left_join_date_dim(
    fact: DataFrame, calendar: DataFrame, fact_date: str, dim_date: str = "date_raw"
) -> DataFrame:
    """Calendar attributes by day; days outside the calendar get NULLs."""
    return left_join_on(fact, calendar, F.col(fact_date), dim_date)


def anti_join_existing(
    batch: DataFrame, existing: DataFrame, key: str, as_text: bool = False
) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing`` yet.

    ``existing`` is the whole target and ``batch`` a short trailing window. Reducing ``existing``
    to the keys of the batch first lets the small side be the build side, so the target's ids are
    only scanned; the anti join then sees a few matched keys. Above the broadcast size a target in
    buckets by its key (``targets.Keyed``) stays in place and the batch is moved to the buckets.
    """
    _, n, found = _stored_keys(batch, existing, key, as_text)
    return batch.withColumn("_key", _keyed(key, as_text)).join(build_side(found, n), "_key", "left_anti").drop("_key")


def _keyed(key: str, as_text: bool) -> Column:
    return F.col(key).cast("string") if as_text else F.col(key)


def _stored_keys(
    batch: DataFrame, existing: DataFrame, key: str, as_text: bool
) -> tuple[DataFrame, int, DataFrame]:
    """The keys of the batch, written, their number, and those of ``existing`` that are among them."""
    keyed = _keyed(key, as_text)
    # Written, so that the join with the target is planned on its size: as long as it is small,
    # nothing of the target is shuffled.
    wanted = materialize(batch.select(keyed.alias("_key")).distinct(), "batch-keys")
    n = wanted.count()  # from the files' footers
    return wanted, n, existing.select(keyed.alias("_key")).join(build_side(wanted, n), "_key", "left_semi")


def not_stored(batch: DataFrame, existing: DataFrame, key: str, as_text: bool = False) -> DataFrame:
    """``anti_join_existing`` for wide batches: stored and new keys are told apart first, by keys alone.

    Where most keys are stored already, the rows meet the few new ones, and as long as those are small nothing
    of the batch is shuffled. Elsewhere the rows are shuffled once, by their key, and so need no other shuffle
    to be grouped by it.
    """
    wanted, n, found = _stored_keys(batch, existing, key, as_text)
    stored = materialize(found.distinct(), "stored-keys")
    m = stored.count()
    keyed = batch.withColumn("_key", _keyed(key, as_text))
    if n - m > n // 2:
        return keyed.join(stored.hint("merge"), "_key", "left_anti").drop("_key")
    new = materialize(wanted.join(build_side(stored, m), "_key", "left_anti"), "new-keys")
    rows = keyed.join(build_side(new, n - m), "_key", "left_semi").select(*batch.columns)
    # A NULL key is never stored, and equals none of the new ones.
    return rows.unionByName(batch.filter(F.col(key).isNull())) if new.filter("_key IS NULL").count() else rows


def by_rows(df: DataFrame) -> DataFrame:
    """``df`` as the right side of a join, for tables that are cheap to count and whose files may be small
    though their rows are many."""
    return build_side(df, df.count())


def build_side(df: DataFrame, rows: int) -> DataFrame:
    """``df``, about ``rows`` rows, as the right side of a join: merged, not broadcast, above ``BUILD_ROWS`` rows.

    For keys, digests and product tables, whose files are many times smaller than the rows that a
    broadcast sends through the driver.
    """
    return df.hint("merge") if rows > BUILD_ROWS else df


def lookup_default(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str,
    columns: dict[str, str],
    default: object = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Dictionary lookup: ``columns`` maps lookup columns to output names.

    A key that is absent, and one that is present with no value, both give ``default``. Of a
    repeated lookup key the entry that comes last by ``order_by``, then by its values, counts.
    """
    picked = lookup.select(
        F.col(lookup_key).alias("_key"),
        *[F.col(c).alias(f"_order_{i}") for i, c in enumerate(order_by)],
        *[F.col(c).alias(name) for c, name in columns.items()],
    )
    order = [f"_order_{i}" for i in range(len(order_by))]
    picked = distinct_by_key(picked, ["_key"], order, last=True).drop(*order)
    out = df.withColumn("_key", F.col(key)).join(picked, "_key", "left").drop("_key")
    if default is None:
        return out
    return out.fillna(default, subset=list(columns.values()))


def status_lookup(df: DataFrame, ads: DataFrame) -> DataFrame:
    names = {"status": "status", "effective_status": "effective_status"}
    return lookup_default(df, ads, "ad_id", "id", names, UNKNOWN)


def budget_lookup(df: DataFrame, budgets: DataFrame, key: str, level: str) -> DataFrame:
    fields = ["daily_budget", "lifetime_budget", "budget_remaining"]
    return lookup_default(df, budgets, key, "id", {f: f"{f}_{level}" for f in fields})


def explode_children(df: DataFrame, parent: str, children: str, parent_name: str) -> DataFrame:
    """Child records stamped with their parent's id; parents without children disappear."""
    return df.select(
        F.col(parent).alias(parent_name), F.explode(children).alias("child")
    ).select(parent_name, "child.*")


def unnest(df: DataFrame, items: Column, name: str) -> DataFrame:
    """Lateral cross join with an array: a NULL or empty array drops the row."""
    return df.select("*", F.explode(items).alias(name))


def coalesce_update(
    left: DataFrame,
    right: DataFrame,
    key: str,
    columns: Sequence[str],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """``columns`` taken from ``right`` wherever it has the key, even if the value is NULL there. Of
    a key repeated in ``right`` the row that comes last by ``order_by``, then by its values, counts."""
    kept = [key, *order_by, *[c for c in columns if c not in order_by]]
    right = distinct_by_key(right.select(*kept), [key], order_by, last=True)
    have = [c for c in columns if c in left.columns]
    picked = right.select(
        key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns]
    )
    joined = left.join(picked, key, "left")
    updates = {
        c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c) if c in have else F.lit(None))
        for c in columns
    }
    return joined.withColumns(updates).drop("_hit", *[f"_new_{c}" for c in columns])


def date_grid(df: DataFrame, first: Column, last: Column, name: str = "fecha") -> DataFrame:
    """Every row on every day from ``first`` to ``last``.

    The days are generated per row, so this is the cross join with a calendar without one: no
    side is broadcast and nothing is shuffled.
    """
    return df.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias(name), "*")


def attach_colour(df: DataFrame, code: str, name: str = "color") -> DataFrame:
    """Colour of each code. The rules run once per distinct code and are joined back.

    The codes are not filtered by their colour: that predicate would be pushed below the distinct
    and repeat the expression behind ``code`` once per rule. NULL codes match nothing and have the
    default.
    """
    named = df.select(F.col(code).alias("_code")).distinct().withColumn(name, colour(F.col("_code")))
    joined = df.join(named, F.col(code) == F.col("_code"), "left").drop("_code")
    return joined.fillna(COLOUR_OTHER, subset=[name])
