"""Grouped results. All of them aggregate before the shuffle, so a hot key costs one row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmarts.functions.numbers import MONEY, money_sum


def sum_by_key(df: DataFrame, keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Exact sums: ``sums`` maps output names to columns."""
    return df.groupBy(*keys).agg(*[money_sum(F.col(c)).alias(n) for n, c in sums.items()])


def count_nonnull(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(col).alias(name))


def count_distinct(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """Exact distinct count, in two steps so that a hot group is spread over its distinct values."""
    return df.groupBy(*keys, col).agg(F.lit(1)).groupBy(*keys).agg(F.count(col).alias(name))


def group_by_all(df: DataFrame, keys: Sequence[Column | str], aggregates: Sequence[Column]) -> DataFrame:
    """Group by every output that is not an aggregate."""
    return df.groupBy(*keys).agg(*aggregates)


def conditional_sums(
    df: DataFrame,
    keys: Sequence[str],
    type_col: str,
    value: Column,
    types: Mapping[str, str],
    to: str,
) -> DataFrame:
    """One column per type: the sum of ``value`` over rows of that type, 0 where there are none.

    ``types`` maps output names to type values; ``to`` is the output type. Money is summed in
    exact arithmetic.
    """
    kind = MONEY if to == "double" else to
    picked = {
        name: F.when(F.col(type_col) == t, value.cast(kind)).otherwise(F.lit(0).cast(kind))
        for name, t in types.items()
    }
    return df.groupBy(*keys).agg(*[F.sum(c).cast(to).alias(n) for n, c in picked.items()])


def max_by_group(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(col).alias(name))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def distinct_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], last: bool = False
) -> DataFrame:
    """One row per key: the first (or last) by ``order_by``, remaining columns breaking ties.

    A min over the row as a struct aggregates before the shuffle; numbering the rows of a key
    would send all of them to one task.
    """
    order = list(order_by) + [c for c in df.columns if c not in order_by and c not in keys]
    if not order:
        return df.distinct()
    pick = F.max if last else F.min
    chosen = df.groupBy(*keys).agg(pick(F.struct(*order)).alias("_row"))
    return chosen.select(*keys, "_row.*").select(*df.columns)


def distinct_ids(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()
