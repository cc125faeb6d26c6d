"""Row selection."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmarts.functions.dates import local_to_epoch
from tillmarts.functions.lookups import LOCAL_ZONE
from tillmarts.storage import materialize


def filter_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(col).isin(*values))


def outside(col: Column, values: Sequence) -> Column:
    """NOT IN: unknown (so the next CASE branch applies) where the value is NULL."""
    return ~col.isin(*values)


def filter_gt(df: DataFrame, col: str, bound: float) -> DataFrame:
    return df.filter(F.col(col) > bound)


def filter_recent(df: DataFrame, col: str, as_of: dt.date | str, days: int = 1) -> DataFrame:
    """Rows dated no earlier than ``days`` before ``as_of``."""
    return df.filter(F.col(col) >= F.date_sub(F.lit(str(as_of)).cast("date"), days))


def local_window(
    now: dt.datetime | str, days_back: int, zone: str = LOCAL_ZONE
) -> tuple[Column, Column]:
    """Epoch seconds of ``now`` less ``days_back + 1`` days and of ``now``, given as local time."""
    end = F.lit(str(now)).cast("timestamp_ntz")
    start = end - F.expr(f"interval {days_back + 1} days")
    return local_to_epoch(start, zone), local_to_epoch(end, zone)


def filter_date_window(
    df: DataFrame,
    epoch_col: str,
    now: dt.datetime | str,
    days_back: int,
    zone: str = LOCAL_ZONE,
) -> DataFrame:
    """Rows whose epoch second lies in the trailing local-time window, both ends included.

    The bounds are constants, so the comparison reaches the scan.
    """
    start, end = local_window(now, days_back, zone)
    return df.filter(F.col(epoch_col).between(start, end))


def filter_between_dates(
    df: DataFrame, col: str, start: dt.date | str, end: dt.date | str
) -> DataFrame:
    """Rows dated from ``start`` to ``end``, both included."""
    first, last = (F.lit(str(d)).cast("date") for d in (start, end))
    return df.filter(F.col(col).between(first, last))


def filter_since(df: DataFrame, col: str, now: str, days_back: int) -> DataFrame:
    """Rows whose timestamp text is at most ``days_back`` days before ``now`` (with its zone)."""
    start = F.lit(now).cast("timestamp") - F.expr(f"interval {days_back * 24} hours")
    return df.filter(F.col(col).try_cast("timestamp") >= start)


def filter_id_range(df: DataFrame, col: str, first: int, last: int) -> DataFrame:
    return df.filter(F.col(col).between(first, last))


def filter_id_intervals(
    df: DataFrame,
    intervals: DataFrame,
    col: str,
    first: str = "first_id",
    last: str = "last_id",
    width: int = 16,
) -> DataFrame:
    """Rows of ``df`` matched to each interval that holds their id; both ends belong to it.

    An interval is the sum of few whole blocks: of single ids at its ends, then of ``width`` ids,
    of ``width`` * ``width`` ids and so on, at most twice ``width`` of each size. An id lies in one block of each
    size, so this is an equi join on (size, block) that gives just the right pairs, whatever the
    intervals' lengths and however they overlap. Rows are repeated for the sizes that occur, at most
    64 / log2(width) of them.
    """
    blocks = materialize(cover_blocks(intervals, first, last, width), "interval-blocks")
    # The sizes in use: a handful of numbers.
    sizes = sorted(r[0] for r in blocks.select("_size").distinct().collect())
    sizes = sizes or [1]  # there may be no interval at all
    each = F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes]))
    rows = df.select("*", each.alias("_size")).withColumn("_block", _floor_div(F.col(col).cast("bigint"), F.col("_size")))
    return rows.join(blocks, ["_size", "_block"]).drop("_size", "_block")


def _floor_div(a: Column, b: Column) -> Column:
    """Whole division that rounds down, without the doubles of ``floor``."""
    return F.call_function("div", a - F.pmod(a, b), b)


def cover_blocks(intervals: DataFrame, first: str, last: str, width: int) -> DataFrame:
    """The rows of ``intervals`` once for each block that makes them up, with ``_size`` and ``_block``.

    With L and R the first and last + 1 in blocks of a size, rounded inwards, the blocks of that size are those
    of [L, R) which no block of the next size covers: some at the left, some at the right.
    """
    begin, end = F.col(first).cast("bigint"), F.col(last).cast("bigint") + 1
    parts = []
    size = 1
    while size < 1 << 62:
        left, right = _ceil_div(begin, size), _floor_div(end, F.lit(size).cast("bigint"))
        if size * width < 1 << 62:
            after, until = _ceil_div(begin, size * width) * width, _floor_div(end, F.lit(size * width).cast("bigint")) * width
        else:  # no larger size
            after = until = right
        whole = after >= until  # no larger block inside
        parts.append(_blocks(size, left, F.when(whole, right).otherwise(after)))
        parts.append(_blocks(size, F.when(whole, right).otherwise(until), right))
        size *= width
    sides = intervals.filter(F.col(first) <= F.col(last)).select("*", F.explode(F.array(*parts)).alias("_part"))
    sides = sides.filter("_part.low < _part.high")
    block = F.explode(F.sequence(F.col("_part.low"), F.col("_part.high") - 1))
    return sides.select(*intervals.columns, F.col("_part.size").alias("_size"), block.alias("_block"))


def _ceil_div(a: Column, b: int) -> Column:
    return -_floor_div(-a, F.lit(b).cast("bigint"))


def _blocks(size: int, low: Column, high: Column) -> Column:
    return F.struct(F.lit(size).cast("bigint").alias("size"), low.alias("low"), high.alias("high"))


def split_bad_rows(df: DataFrame, casts: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose text columns all hold values of the wanted types, cast; and the other rows as is.

    A NULL is not a fault. Both frames are plain filters over the same input.
    """
    bad = F.lit(False)
    for col, to in casts.items():
        bad = bad | (F.col(col).isNotNull() & F.col(col).try_cast(to).isNull())
    good = df.filter(~bad).withColumns({c: F.col(c).try_cast(to) for c, to in casts.items()})
    return good, df.filter(bad)


def filter_required(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def filter_by_code(df: DataFrame, col: str, code: object) -> DataFrame:
    return df.filter(F.col(col) == F.lit(code))


def first_row(df: DataFrame, *order_by: str) -> DataFrame:
    """The first row by a total order."""
    return df.orderBy(*order_by).limit(1)
