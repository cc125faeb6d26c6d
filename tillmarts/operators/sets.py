"""Unions, id intervals and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmarts.operators.filters import filter_id_intervals
from tillmarts.storage import materialize


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def next_larger(df: DataFrame, col: str, name: str) -> DataFrame:
    """Each distinct id with the next larger one (NULL for the largest).

    A window over all ids would be one task. Instead the ids are cut into contiguous blocks of
    even size by their sampled distribution and written out with their block number; the window
    runs inside blocks, and each block's last id is closed by the first id of the following
    block. Only one row per block takes part in the unpartitioned step.
    """
    ids = df.select(col).filter(F.col(col).isNotNull()).distinct()
    blocks = materialize(
        ids.repartitionByRange(col).withColumn("_block", F.spark_partition_id()), "id-blocks"
    )
    inside = F.lead(col).over(Window.partitionBy("_block").orderBy(col))
    # At most one row per shuffle partition.
    firsts = blocks.groupBy("_block").agg(F.min(col).alias("_first"))
    following = firsts.select(
        "_block", F.lead("_first").over(Window.orderBy("_block")).alias("_following")
    )
    return (
        blocks.withColumn("_inside", inside)
        .join(following, "_block", "left")
        .select(col, F.coalesce("_inside", "_following").alias(name))
    )


def interval_pairs(
    cursors: DataFrame, col: str = "id", first: str = "first_id", last: str = "last_id"
) -> DataFrame:
    """``(id, next id - 1)`` from a cursor list; the largest cursor only closes its predecessor."""
    paired = next_larger(cursors, col, "_next").filter(F.col("_next").isNotNull())
    return paired.select(F.col(col).alias(first), (F.col("_next") - 1).alias(last))


def cut_interval(df: DataFrame, first: Column, last: Column, width: int, name: str) -> DataFrame:
    """Each row once per ``width`` steps from ``first`` to ``last``, with the step's start."""
    return df.withColumn(name, F.explode(F.sequence(first, last, F.lit(width).cast("bigint"))))


def missing_ranges(
    intervals: DataFrame,
    fetched: DataFrame,
    col: str = "id",
    first: str = "first_id",
    last: str = "last_id",
) -> DataFrame:
    """The gaps of the intervals: (first, last, gap_first, gap_last) of each run of ids that was not fetched.

    Gaps lie between a fetched id and the next larger one, so what is shuffled grows with the
    fetched ids, the intervals and the gaps, never with the ids that are missing. Intervals may
    overlap; each has its own gaps.
    """
    bounds = materialize(intervals.select(first, last).distinct().filter(F.col(first) <= F.col(last)), "intervals")
    least, most = bounds.agg(F.min(first), F.max(last)).first()  # two numbers
    if least is None:
        return bounds.select("*", F.col(first).alias("gap_first"), F.col(last).alias("gap_last"))
    inside = fetched.select(F.col(col).cast("bigint").alias("_id")).filter(F.col("_id").between(least, most))
    # An id before all and one behind all, so that the ends have gaps too.
    ends = bounds.sparkSession.createDataFrame([(least - 1,), (most + 1,)], "_id bigint")
    steps = next_larger(inside.unionByName(ends), "_id", "_next")
    gaps = steps.filter(F.col("_next") > F.col("_id") + 1).select(
        (F.col("_id") + 1).alias("_from"), (F.col("_next") - 1).alias("_to")
    )
    gaps = materialize(gaps, "gaps")
    # A gap meets an interval if it begins inside it, or if it holds the interval's first id.
    begun = filter_id_intervals(gaps, bounds, "_from", first, last)
    held = filter_id_intervals(bounds, gaps, first, "_from", "_to").filter(F.col("_from") < F.col(first))
    met = begun.unionByName(held)
    return met.select(
        first, last, F.greatest("_from", first).cast("bigint").alias("gap_first"),
        F.least("_to", last).cast("bigint").alias("gap_last"),
    )


def missing_ids(
    intervals: DataFrame,
    fetched: DataFrame,
    col: str = "id",
    first: str = "first_id",
    last: str = "last_id",
    run: int = 10_000,
) -> DataFrame:
    """Ids inside the intervals that were not fetched.

    Ids are generated inside gaps only. A gap is cut into spans of ``run`` * ``run`` ids, these into runs of
    ``run`` ids and these into ids, each spread over the tasks, so a single wide gap neither becomes
    one long array nor one long task.
    """
    gaps = missing_ranges(intervals, fetched, col, first, last)
    # A fixed number of partitions: the runs are few bytes but many ids, so they must not be
    # coalesced by their size.
    tasks = int(intervals.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    start, stop = F.col("_start"), F.least(F.col("_start") + run - 1, F.col("gap_last"))
    spans = cut_interval(gaps, F.col("gap_first"), F.col("gap_last"), run * run, "_span").repartition(tasks, "_span")
    until = F.least(F.col("_span") + run * run - 1, F.col("gap_last"))
    runs = cut_interval(spans, F.col("_span"), until, run, "_start").repartition(tasks, "_start")
    return runs.select(first, last, F.explode(F.sequence(start, stop)).alias(col))


def sorted_list(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).orderBy(col)


def order_by_desc(df: DataFrame, col: str, *ties: str) -> DataFrame:
    """Sorted by ``col``, largest first. ``ties`` orders equal values, which also lets the range
    partitioning split a value that many rows share."""
    return df.orderBy(F.desc(col), *ties)
