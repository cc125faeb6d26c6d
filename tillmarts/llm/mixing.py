"""Mixing sources to target weights.

Words are counted per source, targets follow from the sources' weights, and target / size is the
rate at which a source is repeated. A document is emitted floor(rate) times, and once more where
a hash of its key falls below the fraction of the rate. The hash depends on key and seed alone,
so reruns agree.

Defined results: a NULL text has size 0; NULL is a source of its own and comes last; a source
without words has target and rate 0, so its documents are not taken; NULL keys share one draw;
repeated rows share a draw too; an empty table gives no rows; further columns are kept by
``mix`` and ignored by ``plan``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmarts.llm.common import WORD, fresh_name, unit_interval
from tillmarts.storage import materialize

WEIGHTS = (5, 2, 1)
TOTAL_PERCENT = 150
MOST_TIMES = 2


def source_targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    percent: int = TOTAL_PERCENT,
    most: int = MOST_TIMES,
) -> DataFrame:
    """source, source_size, target from rows of source and size.

    Sources in code-point order, NULL last, take ``weights`` in turn. ``percent`` of all words is
    shared by weight; no target exceeds ``most`` times its source's size, and the excess is shared
    among the others in the same way. That is a water level: a source is full if its limit per
    weight lies below the level, so one pass in the order of limit / weight finds all full ones.
    The sources are few rows; all sums are whole numbers.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = (F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (turn + 1).cast("int"))
    ranked = per.withColumn("w", weight)
    order = W.orderBy((F.col("source_size") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = ranked.select(
        "*",
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("full_size"),
        F.sum("w").over(after).alias("w_left"),
        F.sum("source_size").over(whole).alias("all_size"),
    )
    # With those before it full, would this one overflow? (100 * level numerator, whole numbers)
    left = F.col("all_size") * percent - F.col("full_size") * (100 * most)
    # Where the two sides are equal both ways give the same target, so doubles are good enough.
    over = left.cast("double") * F.col("w") >= F.col("source_size").cast("double") * (100 * most) * F.col("w_left")
    ranked = ranked.select("*", over.alias("full"), left.alias("left"))
    level = F.min(F.when(~F.col("full"), F.struct("full_size", "left", "w_left"))).over(whole)
    shared = (F.col("level.left") * F.col("w")).cast("double") / (F.col("level.w_left") * 100).cast("double")
    return ranked.withColumn("level", level).select(
        "source",
        "source_size",
        F.when(F.col("full"), (F.col("source_size") * most).cast("double")).otherwise(shared).alias("target"),
    )


def _copies(target: str, source_size: str, key: str, seed: str):
    """Whole copies and the drawn one, from rate = target / source_size."""
    rate = F.when(F.col(source_size) > 0, F.col(target) / F.col(source_size)).otherwise(F.lit(0.0))
    whole = F.floor(rate)
    drawn = unit_interval(F.col(key), seed=seed) < rate - whole
    return (whole + F.when(drawn, 1).otherwise(0)).cast("int")


def plan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: str = "mix",
    **settings,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken (words)."""
    sizes = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    sizes = materialize(sizes, "sizes")  # texts are read once
    targets = source_targets(sizes, **settings).select(
        F.col("source").alias("_source"), "source_size", "target"
    )
    return (
        sizes.join(targets, F.col("source").eqNullSafe(F.col("_source")), "left")
        .withColumn("copies", _copies("target", "source_size", "doc_id", seed))
        .select(
            "doc_id", "source", "size", "source_size", "target", "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: str = "mix",
    **settings,
) -> DataFrame:
    """The mixed documents, each row repeated as often as it is taken, with the columns of ``docs``."""
    sizes = docs.select(
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    name, size, target, times = (fresh_name(docs, n) for n in ("name", "size", "target", "times"))
    targets = materialize(source_targets(sizes, **settings), "targets").select(
        F.col("source").alias(name), F.col("source_size").alias(size), F.col("target").alias(target)
    )
    rows = docs.join(targets, F.col(source).eqNullSafe(F.col(name)), "left")
    rows = rows.withColumn(times, _copies(target, size, key, seed)).filter(F.col(times) > 0)
    repeated = F.explode(F.array_repeat(F.lit(1), F.col(times)))
    return rows.withColumn(name, repeated).select(docs.columns)
