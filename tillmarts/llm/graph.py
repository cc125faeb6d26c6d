"""Connected components of a large graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmarts.storage import materialize


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, label: the smallest node of its component, for every node of an edge (columns a, b).

    Alternating large-star and small-star steps. Every step is a minimum per node and a join, so a
    node with very many neighbours is reduced before the shuffle and split in the join; each
    round is written out. Self-loops and repeated edges do no harm; no edges give no rows.
    """
    edges = materialize(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    state = _state(edges)
    for _ in range(most_rounds):
        if state[0] == 0:
            break
        edges = materialize(_small_star(_large_star(edges)), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"the components were not settled after {most_rounds} rounds")
    # Settled edges lead from each node to its component's smallest.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    summed = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(summed, F.lit(0))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()
