"""Connected components of a graph given by its links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.session import checkpoint


def _nearest(links: DataFrame) -> DataFrame:
    """The smallest of each node ``a`` and its neighbours ``b``."""
    return links.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (
        both.join(_nearest(both), "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    low = _nearest(links)
    moved = links.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(low.select("a", F.col("low").alias("b"))).where(F.col("a") != F.col("b"))


def _mark(links: DataFrame) -> tuple:
    """What tells one set of links from another."""
    # Sums of two halves of a hash stay inside a long.
    halves = [F.sum(F.pmod(F.xxhash64(F.lit(k), "a", "b"), F.lit(1 << 31))) for k in (1, 2)]
    return tuple(links.agg(F.count(F.lit(1)), *halves).first())


def components(links: DataFrame) -> DataFrame:
    """The root of every linked node as ``(node, root)``: the smallest node reachable.

    ``links`` has two columns of one orderable type. Links of a node with itself count as
    none, nulls and repetitions are left out, no link gives no row. A node
    with very many links is grouped by partial minima and joined by a join that the engine
    can split, so it needs no task of its own.
    """
    left, right = links.columns
    known = links.where(F.col(left).isNotNull() & F.col(right).isNotNull())
    now = known.select(F.greatest(left, right).alias("a"), F.least(left, right).alias("b"))
    now = checkpoint(now.where(F.col("a") != F.col("b")).distinct())
    seen = _mark(now)
    while seen[0]:
        now = checkpoint(_small_star(_large_star(now).distinct()).distinct())
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", F.col("b").alias("root")).distinct()
    )
