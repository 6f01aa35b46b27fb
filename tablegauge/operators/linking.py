"""Connected parts of a graph of point ids, per setting, and their numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.operators.ranks import running_totals
from tablegauge.session import checkpoint, checkpoint_counting


def connected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(setting, node, root)``: the smallest node id of each connected part.

    Every round hangs each node below its smallest neighbour, follows the pointers to the
    top, and keeps the edges between different tops, which at least halves the number of
    parts that still have edges. ``edges`` is read repeatedly and should be a written table.
    """
    roots = nodes.select("setting", "node", F.col("node").alias("root"))
    edges = edges.where("u <> v")
    rest = 0 if edges.isEmpty() else 1
    while rest:
        both = edges.unionByName(edges.select("setting", F.col("v").alias("u"), F.col("u").alias("v")))
        parent = both.groupBy("setting", "u").agg(F.min("v").alias("p"))
        parent = checkpoint(parent.select("setting", "u", F.least("u", "p").alias("p")))
        moved = 1
        while moved:
            parent, moved = checkpoint_counting(_jump(_jump(_jump(parent))), F.col("moved"))
        lower = parent.where("u <> p")
        up = lower.select("setting", F.col("u").alias("root"), "p")
        roots = roots.join(up, ["setting", "root"], "left")
        roots = roots.select("setting", "node", F.coalesce("p", "root").alias("root"))
        pu = lower.select("setting", "u", F.col("p").alias("pu"))
        pv = lower.select("setting", F.col("u").alias("v"), F.col("p").alias("pv"))
        edges = (
            edges.join(pu, ["setting", "u"], "left")
            .join(pv, ["setting", "v"], "left")
            .select("setting", F.coalesce("pu", "u").alias("u"), F.coalesce("pv", "v").alias("v"))
        )
        edges, rest = checkpoint_counting(edges.where("u <> v").distinct(), F.lit(True))
    return checkpoint(roots)


def _jump(parent: DataFrame) -> DataFrame:
    """Every pointer moved on to where its target points; ``moved`` tells which did."""
    above = parent.where("u <> p").select("setting", F.col("u").alias("p"), F.col("p").alias("q"))
    jumped = parent.select("setting", "u", "p").join(above, ["setting", "p"], "left")
    return jumped.select("setting", "u", F.coalesce("q", "p").alias("p"), F.col("q").isNotNull().alias("moved"))


def numbered_parts(roots: DataFrame) -> DataFrame:
    """``(setting, node, cluster)`` with clusters counted from 0 by their smallest core id."""
    tops = roots.select("setting", "root").distinct().withColumn("one", F.lit(1))
    order = running_totals(tops, "root", ["one"], ["setting"])
    numbers = order.select("setting", "root", (F.col("cum_one") - 1).cast("int").alias("cluster"))
    return checkpoint(roots.join(numbers, ["setting", "root"]).select("setting", "node", "cluster"))
