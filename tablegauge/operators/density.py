"""Density clustering (DBSCAN), exact, for one or many (eps, min_samples) settings.

Space is cut into cells whose diagonal is eps, so points of one cell are neighbours without
a look at their distances: a cell with min_samples points is core throughout, and all core
points of a cell are in one cluster. What is left to measure is

* for points of thin cells, their neighbours in nearby cells; cells wholly inside the
  radius are added by their size, and only cells the sphere cuts through are opened;
* between neighbouring core cells, whether any two core points touch; one point per cell
  is tried first, and only cell pairs that are still in different clusters are opened.

Opened cells are read in salted parts of bounded size and reduced to counts or flags in
the same stage. Clusters are the connected parts of the graph of core cells. All settings
run as one job, keyed by setting.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.functions.arrays import squared_distance
from tablegauge.operators.clustering import SCORES, cluster_scores, dimensions
from tablegauge.operators.linking import connected, numbered_parts
from tablegauge.operators.wide_density import dbscan_by_pivots
from tablegauge.session import checkpoint, checkpoint_counting, if_small, spread

NOISE = -1
# Points of one cell that are read together.
PART_ROWS = 4_096
# Axes on which nearby cells are looked up; the rest are checked afterwards.
LOOKUP_AXES = 4
# Axes beyond which a sphere cuts nearly all cells, so that pivots tell more.
CELL_AXES = 6

# The searched radii and core sizes.
EPS_RANGE = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
MIN_SAMPLES_RANGE = (3, 5, 10)


def dbscan(points: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """``(id, label)`` with -1 for noise; clusters are numbered by their first core id."""
    return dbscan_many(points, [(eps, min_samples)]).select("id", "label")


def dbscan_many(points: DataFrame, settings: Sequence[tuple[float, int]]) -> DataFrame:
    """``(setting, id, label)`` for every setting, numbered in the given order.

    Points of more than ``CELL_AXES`` coordinates go by ``wide_density``, with equal results.
    """
    spark = points.sparkSession
    d = dimensions(points)
    if d > CELL_AXES:
        return dbscan_by_pivots(points, settings)
    radii = sorted({e for e, _ in settings})
    caps = {e: max(m for f, m in settings if f == e) for e in radii}

    grid = _cells(spread(points), radii, d)
    cells = grid.groupBy("e", "cell").agg(F.count(F.lit(1)).alias("n"))
    near = checkpoint(_near_cells(cells, radii, d))
    sized = checkpoint(_with_cell_size(grid, cells))
    counted = _neighbour_counts(sized, near, radii, caps, d)

    chosen = spark.createDataFrame(
        [(i, radii.index(e), m) for i, (e, m) in enumerate(settings)], "setting int, e int, min_samples int"
    )
    each = counted.join(F.broadcast(chosen), "e").withColumn("core", F.col("hits") >= F.col("min_samples"))
    each = checkpoint(each.drop("min_samples", "hits"))

    core_cells = (
        each.where("core")
        .groupBy("setting", "e", "cell")
        .agg(
            F.min("id").alias("node"),
            F.count(F.lit(1)).alias("m"),
            # NaN is near to nothing and must not widen the box.
            F.array(*[F.min(F.nanvl(F.col("x")[k], F.lit(None).cast("double"))) for k in range(d)]).alias("low"),
            F.array(*[F.max(F.nanvl(F.col("x")[k], F.lit(None).cast("double"))) for k in range(d)]).alias("high"),
        )
    )
    witness = each.where("core").select("setting", F.col("id").alias("node"), "x")
    core_cells = checkpoint(core_cells.join(witness, ["setting", "node"]))
    roots = _core_clusters(each, core_cells, near, radii, d)
    numbered = numbered_parts(roots)

    core_labels = core_cells.select("setting", "node", "cell").join(numbered, ["setting", "node"])
    return _labels(each, core_labels, near, radii, d)


def _cells(points: DataFrame, radii: list[float], d: int) -> DataFrame:
    """One row per point and radius, with the index of the cell the point lies in."""
    # A hair below eps / sqrt(d), so that rounding cannot part the corners by more than eps.
    sides = [e / math.sqrt(d) * (1 - 1e-9) for e in radii]
    places = [
        F.struct(
            F.lit(i).alias("e"),
            F.array(*[F.floor(F.col("x")[k] / F.lit(s)).cast("bigint") for k in range(d)]).alias("cell"),
        )
        for i, s in enumerate(sides)
    ]
    return points.select("id", "x", F.inline(F.array(*places)))


def _pick(by_radius: list[float], e: str = "e") -> Column:
    """The entry for the radius number in column ``e``."""
    return F.element_at(F.array(*[F.lit(float(v)) for v in by_radius]), F.col(e) + 1)


def _near_cells(cells: DataFrame, radii: list[float], d: int) -> DataFrame:
    """Ordered pairs of different occupied cells that may hold points within the radius.

    Cells meet through blocks of cells, wide enough that neighbours lie in the same or an
    adjacent block; the distance between the boxes then decides.
    """
    reach = math.isqrt(d) + 1
    axes = list(range(min(d, LOOKUP_AXES)))

    def block(shift: Sequence[int]) -> Column:
        return F.array(*[F.floor(F.col("cell")[k] / reach).cast("bigint") + s for k, s in zip(axes, shift)])

    shifts = list(itertools.product((-1, 0, 1), repeat=len(axes)))
    left = cells.select("e", "cell", F.explode(F.array(*[block(s) for s in shifts])).alias("_block"))
    right = cells.select(
        "e", F.col("cell").alias("other"), F.col("n").alias("n_other"), block([0] * len(axes)).alias("_block")
    )
    gap = F.lit(0).cast("bigint")
    for k in range(d):
        steps = F.greatest(F.abs(F.col("cell")[k] - F.col("other")[k]) - 1, F.lit(0))
        gap = gap + steps * steps
    # Box distance in cell sides; eps is sqrt(d) sides.
    close = (gap <= d) & (F.col("cell") != F.col("other"))
    return left.join(right, ["e", "_block"]).where(close).select("e", "cell", "other", "n_other")


def _with_cell_size(grid: DataFrame, cells: DataFrame) -> DataFrame:
    """Points with the size of their cell and the part of the cell they are read in."""
    sized = grid.join(if_small(cells), ["e", "cell"])
    parts = F.ceil(F.col("n") / PART_ROWS)
    return sized.withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))


def _all_parts(size: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), (F.ceil(size / PART_ROWS) - 1).cast("int")))


def _to_box(radii: list[float], d: int, farthest: bool) -> Column:
    """Squared distance of ``x`` to the nearest or farthest point of the box of ``other``."""
    side = _pick([e / math.sqrt(d) * (1 - 1e-9) for e in radii])
    out = F.lit(0.0)
    for k in range(d):
        low = F.col("other")[k].cast("double") * side - F.col("x")[k]
        high = (F.col("other")[k] + 1).cast("double") * side - F.col("x")[k]
        step = F.greatest(F.abs(low), F.abs(high)) if farthest else F.greatest(low, -high, F.lit(0.0))
        out = out + step * step
    return out


def _apart(low: Column, high: Column, d: int) -> Column:
    """Squared distance of the box from ``low`` to ``high`` to that of the other cell's core points."""
    out = F.lit(0.0)
    for k in range(d):
        step = F.greatest(F.col("low_other")[k] - high[k], low[k] - F.col("high_other")[k], F.lit(0.0))
        out = out + step * step
    return out


def _within(radii: list[float], d: int) -> Column:
    eps = _pick(radii)
    return squared_distance(F.col("x"), F.col("y"), d) <= eps * eps


def _neighbour_counts(
    sized: DataFrame, near: DataFrame, radii: list[float], caps: dict[float, int], d: int
) -> DataFrame:
    """``hits``: neighbours of each point, itself included; a lower bound once it is enough."""
    cap = _pick([caps[e] for e in radii])
    eps = _pick(radii)
    thin = sized.where(F.col("n") < cap).select("e", "cell", "id", "x", "n")
    around = thin.join(near, ["e", "cell"])
    inside = _to_box(radii, d, farthest=True) <= eps * eps * (1 - 1e-9)
    touched = _to_box(radii, d, farthest=False) <= eps * eps * (1 + 1e-9)
    around = around.withColumns({"_in": inside, "_cut": ~inside & touched})
    sure = around.groupBy("e", "id").agg(F.sum(F.when(F.col("_in"), F.col("n_other")).otherwise(0)).alias("sure"))
    sure = checkpoint(sure)
    open_points = around.where("_cut").join(sure, ["e", "id"]).where(F.col("n") + F.col("sure") < cap)
    opened = open_points.select("e", "id", "x", F.col("other").alias("cell"), _all_parts(F.col("n_other")).alias("part"))
    there = sized.select("e", "cell", "part", F.col("x").alias("y"))
    measured = (
        opened.join(there, ["e", "cell", "part"])
        .where(_within(radii, d))
        .groupBy("e", "id")
        .agg(F.count(F.lit(1)).alias("seen"))
    )
    zero = F.lit(0).cast("bigint")
    return (
        sized.join(sure, ["e", "id"], "left")
        .join(measured, ["e", "id"], "left")
        .withColumn("hits", F.col("n") + F.coalesce("sure", zero) + F.coalesce("seen", zero))
        .select("e", "cell", "id", "x", "n", "part", "hits")
    )


def _core_clusters(
    each: DataFrame, core_cells: DataFrame, near: DataFrame, radii: list[float], d: int
) -> DataFrame:
    """``(setting, node, root)``: for each core cell the smallest core id of its cluster.

    The box around a cell's core points is often smaller than the cell, so many cell pairs
    need no look at their points.
    """
    a = core_cells.select("setting", "e", "cell", "node", "x", "m", "low", "high")
    b = core_cells.select(
        "setting", "e", F.col("cell").alias("other"), F.col("node").alias("peer"), F.col("x").alias("y"),
        F.col("m").alias("m_other"), F.col("low").alias("low_other"), F.col("high").alias("high_other"),
    )
    eps = _pick(radii)
    reachable = _apart(F.col("low"), F.col("high"), d) <= eps * eps * (1 + 1e-9)
    pairs = near.join(a, ["e", "cell"]).join(b, ["setting", "e", "other"]).where("node < peer").where(reachable)
    pairs = checkpoint(pairs.withColumn("touch", _within(radii, d)).drop("x", "y", "n_other", "low", "high"))
    nodes = core_cells.select("setting", "node")
    sure = pairs.where("touch").select("setting", F.col("node").alias("u"), F.col("peer").alias("v"))
    roots = connected(nodes, sure)

    # Only pairs the first round left apart are opened, and of them only points in reach.
    left = roots.select("setting", "node", F.col("root").alias("ru"))
    right = roots.select("setting", F.col("node").alias("peer"), F.col("root").alias("rv"))
    apart = pairs.where("not touch").join(left, ["setting", "node"]).join(right, ["setting", "peer"]).where("ru <> rv")
    apart, n_apart = checkpoint_counting(apart, F.lit(True))
    if n_apart == 0:
        return roots
    core = each.where("core").select("setting", "e", "cell", "id", "x", "part", "n")
    reach = _apart(F.col("x"), F.col("x"), d) <= eps * eps * (1 + 1e-9)
    opened = apart.select("setting", "e", "cell", "other", "ru", "rv", "low_other", "high_other")
    from_u = core.join(opened, ["setting", "e", "cell"]).where(reach)
    size = each.select("setting", F.col("cell").alias("other"), F.col("n").alias("n_other")).distinct()
    from_u = from_u.join(size, ["setting", "other"])
    from_u = from_u.select(
        "setting", "e", "x", "ru", "rv", F.col("other").alias("cell"), _all_parts(F.col("n_other")).alias("part")
    )
    to_v = core.select("setting", "e", "cell", "part", F.col("x").alias("y"))
    joined = (
        from_u.join(to_v, ["setting", "e", "cell", "part"]).where(_within(radii, d)).select("setting", "ru", "rv")
    )
    links = joined.groupBy("setting", "ru", "rv").agg(F.lit(1).alias("one"))
    links = checkpoint(links.select("setting", F.col("ru").alias("u"), F.col("rv").alias("v")))
    tops = roots.select("setting", F.col("root").alias("node")).distinct()
    merged = connected(tops, links).select("setting", F.col("node").alias("root"), F.col("root").alias("top"))
    return checkpoint(
        roots.join(merged, ["setting", "root"]).select("setting", "node", F.col("top").alias("root"))
    )


def _labels(each: DataFrame, core_labels: DataFrame, near: DataFrame, radii: list[float], d: int) -> DataFrame:
    """Core points take their cell's cluster, others the smallest cluster of a core neighbour."""
    own = core_labels.select("setting", "cell", "cluster")
    here = each.join(if_small(own), ["setting", "cell"], "left")
    loose = each.where("not core").select("setting", "e", "cell", "id", "x")
    sizes = each.where("core").groupBy("setting", "cell").agg(F.max("n").alias("n_other"))
    targets = own.join(sizes, ["setting", "cell"]).select(
        "setting", F.col("cell").alias("other"), "cluster", "n_other"
    )
    eps = _pick(radii)
    around = loose.join(near.drop("n_other"), ["e", "cell"]).join(targets, ["setting", "other"])
    around = around.where(_to_box(radii, d, farthest=False) <= eps * eps * (1 + 1e-9))
    opened = around.select(
        "setting", "e", "id", "x", "cluster", F.col("other").alias("cell"), _all_parts(F.col("n_other")).alias("part")
    )
    there = each.where("core").select("setting", "cell", "part", F.col("x").alias("y"))
    touched = (
        opened.join(there, ["setting", "cell", "part"])
        .where(_within(radii, d))
        .groupBy("setting", "id")
        .agg(F.min("cluster").alias("reached"))
    )
    label = F.when(F.col("core"), F.col("cluster")).otherwise(F.least("cluster", "reached"))
    return here.join(touched, ["setting", "id"], "left").select(
        "setting", "id", F.coalesce(label, F.lit(NOISE)).cast("int").alias("label")
    )


def dbscan_sweep(
    points: DataFrame,
    eps_range: Sequence[float] = EPS_RANGE,
    min_samples_range: Sequence[int] = MIN_SAMPLES_RANGE,
    max_noise: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All settings with their scores on clustered points, and all labelings.

    The first frame has ``(setting, eps, min_samples, n_labels, noise_ratio, silhouette,
    is_best)``. Settings with two or fewer distinct labels, noise counted as one, get no
    score. The best has the highest silhouette, the first setting among equals; no row is
    best if none qualifies. ``max_noise`` can rule out settings with a larger noise share.
    """
    spark = points.sparkSession
    settings = list(itertools.product(eps_range, min_samples_range))
    labels = checkpoint(dbscan_many(points, settings))
    frame = spark.createDataFrame(
        [(i, e, m) for i, (e, m) in enumerate(settings)], "setting int, eps double, min_samples int"
    )
    shape = labels.groupBy("setting").agg(
        F.count_distinct("label").alias("n_labels"), F.avg((F.col("label") == NOISE).cast("int")).alias("noise_ratio")
    )
    shape = checkpoint(frame.join(F.broadcast(shape), "setting"))
    fits = F.col("n_labels") > 2
    if max_noise is not None:
        fits = fits & (F.col("noise_ratio") <= max_noise)
    scored = [r["setting"] for r in shape.where(fits).select("setting").orderBy("setting").collect()]
    kept = labels.where(F.col("setting").isin(scored) & (F.col("label") != NOISE))
    # One entry per setting at most, so the lists stay short.
    by_setting = F.map_from_entries(F.collect_list(F.struct("setting", "label")))
    per_point = kept.groupBy("id").agg(by_setting.alias("_by_setting"))
    chosen = F.array(*[F.try_element_at("_by_setting", F.lit(s)) for s in scored]).cast("array<int>")
    labelled = per_point.join(points, "id").select("id", "x", chosen.alias("labels"))
    setting = F.element_at(F.array(*[F.lit(s) for s in scored]).cast("array<int>"), F.col("variant") + 1)
    scores = cluster_scores(labelled).select(setting.alias("setting"), *SCORES) if scored else None
    if scores is None:
        empty = ", ".join(f"{c} double" for c in SCORES)
        scores = spark.createDataFrame([], f"setting int, {empty}")
    table = checkpoint(shape.join(F.broadcast(scores), "setting", "left"))
    # A later setting must be strictly better, and better than -1.
    best = (
        table.where("silhouette > -1")
        .agg(F.max_by("setting", F.struct(F.col("silhouette"), -F.col("setting"))))
        .scalar()
    )
    table = table.withColumn("is_best", F.coalesce(F.col("setting") == best, F.lit(False)))
    return table.orderBy("setting"), labels
