"""Density clustering of points with many coordinates, exact, by a metric index.

Cells say little in many dimensions: a sphere cuts nearly all of them. Here points are
grouped by their nearest pivot and cut into rings of its distance, so that a block is a narrow
range of distances to every pivot. By the triangle inequality two blocks can hold points
within a radius only if their ranges come within it for each pivot; such pairs of blocks are
found by a range join on pivot distances and compared by matrix products. A pair is
reduced to counts, links of a spanning forest, or smallest labels where it is compared;
pairs of points never travel. All settings of a sweep share the distances.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.operators.linking import connected, numbered_parts
from tablegauge.session import checkpoint, even_keys, if_small

PIVOTS = 16
# Points from which the pivots are chosen.
PIVOT_SAMPLE = 1_024
# Points per side of a comparison.
BLOCK_ROWS = 2_048
# Blocks that travel together at most.
SLAB_BLOCKS = 16
# Pairs of slabs that get a task each; more are dealt out by hash.
MOST_TASKS = 10_000
# Rings of one pivot's cell before they are split by hash.
RINGS = 256
# Steps that a range of pivot distances is cut into for the range join.
STEPS = 64
# Rows of a block whose distances are worked out together.
CHUNK = 512
# Pairs of two blocks up to which links are merged as they are; more are put into bits.
FEW_PAIRS = 16_384
# Relative error of a matrix product above which differences decide.
ROUNDING = 1e-9


def pivots_of(points: DataFrame, n: int = PIVOTS) -> np.ndarray:
    """Points far from each other out of a bounded sample: each the farthest from those before it."""
    sample = points.select("x").orderBy(F.xxhash64("id"), "id").limit(PIVOT_SAMPLE).toPandas()
    x = np.stack(sample["x"].to_numpy()).astype(float)
    chosen = [0]
    near = ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < n and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    return x[chosen]


def _pivot_distances(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``(id, x, to, cell, own)``: distances to all pivots, the nearest pivot and the distance to it."""

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            x = np.stack(frame["x"].to_numpy()).astype(float)
            to = np.sqrt(np.stack([((x - p) ** 2).sum(axis=1) for p in pivots], axis=1))
            cell = to.argmin(axis=1)
            own = to[np.arange(len(to)), cell]
            yield pd.DataFrame({"id": frame["id"], "x": list(x), "to": list(to), "cell": cell.astype("int32"), "own": own})

    schema = "id bigint, x array<double>, to array<double>, cell int, own double"
    return points.select("id", "x").mapInPandas(measure, schema)


def metric_blocks(points: DataFrame, n_pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """``(id, x, block)`` and ``(block, cell, lows, highs)``: blocks of bounded size with their ranges of pivot distances.

    A ring that equal distances make too large is split by a hash of the id.
    """
    measured = checkpoint(_pivot_distances(points, pivots_of(points, n_pivots)))
    grid = ", ".join(f"{i / RINGS}D" for i in range(1, RINGS))
    # One row per pivot.
    cuts = measured.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"percentile_approx(own, array({grid}), {16 * RINGS})").alias("cuts")
    )
    ringed = measured.join(F.broadcast(cuts), "cell")
    place = F.size(F.filter("cuts", lambda c: c < F.col("own")))
    rings = F.least(F.lit(RINGS), F.ceil(F.col("n") / block_rows))
    ringed = ringed.withColumn("ring", F.floor(place * rings / RINGS).cast("int")).drop("n", "cuts")
    ringed = checkpoint(ringed)
    sizes = ringed.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n"))
    split = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / block_rows)).cast("bigint")
    # Pivots and rings have fixed bounds, which leaves 48 bits to the splits.
    number = (F.col("cell") * RINGS + F.col("ring")).cast("bigint") * F.lit(1 << 48) + split
    placed = checkpoint(ringed.join(if_small(sizes), ["cell", "ring"]).select("id", "x", "to", "cell", number.alias("block")))
    ends = [f(F.col("to")[i]).alias(f"{n}{i}") for n, f in (("lo", F.min), ("hi", F.max)) for i in range(n_pivots)]
    ranges = placed.groupBy("block", "cell").agg(*ends)
    lists = [F.array(*[f"{n}{i}" for i in range(n_pivots)]).alias(name) for n, name in (("lo", "lows"), ("hi", "highs"))]
    return placed.select("id", "x", "block"), checkpoint(ranges.select("block", "cell", *lists))


def near_blocks(blocks: DataFrame, radius: float, n_pivots: int = PIVOTS) -> DataFrame:
    """``(a, b)`` with ``a <= b``: the pairs of blocks that may hold points within ``radius``.

    The range join asks, for the pivot of ``b``'s cell, which blocks come near the ring of ``b``;
    then the ranges of all pivots must come within the radius. Missing pivots count as near.
    """
    widest = blocks.agg(F.max(F.array_max("highs"))).first()[0] or 0.0
    step = max(radius, widest / STEPS) or 1.0
    steps = lambda low, high: F.sequence(F.floor(low / step), F.floor(high / step))
    slack = radius * (1 + ROUNDING) + ROUNDING
    around = blocks.select(
        F.col("block").alias("a"),
        F.col("lows").alias("a_lows"),
        F.col("highs").alias("a_highs"),
        F.posexplode(F.arrays_zip("lows", "highs")).alias("cell", "span"),
    ).where(F.col("span.lows").isNotNull())
    around = around.select(
        "a", "a_lows", "a_highs", "cell",
        F.explode(steps(F.greatest(F.col("span.lows") - slack, F.lit(0.0)), F.col("span.highs") + slack)).alias("step"),
    )
    own_low, own_high = (F.element_at(c, F.col("cell") + 1) for c in ("lows", "highs"))
    rings = blocks.select(
        F.col("block").alias("b"), F.col("lows").alias("b_lows"), F.col("highs").alias("b_highs"), "cell",
        F.explode(steps(own_low, own_high)).alias("step"),
    )
    met = around.join(rings, ["cell", "step"])
    gap = F.zip_with(
        F.arrays_zip("a_lows", "a_highs"),
        F.arrays_zip("b_lows", "b_highs"),
        lambda a, b: F.greatest(a["a_lows"] - b["b_highs"], b["b_lows"] - a["a_highs"]),
    )
    close = F.forall(gap, lambda g: F.coalesce(g, F.lit(0.0)) <= slack)
    pairs = met.where(close).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return checkpoint(pairs.distinct())


def within(xa: np.ndarray, xb: np.ndarray, radii: Sequence[float]) -> list[np.ndarray]:
    """For every radius which rows of ``xa`` and ``xb`` are within it, the radius included.

    Products decide where they are clear, differences of the coordinates elsewhere.
    """
    # Distances do not change with the origin; one amid the points keeps products small.
    middle = xb.mean(axis=0)
    ca, cb = xa - middle, xb - middle
    na, nb = (ca * ca).sum(axis=1), (cb * cb).sum(axis=1)
    left = np.concatenate([-2 * ca, na[:, None], np.ones((len(ca), 1))], axis=1)
    squared = left @ np.concatenate([cb, np.ones((len(cb), 1)), nb[:, None]], axis=1).T
    unsure = ROUNDING * (na.max() + nb.max())
    out = []
    for radius in radii:
        limit = radius * radius
        hit, loose = squared <= limit - unsure, squared <= limit + unsure
        if np.count_nonzero(hit) != np.count_nonzero(loose):
            i, j = np.nonzero(loose & ~hit)
            for start in range(0, len(i), 1 << 16):
                part = slice(start, start + (1 << 16))
                gap = xa[i[part]] - xb[j[part]]
                hit[i[part], j[part]] = np.einsum("ij,ij->i", gap, gap) <= limit
        out.append(hit)
    return out


def close_pairs(xa: np.ndarray, xb: np.ndarray, radii: Sequence[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(i, j, first)``: the rows of ``xa`` and ``xb`` within the last of the ascending ``radii``, and the first they are within.

    Decided as by ``within``, but distances are looked at once; all else costs by the pairs found.
    """
    middle = xb.mean(axis=0)
    ca, cb = xa - middle, xb - middle
    na, nb = (ca * ca).sum(axis=1), (cb * cb).sum(axis=1)
    left = np.concatenate([-2 * ca, na[:, None], np.ones((len(ca), 1))], axis=1)
    squared = left @ np.concatenate([cb, np.ones((len(cb), 1)), nb[:, None]], axis=1).T
    unsure = ROUNDING * (na.max() + nb.max())
    limits = np.array([r * r for r in radii])
    at = np.flatnonzero(squared <= limits[-1] + unsure)
    i, j = np.divmod(at, len(xb))
    near = squared.reshape(-1)[at]
    # Differences decide where products lie close to a limit.
    unclear = np.flatnonzero((np.abs(near[:, None] - limits[None, :]) <= unsure).any(axis=1))
    for start in range(0, len(unclear), 1 << 16):
        part = unclear[start : start + (1 << 16)]
        gap = xa[i[part]] - xb[j[part]]
        near[part] = np.einsum("ij,ij->i", gap, gap)
    first = np.searchsorted(limits, near).astype(np.int16)
    found = first < len(limits)
    return i[found].astype(np.int32), j[found].astype(np.int32), first[found]


def bits_of(i: np.ndarray, j: np.ndarray, rows: int, columns: int) -> np.ndarray:
    """The pairs ``(i, j)`` as a row of bits per ``i``."""
    hit = np.zeros((rows, columns), dtype=bool)
    hit[i, j] = True
    return np.packbits(hit, axis=1)


def forest(
    across: np.ndarray, back: np.ndarray, of_rows: np.ndarray, of_columns: np.ndarray, rows: np.ndarray, columns: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Links of the ids ``rows`` and ``columns`` to the smallest id of their part of a graph, one per other id.

    ``across`` holds the bits of the columns that a row meets, ``back`` those of the rows of a column; only
    rows and columns marked in ``of_rows`` and ``of_columns`` are in the graph.
    """
    unseen = np.packbits(of_columns)
    waiting = of_rows & (across & unseen).any(axis=1)
    start, end = [], []
    for first in np.flatnonzero(waiting):
        if not waiting[first]:
            continue
        part = []
        front = np.array([first])
        waiting[first] = False
        while len(front):
            part.append(rows[front])
            met = np.bitwise_or.reduce(across[front], axis=0) & unseen
            unseen &= ~met
            met = np.flatnonzero(np.unpackbits(met, count=len(columns)))
            if not len(met):
                break
            part.append(columns[met])
            front = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(back[met], axis=0), count=len(rows)).view(bool) & waiting)
            waiting[front] = False
        ids = np.unique(np.concatenate(part))
        start.append(ids[1:])
        end.append(np.full(len(ids) - 1, ids[0]))
    none = np.empty(0, dtype=np.int64)
    return np.concatenate([none, *start]), np.concatenate([none, *end])


def merged(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links to the smallest id of each connected part of the given links, one per other id."""
    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(ids))
    while (root[a] != root[b]).any():
        low = np.minimum(root[a], root[b])
        for side in (root[a], root[b]):
            np.minimum.at(root, side, low)
        while (root[root] != root).any():
            root = root[root]
    hung = root != np.arange(len(ids))
    return ids[hung], ids[root[hung]]


def _in_slabs(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(block, slab)`` and ``(i, j, met)``: runs of blocks that travel together, and the pairs of blocks of two runs."""
    spark = pairs.sparkSession
    # Blocks are few, one per ``BLOCK_ROWS`` points.
    blocks = pairs.select("a").union(pairs.select("b")).distinct()
    numbers = [r[0] for r in blocks.orderBy("a").collect()]
    n = len(numbers)
    # Large enough that points are sent seldom, enough of them to keep tasks busy.
    slabs = max(1, -(-n // SLAB_BLOCKS), min(n, 2 * int(spark.sparkContext.defaultParallelism**0.5) + 1))
    rows = [(block, at * slabs // n) for at, block in enumerate(numbers)]
    of = spark.createDataFrame(rows, "block bigint, slab int")
    first = F.broadcast(of.select(F.col("block").alias("a"), F.col("slab").alias("i")))
    second = F.broadcast(of.select(F.col("block").alias("b"), F.col("slab").alias("j")))
    # Slabs keep the order of blocks, so i <= j.
    met = pairs.join(first, "a").join(second, "b").groupBy("i", "j").agg(F.collect_list(F.struct("a", "b")).alias("met"))
    met = checkpoint(met)
    # Few bytes may mean much work, so every pair of slabs is a task of its own while these are not too many.
    listed = [(r["i"], r["j"]) for r in met.select("i", "j").collect()]
    keys = even_keys(spark, len(listed)) if len(listed) <= MOST_TASKS else range(len(listed))
    keyed = spark.createDataFrame([(i, j, k) for (i, j), k in zip(listed, keys)], "i int, j int, pair bigint")
    return of, checkpoint(met.join(F.broadcast(keyed), ["i", "j"]))


def _over_pairs(placed: DataFrame, slabs: tuple[DataFrame, DataFrame], compare: Callable, combine: Callable, schema: str) -> DataFrame:
    """Run ``compare`` on the two blocks of every pair; it gives lines per point, not per pair of points.

    Blocks travel in slabs, so a point is sent once per slab it meets; ``combine`` makes one line
    per point of those that the pairs of two slabs give.
    """
    of, met = slabs
    here = placed.join(F.broadcast(of), "block")
    keyed = F.broadcast(met.select("i", "j", "pair"))
    left = here.withColumnRenamed("slab", "i").join(keyed, "i")
    # Fresh columns, so that the two sides of one frame stay apart.
    right = here.select(*[F.col(c).alias(c) for c in here.columns])
    right = right.withColumnRenamed("slab", "j").join(keyed, "j")
    right = right.select(*[F.col(c).alias(c) for c in right.columns])
    tasks = max(1, min(MOST_TASKS, met.count()))
    # The pairs of blocks come as a row of their own, with a block number that no block has.
    left = left.withColumn("met", F.lit(None).cast("array<struct<a: bigint, b: bigint>>"))
    listed = met.select("i", "j", "pair", "met", F.lit(-1).cast("bigint").alias("block"), F.lit(-1).cast("bigint").alias("id"))
    left = left.unionByName(listed, allowMissingColumns=True)
    left, right = left.repartition(tasks, "pair"), right.repartition(tasks, "pair")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({n: [] for n in names})]
        known = a["block"] == -1
        pairs = [p for listed in a["met"][known] for p in listed]
        sides = []
        for frame in (a[~known], b):
            blocks = {}
            for block, part in frame.groupby("block"):
                blocks[block] = (part, np.stack(part["x"].to_numpy()).astype(float))
            sides.append(blocks)
        for pair in pairs:
            one, other = sides[0].get(pair["a"]), sides[1].get(pair["b"])
            if one is not None and other is not None:
                found += compare(one[0], other[0], one[1], other[1], pair["a"] == pair["b"])
        if len(found) == 1:
            return found[0]
        return combine(pd.concat(found[1:], ignore_index=True)[names])[names]

    return left.groupBy("pair").cogroup(right.groupBy("pair")).applyInPandas(run, schema)


def _chunks(n: int) -> Iterator[slice]:
    return (slice(at, at + CHUNK) for at in range(0, n, CHUNK))


def _neighbour_counts(placed: DataFrame, slabs: tuple[DataFrame, DataFrame], radii: list[float]) -> DataFrame:
    """``(id, hits)``: neighbours of each point, itself included, one number per radius."""

    def compare(a, b, xa, xb, same):
        of_a = np.zeros((len(a), len(radii)), dtype=np.int64)
        of_b = np.zeros((len(b), len(radii)), dtype=np.int64)
        for part in _chunks(len(a)):
            i, j, first = close_pairs(xa[part], xb, radii)
            for of, at in ((of_a[part], i), (of_b, j)):
                found = np.bincount(at * len(radii) + first, minlength=of.size).reshape(of.shape)
                of += found.cumsum(axis=1)
        sides = [(a, of_a)] if same else [(a, of_a), (b, of_b)]
        return [pd.DataFrame({"id": frame["id"], **{f"h{e}": n[:, e] for e in range(len(radii))}}) for frame, n in sides]

    columns = [f"h{e}" for e in range(len(radii))]
    add = lambda found: found.groupby("id", as_index=False).sum()
    lines = _over_pairs(placed, slabs, compare, add, "id bigint, " + ", ".join(f"{c} bigint" for c in columns))
    return lines.groupBy("id").agg(F.array(*[F.sum(c) for c in columns]).alias("hits"))


def _stacked(frame: pd.DataFrame, name: str) -> np.ndarray:
    return np.array(frame[name].tolist(), dtype=float)


def _core_links(placed: DataFrame, slabs: tuple[DataFrame, DataFrame], settings: list[tuple[int, int]], radii: list[float]) -> DataFrame:
    """``(setting, u, v)``: links that join core points as their distances do, a forest per pair of blocks."""

    def compare(a, b, xa, xb, same):
        cores_a, cores_b = _stacked(a, "cores"), _stacked(b, "cores")
        ids_a, ids_b = a["id"].to_numpy(), b["id"].to_numpy()
        # Points that no setting has among the core points join nothing.
        of_a, of_b = (np.flatnonzero(c.any(axis=1)) for c in (cores_a, cores_b))
        if not len(of_a) or not len(of_b):
            return []
        xa, xb, ids_a, ids_b, cores_a, cores_b = xa[of_a], xb[of_b], ids_a[of_a], ids_b[of_b], cores_a[of_a] > 0, cores_b[of_b] > 0
        found = []
        for part in _chunks(len(xa)):
            i, j, first = close_pairs(xa[part], xb, radii)
            found.append((i + np.int32(part.start), j, first))
        i, j, first = (np.concatenate(f) for f in zip(*found))
        out = []
        bits: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for s, (e, _) in enumerate(settings):
            hit = first <= e
            if np.count_nonzero(hit) <= FEW_PAIRS:
                joined = hit & cores_a[i, s] & cores_b[j, s]
                u, v = merged(ids_a[i[joined]], ids_b[j[joined]])
            else:
                if e not in bits:
                    near_i, near_j = i[hit], j[hit]
                    bits[e] = bits_of(near_i, near_j, len(xa), len(xb)), bits_of(near_j, near_i, len(xb), len(xa))
                u, v = forest(*bits[e], cores_a[:, s], cores_b[:, s], ids_a, ids_b)
            if len(u):
                out.append(pd.DataFrame({"setting": np.int32(s), "u": u, "v": v}))
        return out

    def join(found: pd.DataFrame) -> pd.DataFrame:
        out = []
        for s, links in found.groupby("setting"):
            u, v = merged(links["u"].to_numpy(), links["v"].to_numpy())
            out.append(pd.DataFrame({"setting": np.int32(s), "u": u, "v": v}))
        return pd.concat(out, ignore_index=True)

    return _over_pairs(placed, slabs, compare, join, "setting int, u bigint, v bigint")


def _reached(placed: DataFrame, slabs: tuple[DataFrame, DataFrame], settings: list[tuple[int, int]], radii: list[float]) -> DataFrame:
    """``(setting, id, reached)``: for points that are no core points the smallest cluster of a core neighbour."""

    def compare(a, b, xa, xb, same):
        of_a, of_b = _stacked(a, "clusters"), _stacked(b, "clusters")
        unknown = np.isnan(np.concatenate([of_a, of_b]))
        # Settings in which some points lack a cluster and others have one.
        asked = np.flatnonzero(unknown.any(axis=0) & ~unknown.all(axis=0))
        if not len(asked):
            return []
        best_a, best_b = np.full(of_a.shape, np.inf), np.full(of_b.shape, np.inf)
        for part in _chunks(len(a)):
            i, j, first = close_pairs(xa[part], xb, radii)
            i += np.int32(part.start)
            for s in asked:
                hit = first <= settings[s][0]
                for own, at, other, met, best in ((of_a, i, of_b, j, best_a), (of_b, j, of_a, i, best_b)):
                    # Only points without a cluster look for one.
                    asking = hit & np.isnan(own[:, s])[at] & ~np.isnan(other[:, s])[met]
                    np.minimum.at(best[:, s], at[asking], other[met[asking], s])
        out = []
        for frame, own, best in [(a, of_a, best_a)] if same else [(a, of_a, best_a), (b, of_b, best_b)]:
            for s in range(len(settings)):
                loose = np.isnan(own[:, s]) & np.isfinite(best[:, s])
                if loose.any():
                    found = {"setting": np.int32(s), "id": frame["id"].to_numpy()[loose], "reached": best[loose, s].astype("int32")}
                    out.append(pd.DataFrame(found))
        return out

    least = lambda found: found.groupby(["setting", "id"], as_index=False).min()
    lines = _over_pairs(placed, slabs, compare, least, "setting int, id bigint, reached int")
    return lines.groupBy("setting", "id").agg(F.min("reached").alias("reached"))


def dbscan_by_pivots(
    points: DataFrame, settings: Sequence[tuple[float, int]], n_pivots: int = PIVOTS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(setting, id, label)`` for every (radius, core size), numbered in the given order; -1 is noise."""
    spark = points.sparkSession
    points = points.where(F.col("x").isNotNull())
    if points.isEmpty():
        return spark.createDataFrame([], "setting int, id bigint, label int")
    radii = sorted({e for e, _ in settings})
    numbered = [(radii.index(e), m) for e, m in settings]
    placed, blocks = metric_blocks(points, n_pivots, block_rows)
    pairs = near_blocks(blocks, radii[-1], n_pivots)
    slabs = _in_slabs(pairs)
    hits = _neighbour_counts(placed, slabs, radii)
    core = F.array(*[F.col("hits")[e] >= m for e, m in numbered])
    placed = checkpoint(placed.join(hits, "id").select("id", "x", "block", core.alias("cores")))
    # Point ids and settings; settings are few.
    each = placed.select("id", F.posexplode("cores").alias("setting", "core"))
    nodes = each.where("core").select("setting", F.col("id").alias("node"))
    links = checkpoint(_core_links(placed, slabs, numbered, radii).distinct())
    clusters = numbered_parts(connected(nodes, links))
    per_point = clusters.groupBy(F.col("node").alias("id")).agg(
        F.map_from_entries(F.collect_list(F.struct("setting", "cluster"))).alias("of")
    )
    chosen = F.array(*[F.try_element_at("of", F.lit(s)) for s in range(len(numbered))]).cast("array<int>")
    known = placed.select("id", "x", "block").join(per_point, "id", "left")
    known = checkpoint(known.select("id", "x", "block", chosen.alias("clusters")))
    reached = _reached(known, slabs, numbered, radii)
    labelled = known.select("id", F.posexplode("clusters").alias("setting", "cluster")).join(reached, ["setting", "id"], "left")
    return labelled.select("setting", "id", F.coalesce("cluster", "reached", F.lit(-1)).cast("int").alias("label"))
