"""Silhouettes of points with one or two coordinates, without a look at all pairs.

Space is cut into square cells until each holds few points. The sum of distances from a point
to a cluster is made of the points of nearby cells, measured one by one, and of cells farther
away than they are wide, where the distance is smooth: there a polynomial of ``NODES``
Chebyshev nodes an axis stands for the distance, with a relative error below 1e-9. A cell gives
each of its clusters a weight per node, and the same weights serve every point far away, so
the work grows with the points and not with their square. Equal points are read together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegauge.session import checkpoint

# Axes up to which cells are few enough.
FAR_AXES = 2
# Clusters of all labelings together that sums are kept for.
MOST_CLUSTERS = 20_000
# Points of a cell that is not cut further.
LEAF_ROWS = 1_024
# Points whose cells are worked on by one task.
GROUP_ROWS = 32_768
NODES = 16
# Halvings of the whole extent at most, and those counted at a time.
DEPTH = 30
LEVELS = 3


class Cells:
    """The tree of cells: codes interleave the bits of the axes, so a cell is a range of codes."""

    def __init__(self, low: np.ndarray, side: float, leaves: list[tuple[int, int, int]]):
        self.low, self.side, self.d = low, side, len(low)
        # (level, cell, points) in the order of codes.
        self.leaves = sorted(leaves, key=lambda c: c[1] << self.d * (DEPTH - c[0]))
        self.starts = np.array([c << self.d * (DEPTH - level) for level, c, _ in self.leaves], dtype=np.int64)
        self.number = {(level, c): i for i, (level, c, _) in enumerate(self.leaves)}
        # Cells that are cut further.
        self.inner = {
            (above, c >> self.d * (level - above)) for level, c, _ in self.leaves for above in range(level)
        }

    def box(self, cell: tuple[int, int]) -> tuple[np.ndarray, float]:
        """Lower corner and side."""
        level, code = cell
        place = [sum(((code >> (self.d * b + k)) & 1) << b for b in range(level)) for k in range(self.d)]
        side = self.side / 2**level
        return self.low + side * np.array(place, dtype=float), side

    def around(self, leaf: int) -> tuple[list[int], list[tuple[int, int]], list[tuple[int, int]]]:
        """Near leaves, cells far from the leaf, and cells far from its points only."""
        low, side = self.box(self.leaves[leaf][:2])
        near, far, half = [], [], []
        stack = [(0, 0)]
        while stack:
            cell = stack.pop()
            other, width = self.box(cell)
            gap = float(np.maximum(other - (low + side), low - (other + width)).max())
            # A hair above, so that rounding of corners does not decide.
            if gap >= max(side, width) * (1 - 1e-9):
                far.append(cell)
            elif gap >= width * (1 - 1e-9):
                half.append(cell)
            elif cell in self.number:
                near.append(self.number[cell])
            else:
                below = [(cell[0] + 1, (cell[1] << self.d) + i) for i in range(1 << self.d)]
                stack += [c for c in below if c in self.inner or c in self.number]
        return near, far, half


def codes(x: np.ndarray, low: np.ndarray, side: float) -> np.ndarray:
    place = np.clip((x - low) / side * 2.0**DEPTH, 0, 2**DEPTH - 1).astype(np.int64)
    out = np.zeros(len(x), dtype=np.int64)
    for b in range(DEPTH):
        for k in range(x.shape[1]):
            out |= ((place[:, k] >> b) & 1) << (x.shape[1] * b + k)
    return out


def _tree(coded: DataFrame, low: np.ndarray, side: float) -> Cells:
    """Cells cut until they hold ``LEAF_ROWS`` points; only crowded cells are counted further."""
    d = len(low)
    spark = coded.sparkSession
    leaves: list[tuple[int, int, int]] = []
    crowded = [0]
    for level in range(0, DEPTH, LEVELS):
        of = F.shiftrightunsigned("code", d * (DEPTH - level))
        held = spark.createDataFrame([(c,) for c in crowded], "above bigint")
        below = coded.select("code", of.alias("above")).join(F.broadcast(held), "above", "left_semi")
        cell = F.shiftrightunsigned("code", d * (DEPTH - level - LEVELS)).alias("cell")
        counts = {level + LEVELS: dict(below.groupBy(cell).count().collect())}
        for up in range(level + LEVELS - 1, level - 1, -1):
            counts[up] = {}
            for c, n in counts[up + 1].items():
                counts[up][c >> d] = counts[up].get(c >> d, 0) + n
        open_cells, crowded = set(counts[level]), []
        for down in range(level, level + LEVELS + 1):
            last = down == level + LEVELS
            here = [c for c in counts[down] if down == level or (c >> d) in open_cells]
            small = [c for c in here if counts[down][c] <= LEAF_ROWS or down == DEPTH]
            leaves += [(down, c, counts[down][c]) for c in small]
            open_cells = set(here) - set(small)
            if last:
                crowded = sorted(open_cells)
        if not crowded:
            break
    return Cells(low, side, leaves)


def _nodes(low: np.ndarray, side: float) -> np.ndarray:
    axis = (1 + np.cos((2 * np.arange(NODES) + 1) * np.pi / (2 * NODES))) / 2
    grid = np.meshgrid(*[low[k] + side * axis for k in range(len(low))], indexing="ij")
    return np.stack([g.ravel() for g in grid], axis=1)


def _basis(x: np.ndarray, low: np.ndarray, side: float) -> np.ndarray:
    """The polynomials that are 1 at one node and 0 at the others, at every point."""
    angle = (2 * np.arange(NODES) + 1) * np.pi / (2 * NODES)
    order = np.arange(NODES)
    scale = np.where(order == 0, 1.0, 2.0) / NODES
    at_nodes = np.cos(np.outer(order, angle)) * scale[:, None]
    out = np.ones((len(x), 1))
    for k in range(x.shape[1]):
        u = np.clip(2 * (x[:, k] - low[k]) / side - 1, -1, 1)
        one = np.cos(np.arccos(u)[:, None] * order[None, :]) @ at_nodes
        out = (out[:, :, None] * one[:, None, :]).reshape(len(x), -1)
    return out


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squared = np.zeros((len(a), len(b)))
    for k in range(a.shape[1]):
        gap = a[:, k, None] - b[None, :, k]
        gap *= gap
        squared += gap
    return np.sqrt(squared, out=squared)


class _Columns:
    """The clusters of all labelings, numbered through."""

    def __init__(self, sizes: dict[tuple[int, int], int]):
        self.variants = sorted({v for v, _ in sizes})
        self.labels = {v: np.array(sorted(c for w, c in sizes if w == v)) for v in self.variants}
        lengths = [len(self.labels[v]) for v in self.variants]
        self.start = dict(zip(self.variants, np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(int)))
        self.size = np.array([sizes[v, c] for v in self.variants for c in self.labels[v].tolist()], dtype=float)

    def of(self, labels: np.ndarray) -> np.ndarray:
        """The column of every point and labeling, -1 where the labeling leaves it out."""
        out = np.full((len(labels), len(self.variants)), -1, dtype=np.int64)
        for i, v in enumerate(self.variants):
            inside = ~np.isnan(labels[:, v])
            out[inside, i] = self.start[v] + np.searchsorted(self.labels[v], labels[inside, v].astype(np.int64))
        return out


def _membership(columns: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The columns that occur, and each point's weight in them."""
    present = np.unique(columns[columns >= 0])
    out = np.zeros((len(columns), len(present)))
    for i in range(columns.shape[1]):
        inside = columns[:, i] >= 0
        out[inside, np.searchsorted(present, columns[inside, i])] = weight[inside]
    return present, out


def _read(frame: pd.DataFrame, columns: _Columns) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = np.stack(frame["x"].to_numpy()).astype(float)
    labels = np.array(frame["labels"].tolist(), dtype=float)
    return x, columns.of(labels), frame["weight"].to_numpy().astype(float)


def _slices(leaf: np.ndarray) -> dict[int, np.ndarray]:
    order = np.argsort(leaf, kind="stable")
    found, starts = np.unique(leaf[order], return_index=True)
    return dict(zip(found.tolist(), np.split(order, starts[1:])))


def _weights(placed: DataFrame, cells: Cells, columns: _Columns) -> DataFrame:
    """``(level, cell, present, held)``: the weight per cluster and node of every cell."""

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        x, of, weight = _read(frame, columns)
        rows = []
        pieces: dict[tuple[int, int], list[np.ndarray]] = {}
        for leaf, at in _slices(frame["leaf"].to_numpy()).items():
            level, cell, _ = cells.leaves[leaf]
            # Cells of fewer than two halvings are never far from any other.
            for up in range(2, level + 1):
                pieces.setdefault((up, cell >> cells.d * (level - up)), []).append(at)
        for cell, parts in pieces.items():
            at = np.concatenate(parts)
            present, member = _membership(of[at], weight[at])
            held = np.zeros((len(present), NODES**cells.d))
            for s in range(0, len(at), 4096):
                part = slice(s, s + 4096)
                held += member[part].T @ _basis(x[at[part]], *cells.box(cell))
            rows.append((*cell, present.tobytes(), held.tobytes()))
        return pd.DataFrame(rows, columns=["level", "cell", "present", "held"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [
            (np.frombuffer(p, dtype=np.int64), np.frombuffer(h).reshape(-1, NODES**cells.d))
            for p, h in zip(frame["present"], frame["held"])
        ]
        present = np.unique(np.concatenate([p for p, _ in parts]))
        held = np.zeros((len(present), NODES**cells.d))
        for p, h in parts:
            held[np.searchsorted(present, p)] += h
        first = frame.iloc[0]
        return pd.DataFrame(
            [(first["level"], first["cell"], present.tobytes(), held.tobytes())], columns=["level", "cell", "present", "held"]
        )

    schema = "level int, cell bigint, present binary, held binary"
    return placed.groupBy("home").applyInPandas(add, schema).groupBy("level", "cell").applyInPandas(merge, schema)


def _scores(sums: np.ndarray, of: np.ndarray, columns: _Columns) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per labeling which points it holds and their silhouettes; NaN if there is one cluster only."""
    for i, v in enumerate(columns.variants):
        rows = np.flatnonzero(of[:, i] >= 0)
        start, n = columns.start[v], len(columns.labels[v])
        own = of[rows, i]
        size = columns.size[own]
        a = sums[rows, own] / np.maximum(size - 1, 1)
        means = sums[rows, start : start + n] / columns.size[None, start : start + n]
        means[np.arange(len(rows)), own - start] = np.inf
        b = means.min(axis=1)
        most = np.maximum(a, b)
        score = np.divide(b - a, most, out=np.zeros(len(rows)), where=(most > 0) & np.isfinite(b))
        score[size == 1] = 0.0
        score[~np.isfinite(b)] = np.nan
        yield v, rows, score


def silhouettes_by_cells(labelled: DataFrame, sizes: dict[tuple[int, int], int], d: int) -> DataFrame:
    """``(variant, silhouette)`` of points with ``d`` coordinates; ``sizes`` by labeling and cluster."""
    spark = labelled.sparkSession
    columns = _Columns(sizes)
    points = checkpoint(labelled.groupBy("x", "labels").agg(F.count(F.lit(1)).alias("weight")))
    ends = points.agg(*[f(F.col("x")[k]) for f in (F.min, F.max) for k in range(d)]).first()
    low, high = np.array(ends[:d], dtype=float), np.array(ends[d:], dtype=float)
    side = float((high - low).max()) or 1.0

    @F.pandas_udf("bigint")
    def code(x: pd.Series) -> pd.Series:
        return pd.Series(codes(np.stack(x.to_numpy()).astype(float), low, side) if len(x) else [], dtype="int64")

    coded = checkpoint(points.withColumn("code", code("x")))
    cells = _tree(coded, low, side)
    group, filled, groups = 0, 0, []
    for _, _, n in cells.leaves:
        if filled and filled + n > GROUP_ROWS:
            group, filled = group + 1, 0
        filled += n
        groups.append(group)
    starts = cells.starts

    @F.pandas_udf("int")
    def leaf_of(code: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(starts, code.to_numpy(), side="right") - 1).astype("int32")

    homes = spark.createDataFrame(list(enumerate(groups)), "leaf int, home int")
    placed = coded.withColumn("leaf", leaf_of("code")).drop("code").join(F.broadcast(homes), "leaf")
    placed = checkpoint(placed.repartition(group + 1, "home"))

    # Which group reads which leaves and cells; all are cells, no points.
    near, far = set(), set()
    for leaf, home in enumerate(groups):
        leaves, whole, half = cells.around(leaf)
        near |= {(other, home) for other in leaves}
        far |= {(*cell, home) for cell in [*whole, *half]}
    readers = spark.createDataFrame(sorted(near), "leaf int, reader int")
    cell_readers = spark.createDataFrame(sorted(far), "level int, cell bigint, reader int")
    sources = placed.join(F.broadcast(readers), "leaf").repartition(group + 1, "reader")
    weights = checkpoint(_weights(placed, cells, columns)).join(F.broadcast(cell_readers), ["level", "cell"])
    weights = weights.repartition(group + 1, "reader")

    def score(frame: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        x, of, weight = _read(frame, columns)
        by_leaf = _slices(frame["leaf"].to_numpy())
        homes = frame["home"].to_numpy()
        reader = frame["reader"].iloc[0]
        members = {leaf: _membership(of[at], weight[at]) for leaf, at in by_leaf.items()}
        by_cell = {
            (level, cell): (np.frombuffer(p, dtype=np.int64), np.frombuffer(h).reshape(-1, NODES**d))
            for level, cell, p, h in zip(held["level"], held["cell"], held["present"], held["held"])
        }
        totals = np.zeros((len(columns.variants), 2))
        for leaf, at in by_leaf.items():
            if homes[at[0]] != reader:
                continue
            box = cells.box(cells.leaves[leaf][:2])
            own_nodes = _nodes(*box)
            near, far, half = cells.around(leaf)
            smooth = np.zeros((len(own_nodes), len(columns.size)))
            for cell in far:
                present, w = by_cell[cell]
                smooth[:, present] += _lengths(own_nodes, _nodes(*cells.box(cell))) @ w.T
            for s in range(0, len(at), LEAF_ROWS):
                part = at[s : s + LEAF_ROWS]
                sums = _basis(x[part], *box) @ smooth
                for cell in half:
                    present, w = by_cell[cell]
                    sums[:, present] += _lengths(x[part], _nodes(*cells.box(cell))) @ w.T
                for other in near:
                    present, member = members[other]
                    sums[:, present] += _lengths(x[part], x[by_leaf[other]]) @ member
                for i, (_, rows, found) in enumerate(_scores(sums, of[part], columns)):
                    totals[i] += (found * weight[part[rows]]).sum(), weight[part[rows]].sum()
        return pd.DataFrame({"variant": columns.variants, "total": totals[:, 0], "n": totals[:, 1]})

    parts = (
        sources.groupBy("reader")
        .cogroup(weights.groupBy("reader"))
        .applyInPandas(score, "variant int, total double, n double")
    )
    mean = F.sum("total") / F.sum("n")
    return parts.where("n > 0").groupBy("variant").agg(F.when(~F.isnan(mean), mean).alias("silhouette"))
