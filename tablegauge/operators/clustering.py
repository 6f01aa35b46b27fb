"""Scaling, k-means with restarts, k sweeps, PCA and clustering scores."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegauge.functions.arrays import squared_distance
from tablegauge.functions.scalars import number_columns, present
from tablegauge.operators.far_field import FAR_AXES, MOST_CLUSTERS, silhouettes_by_cells
from tablegauge.operators.metrics import adjusted_rand
from tablegauge.operators.slab_sums import LINES, cluster_sums
from tablegauge.session import BROADCAST_ROWS, checkpoint, if_small, spread

# Points per side of a block whose distances one task works out at a time.
BLOCK_ROWS = 16_384
_CHUNK = 512
# Squared distances, relative to the largest, below which products would lose digits.
CANCELLING = 1e-6
# Coordinates above which distances come from matrix products.
PRODUCT_AXES = 4
# Clusters in a block up to which their sums come from matrix products.
PRODUCT_CLUSTERS = 256
# Points of few coordinates above which cells far away are summed as a whole.
CELLS_ABOVE = 8_192
MOST_PAIR_TASKS = 10_000
# Points in one packed matrix of a k-means pass.
PACK_ROWS = 4_096
# Points whose distances to all centres are worked on at a time: these fit a processor's cache.
PASS_ROWS = 1_024
# Tasks of a k-means pass.
MOST_PASS_TASKS = 256
# Relative difference of costs below which two fits count as alike.
SAME_COST = 1e-9


def points_from_columns(df: DataFrame, row_id: str, columns: list[str] | None = None) -> DataFrame:
    """``(id, x)``: the numeric columns other than the id as one array."""
    names = [c for c in number_columns(df) if c != row_id] if columns is None else columns
    return df.select(
        F.col(row_id).cast("bigint").alias("id"),
        F.array(*[present(df, n).cast("double") for n in names]).alias("x"),
    )


def points_from_array(df: DataFrame, row_id: str, name: str) -> DataFrame:
    return df.select(F.col(row_id).cast("bigint").alias("id"), F.col(name).cast("array<double>").alias("x"))


def dimensions(points: DataFrame) -> int:
    first = points.select(F.size("x").alias("d")).first()
    return 0 if first is None else first["d"]


def scale_points(points: DataFrame) -> DataFrame:
    """Every dimension to mean 0 and population deviation 1; constant ones only shifted."""
    vectors = points.select(array_to_vector("x").alias("v"))
    stats = vectors.agg(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s")).first()
    if stats["s"] is None or stats["s"]["count"] == 0:
        return points
    n = stats["s"]["count"]
    mean = stats["s"]["mean"].toArray()
    spread = np.sqrt(stats["s"]["variance"].toArray() * (n - 1) / n)
    spread[spread == 0] = 1.0
    scaled = [(F.col("x")[i] - F.lit(float(m))) / F.lit(float(s)) for i, (m, s) in enumerate(zip(mean, spread))]
    return points.withColumn("x", F.array(*scaled))


def _vectors(points: DataFrame) -> DataFrame:
    return points.withColumn("features", array_to_vector("x"))


def kmeans_models(
    points: DataFrame,
    ks: Iterable[int],
    seeds: Iterable[int] = (42,),
    n_init: int = 10,
    max_iter: int = 300,
    parallelism: int = 4,
) -> dict[tuple[int, int], np.ndarray]:
    """For every k and seed, the centres of the cheapest of ``n_init`` fits.

    The engine draws the first centres of every fit; then all fits move in step, one pass over
    the points for all that still move, so passes do not grow with the number of fits.
    """
    points = spread(points)
    data = _vectors(points).select("features").persist()
    jobs = [(k, seed, seed * 1000 + i) for k in ks for seed in seeds for i in range(n_init)]

    def start(job: tuple[int, int, int]) -> np.ndarray:
        k, _, seed = job
        model = KMeans(k=k, seed=seed, maxIter=0, initMode="k-means||").fit(data)
        return np.array(model.clusterCenters(), dtype=float)

    pool = ThreadPool(max(1, min(parallelism, len(jobs))))
    try:
        starts = pool.map(inheritable_thread_target(data.sparkSession)(start), jobs)
    finally:
        pool.close()
        data.unpersist()
    best: dict[tuple[int, int], tuple[float, np.ndarray]] = {}
    for (k, seed, _), (centers, cost) in zip(jobs, _moved_in_step(points, starts, max_iter)):
        # Fits that end alike differ by rounding; the first of them is taken.
        if (k, seed) not in best or cost < best[k, seed][0] * (1 - SAME_COST):
            best[k, seed] = (cost, centers)
    return {key: centers for key, (_, centers) in best.items()}


def _packed(points: DataFrame) -> DataFrame:
    """``(n, block)``: points as the bytes of matrices, so that a pass moves no single rows."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), PACK_ROWS):
                x = np.stack(frame["x"].iloc[at : at + PACK_ROWS].to_numpy()).astype(float)
                yield pd.DataFrame({"n": [len(x)], "block": [x.tobytes()]})

    return points.select("x").mapInPandas(pack, "n int, block binary")


def _nearest(x: np.ndarray, centers: np.ndarray, sizes: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per group of centres, of the given sizes, the nearest one of each point and its squared distance."""
    # Distances do not change with the origin; one amid the centres keeps products small.
    middle = centers.mean(axis=0)
    x, centers = x - middle, centers - middle
    apart = (centers * centers).sum(axis=1)[None, :] - 2 * (x @ centers.T)
    length = (x * x).sum(axis=1)
    at = 0
    for size in sizes:
        group = apart[:, at : at + size]
        found = group.argmin(axis=1)
        yield found, np.maximum(group[np.arange(len(x)), found] + length, 0.0)
        at += size


def _members_of(x: np.ndarray, centers: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """1 where a centre is the nearest of its group to a point (the first among equals), and each group's cost.

    A row per centre, so that a group's distances lie side by side and no index of the nearest is needed.
    """
    middle = centers.mean(axis=0)
    x, centers = x - middle, centers - middle
    apart = (centers * centers).sum(axis=1)[:, None] - 2 * (centers @ x.T)
    length = (x * x).sum(axis=1)
    member, costs = np.empty(apart.shape), np.empty(len(sizes))
    at = 0
    for g, size in enumerate(sizes):
        group, inside = apart[at : at + size], member[at : at + size]
        least = group.min(axis=0)
        np.equal(group, least, out=inside)
        unclear = np.flatnonzero(inside.sum(axis=0) != 1)
        if len(unclear):
            inside[:, unclear] = 0.0
            inside[group[:, unclear].argmin(axis=0), unclear] = 1.0
        costs[g] = np.maximum(least + length, 0.0).sum()
        at += size
    return member, costs


def _moved_in_step(
    points: DataFrame, starts: list[np.ndarray], max_iter: int, tol: float = 1e-4
) -> list[tuple[np.ndarray, float]]:
    """Centres and cost of every start after the moves of k-means."""
    # A pass sends sums of centres from every task, so tasks follow the cores, not the rows.
    tasks = max(2, min(MOST_PASS_TASKS, points.sparkSession.sparkContext.defaultParallelism))
    blocks = _packed(points).repartition(tasks).persist()
    ended = [(centers, 0.0) for centers in starts]
    moving = list(range(len(starts)))
    try:
        for _ in range(max_iter):
            if not moving:
                break
            centers = [ended[i][0] for i in moving]
            totals, counts, costs = _pass_over(blocks, centers)
            at, still = 0, []
            for i, old, cost in zip(moving, centers, costs):
                part = slice(at, at + len(old))
                at += len(old)
                filled = counts[part, None] > 0
                new = np.where(filled, totals[part] / np.maximum(counts[part, None], 1), old)
                ended[i] = (new, float(cost))
                if (((new - old) ** 2).sum(axis=1) > tol * tol).any():
                    still.append(i)
            moving = still
    finally:
        blocks.unpersist()
    return ended


def _pass_over(blocks: DataFrame, groups: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per centre the sum and number of its points, per group of centres the cost."""
    sizes = [len(g) for g in groups]
    centers = np.concatenate(groups)
    d = centers.shape[1]

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals, counts, costs = np.zeros(centers.shape), np.zeros(len(centers)), np.zeros(len(sizes))
        for frame in frames:
            for block in frame["block"]:
                whole = np.frombuffer(block).reshape(-1, d)
                for at in range(0, len(whole), PASS_ROWS):
                    x = whole[at : at + PASS_ROWS]
                    member, cost = _members_of(x, centers, sizes)
                    totals += member @ x
                    counts += member.sum(axis=1)
                    costs += cost
        yield pd.DataFrame({"totals": [totals.tobytes()], "counts": [counts.tobytes()], "costs": [costs.tobytes()]})

    parts = blocks.mapInPandas(add, "totals binary, counts binary, costs binary").collect()
    totals, counts, costs = (sum(np.frombuffer(p[name]) for p in parts) for name in ("totals", "counts", "costs"))
    return totals.reshape(-1, d), counts, costs


def kmeans(points: DataFrame, k: int, seed: int = 42, n_init: int = 10, parallelism: int = 4) -> DataFrame:
    """``(id, x, label)`` of the cheapest of ``n_init`` k-means fits."""
    model = kmeans_models(points, [k], [seed], n_init, parallelism=parallelism)[k, seed]
    return with_labels(points, [model]).select(*points.columns, F.col("labels")[0].alias("label"))


def with_labels(points: DataFrame, models: list[np.ndarray]) -> DataFrame:
    """``points`` with ``labels``: the nearest of every model's centres, found in one pass."""
    centers, sizes = np.concatenate(models), [len(m) for m in models]

    @F.pandas_udf("array<int>")
    def nearest(x: pd.Series) -> pd.Series:
        if len(x) == 0:
            return pd.Series([], dtype=object)
        found = [f for f, _ in _nearest(np.stack(x.to_numpy()).astype(float), centers, sizes)]
        return pd.Series(list(np.stack(found, axis=1).astype("int32")))

    return points.select("*", nearest("x").alias("labels"))


def choose_k(
    points: DataFrame, ks: Iterable[int] = range(2, 11), seed: int = 42, n_init: int = 10, parallelism: int = 4
) -> DataFrame:
    """``(k, silhouette, davies_bouldin, calinski_harabasz, is_best)`` for every k."""
    points = checkpoint(spread(points))
    models = kmeans_models(points, ks, [seed], n_init, parallelism=parallelism)
    return score_ks(with_labels(points, list(models.values())), [k for k, _ in models])


def score_ks(labelled: DataFrame, ks: list[int]) -> DataFrame:
    """The scores of one labeling per k, with the best silhouette marked."""
    k = F.element_at(F.array(*[F.lit(k) for k in ks]), F.col("variant") + 1)
    return mark_best(cluster_scores(labelled).select(k.alias("k"), *SCORES), "silhouette", "k")


def mark_best(scores: DataFrame, metric: str, order: str) -> DataFrame:
    """Flag the row with the highest metric, the lowest ``order`` among equals."""
    scores = checkpoint(scores)
    best = scores.agg(F.max_by(order, F.struct(F.col(metric), -F.col(order)))).scalar()
    return scores.withColumn("is_best", F.col(order) == best)


def pca_points(points: DataFrame, k: int = 2) -> DataFrame:
    """``(id, pc1, .., pck)``: principal components of the centred points.

    Each component points where its largest loading is positive.
    """
    d = dimensions(points)
    means = points.agg(*[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(d)]).first()
    centred = points.withColumn("x", F.array(*[F.col("x")[i] - F.lit(means[f"m{i}"]) for i in range(d)]))
    data = _vectors(centred)
    model = PCA(k=k, inputCol="features", outputCol="projected").fit(data)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[np.abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    flat = vector_to_array("projected")
    keep = [c for c in points.columns if c != "x"]
    return model.transform(data).select(*keep, *[(flat[j] * signs[j]).alias(f"pc{j + 1}") for j in range(k)])


def noise_share(labels: DataFrame, label: str = "label") -> DataFrame:
    return labels.agg(F.avg((F.col(label) == -1).cast("int")).alias("noise_ratio"))


# Scores take ``(id, x, labels)``: labels holds a cluster per labeling, or null where the
# labeling leaves the point out. Results have one row per labeling, numbered by ``variant``.
SCORES = ("silhouette", "davies_bouldin", "calinski_harabasz")


def members(labelled: DataFrame) -> DataFrame:
    """``(variant, id, x, label)``: one row per point and labeling it is part of."""
    return labelled.select("id", "x", F.posexplode("labels").alias("variant", "label")).where(
        F.col("label").isNotNull()
    )


def one_labeling(clustered: DataFrame) -> DataFrame:
    """``(id, x, label)`` in the form the scores take."""
    return clustered.select("id", "x", F.array("label").alias("labels"))


def _centroids(clustered: DataFrame) -> DataFrame:
    return (
        clustered.groupBy("variant", "label")
        .agg(Summarizer.metrics("mean", "count").summary(array_to_vector("x")).alias("s"))
        .select(
            "variant",
            "label",
            vector_to_array("s.mean").alias("center"),
            F.col("s.count").alias("size"),
        )
    )


def _spreads(clustered: DataFrame, d: int) -> DataFrame:
    """Per cluster: centre, size, mean distance and summed squared distance to the centre."""
    centers = if_small(checkpoint(_centroids(clustered)))
    squared = squared_distance(F.col("x"), F.col("center"), d)
    return (
        clustered.join(centers, ["variant", "label"])
        .withColumn("_sq", squared)
        .groupBy("variant", "label")
        .agg(F.avg(F.sqrt("_sq")).alias("spread"), F.sum("_sq").alias("within"))
        .join(centers, ["variant", "label"])
    )


def davies_bouldin(labelled: DataFrame) -> DataFrame:
    """``(variant, davies_bouldin)``: mean over clusters of the worst ratio of spread to gap."""
    return _davies_bouldin(_spreads(members(labelled), dimensions(labelled)))


def _davies_bouldin(spreads: DataFrame) -> DataFrame:
    rows = spreads.select("variant", F.col("label").cast("bigint").alias("id"), "center", "spread")

    def worst(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        a, b = np.stack(left["x"].to_numpy()), np.stack(right["x"].to_numpy())
        sa, sb = left["weight"].to_numpy(), right["weight"].to_numpy()
        out = np.zeros(len(a))
        for at in range(0, len(a), _CHUNK):
            gap = _distances(a[at : at + _CHUNK], b)
            total = sa[at : at + _CHUNK, None] + sb[None, :]
            # Clusters at one place have no gap to compare; such pairs count as 0.
            ratio = np.divide(total, gap, out=np.zeros_like(total), where=gap > 0)
            ratio[left["id"].to_numpy()[at : at + _CHUNK, None] == right["id"].to_numpy()[None, :]] = 0.0
            out[at : at + _CHUNK] = ratio.max(axis=1)
        return pd.DataFrame({"variant": left["variant"].to_numpy(), "id": left["id"].to_numpy(), "ratio": out})

    entries = rows.select("variant", "id", F.col("center").alias("x"), F.col("spread").alias("weight"))
    largest = entries.groupBy("variant").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    blocks = _block_count(largest, BLOCK_ROWS, 1)
    placed = entries.withColumn("_own", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    ratios = _block_pairs(placed, blocks, ["variant"], worst, "variant int, id bigint, ratio double", symmetric=False)
    return (
        ratios.groupBy("variant", "id")
        .agg(F.max("ratio").alias("ratio"))
        .groupBy("variant")
        .agg(F.avg("ratio").alias("davies_bouldin"))
    )


def calinski_harabasz(labelled: DataFrame) -> DataFrame:
    """``(variant, calinski_harabasz)``: between over within spread per degree of freedom."""
    d = dimensions(labelled)
    return _calinski_harabasz(_spreads(members(labelled), d), d)


def _calinski_harabasz(spreads: DataFrame, d: int) -> DataFrame:
    mean = F.array(*[F.try_divide(F.sum(F.col("center")[i] * F.col("size")), F.sum("size")) for i in range(d)])
    whole = spreads.groupBy("variant").agg(mean.alias("middle"))
    between = F.col("size") * squared_distance(F.col("center"), F.col("middle"), d)
    sums = (
        spreads.join(whole, "variant")
        .groupBy("variant")
        .agg(
            F.sum(between).alias("between"),
            F.sum("within").alias("within"),
            F.count(F.lit(1)).alias("k"),
            F.sum("size").alias("n"),
        )
    )
    ratio = F.try_divide(F.col("between") * (F.col("n") - F.col("k")), F.col("within") * (F.col("k") - 1))
    return sums.select(
        "variant", F.when(F.col("within") == 0, F.lit(1.0)).otherwise(ratio).alias("calinski_harabasz")
    )


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``a`` to all rows of ``b``."""
    if a.shape[1] > PRODUCT_AXES and len(b):
        return _distances_by_products(a, b)
    # Differences first: products of large coordinates would cancel.
    squared = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        gap = a[:, i, None] - b[None, :, i]
        squared += gap * gap
    return np.sqrt(squared)


def _distances_by_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances by one matrix product; differences decide where it would cancel."""
    # Distances do not change with the origin; one amid the points keeps products small.
    middle = b.mean(axis=0)
    ca, cb = a - middle, b - middle
    na, nb = (ca * ca).sum(axis=1), (cb * cb).sum(axis=1)
    left = np.concatenate([-2 * ca, na[:, None], np.ones((len(a), 1))], axis=1)
    right = np.concatenate([cb, np.ones((len(b), 1)), nb[:, None]], axis=1)
    squared = left @ right.T
    i, j = np.nonzero(squared <= CANCELLING * (na.max(initial=0.0) + nb.max()))
    for at in range(0, len(i), 1 << 16):
        part = slice(at, at + (1 << 16))
        gap = a[i[part]] - b[j[part]]
        squared[i[part], j[part]] = np.einsum("ij,ij->i", gap, gap)
    return np.sqrt(squared, out=squared)


def _block_count(rows: int, block_rows: int, parallelism: int) -> int:
    """Blocks to cut the rows into: small enough for a task, enough to keep tasks busy."""
    return max(1, -(-rows // block_rows), min(-(-rows // 256), int(parallelism**0.5) + 1))


def _placed_by_locality(points: DataFrame, block_rows: int) -> tuple[DataFrame, int]:
    """``points`` with a block number ``_own``, and the number of blocks.

    Blocks are runs of slices of the first axis, so that a small cluster mostly lies in one
    block. Every cut value gets a slice of its own; one that ties make too large for a block
    is split by id.
    """
    n = points.count()
    wanted = _block_count(n, block_rows, points.sparkSession.sparkContext.defaultParallelism)
    if wanted == 1:
        return points.withColumn("_own", F.lit(0)), 1
    axis = points.withColumn("_axis", F.col("x")[0])
    probabilities = [i / (4 * wanted) for i in range(1, 4 * wanted)]
    values = axis.approxQuantile("_axis", probabilities, 0.02 / wanted)
    cuts = sorted({c for v in values for c in (v, float(np.nextafter(v, np.inf)))})
    slicer = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="_axis", outputCol="_slice")
    sliced = slicer.transform(axis).withColumn("_slice", F.col("_slice").cast("int"))
    found = dict(sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("n")).collect())

    target = -(-n // wanted)
    starts, parts, blocks, filled = [], [], 0, 0
    for s in range(len(cuts) + 1):
        rows = found.get(s, 0)
        if filled and filled + rows > target:
            blocks, filled = blocks + 1, 0
        starts.append(blocks)
        parts.append(max(1, -(-rows // target)))
        if parts[-1] > 1:
            blocks, filled = blocks + parts[-1], 0
        else:
            filled += rows

    def of_slice(numbers: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in numbers]), F.col("_slice") + 1)

    own = of_slice(starts) + F.pmod(F.xxhash64("id"), of_slice(parts)).cast("int")
    return sliced.withColumn("_own", own).drop("_axis", "_slice"), blocks + (1 if filled else 0)


def _block_pairs(
    placed: DataFrame, blocks: int, groups: list[str], kernel, schema: str, symmetric: bool
) -> DataFrame:
    """Run ``kernel`` over every pair of row blocks of each group.

    The kernel sees two blocks and returns lines per point, never per pair of points. With
    ``symmetric`` each unordered pair of blocks is visited once and the kernel reports for
    both sides; a block that meets itself is sent once.
    """
    last = F.lit(blocks - 1)
    start = F.col("_own") if symmetric else F.lit(0)
    left = placed.select("*", F.explode(F.sequence(start, last)).alias("_j")).withColumnRenamed("_own", "_i")
    stop = F.col("_own") - 1 if symmetric else last
    # Fresh columns, so that the two sides of one frame stay apart.
    again = placed.select(*[F.col(c).alias(c) for c in placed.columns])
    again = again.where(F.col("_own") > 0) if symmetric else again
    right = again.select("*", F.explode(F.sequence(F.lit(0), stop)).alias("_i")).withColumnRenamed("_own", "_j")
    keys = [*groups, "_i", "_j"]
    # The work grows with the square of the rows, so few bytes must not mean few tasks.
    tasks = min(MOST_PAIR_TASKS, blocks * (blocks + 1) // 2 if symmetric else blocks * blocks)
    left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)

    def run(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if symmetric and key[-2] == key[-1]:
            b = a
        if len(a) == 0 or len(b) == 0:
            return pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})
        return kernel(a, b)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, schema)


def silhouettes(labelled: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(variant, silhouette)`` with plain Euclidean distances over all pairs of points.

    Points of few coordinates go by ``far_field``, with results equal to within rounding at 1e-9.
    All labelings share the distances: a block pair is measured once and summed per cluster
    for each labeling. Where clusters are few and points fill several blocks, sums go by ``slab_sums``.
    Elsewhere a cluster that lies wholly in one block is finished there, and only
    the nearest of such clusters is reported; sums are reported for the others and for the
    point's own. Points alone in their cluster score 0.
    """
    sizes = checkpoint(members(labelled).groupBy("variant", "label").agg(F.count(F.lit(1)).alias("size")))
    known: dict[tuple[int, int], int] = {}
    if sizes.count() <= BROADCAST_ROWS:
        known = {(r["variant"], r["label"]): r["size"] for r in sizes.collect()}

    d = dimensions(labelled)
    if known and len(known) <= MOST_CLUSTERS and d <= FAR_AXES and labelled.count() > CELLS_ABOVE:
        return silhouettes_by_cells(labelled, known, d)

    def lines_of(own: np.ndarray, ids: np.ndarray, there: tuple, part: np.ndarray, v: int) -> list[pd.DataFrame]:
        """Lines of the points ``ids`` from their sums to the other block's clusters under one labeling."""
        clusters, _, _, whole, size = there
        if len(ids) == 0 or len(clusters) == 0:
            return []
        of_own = own[:, None] == clusters[None, :]
        finished = whole[None, :] & ~of_own
        rows, columns = np.nonzero(~finished)
        out = [_lines(v, ids[rows], own[rows], clusters[columns], part[rows, columns])]
        if finished.any():
            nearest = np.where(finished, part / size[None, :], np.inf).min(axis=1)
            rows = np.flatnonzero(np.isfinite(nearest))
            out.append(_lines(v, ids[rows], own[rows], np.full(len(rows), np.nan), nearest[rows]))
        return out

    def clusters_of(labels: np.ndarray) -> list:
        """Per labeling: cluster numbers, rows in cluster order, where each starts, whether it
        is complete, and its size."""
        out = []
        for v in range(labels.shape[1]):
            column = labels[:, v]
            inside = ~np.isnan(column)
            clusters, counts = np.unique(column[inside], return_counts=True)
            order = np.argsort(column, kind="stable")[: int(inside.sum())]
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
            total = np.array([known.get((v, int(c)), -1) for c in clusters], dtype=np.float64)
            out.append((clusters, order, starts, total == counts, total))
        return out

    def membership(there: list, rows: int) -> np.ndarray | None:
        """1 where a point is in a cluster, the labelings side by side; none if these are many."""
        if sum(len(t[0]) for t in there) > PRODUCT_CLUSTERS:
            return None
        found = [np.zeros((rows, len(t[0]))) for t in there]
        for member, (clusters, order, starts, _, _) in zip(found, there):
            for c, at in enumerate(np.split(order, starts[1:]) if len(clusters) else []):
                member[at, c] = 1.0
        return np.concatenate(found, axis=1)

    def sums(own: np.ndarray, ids: np.ndarray, there: list, summed: np.ndarray | None, distances: np.ndarray | None):
        """Lines of the points ``ids`` under all labelings, from sums by cluster or from distances."""
        out, at = [], 0
        for v, entry in enumerate(there):
            inside = ~np.isnan(own[:, v])
            n = len(entry[0])
            if inside.any() and n:
                if summed is not None:
                    part = summed[inside, at : at + n]
                else:
                    part = np.add.reduceat(distances[inside][:, entry[1]], entry[2], axis=1)
                out += lines_of(own[inside, v], ids[inside], entry, part, v)
            at += n
        return out

    def kernel(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        xa, xb = np.stack(a["x"].to_numpy()), np.stack(b["x"].to_numpy())
        la = np.array(a["labels"].tolist(), dtype=np.float64)
        lb = np.array(b["labels"].tolist(), dtype=np.float64)
        ia, ib = a["id"].to_numpy(), b["id"].to_numpy()
        same_block = a["_i"].iloc[0] == a["_j"].iloc[0]
        in_a, in_b = clusters_of(la), clusters_of(lb)
        of_a, of_b = membership(in_a, len(a)), membership(in_b, len(b))
        # Sums of the other side come from the same distances.
        back = None if same_block or of_a is None else np.zeros((len(b), of_a.shape[1]))
        out = []
        for at in range(0, len(a), _CHUNK):
            piece = slice(at, at + _CHUNK)
            distances = _distances(xa[piece], xb)
            if same_block:
                distances[ia[piece][:, None] == ib[None, :]] = 0.0
            out += sums(la[piece], ia[piece], in_b, None if of_b is None else distances @ of_b, distances)
            if back is not None:
                back += distances.T @ of_a[piece]
        if back is not None:
            out += sums(lb, ib, in_a, back, None)
        elif not same_block:
            for at in range(0, len(b), _CHUNK):
                piece = slice(at, at + _CHUNK)
                out += sums(lb[piece], ib[piece], in_a, None, _distances(xb[piece], xa))
        return pd.concat(out, ignore_index=True) if out else _lines(0, *[np.empty(0)] * 4)

    def means_of(parts: DataFrame) -> DataFrame:
        """``(variant, id, mates, a, b)``: cluster size and mean distances of every point, from its lines."""
        totals = parts.groupBy("variant", "id", "own", "label").agg(
            F.sum("distance").alias("distance"), F.min("distance").alias("nearest")
        )
        same = F.col("own") == F.col("label")
        b = F.when(F.col("label").isNull(), F.col("nearest")).when(~same, F.col("distance") / F.col("size"))
        return (
            totals.join(if_small(sizes), ["variant", "label"], "left")
            .groupBy("variant", "id")
            .agg(
                F.max(F.when(same, F.col("size"))).alias("mates"),
                F.max(F.when(same, F.try_divide(F.col("distance"), F.col("size") - 1))).alias("a"),
                F.min(b).alias("b"),
            )
        )

    if 0 < len(known) <= PRODUCT_CLUSTERS and labelled.count() > block_rows:
        clusters = sorted(known)
        if labelled.groupBy("id").count().where(F.col("count") > 1).isEmpty():
            # All sums of a point lie together, so its means need no shuffle.
            means = cluster_sums(labelled, clusters, d, block_rows, _distances, [known[c] for c in clusters])
        else:
            means = means_of(cluster_sums(labelled, clusters, d, block_rows, _distances))
    else:
        placed, blocks = _placed_by_locality(labelled.select("id", "x", "labels"), block_rows)
        means = means_of(_block_pairs(placed, blocks, [], kernel, LINES, symmetric=True))
    score = F.when(F.col("mates") == 1, F.lit(0.0)).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    )
    # A silhouette needs at least two clusters.
    return (
        means.withColumn("s", F.when(F.col("b").isNotNull(), score))
        .groupBy("variant")
        .agg(F.avg("s").alias("silhouette"))
    )


def _lines(variant: int, ids: np.ndarray, own: np.ndarray, label: np.ndarray, distance: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "variant": np.full(len(ids), variant, dtype=np.int32),
            "id": ids.astype(np.int64),
            "own": own.astype(np.int32),
            "label": pd.array(label, dtype="Float64").astype("Int32"),
            "distance": distance,
        }
    )


def cluster_scores(labelled: DataFrame) -> DataFrame:
    """``(variant, silhouette, davies_bouldin, calinski_harabasz)`` of every labeling."""
    labelled = checkpoint(labelled.select("id", "x", "labels"))
    d = dimensions(labelled)
    spreads = checkpoint(_spreads(members(labelled), d))
    return (
        silhouettes(labelled)
        .join(_davies_bouldin(spreads), "variant")
        .join(_calinski_harabasz(spreads, d), "variant")
    )


def seed_stability(
    points: DataFrame, k: int, seeds: Iterable[int] = range(42, 47), n_init: int = 10, parallelism: int = 4
) -> DataFrame:
    """``(seed, adjusted_rand)`` of each further seed against the first."""
    seeds = list(seeds)
    models = kmeans_models(points, [k], seeds, n_init, parallelism=parallelism)
    labelled = with_labels(points, [models[k, s] for s in seeds])
    first = F.col("labels")[0]
    pairs = F.array(
        *[
            F.struct(F.lit(s).alias("seed"), first.alias("a"), F.col("labels")[i].alias("b"))
            for i, s in enumerate(seeds)
            if i > 0
        ]
    )
    return adjusted_rand(labelled.select(F.inline(pairs)), "a", "b", ["seed"])


# Names of the stability levels and their bounds.
STABILITY_LEVELS = (("высокую", 0.8), ("умеренную", 0.5))
LOWEST_STABILITY = "низкую"


def stability_level(mean: Column) -> Column:
    (high, above_high), (moderate, above_moderate) = STABILITY_LEVELS
    return F.when(mean > above_high, high).when(mean > above_moderate, moderate).otherwise(LOWEST_STABILITY)


def stability_summary(per_seed: DataFrame) -> DataFrame:
    """``(mean, std, level)`` of the agreement between seeds."""
    stats = per_seed.agg(F.avg("adjusted_rand").alias("mean"), F.stddev_pop("adjusted_rand").alias("std"))
    return stats.withColumn("level", stability_level(F.col("mean")))
