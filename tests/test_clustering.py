import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from tablegauge import session
from tablegauge.operators import clustering, density, metrics


def make_points(spark, x):
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(x)]
    return spark.createDataFrame(rows, "id bigint, x array<double>")


def brute_dbscan(x, eps, min_samples):
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    near = d2 <= eps * eps
    core = near.sum(axis=1) >= min_samples
    labels = np.full(len(x), -1)
    cluster = 0
    for i in range(len(x)):
        if not core[i] or labels[i] != -1:
            continue
        labels[i] = cluster
        queue = [i]
        while queue:
            p = queue.pop()
            if not core[p]:
                continue
            for q in np.flatnonzero(near[p]):
                if labels[q] == -1:
                    labels[q] = cluster
                    queue.append(q)
        cluster += 1
    return labels


def brute_silhouette(x, labels):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    out = []
    for i in range(len(x)):
        mates = labels == labels[i]
        if mates.sum() == 1:
            out.append(0.0)
            continue
        a = d[i, mates].sum() / (mates.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {labels[i]})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def brute_davies_bouldin(x, labels):
    ks = sorted(set(labels))
    c = np.array([x[labels == k].mean(axis=0) for k in ks])
    s = np.array([np.sqrt(((x[labels == k] - c[i]) ** 2).sum(axis=1)).mean() for i, k in enumerate(ks)])
    worst = []
    for i in range(len(ks)):
        worst.append(max((s[i] + s[j]) / np.linalg.norm(c[i] - c[j]) for j in range(len(ks)) if j != i))
    return float(np.mean(worst))


def brute_calinski(x, labels):
    ks = sorted(set(labels))
    m = x.mean(axis=0)
    between = sum((labels == k).sum() * ((x[labels == k].mean(axis=0) - m) ** 2).sum() for k in ks)
    within = sum(((x[labels == k] - x[labels == k].mean(axis=0)) ** 2).sum() for k in ks)
    return between * (len(x) - len(ks)) / (within * (len(ks) - 1))


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(5)
    centers = np.array([[0, 0], [4, 0], [0, 4], [2, 2]])
    x = np.concatenate([rng.normal(c, 0.5, (60, 2)) for c in centers] + [rng.uniform(-3, 7, (60, 2))])
    return x[rng.permutation(len(x))]


@pytest.mark.parametrize("dims", [1, 2, 3, 5])
def test_dbscan_matches_brute_force(spark, dims, monkeypatch):
    monkeypatch.setattr(density, "PART_ROWS", 16)
    rng = np.random.default_rng(dims)
    # A third of the points sits in one small spot, the rest is spread out.
    x = np.concatenate([rng.normal(0, 0.05, (80, dims)), rng.normal(0, 1.0, (160, dims))])
    x = x[rng.permutation(len(x))]
    settings = [(e * math.sqrt(dims), m) for e in (0.05, 0.15, 0.4) for m in (3, 5, 10)]
    got = density.dbscan_many(make_points(spark, x), settings).toPandas()
    for s, (eps, m) in enumerate(settings):
        labels = got[got.setting == s].sort_values("id").label.to_numpy()
        assert labels.tolist() == brute_dbscan(x, eps, m).tolist(), (eps, m)


def test_dbscan_follows_a_chain(spark):
    x = np.array([[i * 0.9, 0.0] for i in range(60)] + [[i * 0.9, 50.0] for i in range(40)])
    got = density.dbscan(make_points(spark, x), 1.0, 2).toPandas().sort_values("id").label.tolist()
    assert got == [0] * 60 + [1] * 40


def test_dbscan_opens_cells_whose_first_points_do_not_touch(spark, monkeypatch):
    monkeypatch.setattr(density, "PART_ROWS", 4)
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 3, (300, 2))
    radii = (0.12, 0.2, 0.3)
    got = density.dbscan_many(make_points(spark, x), [(eps, 3) for eps in radii]).toPandas()
    for s, eps in enumerate(radii):
        labels = got[got.setting == s].sort_values("id").label.tolist()
        assert labels == brute_dbscan(x, eps, 3).tolist()


def test_connected_parts(spark):
    nodes = spark.createDataFrame([(0, i) for i in range(40)] + [(1, i) for i in range(5)], "setting int, node bigint")
    edges = spark.createDataFrame(
        [(0, i, i + 1) for i in range(19)] + [(0, 39 - i, 38 - i) for i in range(10)] + [(1, 4, 2)],
        "setting int, u bigint, v bigint",
    )
    got = {(r.setting, r.node): r.root for r in density.connected(nodes, edges).collect()}
    assert all(got[0, i] == 0 for i in range(20))
    assert all(got[0, i] == i for i in range(20, 29))
    assert all(got[0, i] == 29 for i in range(29, 40))
    assert got[1, 4] == 2 and got[1, 3] == 3


@pytest.mark.parametrize("block_rows", [40, 10_000])
def test_scores_match_brute_force(spark, blobs, block_rows):
    rng = np.random.default_rng(0)
    labelings = [rng.integers(0, 4, len(blobs)), (blobs[:, 0] > 2).astype(int)]
    lone = np.zeros(len(blobs), dtype=int)
    lone[:150], lone[150] = 1, 2
    labelings.append(lone)
    rows = [(i, [float(c) for c in blobs[i]], [int(lab[i]) for lab in labelings]) for i in range(len(blobs))]
    frame = spark.createDataFrame(rows, "id bigint, x array<double>, labels array<int>")
    sil = {r.variant: r.silhouette for r in clustering.silhouettes(frame, block_rows).collect()}
    rest = {r.variant: r for r in clustering.cluster_scores(frame).collect()}
    for v, lab in enumerate(labelings):
        assert sil[v] == pytest.approx(brute_silhouette(blobs, lab), abs=1e-9)
        assert rest[v].davies_bouldin == pytest.approx(brute_davies_bouldin(blobs, lab), abs=1e-9)
        assert rest[v].calinski_harabasz == pytest.approx(brute_calinski(blobs, lab), rel=1e-9)


def test_silhouette_of_partial_labelings(spark, blobs):
    lab = (blobs[:, 0] > 2).astype(int)
    keep = blobs[:, 1] > 1
    rows = [
        (i, [float(c) for c in blobs[i]], [int(lab[i]), int(lab[i]) if keep[i] else None]) for i in range(len(blobs))
    ]
    frame = spark.createDataFrame(rows, "id bigint, x array<double>, labels array<int>")
    sil = {r.variant: r.silhouette for r in clustering.silhouettes(frame, 50).collect()}
    assert sil[0] == pytest.approx(brute_silhouette(blobs, lab), abs=1e-9)
    assert sil[1] == pytest.approx(brute_silhouette(blobs[keep], lab[keep]), abs=1e-9)


def test_scaling_uses_population_deviation(spark):
    x = np.array([[1.0, 5.0], [2.0, 5.0], [4.0, 5.0]])
    got = np.array([r.x for r in clustering.scale_points(make_points(spark, x)).orderBy("id").collect()])
    assert np.allclose(got[:, 0], (x[:, 0] - x[:, 0].mean()) / x[:, 0].std())
    assert np.allclose(got[:, 1], 0.0)


def test_kmeans_finds_blobs_and_best_k(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.2, (40, 2)) for c in ([0, 0], [5, 0], [0, 5])])
    points = make_points(spark, x)
    table = clustering.choose_k(points, range(2, 5), n_init=2).toPandas().set_index("k")
    assert table.index[table.is_best].tolist() == [3]
    labels = clustering.kmeans(points, 3, n_init=2).toPandas().sort_values("id").label.to_numpy()
    truth = np.repeat([0, 1, 2], 40)
    assert len(set(zip(labels, truth))) == 3
    assert table.loc[3, "silhouette"] == pytest.approx(brute_silhouette(x, truth), abs=1e-9)


def test_seed_stability(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.2, (30, 2)) for c in ([0, 0], [5, 0])])
    per_seed = clustering.seed_stability(make_points(spark, x), 2, range(42, 45), n_init=2)
    assert [r.adjusted_rand for r in per_seed.collect()] == [1.0, 1.0]
    row = clustering.stability_summary(per_seed).first()
    assert (row["mean"], row["std"], row["level"]) == (1.0, 0.0, "высокую")


def test_pca_matches_eigenvectors(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(200, 3)) @ np.diag([3.0, 1.0, 0.2]) + 7
    got = clustering.pca_points(make_points(spark, x)).toPandas().sort_values("id")
    c = x - x.mean(axis=0)
    _, _, vt = np.linalg.svd(c, full_matrices=False)
    for j in range(2):
        v = vt[j] * np.sign(vt[j][np.abs(vt[j]).argmax()])
        assert np.allclose(got[f"pc{j + 1}"], c @ v, atol=1e-8)


def brute_rand(a, b):
    table = pd.crosstab(pd.Series(a), pd.Series(b)).to_numpy()
    pairs = lambda n: n * (n - 1) / 2
    both, ra, rb = pairs(table).sum(), pairs(table.sum(axis=1)).sum(), pairs(table.sum(axis=0)).sum()
    expected = ra * rb / pairs(len(a))
    return (both - expected) / ((ra + rb) / 2 - expected)


def test_adjusted_rand(spark):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 4, 200), rng.integers(0, 3, 200)
    frame = spark.createDataFrame(pd.DataFrame({"a": a, "b": b}))
    assert metrics.adjusted_rand(frame, "a", "b").first()[0] == pytest.approx(brute_rand(a, b))
    same = frame.select("a", (F.col("a") + 10).alias("b"))
    assert metrics.adjusted_rand(same, "a", "b").first()[0] == 1.0
    one = frame.select(F.lit(1).alias("a"), F.lit(1).alias("b"))
    assert metrics.adjusted_rand(one, "a", "b").first()[0] == 1.0


def test_dbscan_sweep_picks_best_silhouette(spark, blobs):
    points = make_points(spark, blobs)
    eps, ms = (0.2, 0.4), (3, 8)
    table, labels = density.dbscan_sweep(points, eps, ms)
    rows = table.toPandas()
    best, expected = -1.0, None
    for i, (e, m) in enumerate((e, m) for e in eps for m in ms):
        lab = brute_dbscan(blobs, e, m)
        row = rows[rows.setting == i].iloc[0]
        assert row.n_labels == len(set(lab))
        assert row.noise_ratio == pytest.approx((lab == -1).mean())
        if len(set(lab)) <= 2:
            assert math.isnan(row.silhouette)
            continue
        score = brute_silhouette(blobs[lab != -1], lab[lab != -1])
        assert row.silhouette == pytest.approx(score, abs=1e-9)
        if score > best:
            best, expected = score, i
    assert rows.index[rows.is_best].tolist() == [expected]


def test_silhouette_with_ties_and_many_small_clusters(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = np.concatenate([np.tile([[1.0, 2.0]], (90, 1)), rng.uniform(-5, 5, (150, 2))])
    small = np.concatenate([np.zeros(90, dtype=int), 1 + (x[90:, 0] * 3).astype(int) + 20 * (x[90:, 1] * 3).astype(int)])
    rows = [(i, [float(c) for c in x[i]], [int(small[i]), i % 2]) for i in range(len(x))]
    frame = spark.createDataFrame(rows, "id bigint, x array<double>, labels array<int>")
    want = [brute_silhouette(x, small), brute_silhouette(x, np.arange(len(x)) % 2)]
    for known in (200_000, 0):
        monkeypatch.setattr(clustering, "BROADCAST_ROWS", known)
        got = {r.variant: r.silhouette for r in clustering.silhouettes(frame, 32).collect()}
        assert [got[0], got[1]] == pytest.approx(want, abs=1e-9)


def test_fits_move_in_step_and_end_as_the_engines(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(c, 0.6, (50, 2)) for c in ([0, 0], [4, 0], [0, 4])]) + 1000
    points = make_points(spark, x).coalesce(1)
    passes = []
    inner = clustering._pass_over
    monkeypatch.setattr(clustering, "_pass_over", lambda blocks, groups: passes.append(len(groups)) or inner(blocks, groups))
    found = clustering.kmeans_models(points, [2, 3], [7, 9], n_init=3)
    # One pass serves all fits, not one job per fit and move.
    assert passes[0] == 12 and len(passes) <= 60 and sum(passes) > 2 * len(passes)
    vectors = clustering._vectors(points).select("features").persist()
    for (k, seed), centers in found.items():
        fits = [KMeans(k=k, seed=seed * 1000 + i, maxIter=300, tol=1e-4).fit(vectors) for i in range(3)]
        best = min(fits, key=lambda m: m.summary.trainingCost)
        assert centers[centers[:, 0].argsort()] == pytest.approx(
            np.array(sorted(map(list, best.clusterCenters()))), abs=1e-6
        )
    labels = clustering.with_labels(points, list(found.values())).orderBy("id").collect()
    for v, centers in enumerate(found.values()):
        nearest = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert [r["labels"][v] for r in labels] == nearest.tolist()


def test_wide_distances_by_products(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(1e4, 1, (300, 24))
    x[100:140], x[140:150] = x[:40], x[0] + 1e-7
    plain = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.allclose(clustering._distances_by_products(x[:120], x), plain[:120], rtol=1e-7, atol=1e-14)
    lab = [rng.integers(0, 4, len(x)), np.arange(len(x)) // 7]
    frame = spark.createDataFrame(
        [(i, [float(c) for c in x[i]], [int(lab[0][i]), int(lab[1][i])]) for i in range(len(x))],
        "id bigint, x array<double>, labels array<int>",
    )
    # Both ways to sum: by products where clusters are few, in cluster order elsewhere.
    for most in (256, 0):
        monkeypatch.setattr(clustering, "PRODUCT_CLUSTERS", most)
        got = {r.variant: r.silhouette for r in clustering.silhouettes(frame, 64).collect()}
        assert [got[0], got[1]] == pytest.approx([brute_silhouette(x, lab[0]), brute_silhouette(x, lab[1])], abs=1e-8)


def test_equal_centres_share_no_point():
    """A point between equal centres belongs to the first; every group gives each point to one centre."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 2))
    sizes = [3, 2, 4]
    groups = [x[[0, 0, 1]], x[[2, 3]], x[[4, 5, 5, 5]]]
    member, costs = clustering._members_of(x, np.concatenate(groups), sizes)
    at = 0
    for centers, cost in zip(groups, costs):
        squared = ((x[:, None, :] - centers[None]) ** 2).sum(axis=2)
        inside = member[at : at + len(centers)]
        assert (inside.sum(axis=0) == 1).all()
        assert (inside.argmax(axis=0) == squared.argmin(axis=1)).all()
        assert cost == pytest.approx(squared.min(axis=1).sum())
        at += len(centers)


def test_rows_of_one_file_are_dealt_to_all_cores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tablegauge.session.SPREAD_ROWS", 100)
    spark.range(5_000).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    held = session.spread(one).groupBy(F.spark_partition_id()).count().collect()
    assert len(held) == spark.sparkContext.defaultParallelism
    assert max(r["count"] for r in held) < 2 * 5_000 / len(held)
    assert session.spread(one.limit(100)).count() == 100


def test_cells_apart_are_not_opened(spark, monkeypatch):
    """Points on lines farther apart than the radius, in cells that are not: no points of other lines are read."""
    rng = np.random.default_rng(5)
    x = np.stack([np.repeat([0.0, 1.4, 2.8], 200), rng.uniform(0, 0.5, 600)], axis=1)
    points = make_points(spark, x)
    read = []
    counting = density.checkpoint_counting

    def count(df, condition):
        out = counting(df, condition)
        read.append(out[1])
        return out

    monkeypatch.setattr(density, "checkpoint_counting", count)
    got = [r["label"] for r in density.dbscan(points, 1.0, 5).orderBy("id").collect()]
    assert got == brute_dbscan(x, 1.0, 5).tolist()
    assert read == [0]
